"""Foreign-key orphans: null keys, duplicate parents, composite keys, all plans."""

import pytest

import sluice as S

STRATEGIES = ["auto", "keys", "direct"]


def child_parent(spark):
    child = spark.createDataFrame(
        [("V1", "P1"), ("V2", "P9999"), ("V3", None), ("V4", "P2"), ("V5", "P2"), ("V6", " P1")],
        "visit_id string, patient_id string",
    )
    parent = spark.createDataFrame([("P1", "A"), ("P1", "A"), ("P2", "B"), (None, "C")], "patient_id string, site string")
    return child, parent


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_orphans_null_is_orphan(spark, strategy):
    child, parent = child_parent(spark)
    got = sorted(r.visit_id for r in S.orphans(child, parent, "patient_id", strategy=strategy).collect())
    assert got == ["V2", "V3", "V6"]  # unknown, null and untrimmed keys; parent duplicates do not multiply


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_orphans_null_not_orphan(spark, strategy):
    child, parent = child_parent(spark)
    got = sorted(r.visit_id for r in S.orphans(child, parent, "patient_id", null_is_orphan=False,
                                               strategy=strategy).collect())
    assert got == ["V2", "V6"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_orphans_plus_matched_is_children(spark, strategy):
    child, parent = child_parent(spark)
    orph = S.orphans(child, parent, "patient_id", strategy=strategy)
    matched = child.join(parent.select("patient_id").distinct(), "patient_id", "left_semi")
    assert orph.count() + matched.count() == child.count()
    assert orph.unionByName(matched).distinct().count() == child.count()


def test_keys_strategy_shuffled_semi_join_path(spark):
    child, parent = child_parent(spark)
    got = sorted(r.visit_id for r in S.orphans(child, parent, "patient_id", strategy="keys",
                                               max_broadcast_keys=0).collect())
    assert got == ["V2", "V3", "V6"]


def test_keys_strategy_hot_key_split(spark):
    """Missing set too large to broadcast: hot missing keys are matched map-only."""
    child = spark.range(0, 3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS fk")
    parent = spark.range(0, 2000).selectExpr("id * 2 AS pk")
    want = sorted(r.id for r in S.orphans(child, parent, "fk", parent_key="pk", strategy="direct").collect())
    for max_keys, hot in [(3, 10), (0, 10), (3, 5000)]:
        got = sorted(r.id for r in S.orphans(child, parent, "fk", parent_key="pk", strategy="keys",
                                             max_broadcast_keys=max_keys, hot_key_rows=hot).collect())
        assert got == want


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_composite_key_and_renamed_parent(spark, strategy):
    child = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, None, "c"), (3, 1, "d")], "o long, l int, id string")
    parent = spark.createDataFrame([(1, 1), (1, 2), (3, 2)], "po long, pl int")
    got = sorted(r.id for r in S.orphans(child, parent, ["o", "l"], parent_key=["po", "pl"], strategy=strategy).collect())
    assert got == ["c", "d"]


def test_foreign_key_issues_shape(spark):
    child, parent = child_parent(spark)
    got = sorted(tuple(r) for r in S.foreign_key_issues(
        child, parent, "patient_id", "visit_id", "visits", parent_name="patients").collect())
    assert got[0] == ("visits", "V2", "patient_id", "INVALID_FOREIGN_KEY",
                      "patient_id does not exist in patients dataset", "HIGH")
    assert [g[1] for g in got] == ["V2", "V3", "V6"]


def test_hot_key_child(spark):
    """A third of the child on one key, plus many null keys: same answer in all plans."""
    child = spark.range(0, 3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS fk")
    parent = spark.range(0, 2000).selectExpr("id * 2 AS pk")
    expect = None
    for strategy in STRATEGIES:
        got = sorted(r.id for r in S.orphans(child, parent, "fk", parent_key="pk", strategy=strategy).collect())
        expect = expect or got
        assert got == expect
    assert len(expect) == 1000 + 1000 + sum(1 for i in range(3000) if i % 3 == 2 and (i % 2 == 1 or i >= 4000))


def test_auto_large_parent_paths(spark):
    """auto with a parent over the broadcast bound: distinct keys, then broadcast or the split plan."""
    child = spark.range(0, 3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS fk")
    parent = spark.range(0, 4000).selectExpr("(id % 2000) * 2 AS pk")  # every key twice
    want = sorted(r.id for r in S.orphans(child, parent, "fk", parent_key="pk", strategy="direct").collect())
    for max_keys, hot in [(2500, 10), (10, 10), (10, 5000), (0, 10)]:
        got = sorted(r.id for r in S.orphans(child, parent, "fk", parent_key="pk", strategy="auto",
                                             max_broadcast_keys=max_keys, hot_key_rows=hot).collect())
        assert got == want


def test_argument_errors(spark):
    child, parent = child_parent(spark)
    with pytest.raises(ValueError):
        S.orphans(child, parent, ["patient_id", "visit_id"], parent_key="patient_id")
    with pytest.raises(ValueError):
        S.orphans(child, parent, "patient_id", strategy="nope")


def test_text_key_against_numeric_parent(spark):
    """Text that is no number is an orphan under every plan, and keeps its text."""
    child = spark.createDataFrame([(1, "5"), (2, "abc"), (3, None), (4, "7"), (5, " 5 ")], "id long, fk string")
    parent = spark.createDataFrame([(5,), (6,)], "pk long")
    for kw in ({"strategy": "auto"}, {"strategy": "keys"}, {"strategy": "direct"}, {"max_broadcast_keys": 0},
               {"max_broadcast_bytes": 0}):
        got = sorted((r.id, r.fk) for r in S.orphans(child, parent, "fk", parent_key="pk", **kw).collect())
        assert got == [(2, "abc"), (3, None), (4, "7")]
        kept = S.orphans(child, parent, "fk", parent_key="pk", null_is_orphan=False, **kw).collect()
        assert sorted(r.id for r in kept) == [2, 4]
    numbers = spark.createDataFrame([(1, 5), (2, 9)], "id long, fk long")
    texts = spark.createDataFrame([("5",), ("x",)], "pk string")
    assert [r.id for r in S.orphans(numbers, texts, "fk", parent_key="pk").collect()] == [2]


def test_key_size_counts_text_bytes(spark):
    from sluice.operators.integrity import key_size

    df = spark.createDataFrame([("ab", 1), ("é", 2), (None, 3)], "s string, n long")
    assert key_size(df, ["n"]) == (3, 24)
    assert key_size(df, ["s"]) == (3, 3 * 16 + 4)
