"""Key filters and joins with more hot keys than may be broadcast."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import sluice as S
from sluice.operators.skew import KeyFilter, join_unique
from sluice.sources.scratch import materialize


def test_filter_marks_every_key_and_few_others(spark):
    keys = spark.range(0, 3000).select(F.col("id").alias("k"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"))
    marks = KeyFilter(keys, ["k", "t"], 3000)
    asked = spark.range(0, 30000).select(F.col("id").alias("k"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"))
    got = {r.k for r in marks.mark(asked, "m").where("m").collect()}
    assert got >= set(range(3000))
    assert len(got) - 3000 <= 3 * marks.false_share * 27000 + 30
    nulls = spark.createDataFrame([(1, None), (None, "t1")], "k long, t string")
    assert marks.mark(nulls, "m").where("m").count() == 0


def test_filter_keeps_its_size(spark):
    keys = spark.range(0, 5000).select(F.col("id").alias("k"))
    marks = KeyFilter(keys, ["k"], 5000, max_words=100)
    assert marks.table.count() <= 100 and marks.words == 100
    assert marks.mark(keys, "m").where("m").count() == 5000
    assert KeyFilter(keys.where("k < 0"), ["k"], 0).mark(keys, "m").where("m").count() == 0


def _hot(rows, names, least):
    return materialize(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > least))


@pytest.mark.parametrize("bounds", [(1000, 1 << 20), (3, 1 << 20), (1, 1 << 20), (0, 0)])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_join_matches_a_plain_join_under_any_bound(spark, how, bounds):
    # Keys 0..9 are hot by falling degree, 3 and 7 have no partner; the others are cold.
    rows = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 2 == 0, F.col("id") % 10).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    one = spark.range(0, 4000).where("id not in (3, 6)").select(F.col("id").alias("k"), F.concat(F.lit("p"), F.col("id")).alias("p"))
    got = join_unique(rows, one, ["k"], how, _hot(rows, ["k"], 100), 100, *bounds)
    want = rows.join(one, "k", how)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(map(tuple, want.collect()))


@pytest.mark.parametrize("how", ["left", "left_semi"])
def test_hot_keys_beyond_the_bounds_are_spread_over_tasks(spark, how):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 40000, 1, 4).select((F.col("id") % 4).alias("k"), F.col("id").alias("v"))
        one = spark.range(0, 4).select(F.col("id").alias("k"), (F.col("id") * 10).alias("p"))
        got = join_unique(rows, one, ["k"], how, _hot(rows, ["k"], 500), 500, 0, 0)
        assert got.count() == 40000 and (how == "left_semi" or got.where("p <> k * 10 or p is null").isEmpty())
        assert got.agg(F.countDistinct("v")).first()[0] == 40000
        tasks = [r.n for r in got.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert max(tasks) < 10000  # a plain join gives a whole key, 10,000 rows, to one task
    finally:
        for k in settings:
            spark.conf.unset(k)


def _nodes(plan):
    """The nodes of an executed plan, its query stages included."""
    kind = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else []
    yield plan
    for child in inner or [plan.children().apply(i) for i in range(plan.children().size())]:
        yield from _nodes(child)


def test_few_copies_of_few_very_hot_keys(spark):
    # Each key is copied for its own rows, and next to no other key is taken for a hot one.
    rows = spark.range(0, 40_020, 1, 4).select(F.when(F.col("id") < 40_000, F.col("id") % 4).otherwise(100).alias("k"), F.col("id").alias("v"))
    one = spark.range(0, 200_000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("p"))
    got = join_unique(rows, one, ["k"], "left", _hot(rows, ["k"], 10), 10, 0, 0)
    assert sum(r.p == r.k * 10 for r in got.collect()) == 40_020
    made = [n.metrics().apply("numOutputRows").value() for n in _nodes(got._jdf.queryExecution().executedPlan())
            if n.getClass().getSimpleName() == "GenerateExec"]
    assert made and max(made) <= 200_000 + 4 * 1000 + 1000


@pytest.mark.parametrize("bounds", [(1000, 1 << 20), (0, 0)])
def test_join_of_keys_of_two_number_types(spark, bounds):
    rows = spark.range(0, 4000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"), F.col("id").alias("v"))
    one = spark.range(0, 3000).select(F.when(F.col("id") == 5, (1 << 32) + 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("p"))
    got = join_unique(rows, one, ["k"], "left", _hot(rows, ["k"], 50), 50, *bounds)
    want = rows.join(one, "k", "left")
    assert got.schema["k"] == rows.schema["k"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_dedup_beyond_the_key_bound_moves_no_single_rows(spark):
    df = spark.range(0, 20000).select(F.when(F.col("id") < 4000, F.col("id") % 1000).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    got = S.dedup(df, ["k"], order_by=["v"], strategy="duplicated", max_duplicate_keys=200, count_col="n")
    assert {(r.k, r.v, r.n) for r in got.collect()} == {(i, i, 4) for i in range(1000)} | {(i, i, 1) for i in range(4000, 20000)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "__bits" in plan
    # No use in a filter that is full: every row is aggregated.
    full = S.dedup(df, ["k"], order_by=["v"], strategy="duplicated", max_duplicate_keys=2)
    assert full.count() == 17000 and "Union" not in full._jdf.queryExecution().optimizedPlan().toString()


def test_orphans_and_lookups_with_hot_keys_beyond_the_bounds(spark):
    child = spark.range(0, 9000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("x"), (F.col("id") % 2).cast("string")))
        .when(F.col("id") % 3 == 1, F.concat(F.lit("p"), (F.col("id") % 40).cast("string")))
        .when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("q"), F.col("id"))).alias("fk"), F.col("id").alias("c"))
    parent = spark.range(0, 30).select(F.concat(F.lit("p"), F.col("id")).alias("pk"), F.col("id").alias("name"))
    want = {r.c for r in child.join(parent, F.col("fk") == F.col("pk"), "left_anti").collect()}
    got = S.orphans(child, parent, "fk", parent_key="pk", max_broadcast_keys=0, hot_key_rows=50)
    assert sorted(r.c for r in got.collect()) == sorted(want)
    found = S.lookup_first(child, parent, "fk", ["name"], parent_key="pk", max_broadcast_rows=0, hot_key_rows=50)
    plain = child.join(parent.withColumnRenamed("pk", "fk"), "fk", "left")
    assert Counter(map(tuple, found.select("c", "fk", "name").collect())) == Counter(map(tuple, plain.select("c", "fk", "name").collect()))


def test_lookup_copies_few_parents_for_very_hot_keys(spark):
    # As lookup_hot_beyond_bounds: every hot key is over the bound, some have no parent. Copies are a part of the rows, not of their square.
    child = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("c"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 7 - 2).when(F.col("id") % 13 == 1, None).otherwise(F.col("id") % 20_000).alias("fk"))
    parent = spark.range(0, 20_000).select(F.col("id").alias("pk"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    found = S.lookup_first(child, parent, "fk", ["name"], parent_key="pk", max_broadcast_rows=2, hot_key_rows=20)
    assert Counter(map(tuple, found.select("c", "fk", "name").collect())) == Counter(
        map(tuple, child.join(parent.withColumnRenamed("pk", "fk"), "fk", "left").select("c", "fk", "name").collect()))
    rows = found.collect()
    made = [n.metrics().apply("numOutputRows").value() for n in _nodes(found._jdf.queryExecution().executedPlan())
            if n.getClass().getSimpleName() == "GenerateExec"]
    assert len(rows) == 60_000 and made and max(made) <= 20_000 + 20_000 // 20 + 1000
