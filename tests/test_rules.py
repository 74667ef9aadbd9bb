"""Row rules, fused rules, unique rule."""

from pyspark.sql import functions as F

import sluice as S
from sluice.operators.rules import InvalidCastRule, MissingRule, PredicateRule


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, v) for v in t))


def meds(spark):
    return spark.createDataFrame(
        [("M1", -10, "x"), ("M2", 5, "1.5"), ("M2", 5, "1.5"), ("M3", None, "bad"), (None, -1, None)],
        "medication_id string, dose int, v string",
    ).withColumn("v_num", S.to_double("v"))


def test_predicate_rule_null_is_false(spark):
    got = rows(S.row_rule_issues(meds(spark), "medications", ["medication_id"],
                                 [PredicateRule("dose", "dose < 0", "Dose cannot be negative")]))
    assert got == [
        ("medications", None, "dose", "INVALID_BUSINESS_VALUE", "Dose cannot be negative", "HIGH"),
        ("medications", "M1", "dose", "INVALID_BUSINESS_VALUE", "Dose cannot be negative", "HIGH"),
    ]


def test_fused_rules_equal_separate_rules(spark):
    df = meds(spark)
    rules = [PredicateRule("dose", F.col("dose") < 0, "neg"), MissingRule("dose"),
             InvalidCastRule("v", "v_num"), MissingRule("v", severity="HIGH")]
    fused = rows(S.row_rule_issues(df, "m", ["medication_id"], rules))
    separate = sorted(sum((rows(S.row_rule_issues(df, "m", ["medication_id"], [r])) for r in rules), []),
                      key=lambda t: tuple((v is not None, v) for v in t))
    assert fused == separate
    # M1 neg + bad cast, M3 missing dose + bad cast, null key neg + missing v
    assert len(fused) == 6


def test_duplicated_bad_row_gives_two_issues(spark):
    df = spark.createDataFrame([("P1", None), ("P1", None), ("P2", 1990)], "patient_id string, birth_year int")
    got = rows(S.row_rule_issues(df, "patients", ["patient_id"], [MissingRule("birth_year", "Missing birth_year value")]))
    assert len(got) == 2 and got[0][1] == "P1"


def test_unique_rule_one_issue_per_key_null_key_is_a_group(spark):
    df = spark.createDataFrame([("V1",), ("V1",), ("V1",), ("V2",), (None,), (None,)], "visit_id string")
    got = rows(S.unique_issues(df, "visits", S.UniqueRule(("visit_id",))))
    assert [g[1] for g in got] == [None, "V1"]
    assert got[1] == ("visits", "V1", "visit_id", "DUPLICATE_RECORD", "Duplicate visit_id detected", "HIGH")


def test_duplicate_keys_composite(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a long, b int")
    assert rows(S.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]


def test_issue_summary(spark):
    df = meds(spark)
    issues = S.union_issues([
        S.row_rule_issues(df, "m", ["medication_id"], [PredicateRule("dose", "dose < 0", "neg")]),
        S.unique_issues(df, "m", S.UniqueRule(("medication_id",))),
    ])
    assert rows(S.issue_summary(issues)) == [("DUPLICATE_RECORD", "HIGH", 1), ("INVALID_BUSINESS_VALUE", "HIGH", 2)]
    assert rows(S.issue_summary(issues, ["dataset_name", "issue_type", "severity"]))[0][0] == "m"


def test_duplicate_keys_by_hash_match_the_plain_plan(spark):
    import sluice as S

    df = spark.range(0, 3000).selectExpr(
        "case when id % 5 = 0 then 'text ' || id % 50 when id % 7 = 0 then null else 'own ' || id end as t", "case when id % 11 = 0 then null else id % 3 end as k")
    want = sorted(map(str, S.duplicate_keys(df, ["t", "k"]).collect()))
    for bound in (2_000_000, 3, 1):
        assert sorted(map(str, S.duplicate_keys(df, ["t", "k"], "hashed", bound).collect())) == want
    assert sorted(map(str, S.duplicate_keys(df, [F.upper("t").alias("u")], "hashed").collect())) == sorted(map(str, S.duplicate_keys(df, [F.upper("t").alias("u")]).collect()))
    assert S.duplicate_keys(df.limit(0), ["t"], "hashed").count() == 0
    rule = S.UniqueRule(("t",))
    assert sorted(map(str, S.unique_issues(df, "d", rule, "hashed").collect())) == sorted(map(str, S.unique_issues(df, "d", rule).collect()))
