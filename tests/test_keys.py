"""Dedup, distinct values and keys, lookups."""

from pyspark.sql import functions as F

import sluice as S


def test_dedup_keeps_first_by_order_then_all_columns(spark):
    df = spark.createDataFrame(
        [("K1", 3, "z"), ("K1", 1, "y"), ("K1", 1, "x"), ("K2", 5, "a"), (None, 1, "n1"), (None, 2, "n2")],
        "k string, o int, v string")
    got = sorted((tuple(r) for r in S.dedup(df, ["k"], order_by=["o"]).collect()), key=str)
    assert got == sorted([("K1", 1, "x"), ("K2", 5, "a"), (None, 1, "n1")], key=str)
    last = {r.k: r.o for r in S.dedup(df, ["k"], order_by=["o"], keep="last").collect()}
    assert last == {"K1": 3, "K2": 5, None: 2}
    assert S.dedup(df, ["k"]).columns == ["k", "o", "v"]


def test_dedup_independent_of_partitioning(spark):
    df = spark.range(0, 5000).selectExpr("id % 97 AS k", "id", "CAST(id * 7 % 13 AS STRING) AS v")
    a = sorted(tuple(r) for r in S.dedup(df.repartition(1), ["k"]).collect())
    b = sorted(tuple(r) for r in S.dedup(df.repartition(16, "v"), ["k"]).collect())
    assert a == b and len(a) == 97


def test_dedup_exact_duplicates(spark):
    df = spark.createDataFrame([("P1", "A"), ("P1", "A"), ("P2", "B")], "patient_id string, site string")
    assert S.dedup(df, ["patient_id"]).count() == 2


def test_distinct_values_and_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    assert sorted(S.distinct_values(df, "c").collect(), key=str) == sorted([("a",), (None,), ("b",)], key=str)
    assert sorted(r.c for r in S.distinct_keys(df, "c").collect()) == ["a", "b"]


def test_lookup_first_never_multiplies(spark):
    child = spark.createDataFrame([("V1", "P1"), ("V2", "P2"), ("V3", "P3")], "visit_id string, patient_id string")
    parent = spark.createDataFrame([("P1", "SITE_B", 2), ("P1", "SITE_A", 1), ("P2", "SITE_C", 1)],
                                   "pid string, site_id string, o int")
    got = {r.visit_id: r.site_id for r in
           S.lookup_first(child, parent, "patient_id", ["site_id"], parent_key="pid", order_by=["o"]).collect()}
    assert got == {"V1": "SITE_A", "V2": "SITE_C", "V3": None}


def test_lookup_constant(spark):
    df = spark.createDataFrame([("ALT",), ("CREATININE",), ("XYZ",)], "t string")
    table = {"ALT": {"unit": "U/L", "low": 7, "high": 56}, "CREATININE": {"unit": "mg/dL", "low": 0.6, "high": 1.3}}
    got = [tuple(r) for r in df.select("t", *S.lookup_constant("t", table, ["unit", "low", "high"])).collect()]
    assert got == [("ALT", "U/L", 7.0, 56.0), ("CREATININE", "mg/dL", 0.6, 1.3), ("XYZ", None, None, None)]


def test_dedup_count_col(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    got = {r.k: (r.v, r.n) for r in S.dedup(df, ["k"], count_col="n").collect()}
    assert got == {"a": (1, 2), "b": (3, 1), None: (4, 1)}
    keys_only = {r.k: r.n for r in S.dedup(df.select("k"), ["k"], count_col="n").collect()}
    assert keys_only == {"a": 2, "b": 1, None: 1}


def test_lookup_first_null_keys_and_large_parent_paths(spark):
    child = spark.range(0, 600).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id % 50 END AS k")
    parent = spark.range(0, 40).selectExpr("id AS pk", "CONCAT('n', CAST(id AS STRING)) AS name")
    want = {r.id: r.name for r in S.lookup_first(child, parent, "k", ["name"], parent_key="pk").collect()}
    assert want[0] == "n7" and want[1] is None and want[2] == "n2" and want[47] is None  # 47 % 50 = 47 > 39
    for max_rows, hot in [(5, 50), (5, 10_000), (0, 0)]:
        got = S.lookup_first(child, parent, "k", ["name"], parent_key="pk",
                             max_broadcast_rows=max_rows, hot_key_rows=hot)
        assert got.count() == 600
        assert {r.id: r.name for r in got.collect()} == want


def test_dedup_single_column_matches_struct_form(spark):
    df = spark.createDataFrame([("a", None), ("a", 3), ("b", 5), ("b", 2), ("c", None)], "k string, v long")
    fast = {r.k: r.v for r in S.dedup(df, ["k"]).collect()}
    slow = {r.k: r.v for r in S.dedup(df.withColumn("w", F.lit(1)), ["k"]).collect()}
    assert fast == slow == {"a": None, "b": 2, "c": None}
    assert {r.k: r.v for r in S.dedup(df, ["k"], keep="last").collect()} == {"a": 3, "b": 5, "c": None}


def test_dedup_strategies_agree(spark):
    df = spark.range(0, 3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 11 = 0 THEN NULL ELSE CAST(id % 1700 AS STRING) END AS k",
        "id % 5 AS o", "CAST(id AS STRING) AS v")
    def rows(x):
        return sorted((tuple(r) for r in x.collect()), key=str)
    want = rows(S.dedup(df, ["k"], ["o"], strategy="shuffle", count_col="n"))
    assert rows(S.dedup(df, ["k"], ["o"], count_col="n")) == want
    assert rows(S.dedup(df, ["k"], ["o"], count_col="n", small_rows=0)) == want
    assert rows(S.dedup(df, ["k"], ["o"], count_col="n", strategy="duplicated")) == want
    assert rows(S.dedup(df, ["k"], ["o"], count_col="n", small_rows=0, max_duplicate_keys=0)) == want
    unique = df.where("k IS NOT NULL").dropDuplicates(["k"])
    # Nothing duplicated: the rows pass as they are.
    assert rows(S.dedup(unique, ["k"], strategy="duplicated")) == rows(unique)


def test_dedup_with_map_column(spark):
    df = spark.createDataFrame(
        [("a", 2, {"x": 1}), ("a", 1, {"y": 2}), ("b", 5, {"z": 3})], "k string, o int, m map<string,int>")
    got = {r.k: (r.o, r.m) for r in S.dedup(df, ["k"], ["o"]).collect()}
    assert got == {"a": (1, {"y": 2}), "b": (5, {"z": 3})}
