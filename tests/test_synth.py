"""Synthesis: seeded, independent of partitioning, defects in place."""

from pyspark.sql import functions as F

from sluice.operators import synth


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_patients_independent_of_partitioning(spark):
    a = synth.patients(spark, spark.range(1, 101, numPartitions=1))
    b = synth.patients(spark, spark.range(1, 101, numPartitions=8))
    assert rows(a) == rows(b)
    assert a.count() == 101


def test_defects_and_domains(spark):
    p = {r.patient_id: r for r in synth.patients(spark).collect()}
    assert p["P0006"].sex == "Female" and p["P0021"].birth_year is None
    assert p["P0041"].site_id == "site_a" and p["P0031"].enrollment_date == "15/03/2025"
    others = [r for k, r in p.items() if k not in synth.PATIENT_DEFECTS]
    assert {r.site_id for r in others} <= set(synth.SITES)
    assert all(1945 <= r.birth_year <= 2005 for r in others)


def test_index_rows_dense_and_ordered(spark):
    df = spark.range(0, 1000, numPartitions=7).selectExpr("(id * 7919) % 1000 AS k")
    numbered, n = synth.index_rows(df, ["k"])
    assert n == 1000
    got = sorted((r.row_index, r.k) for r in numbered.collect())
    assert got == [(i, i) for i in range(1000)]


def test_children_reference_valid_parents(spark):
    t = synth.clinical_tables(spark)
    p_ids = {r.patient_id for r in t["patients"].collect()}
    v = t["visits"].collect()
    assert len(v) == 251
    assert {r.patient_id for r in v} - p_ids == {"P9999"}
    sites = {r.patient_id: r.site_id for r in t["patients"].collect()}
    assert all(r.site_id == sites[r.patient_id] for r in v if r.patient_id in sites)
    lab = t["lab_results"]
    assert lab.count() == 401
    bad = lab.where(F.col("result_id") != "LR000004").where(F.col("test_value").try_cast("double").isNull())
    assert bad.count() == 0
    flags = lab.where("result_id NOT IN ('LR000028')").select("abnormal_flag").distinct().collect()
    assert {r[0] for r in flags} <= {"Y", "N"}
    visit_ids = {r.visit_id for r in v}
    assert {r.visit_id for r in t["medications"].collect()} - visit_ids == {"V88888"}


def test_all_tables_independent_of_partitioning(spark):
    """Same five tables whatever the shuffle width and input split."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for parts, splits in [(1, 1), (7, 5)]:
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            ids = {name: spark.range(1, n + 1, numPartitions=splits) for name, n in synth.SIZES.items()}
            tables = synth.clinical_tables(spark, ids)
            got.append({name: rows(df) for name, df in tables.items()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]
    assert {name: len(r) for name, r in got[0].items()} == {n: c + 1 for n, c in synth.SIZES.items()}


def test_sample_of_an_empty_parent_is_null(spark):
    parent = spark.range(0).selectExpr("id", "cast(id as string) as name")
    got = synth.sample_parent(spark.range(3).withColumnRenamed("id", "c"), parent, lambda n: F.col("c") % n)
    assert sorted(tuple(r) for r in got.collect()) == [(0, None, None), (1, None, None), (2, None, None)]
    numbered, n = synth.index_rows(spark.range(0))
    assert n == 0 and numbered.count() == 0


def test_sample_of_a_large_parent_matches_the_broadcast_plan(spark):
    child = spark.range(0, 5000).selectExpr("id as c", "case when id % 3 = 0 then 7 when id % 5 = 0 then null when id % 7 = 0 then -1 else id end as i")
    parent = spark.range(0, 900).selectExpr("id * 3 as pid")
    pick = lambda n: F.col("i") % 1000
    small = synth.sample_parent(child, parent, pick, ["pid"])
    for bounds in ({"max_broadcast_rows": 10}, {"max_broadcast_rows": 0}, {"max_broadcast_bytes": 100}):
        large = synth.sample_parent(child, parent, pick, ["pid"], hot_pick_rows=50, **bounds)
        assert sorted(map(tuple, large.collect()), key=str) == sorted(map(tuple, small.collect()), key=str)


def test_sample_parent_keeps_rows_without_a_pick(spark):
    child = spark.createDataFrame([(1, 0), (2, None), (3, 99)], "id long, i long")
    parent = spark.createDataFrame([("a",), ("b",)], "name string")
    got = synth.sample_parent(child, parent, lambda n: F.col("i"), parent_order=["name"])
    assert sorted((r.id, r.name) for r in got.collect()) == [(1, "a"), (2, None), (3, None)]
