"""Profiles, previews, counted writes, CSV and Parquet layers."""

import os

import pytest
from pyspark.sql import functions as F

import sluice as S
from sluice.plans.clinical import MEDICATIONS_SCHEMA, PATIENTS_SCHEMA


def test_profile(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 2.0)], "s string, d double")
    assert {r.distinct_count for r in S.profile(df).collect()} == {None}
    got = {r.column_name: tuple(r) for r in S.profile(df, distinct=["s", "d"]).collect()}
    assert got["s"] == ("s", "string", 3, 1, 1)
    assert got["d"] == ("d", "double", 3, 1, 2)
    approx = {r.column_name: r.distinct_count for r in S.profile(df, distinct=["s", "d"], approx=True).collect()}
    assert approx == {"s": 1, "d": 2}


def test_preview_is_ordered_and_limited(spark):
    df = spark.range(0, 1000).selectExpr("(id * 7919) % 1000 AS k")
    assert [r.k for r in S.preview(df, ["k"], 5).collect()] == [0, 1, 2, 3, 4]


def test_counted_write(spark, workdir):
    df, obs = S.counted(spark.range(0, 123), "n")
    S.write_parquet(df, os.path.join(workdir, "p"))
    assert int(obs.get["rows"]) == 123


def write_text(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_declared_schema_is_permissive_and_positional(spark, workdir):
    path = os.path.join(workdir, "medications.csv")
    write_text(path, "medication_id,patient_id,visit_id,drug_name,dose,dose_unit,administration_date,route\n"
                     "M1,P1,V1,Drug,abc,mg,2025-01-01,ORAL\n"
                     "M2,P1,V1,Drug,5,mg\n"
                     "M3,P1,V1,Drug,10,mg,2025-01-02,IV,extra\n"
                     "M4,,V1,\"\",-10,mg,2025.07.11,SC\n")
    rows = {r.medication_id: r for r in S.read_csv(spark, path, MEDICATIONS_SCHEMA).collect()}
    assert rows["M1"].dose is None                     # bad int → null, no error
    assert rows["M2"].route is None                    # short row padded
    assert rows["M3"].route == "IV"                    # extra cell dropped
    assert rows["M4"].patient_id is None and rows["M4"].drug_name is None and rows["M4"].dose == -10


def test_csv_corrupt_column(spark, workdir):
    path = os.path.join(workdir, "m.csv")
    write_text(path, "medication_id,patient_id,visit_id,drug_name,dose,dose_unit,administration_date,route\n"
                     "M1,P1,V1,Drug,abc,mg,2025-01-01,ORAL\nM2,P1,V1,Drug,5,mg,2025-01-01,IV\n")
    df = S.read_csv(spark, path, MEDICATIONS_SCHEMA, corrupt_column="_corrupt")
    bad = {r.medication_id: r._corrupt for r in df.collect()}
    assert bad["M1"] is not None and bad["M2"] is None


def test_csv_inferred(spark, workdir):
    path = os.path.join(workdir, "patients.csv")
    write_text(path, "patient_id,birth_year,enrollment_date\nP1,1987.0,2025-01-02\nP2,,15/03/2025\n")
    df = S.read_csv(spark, path, infer=True)
    assert dict(df.dtypes) == {"patient_id": "string", "birth_year": "double", "enrollment_date": "string"}


def test_birth_year_text_reads_as_double(spark, workdir):
    path = os.path.join(workdir, "p.csv")
    write_text(path, "patient_id,site_id,sex,birth_year,enrollment_date,treatment_arm,status\n"
                     "P1,SITE_A,M,1987.0,2025-01-02,PLACEBO,ACTIVE\n")
    assert S.read_csv(spark, path, PATIENTS_SCHEMA).first().birth_year == 1987.0


def test_parquet_roundtrip_partitioned(spark, workdir):
    path = os.path.join(workdir, "issues")
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "dataset_name string, record_id string")
    S.write_parquet(df, path, partition_by=["dataset_name"])
    assert sorted(tuple(r) for r in S.read_parquet(spark, path).select("dataset_name", "record_id").collect()) == [
        ("a", "1"), ("b", "2")]


def test_csv_roundtrip_keeps_padding(spark, workdir):
    df = spark.createDataFrame([(" site_b ", "x,y", None), ("a\t", 'q"t', "z")], "a string, b string, c string")
    path = os.path.join(workdir, "rt.csv")
    S.write_csv(df, path)
    got = sorted((tuple(r) for r in S.read_csv(spark, path, df.schema).collect()), key=str)
    assert got == sorted([(" site_b ", "x,y", None), ("a\t", 'q"t', "z")], key=str)


def test_landing_files_are_compressed_and_shared_among_tasks(spark, workdir, monkeypatch):
    from sluice.operators import synth

    monkeypatch.setattr(synth, "LANDING_FILE_ROWS", 300)
    df = spark.range(0, 1000, 1, 1).selectExpr("id", "if(id % 7 = 0, null, concat(' site_', id % 3, ' ')) as site")
    synth.save_landing({"t": df}, lambda name: f"{workdir}/{name}.csv")
    parts = [f for f in os.listdir(f"{workdir}/t.csv") if f.startswith("part-")]
    assert len(parts) == 4 and all(f.endswith(".csv.gz") for f in parts)
    got = S.read_csv(spark, f"{workdir}/t.csv", df.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_csv_enforce_header(spark, workdir):
    import pytest

    path = os.path.join(workdir, "swapped.csv")
    write_text(path, "route,medication_id,patient_id,visit_id,drug_name,dose,dose_unit,administration_date\n"
                     "IV,M1,P1,V1,Drug,5,mg,2025-01-01\n")
    # By position (the default) the swapped file reads without error.
    assert S.read_csv(spark, path, MEDICATIONS_SCHEMA).first().medication_id == "IV"
    with pytest.raises(Exception):
        S.read_csv(spark, path, MEDICATIONS_SCHEMA, enforce_header=True).collect()


def test_profile_and_preview_of_empty_frames(spark):
    empty = spark.createDataFrame([], "a string, b double")
    got = {r.column_name: (r.row_count, r.null_count, r.distinct_count) for r in S.profile(empty, distinct=["a", "b"]).collect()}
    assert got == {"a": (0, 0, 0), "b": (0, 0, 0)}
    assert S.preview(empty, ["a"], 5).count() == 0
    assert S.preview(spark.range(3), ["id"], 10).count() == 3


def test_exact_distinct_counts_of_every_type_without_expand(spark):
    df = spark.createDataFrame(
        [(1, 1.5, "a", b"x", True, [1, 2], None), (1, float("nan"), "b", b"x", None, [1], None), (2, float("nan"), "a", b"y", False, [1, 2], None),
         (None, -0.0, None, None, True, None, None), (3, 0.0, "", b"", True, [], None)],
        "i int, d double, s string, b binary, f boolean, l array<int>, n string")
    df = df.withColumn("t", F.to_date(F.lit("2024-01-01")) + F.col("i")).withColumn("ts", F.col("t").cast("timestamp")).withColumn("dec", F.col("i").cast("decimal(20,3)"))
    out = S.profile(df, distinct=df.columns)
    got = {r.column_name: (r.null_count, r.distinct_count) for r in out.collect()}
    assert got == {"i": (1, 3), "d": (0, 3), "s": (1, 3), "b": (1, 3), "f": (1, 2), "l": (1, 3), "n": (5, 0), "t": (1, 3), "ts": (1, 3), "dec": (1, 3)}
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    some = {r.column_name: r.distinct_count for r in S.profile(df, distinct=["s"]).collect()}
    assert some["s"] == 3 and some["i"] is None
    empty = S.profile(df.limit(0), distinct=["s", "d"]).collect()
    assert [(r.row_count, r.distinct_count) for r in empty if r.column_name in ("s", "d")] == [(0, 0), (0, 0)]


def test_a_failed_write_leaves_the_old_table(spark, workdir):
    path = f"{workdir}/layer/t"
    S.write_parquet(spark.range(5), path)
    bad = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        S.write_parquet(bad, path)
    assert sorted(r.id for r in S.read_parquet(spark, path).collect()) == [0, 1, 2, 3, 4]
    assert sorted(os.listdir(f"{workdir}/layer")) == ["t"]
    # A job may replace the table it reads.
    S.write_parquet(S.read_parquet(spark, path).where("id > 2"), path)
    assert S.read_parquet(spark, path).count() == 2


def test_a_write_that_died_between_its_renames_is_undone(spark, workdir):
    path = f"{workdir}/layer/t"
    S.write_parquet(spark.range(5), path)
    os.rename(path, f"{workdir}/layer/_t.old")
    assert S.read_parquet(spark, path).count() == 5
    os.rename(path, f"{workdir}/layer/_t.old")
    S.write_parquet(spark.range(3), path, partition_by=[])
    assert S.read_parquet(spark, path).count() == 3 and os.listdir(f"{workdir}/layer") == ["t"]


def test_a_partitioned_table_and_csv_are_replaced_whole(spark, workdir):
    path = f"{workdir}/p"
    for n in (6, 4):
        S.write_parquet(spark.range(n).withColumn("g", F.col("id") % 2), path, partition_by=["g"])
        assert S.read_parquet(spark, path).count() == n
    S.write_csv(spark.range(3), f"{workdir}/c")
    S.write_csv(spark.range(2), f"{workdir}/c")
    assert S.read_csv(spark, f"{workdir}/c").count() == 2
