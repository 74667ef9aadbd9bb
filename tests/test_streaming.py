"""Incremental promotion of landing files through a stream."""

import os

from sluice.plans.clinical import MEDICATIONS
from sluice.sources.io import read_parquet
from sluice.streaming import promote_landing_stream

HEADER = "medication_id,patient_id,visit_id,drug_name,dose,dose_unit,administration_date,route\n"


def test_stream_promotes_new_files(spark, workdir):
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write(HEADER + "M1,P1,V1, Drug ,-10,milligrams,2025.07.11, oral\nM2,P1,V1,Drug,5,mg,2025-01-01,IV\n")
    out, iss, ck = (os.path.join(workdir, x) for x in ("cleaned", "issues", "ck"))
    promote_landing_stream(spark, MEDICATIONS, landing, out, iss, ck).awaitTermination()
    with open(os.path.join(landing, "b.csv"), "w") as f:
        f.write(HEADER + "M3,P2,V2,Drug,-1,mg,2025-02-01,SC\n")
    promote_landing_stream(spark, MEDICATIONS, landing, out, iss, ck).awaitTermination()

    cleaned = {r.medication_id: r for r in read_parquet(spark, out).collect()}
    assert set(cleaned) == {"M1", "M2", "M3"}  # each file processed once
    assert cleaned["M1"].dose_unit == "mg" and cleaned["M1"].route == "ORAL" and cleaned["M1"].drug_name == "Drug"
    assert str(cleaned["M1"].administration_date) == "2025-07-11"
    issues = sorted(r.record_id for r in read_parquet(spark, iss).collect())
    assert issues == ["M1", "M3"]
    assert sorted({r.batch_id for r in read_parquet(spark, out).collect()}) == [0, 1]


def test_replayed_batch_does_not_duplicate(spark, workdir):
    """The same batch id written twice (a replay after a failure) is stored once."""
    from sluice.streaming import batch_writer, clean_stream

    batch = clean_stream(MEDICATIONS, spark.createDataFrame(
        [("M1", "P1", "V1", "Drug", -5, "mg", "2025-01-01", "IV")], MEDICATIONS.schema))
    out, iss = os.path.join(workdir, "cleaned"), os.path.join(workdir, "issues")
    write = batch_writer(MEDICATIONS, out, iss)
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert read_parquet(spark, out).count() == 2
    assert read_parquet(spark, iss).where("batch_id = 0").count() == 1


def test_stream_reports_unparsed_values_like_batch(spark, workdir):
    from dataclasses import replace

    from sluice.plans.promotion import table_issues
    from sluice.sources.io import read_csv

    spec = replace(MEDICATIONS, report_unparsed=("administration_date",), foreign_keys=(), unique=False)
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write(HEADER + "M1,P1,V1,Drug,-10,mg,2025.07.11,ORAL\nM2,P1,V1,Drug,5,mg,someday,IV\n")
    out, iss, ck = (os.path.join(workdir, x) for x in ("cleaned", "issues", "ck"))
    promote_landing_stream(spark, spec, landing, out, iss, ck).awaitTermination()
    streamed = read_parquet(spark, iss).drop("batch_id")
    batch = table_issues({"medications": read_csv(spark, landing, spec.schema)}, {"medications": spec})
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert streamed.count() == 2
    assert read_parquet(spark, out).columns[:8] == spec.schema.names
