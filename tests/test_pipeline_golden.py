"""End-to-end: generated landing CSVs with the known defects → 12 issues."""

from sluice.operators import synth
from sluice.plans.clinical import CLINICAL_SPECS
from sluice.plans.promotion import all_issues, run_all
from sluice.sources.io import LayerPaths, read_parquet

EXPECTED = {
    ("patients", "P0011", "patient_id", "DUPLICATE_RECORD", "Duplicate patient_id detected", "HIGH"),
    ("patients", "P0021", "birth_year", "MISSING_VALUE", "Missing birth_year value", "MEDIUM"),
    ("visits", "V00016", "visit_date", "MISSING_VALUE", "Missing visit_date value", "MEDIUM"),
    ("visits", "V00023", "visit_id", "DUPLICATE_RECORD", "Duplicate visit_id detected", "HIGH"),
    ("adverse_events", "AE00012", "event_id", "DUPLICATE_RECORD", "Duplicate event_id detected", "HIGH"),
    ("lab_results", "LR000004", "test_value", "INVALID_NUMERIC_VALUE",
     "test_value could not be converted to double", "HIGH"),
    ("medications", "M000007", "dose", "INVALID_BUSINESS_VALUE", "Dose cannot be negative", "HIGH"),
    ("medications", "M000045", "medication_id", "DUPLICATE_RECORD", "Duplicate medication_id detected", "HIGH"),
    ("visits", "V00008", "patient_id", "INVALID_FOREIGN_KEY", "patient_id does not exist in patients dataset", "HIGH"),
    ("lab_results", "LR000034", "visit_id", "INVALID_FOREIGN_KEY", "visit_id does not exist in visits dataset", "HIGH"),
    ("adverse_events", "AE00010", "patient_id", "INVALID_FOREIGN_KEY",
     "patient_id does not exist in patients dataset", "HIGH"),
    ("medications", "M000037", "visit_id", "INVALID_FOREIGN_KEY", "visit_id does not exist in visits dataset", "HIGH"),
}


import pytest


@pytest.mark.parametrize("parallel,small_rows", [(1, 10_000_000), (5, 10_000_000), (5, 0)])
def test_golden_pipeline(spark, workdir, parallel, small_rows):
    """small_rows=0 takes the large-table plan: shared duplicated-key set, only duplicated rows aggregated."""
    layers = LayerPaths(workdir)
    synth.save_landing(synth.clinical_tables(spark), layers.landing)
    report = run_all(spark, CLINICAL_SPECS, layers, combined=True, parallel=parallel, small_rows=small_rows)

    assert report.landing_rows == {
        "patients": 101, "visits": 251, "adverse_events": 61, "lab_results": 401, "medications": 181,
    }
    assert report.cleaned_rows_before_dedup == report.landing_rows
    assert report.cleaned_rows == {
        "patients": 100, "visits": 250, "adverse_events": 60, "lab_results": 401, "medications": 180,
    }
    got = [tuple(r) for r in all_issues(spark, CLINICAL_SPECS, layers).collect()]
    assert len(got) == 12
    assert set(got) == EXPECTED
    combined = read_parquet(spark, layers.all_issues())
    assert combined.count() == 12

    cleaned = {n: read_parquet(spark, layers.cleaned(n)) for n in CLINICAL_SPECS}
    p = {r.patient_id: r for r in cleaned["patients"].collect()}
    assert p["P0006"].sex == "F" and p["P0013"].sex == "M"
    assert p["P0021"].birth_year is None
    assert str(p["P0031"].enrollment_date) == "2025-03-15"
    assert p["P0041"].site_id == "SITE_A"
    assert dict(cleaned["patients"].dtypes)["birth_year"] == "int"
    v = {r.visit_id: r for r in cleaned["visits"].collect()}
    assert v["V00026"].completed == "Y"
    assert str(v["V00036"].scheduled_date) == "2025-05-20"
    assert v["V00008"].patient_id == "P9999"  # orphans stay in the cleaned layer
    ae = {r.event_id: r for r in cleaned["adverse_events"].collect()}
    assert ae["AE00005"].severity == "SEVERE"
    assert str(ae["AE00015"].event_date) == "2025-03-18"
    assert ae["AE00023"].serious_event == "Y"
    lab = cleaned["lab_results"]
    assert lab.columns[-1] == "test_value_numeric"
    rows = {r.result_id: r for r in lab.collect()}
    assert rows["LR000004"].test_value_numeric is None
    assert rows["LR000019"].unit == "IU/L"
    assert rows["LR000028"].abnormal_flag == "Y"
    assert lab.where("result_id = 'LR000051'").count() == 2
    m = {r.medication_id: r for r in cleaned["medications"].collect()}
    assert m["M000007"].dose == -10
    assert m["M000017"].dose_unit == "mg"
    assert str(m["M000027"].administration_date) == "2025-07-11"
