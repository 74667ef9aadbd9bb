"""DatasetSpec: cleaning projection, shared duplicated-key set, check mode."""

from pyspark.sql.types import StringType, StructField, StructType

import sluice as S
from sluice.operators.keys import duplicated_keys
from sluice.operators.rules import MissingRule
from sluice.plans.specs import DatasetSpec, ForeignKey
from sluice.plans.promotion import table_issues

SCHEMA = StructType([StructField(c, StringType(), True) for c in ("id", "code", "parent_id")])


def spec():
    return DatasetSpec(name="t", schema=SCHEMA, key=("id",), cleaners={"code": S.upper_trim},
                       row_rules=(MissingRule("code"),), foreign_keys=(ForeignKey("parent_id", "p", "pid"),))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_issues_with_shared_duplicated_keys(spark):
    df = spark.createDataFrame(
        [("a", " x ", "1"), ("a", "y", "1"), ("b", None, "2"), (None, "z", "1"), (None, "w", None), ("c", "v", "9")],
        SCHEMA)
    s = spec()
    cleaned = s.clean(df)
    plain = rows(s.issues(cleaned))
    shared = rows(s.issues(cleaned, duplicated_keys(cleaned, s.key)[0]))
    assert plain == shared
    assert ("t", None, "id", "DUPLICATE_RECORD", "Duplicate id detected", "HIGH") in shared
    assert rows(s.deduplicate(cleaned)) == rows(s.deduplicate(cleaned, strategy="duplicated"))


def test_table_issues_check_mode(spark):
    t = spark.createDataFrame([("a", "x", "1"), ("b", None, "2"), ("c", "y", None)], SCHEMA)
    p = spark.createDataFrame([("1",)], "pid string")
    specs = {"p": DatasetSpec(name="p", schema=None, key=("pid",), dedup=False), "t": spec()}
    got = rows(table_issues({"t": t, "p": p}, specs))
    assert sorted((g[1], g[3]) for g in got) == sorted(
        [("b", "MISSING_VALUE"), ("b", "INVALID_FOREIGN_KEY"), ("c", "INVALID_FOREIGN_KEY")])


def test_fused_foreign_keys_match_separate_checks(spark):
    child = spark.createDataFrame(
        [("c1", "1", 10, 1), ("c2", "9", 10, 2), ("c3", None, 11, 1), ("c4", "2", None, 1), ("c5", "2", 12, 5)],
        "id string, a string, b long, l int")
    pa = spark.createDataFrame([("1",), ("1",), ("2",)], "pa string")                       # duplicated keys
    pb = spark.createDataFrame([(10, 1), (10, 2), (11, 1), (12, 1)], "pb long, pl int")    # composite key
    specs = {
        "pa": DatasetSpec(name="pa", schema=None, key=("pa",), dedup=False),
        "pb": DatasetSpec(name="pb", schema=None, key=("pb", "pl"), dedup=False),
        "c": DatasetSpec(name="c", schema=None, key=("id",), dedup=False, foreign_keys=(
            ForeignKey("a", "pa"), ForeignKey(("b", "l"), "pb"), ForeignKey("a", "pa", null_is_orphan=False,
                                                                             description="a (nulls allowed)"))),
    }
    tables = {"pa": pa, "pb": pb, "c": child}
    fused = rows(S.union_issues(specs["c"].foreign_key_issues(child, tables, specs)))
    separate = rows(S.union_issues(specs["c"].foreign_key_issues(child, tables, specs, strategy="direct")))
    assert fused == separate
    assert sorted((r[1], r[2]) for r in fused) == sorted(
        [("c2", "a"), ("c3", "a"), ("c2", "a"), ("c4", "b|l"), ("c5", "b|l")])


def test_report_unparsed_is_optional(spark, workdir):
    from dataclasses import replace

    from sluice.plans.clinical import PATIENTS
    from sluice.plans.promotion import clean_dataset
    from sluice.sources.io import LayerPaths, read_parquet, write_parquet

    raw = spark.createDataFrame(
        [("P1", "SITE_A", "F", 1990.0, "2025-13-45", "PLACEBO", "ACTIVE"),
         ("P2", "SITE_A", "M", 1980.0, "15/03/2025", "PLACEBO", "ACTIVE"),
         ("P3", "SITE_A", "M", 1970.0, None, "PLACEBO", "ACTIVE"),
         ("P4", "SITE_A", "M", 1960.0, " ", "PLACEBO", "ACTIVE")], PATIENTS.schema)
    layers = LayerPaths(workdir)
    write_parquet(raw, layers.raw("patients"))
    clean_dataset(spark, PATIENTS, layers)
    assert read_parquet(spark, layers.issues("patients")).count() == 0  # default: silent nulls, as the reference
    spec = replace(PATIENTS, report_unparsed=("enrollment_date",))
    clean_dataset(spark, spec, layers)
    got = rows(read_parquet(spark, layers.issues("patients")))
    assert got == [("patients", "P1", "enrollment_date", "INVALID_FORMAT_VALUE",
                    "enrollment_date could not be parsed", "HIGH")]
    assert read_parquet(spark, layers.cleaned("patients")).columns == list(PATIENTS.schema.names)
