"""Seeded synthesis of the clinical landing tables, as Spark jobs.

Every random draw is a hash of (seed, purpose, row id), so a row's values do
not depend on partitioning, task order or retries. Ids come from any
DataFrame with an ``id`` column: ``spark.range(1, n + 1)`` for the reference
sizes, or keys of an existing table so the work grows with it.

Children pick parents by row index: parents are numbered 0..n-1 with
per-partition counts and offsets (no single-partition window over the data),
and each child joins the parent at ``pick(id) mod n``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.columns import (
    add_days,
    date_text,
    flag_when,
    format_id,
    range_flag,
    round_half_even,
    starts_with,
)
from sluice.operators.integrity import DEFAULT_HOT_KEY_ROWS, DEFAULT_MAX_BROADCAST_BYTES
from sluice.operators.keys import distinct_keys, lookup_constant, lookup_first
from sluice.operators.skew import join_unique, key_size
from sluice.sources.scratch import materialize

# Sizes and value domains of the generated tables.
SIZES = {"patients": 100, "visits": 250, "adverse_events": 60, "lab_results": 400, "medications": 180}
SITES = ["SITE_A", "SITE_B", "SITE_C", "SITE_D"]
TREATMENT_ARMS = ["PLACEBO", "DRUG_A", "DRUG_B"]
SEX_VALUES = ["M", "F"]
PATIENT_STATUSES = ["ACTIVE", "COMPLETED", "WITHDRAWN"]
VISIT_TYPES = ["SCREENING", "BASELINE", "FOLLOW_UP", "FINAL"]
AE_SEVERITIES = ["MILD", "MODERATE", "SEVERE"]
AE_RELATIONSHIP = ["NOT_RELATED", "POSSIBLY_RELATED", "RELATED"]
AE_OUTCOMES = ["RESOLVED", "ONGOING", "RECOVERING"]
LAB_TESTS = {
    "ALT": {"unit": "U/L", "low": 7, "high": 56},
    "AST": {"unit": "U/L", "low": 10, "high": 40},
    "HEMOGLOBIN": {"unit": "g/dL", "low": 12, "high": 17},
    "WBC": {"unit": "10^9/L", "low": 4, "high": 11},
    "CREATININE": {"unit": "mg/dL", "low": 0.6, "high": 1.3},
}
DRUGS = ["PLACEBO", "Investigational Drug A", "Investigational Drug B"]
ROUTES = ["ORAL", "IV", "SC"]
DOSES = [5, 10, 20, 50, 100]
DOSE_UNITS = ["mg", "mg/day"]
YES_NO = ["Y", "N"]
# Share of lab values drawn inside the reference range.
NORMAL_SHARE = 0.85

# Injected defects (record id → {column: dirty value}) and the
# record duplicated once in each table.
PATIENT_DEFECTS = {
    "P0006": {"sex": "Female"},
    "P0013": {"sex": "Male"},
    "P0021": {"birth_year": None},
    "P0031": {"enrollment_date": "15/03/2025"},
    "P0041": {"site_id": "site_a"},
}
VISIT_DEFECTS = {
    "V00008": {"patient_id": "P9999"},
    "V00016": {"visit_date": ""},
    "V00026": {"completed": "YES"},
    "V00036": {"scheduled_date": "2025/05/20"},
}
ADVERSE_EVENT_DEFECTS = {
    "AE00005": {"severity": "high"},
    "AE00010": {"patient_id": "P8888"},
    "AE00015": {"event_date": "03-18-2025"},
    "AE00023": {"serious_event": "TRUE"},
}
LAB_RESULT_DEFECTS = {
    "LR000004": {"test_value": "not_available"},
    "LR000019": {"unit": "IU/L"},
    "LR000028": {"abnormal_flag": "TRUE"},
    "LR000034": {"visit_id": "V99999"},
}
MEDICATION_DEFECTS = {
    "M000007": {"dose": -10},
    "M000017": {"dose_unit": "milligrams"},
    "M000027": {"administration_date": "2025.07.11"},
    "M000037": {"visit_id": "V88888"},
}
DUPLICATED = {
    "patients": ["P0011"],
    "visits": ["V00023"],
    "adverse_events": ["AE00012"],
    "lab_results": ["LR000051"],
    "medications": ["M000045"],
}

# Parents up to this many rows, and within the byte bound of the other broadcasts,
# are broadcast to their children (both are measured before the join).
BROADCAST_PARENT_ROWS = 1_000_000
# Rows of one landing file (a compressed file is read by one task).
LANDING_FILE_ROWS = 250_000
_TWO_53 = float(2**53)


# ---------------------------------------------------------------- draws (G2–G4)
def _hash(seed: int, purpose: str, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(purpose), *cols)


def uniform(seed: int, purpose: str, *cols: Column) -> Column:
    """Double in [0, 1) from a hash of the row's id."""
    return F.pmod(_hash(seed, purpose, *cols), F.lit(2**53)).cast("double") / F.lit(_TWO_53)


def randint(low: int, high: int, seed: int, purpose: str, *cols: Column) -> Column:
    """Integer in [low, high]."""
    return (F.lit(low) + F.pmod(_hash(seed, purpose, *cols), F.lit(high - low + 1))).cast("int")


def choice(values: Sequence, seed: int, purpose: str, *cols: Column) -> Column:
    """One of ``values``, uniformly."""
    idx = (F.pmod(_hash(seed, purpose, *cols), F.lit(len(values))) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx)


def random_date_text(start: str, days: int, seed: int, purpose: str, *cols: Column) -> Column:
    """``yyyy-MM-dd`` text of a day in [start, start + days]."""
    return date_text(add_days(F.to_date(F.lit(start)), randint(0, days, seed, purpose, *cols)))


# ---------------------------------------------------------------- rows (G5–G7)
def index_rows(df: DataFrame, order_by: Sequence[str] = (), index_col: str = "row_index") -> tuple[DataFrame, int]:
    """Number rows 0..n-1 (in ``order_by`` order if given); returns (rows, n).

    Rows are tagged once and checkpointed; each row's index is its partition's
    offset (a running sum over one row per partition, a size bounded by the
    partition count) plus its position in the partition.
    """
    src = df.orderBy(*order_by) if order_by else df
    tagged = materialize(src.withColumn("__mid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("__mid"), 33)
    counts = tagged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__offset")
    )
    n = int(counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0])
    numbered = (
        tagged.join(F.broadcast(offsets), part == F.col("__part"))
        .withColumn(index_col, F.col("__offset") + F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__mid", "__part", "__offset")
    )
    return numbered, n


def sample_parent(
    child: DataFrame,
    parent: DataFrame,
    pick: Callable[[Column], Column],
    parent_order: Sequence[str] = (),
    max_broadcast_rows: int = BROADCAST_PARENT_ROWS,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    hot_pick_rows: int = DEFAULT_HOT_KEY_ROWS,
) -> DataFrame:
    """Each child row joined to the parent row at index ``pick(n)`` (0-based).

    ``pick`` receives the parent row count and returns the index expression
    over child columns, e.g. ``lambda n: F.pmod(F.xxhash64("id"), n)``. A child
    whose index is null or out of range keeps nulls; so does every child of an
    empty parent (``pick`` is not called).

    A parent within ``max_broadcast_rows`` and ``max_broadcast_bytes``
    (measured) is broadcast. A larger one is joined on its dense index: a child row
    without a pick in 0..n-1 never enters the shuffle, and picks with more than ``hot_pick_rows`` child rows are matched map-only or salted (``skew.join_unique``).
    """
    numbered, n = index_rows(parent, parent_order, "__pick")
    columns = [c for c in numbered.columns if c != "__pick"]
    types = dict(numbered.dtypes)
    nulls = [F.lit(None).cast(types[c]).alias(c) for c in columns]
    if n == 0:
        return child.select(*child.columns, *nulls)
    picked = child.withColumn("__pick", pick(F.lit(n)).cast("long"))
    rows, size = key_size(numbered, columns)
    if rows <= max_broadcast_rows and size <= max_broadcast_bytes:
        return picked.join(F.broadcast(numbered), "__pick", "left").drop("__pick")
    inside = F.coalesce((F.col("__pick") >= 0) & (F.col("__pick") < n), F.lit(False))
    asking, idle = picked.where(inside), picked.where(~inside).select(*child.columns, *nulls)
    hot = materialize(asking.groupBy("__pick").agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > hot_pick_rows))
    found = join_unique(asking, numbered, ["__pick"], "left", hot, hot_pick_rows, max_broadcast_rows, max_broadcast_bytes)
    return found.drop("__pick").unionByName(idle)


def inject(df: DataFrame, key: str, defects: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """Set given columns at given key values (everything else untouched)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    by_col: dict[str, list[tuple[str, object]]] = {}
    for k, changes in defects.items():
        for c, v in changes.items():
            by_col.setdefault(c, []).append((k, v))
    repl = {}
    for c, pairs in by_col.items():
        expr = None
        for k, v in pairs:
            cond = F.col(key) == F.lit(k)
            val = F.lit(v).cast(types[c])
            expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        repl[c] = expr.otherwise(F.col(c))
    return df.withColumns(repl) if repl else df


def duplicate_rows(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Append a second copy of the rows with the given key values."""
    if not values:
        return df
    return df.unionByName(df.where(F.col(key).isin(list(values))))


# ---------------------------------------------------------------- tables (G1, G8)
def _id_frame(spark: SparkSession, ids: DataFrame | None, name: str) -> DataFrame:
    if ids is None:
        return spark.range(1, SIZES[name] + 1)
    return ids.select(F.col("id").cast("long").alias("id"))


def patients(spark: SparkSession, ids: DataFrame | None = None, seed: int = 42) -> DataFrame:
    i = F.col("id")
    df = _id_frame(spark, ids, "patients").select(
        format_id(i, "P", 4).alias("patient_id"),
        choice(SITES, seed, "site", i).alias("site_id"),
        choice(SEX_VALUES, seed, "sex", i).alias("sex"),
        randint(1945, 2005, seed, "birth", i).cast("double").alias("birth_year"),
        random_date_text("2025-01-01", 364, seed, "enrolled", i).alias("enrollment_date"),
        choice(TREATMENT_ARMS, seed, "arm", i).alias("treatment_arm"),
        choice(PATIENT_STATUSES, seed, "status", i).alias("status"),
    )
    return duplicate_rows(inject(df, "patient_id", PATIENT_DEFECTS), "patient_id", DUPLICATED["patients"])


def _pick(seed: int, purpose: str) -> Callable[[Column], Column]:
    return lambda n: F.pmod(_hash(seed, purpose, F.col("id")), n)


def _with_patient(spark, child_ids: DataFrame, patients_df: DataFrame, seed: int, purpose: str) -> DataFrame:
    """Child ids with a patient drawn from the distinct patient ids and its site."""
    ids = distinct_keys(patients_df, "patient_id")
    picked = sample_parent(child_ids, ids, _pick(seed, purpose), parent_order=["patient_id"])
    return lookup_first(picked, patients_df, "patient_id", ["site_id"])


def visits(spark: SparkSession, patients_df: DataFrame, ids: DataFrame | None = None, seed: int = 42) -> DataFrame:
    i = F.col("id")
    base = _with_patient(spark, _id_frame(spark, ids, "visits"), patients_df, seed, "visit_patient")
    scheduled = add_days(F.to_date(F.lit("2025-01-01")), randint(0, 454, seed, "scheduled", i))
    df = base.select(
        format_id(i, "V", 5).alias("visit_id"),
        "patient_id",
        "site_id",
        choice(VISIT_TYPES, seed, "visit_type", i).alias("visit_type"),
        date_text(scheduled).alias("scheduled_date"),
        date_text(F.date_add(scheduled, randint(-5, 15, seed, "visit_shift", i))).alias("visit_date"),
        choice(YES_NO, seed, "completed", i).alias("completed"),
        choice(YES_NO, seed, "deviation", i).alias("protocol_deviation"),
    )
    return duplicate_rows(inject(df, "visit_id", VISIT_DEFECTS), "visit_id", DUPLICATED["visits"])


def adverse_events(spark: SparkSession, patients_df: DataFrame, ids: DataFrame | None = None, seed: int = 42) -> DataFrame:
    i = F.col("id")
    base = _with_patient(spark, _id_frame(spark, ids, "adverse_events"), patients_df, seed, "ae_patient")
    severity = choice(AE_SEVERITIES, seed, "severity", i)
    df = base.select(
        format_id(i, "AE", 5).alias("event_id"),
        "patient_id",
        "site_id",
        random_date_text("2025-01-01", 454, seed, "event_date", i).alias("event_date"),
        severity.alias("severity"),
        choice(AE_RELATIONSHIP, seed, "relationship", i).alias("relationship_to_treatment"),
        choice(AE_OUTCOMES, seed, "outcome", i).alias("outcome"),
        flag_when((severity == F.lit("SEVERE")) & (uniform(seed, "serious", i) > F.lit(0.4))).alias("serious_event"),
    )
    return duplicate_rows(inject(df, "event_id", ADVERSE_EVENT_DEFECTS), "event_id", DUPLICATED["adverse_events"])


def _with_visit(child_ids: DataFrame, visits_df: DataFrame, seed: int, purpose: str) -> DataFrame:
    """Child ids with a visit (and its patient) drawn from visits of a P-patient."""
    valid = visits_df.where(starts_with("patient_id", "P")).select("visit_id", "patient_id")
    return sample_parent(child_ids, valid, _pick(seed, purpose), parent_order=["visit_id", "patient_id"])


def lab_results(spark: SparkSession, visits_df: DataFrame, ids: DataFrame | None = None, seed: int = 42) -> DataFrame:
    i = F.col("id")
    base = _with_visit(_id_frame(spark, ids, "lab_results"), visits_df, seed, "lab_visit")
    test = choice(list(LAB_TESTS), seed, "test", i)
    ref = dict(zip(["unit", "low", "high"], lookup_constant(test, LAB_TESTS, ["unit", "low", "high"])))
    low, high = ref["low"], ref["high"]
    u = uniform(seed, "value", i)
    value = round_half_even(
        F.when(uniform(seed, "normal", i) < F.lit(NORMAL_SHARE), low + u * (high - low))
        .otherwise((high + F.lit(1)) + u * (high * F.lit(3) - (high + F.lit(1)))),
        2,
    )
    df = base.select(
        format_id(i, "LR", 6).alias("result_id"),
        "patient_id",
        "visit_id",
        test.alias("test_name"),
        value.cast("string").alias("test_value"),
        ref["unit"].alias("unit"),
        low.alias("reference_range_low"),
        high.alias("reference_range_high"),
        range_flag(value, low, high).alias("abnormal_flag"),
    )
    return duplicate_rows(inject(df, "result_id", LAB_RESULT_DEFECTS), "result_id", DUPLICATED["lab_results"])


def medications(spark: SparkSession, visits_df: DataFrame, ids: DataFrame | None = None, seed: int = 42) -> DataFrame:
    i = F.col("id")
    base = _with_visit(_id_frame(spark, ids, "medications"), visits_df, seed, "med_visit")
    df = base.select(
        format_id(i, "M", 6).alias("medication_id"),
        "patient_id",
        "visit_id",
        choice(DRUGS, seed, "drug", i).alias("drug_name"),
        choice(DOSES, seed, "dose", i).cast("int").alias("dose"),
        choice(DOSE_UNITS, seed, "dose_unit", i).alias("dose_unit"),
        random_date_text("2025-01-01", 454, seed, "administered", i).alias("administration_date"),
        choice(ROUTES, seed, "route", i).alias("route"),
    )
    return duplicate_rows(inject(df, "medication_id", MEDICATION_DEFECTS), "medication_id", DUPLICATED["medications"])


def clinical_tables(
    spark: SparkSession, ids: Mapping[str, DataFrame] | None = None, seed: int = 42
) -> dict[str, DataFrame]:
    """All five landing tables, parents first (parents are checkpointed once
    so that children sample the exact rows that are saved)."""
    ids = ids or {}
    p = materialize(patients(spark, ids.get("patients"), seed))
    v = materialize(visits(spark, p, ids.get("visits"), seed))
    return {
        "patients": p,
        "visits": v,
        "adverse_events": adverse_events(spark, p, ids.get("adverse_events"), seed),
        "lab_results": lab_results(spark, v, ids.get("lab_results"), seed),
        "medications": medications(spark, v, ids.get("medications"), seed),
    }


def save_landing(tables: Mapping[str, DataFrame], landing_path: Callable[[str], str]) -> None:
    """Write every table as landing CSV with a header: gzip files, as plain text would be over half of
    all bytes that a promotion writes, of a size that many tasks can share."""
    from sluice.sources.io import write_csv

    for name, df in tables.items():
        write_csv(df, landing_path(name), compression="gzip", max_file_rows=LANDING_FILE_ROWS)
