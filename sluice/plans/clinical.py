"""The five clinical-trial datasets, declared once.

Landing schemas keep dates and flags as text so that dirty values survive
the typed CSV read; cleaning types them.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from sluice.functions.columns import (
    FLAG_FOUR_SYNONYMS,
    FLAG_TWO_SYNONYMS,
    map_values,
    parse_date,
    to_double,
    to_int,
    trim_spaces,
    upper_trim,
)
from sluice.operators.rules import InvalidCastRule, MissingRule, PredicateRule
from sluice.plans.specs import DatasetSpec, ForeignKey, registry


def _schema(*fields: tuple[str, type]) -> StructType:
    return StructType([StructField(n, t(), True) for n, t in fields])


S, D, I = StringType, DoubleType, IntegerType

# Landing schemas (field order is the CSV column order).
PATIENTS_SCHEMA = _schema(
    ("patient_id", S), ("site_id", S), ("sex", S), ("birth_year", D),
    ("enrollment_date", S), ("treatment_arm", S), ("status", S),
)
VISITS_SCHEMA = _schema(
    ("visit_id", S), ("patient_id", S), ("site_id", S), ("visit_type", S),
    ("scheduled_date", S), ("visit_date", S), ("completed", S), ("protocol_deviation", S),
)
ADVERSE_EVENTS_SCHEMA = _schema(
    ("event_id", S), ("patient_id", S), ("site_id", S), ("event_date", S),
    ("severity", S), ("relationship_to_treatment", S), ("outcome", S), ("serious_event", S),
)
LAB_RESULTS_SCHEMA = _schema(
    ("result_id", S), ("patient_id", S), ("visit_id", S), ("test_name", S),
    ("test_value", S), ("unit", S), ("reference_range_low", D),
    ("reference_range_high", D), ("abnormal_flag", S),
)
MEDICATIONS_SCHEMA = _schema(
    ("medication_id", S), ("patient_id", S), ("visit_id", S), ("drug_name", S),
    ("dose", I), ("dose_unit", S), ("administration_date", S), ("route", S),
)

# Value maps and accepted date formats per column.
SEX_MAP = {"FEMALE": "F", "MALE": "M"}
SEVERITY_MAP = {"HIGH": "SEVERE"}
DOSE_UNIT_MAP = {"MILLIGRAMS": "mg"}
ENROLLMENT_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")
VISIT_DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd")
EVENT_DATE_FORMATS = ("yyyy-MM-dd", "MM-dd-yyyy")
ADMINISTRATION_DATE_FORMATS = ("yyyy-MM-dd", "yyyy.MM.dd")


PATIENTS = DatasetSpec(
    name="patients",
    schema=PATIENTS_SCHEMA,
    key=("patient_id",),
    cleaners={
        "site_id": upper_trim,
        "sex": partial(map_values, mapping=SEX_MAP),
        "birth_year": to_int,
        "enrollment_date": partial(parse_date, formats=ENROLLMENT_DATE_FORMATS),
    },
    row_rules=(MissingRule("birth_year", "Missing birth_year value"),),
)

LAB_RESULTS = DatasetSpec(
    name="lab_results",
    schema=LAB_RESULTS_SCHEMA,
    key=("result_id",),
    cleaners={
        "test_name": upper_trim,
        "unit": trim_spaces,
        "abnormal_flag": partial(map_values, mapping=FLAG_TWO_SYNONYMS),
    },
    derived={"test_value_numeric": lambda: to_double(F.col("test_value"))},
    row_rules=(
        InvalidCastRule("test_value", "test_value_numeric", "double",
                        "test_value could not be converted to double"),
    ),
    # The reference neither deduplicates lab results nor checks their keys.
    dedup=False,
    unique=False,
    foreign_keys=(ForeignKey("visit_id", "visits"),),
)

VISITS = DatasetSpec(
    name="visits",
    schema=VISITS_SCHEMA,
    key=("visit_id",),
    cleaners={
        "site_id": upper_trim,
        "visit_type": upper_trim,
        "scheduled_date": partial(parse_date, formats=VISIT_DATE_FORMATS),
        "visit_date": partial(parse_date, formats=VISIT_DATE_FORMATS),
        "completed": partial(map_values, mapping=FLAG_FOUR_SYNONYMS),
        "protocol_deviation": partial(map_values, mapping=FLAG_FOUR_SYNONYMS),
    },
    row_rules=(MissingRule("visit_date", "Missing visit_date value"),),
    foreign_keys=(ForeignKey("patient_id", "patients"),),
)

ADVERSE_EVENTS = DatasetSpec(
    name="adverse_events",
    schema=ADVERSE_EVENTS_SCHEMA,
    key=("event_id",),
    cleaners={
        "site_id": upper_trim,
        "event_date": partial(parse_date, formats=EVENT_DATE_FORMATS),
        "severity": partial(map_values, mapping=SEVERITY_MAP),
        "relationship_to_treatment": upper_trim,
        "outcome": upper_trim,
        "serious_event": partial(map_values, mapping=FLAG_TWO_SYNONYMS),
    },
    foreign_keys=(ForeignKey("patient_id", "patients"),),
)

MEDICATIONS = DatasetSpec(
    name="medications",
    schema=MEDICATIONS_SCHEMA,
    key=("medication_id",),
    cleaners={
        "drug_name": trim_spaces,
        "dose_unit": partial(map_values, mapping=DOSE_UNIT_MAP, fallback="trim"),
        "administration_date": partial(parse_date, formats=ADMINISTRATION_DATE_FORMATS),
        "route": upper_trim,
    },
    row_rules=(PredicateRule("dose", "dose < 0", "Dose cannot be negative"),),
    foreign_keys=(ForeignKey("visit_id", "visits"),),
)

# Parents first; the integrity check needs every cleaned table.
CLINICAL_SPECS = registry([PATIENTS, VISITS, ADVERSE_EVENTS, LAB_RESULTS, MEDICATIONS])
