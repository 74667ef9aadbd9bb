"""The uniform issue table: one row per data-quality finding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.functions.columns import ColumnOrName, key_text

# Issue columns (in order), issue types and severities.
ISSUE_COLUMNS = (
    "dataset_name",
    "record_id",
    "field_name",
    "issue_type",
    "issue_description",
    "severity",
)
DUPLICATE_RECORD = "DUPLICATE_RECORD"
MISSING_VALUE = "MISSING_VALUE"
INVALID_NUMERIC_VALUE = "INVALID_NUMERIC_VALUE"
INVALID_BUSINESS_VALUE = "INVALID_BUSINESS_VALUE"
INVALID_FOREIGN_KEY = "INVALID_FOREIGN_KEY"
# Optional (off by default): text present but not parsable by its cleaner.
INVALID_FORMAT_VALUE = "INVALID_FORMAT_VALUE"
HIGH = "HIGH"
MEDIUM = "MEDIUM"

ISSUE_SCHEMA = StructType([StructField(c, StringType(), True) for c in ISSUE_COLUMNS])


def issue_fields(
    dataset: str,
    record_id: Column,
    field: str,
    issue_type: str,
    description: str,
    severity: str,
) -> list[Column]:
    """The six issue columns, literal except for the record id."""
    return [
        F.lit(dataset).alias("dataset_name"),
        record_id.cast("string").alias("record_id"),
        F.lit(field).alias("field_name"),
        F.lit(issue_type).alias("issue_type"),
        F.lit(description).alias("issue_description"),
        F.lit(severity).alias("severity"),
    ]


def to_issues(
    df: DataFrame,
    dataset: str,
    record_id: Sequence[ColumnOrName] | ColumnOrName,
    field: str,
    issue_type: str,
    description: str,
    severity: str,
) -> DataFrame:
    """Project offending rows of ``df`` onto the issue schema."""
    keys = [record_id] if isinstance(record_id, (str, Column)) else list(record_id)
    return df.select(*issue_fields(dataset, key_text(keys, df), field, issue_type, description, severity))


def empty_issues(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ISSUE_SCHEMA)


def union_issues(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all by column name (duplicates kept)."""
    if not frames:
        raise ValueError("no issue frames to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
