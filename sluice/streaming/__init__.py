"""Incremental landing → cleaned promotion with Structured Streaming.

The reference runs batch jobs only. What carries over to a stream is the
stateless half of a dataset: the typed CSV read, the cleaners and the row
rules look at one row at a time, so each new landing file can be cleaned and
checked as it arrives. Dedup, the unique-key rule and foreign keys need the
whole table and stay in the batch pipeline.

``promote_landing_stream`` reads new CSV files in the landing folder and, per
micro-batch, writes cleaned rows and row-rule issues into a ``batch_id=<n>``
folder of each output (overwrite mode). A batch replayed after a failure
rewrites its own folder instead of appending twice, so the output is
exactly-once; readers see ``batch_id`` as a partition column. The streaming
checkpoint must sit on shared storage on a cluster, and belongs to its output
folders: batch numbers start again with a new checkpoint, so give that new
output folders too.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.rules import UnparsedRule, row_rule_issues
from sluice.plans.specs import DatasetSpec


def read_landing_stream(spark: SparkSession, spec: DatasetSpec, folder: str, max_files: int = 1000) -> DataFrame:
    """New CSV files of ``folder`` as a stream, typed by the spec's schema;
    at most ``max_files`` of them make one micro-batch."""
    return (
        spark.readStream.schema(spec.schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("maxFilesPerTrigger", max_files)
        .csv(folder)
    )


def clean_stream(spec: DatasetSpec, stream: DataFrame) -> DataFrame:
    """Cleaned rows of a stream (same projection as the batch path), with the
    raw text of ``report_unparsed`` columns for the issue pass."""
    return spec.clean(stream, keep_raw=True)


def row_issue_stream(spec: DatasetSpec, cleaned: DataFrame) -> DataFrame | None:
    """Row-rule and unparsed-value issues of a cleaned stream (None if the spec has neither)."""
    rules = [*spec.row_rules, *(UnparsedRule(c, f"__raw__{c}") for c in spec.report_unparsed)]
    return row_rule_issues(cleaned, spec.name, list(spec.key), rules) if rules else None


def batch_writer(spec: DatasetSpec, cleaned_path: str, issues_path: str):
    """The micro-batch sink: cleaned rows and row-rule issues of one batch,
    each into its own ``batch_id=<n>`` folder (a replay overwrites it)."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        part = f"batch_id={batch_id}"
        batch = batch.persist(StorageLevel.DISK_ONLY)  # both writes read it; the files are parsed once
        try:
            batch.drop(*spec.raw_columns()).write.mode("overwrite").parquet(f"{cleaned_path.rstrip('/')}/{part}")
            issues = row_issue_stream(spec, batch)
            if issues is not None:
                issues.write.mode("overwrite").parquet(f"{issues_path.rstrip('/')}/{part}")
        finally:
            batch.unpersist()

    return write_batch


def promote_landing_stream(
    spark: SparkSession,
    spec: DatasetSpec,
    landing_folder: str,
    cleaned_path: str,
    issues_path: str,
    checkpoint: str,
    available_now: bool = True,
    max_files: int = 1000,
) -> StreamingQuery:
    """Start the incremental promotion; ``available_now`` processes the
    files present now and stops (a scheduled incremental batch)."""
    cleaned = clean_stream(spec, read_landing_stream(spark, spec, landing_folder, max_files))
    writer = cleaned.writeStream.foreachBatch(batch_writer(spec, cleaned_path, issues_path)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
