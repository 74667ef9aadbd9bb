"""Reading and writing the storage layers.

Landing is CSV with a header; raw, cleaned and data-quality layers are
Parquet. Every write replaces its folder as a whole: it goes to a hidden sibling first
and takes the folder's place once it is complete, so a job that fails leaves the
old table, and a job may read the table it replaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class LayerPaths:
    """Folder layout under one root (local path or any Hadoop URI).

    ``landing_root`` lets the landing files live apart from the layers built
    from them (several runs over the same landing drop).
    """

    root: str
    landing_root: str | None = None

    def _join(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def landing(self, name: str) -> str:
        base = (self.landing_root or self.root).rstrip("/")
        return f"{base}/landing/{name}.csv"

    def raw(self, name: str) -> str:
        return self._join("raw", name)

    def cleaned(self, name: str) -> str:
        return self._join("cleaned", name)

    def issues(self, name: str) -> str:
        return self._join("data_quality", f"{name}_issues")

    def integrity_issues(self) -> str:
        return self._join("data_quality", "referential_integrity_issues")

    def all_issues(self) -> str:
        return self._join("data_quality", "all_issues")


def rows_to_frame(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str] | StructType) -> DataFrame:
    """A small in-memory table (types inferred from the rows unless a schema is given)."""
    return spark.createDataFrame(list(rows), columns if isinstance(columns, StructType) else list(columns))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    infer: bool = False,
    enforce_header: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV with a header row.

    With ``schema`` the columns are typed by POSITION (header names are not
    checked unless ``enforce_header``), and PERMISSIVE mode turns a cell that
    does not parse into null without an error. With ``infer=True`` and no
    schema, Spark samples the file to guess types (an extra pass).
    ``corrupt_column`` (optional, string) keeps the raw text of bad rows.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        if corrupt_column:
            from pyspark.sql.types import StringType, StructField

            schema = StructType([*schema.fields, StructField(corrupt_column, StringType(), True)])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema)
        if enforce_header:
            reader = reader.option("enforceSchema", False)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder. One whose writer died while it was being replaced is the old table again."""
    _recover(spark, path)
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet folder (optionally partitioned by columns) once ``df`` is written whole."""

    def save(writer: DataFrameWriter, to: str) -> None:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(to)

    replace(df, path, save)


def write_csv(df: DataFrame, path: str, compression: str | None = None, max_file_rows: int = 0) -> None:
    """Replace a CSV folder with a header row; null cells are written empty.

    ``compression`` is a codec of Spark's text files such as gzip. A compressed file is read by one
    task, so give ``max_file_rows`` with it: a task begins a new file after that many rows.

    Values are written as they are: Spark's CSV writer trims leading and
    trailing spaces unless told not to, which would clean padded codes before
    the cleaners ever see them.
    """
    replace(df, path, lambda writer, to: (
        writer.option("header", True)
        .option("compression", compression or "none")
        .option("maxRecordsPerFile", max_file_rows)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(to)
    ))


def replace(df: DataFrame, path: str, save: Callable[[DataFrameWriter, str], None]) -> None:
    """Write ``df`` to a hidden sibling of ``path`` and, once that is whole, publish it there.

    One writer a folder. Publishing is two renames (the old folder aside, the new one in
    place), atomic each on HDFS and local disks; between the two the folder is missing, and the
    next ``read_parquet`` or ``replace`` puts the old one back. An object store copies on rename;
    use a table format there if tables are large. Without a driver JVM (Spark Connect)
    the folder is overwritten in place.
    """
    spark = df.sparkSession
    fs = _files(spark, path)
    if fs is None:
        save(df.write.mode("overwrite"), path)
        return
    _recover(spark, path)
    files, at = fs
    final, staged, aside = at(path), _sibling(path, f"new-{uuid.uuid4().hex[:12]}"), _sibling(path, "old")
    try:
        save(df.write.mode("errorifexists"), staged)
    except BaseException:
        files.delete(at(staged), True)
        raise
    files.delete(at(aside), True)  # left by a writer that died behind its second rename
    if files.exists(final) and not files.rename(final, at(aside)):
        raise OSError(f"could not set {path} aside")
    if not files.rename(at(staged), final):
        files.rename(at(aside), final)
        raise OSError(f"could not publish {path}")
    files.delete(at(aside), True)
    spark.catalog.refreshByPath(path)  # as an overwrite does for what is cached over it


def _sibling(path: str, kind: str) -> str:
    """A name beside ``path`` that Spark's readers of the parent folder skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{kind}" if parent else f"_{name}.{kind}"


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and a maker of its paths; None under Spark Connect."""
    try:
        sc = spark.sparkContext
    except Exception:
        return None
    at = sc._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(sc._jsc.hadoopConfiguration()), at


def _recover(spark: SparkSession, path: str) -> None:
    fs = _files(spark, path)
    if fs is not None:
        files, at = fs
        aside = at(_sibling(path, "old"))
        if not files.exists(at(path)) and files.exists(aside):
            files.rename(aside, at(path))
