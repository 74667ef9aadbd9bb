"""Profiles, summaries, previews and counted writes.

Everything returns a DataFrame; nothing is printed or collected here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)


def profile(
    df: DataFrame, columns: Sequence[str] | None = None, distinct: Sequence[str] = (), approx: bool = False
) -> DataFrame:
    """One row per column: column_name, data_type, row_count, null_count, distinct_count.

    All columns are measured in ONE aggregation over one scan; the single
    result row is unpivoted in place. Row and null counts move one row per
    task. ``distinct_count`` is null except for the columns named in
    ``distinct``: it is exact (null not counted), by ``distinct_counts``.
    ``approx=True`` takes HyperLogLog sketches instead, one per task and column.
    """
    columns = list(columns or df.columns)
    if unknown := set(distinct) - set(columns):
        raise ValueError(f"distinct counts asked for columns not profiled: {sorted(unknown)}")
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(columns):
        aggs.append(F.count(F.col(c)).alias(f"__nn{i}"))
        measure = F.approx_count_distinct(F.col(c)) if approx and c in distinct else F.max(F.lit(None).cast("long"))
        aggs.append(measure.alias(f"__nd{i}"))
    one = df.agg(*aggs)
    exact = [c for c in columns if c in distinct] if not approx else []
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.col("__rows").alias("row_count"),
            (F.col("__rows") - F.col(f"__nn{i}")).alias("null_count"),
            (F.lit(0).cast("long") if c in exact else F.col(f"__nd{i}")).alias("distinct_count"),
        )
        for i, c in enumerate(columns)
    ]
    out = one.select(F.inline(F.array(*rows)))
    if not exact:
        return out
    counted = F.broadcast(distinct_counts(df, exact))  # a row per named column
    return out.join(counted, "column_name", "left").select(
        *[c for c in out.columns if c != "distinct_count"],
        F.coalesce("values", "distinct_count").alias("distinct_count"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name``, ``values``: the number of distinct non-null values of each column (no
    row for a column without any). Exact.

    All columns go through one aggregate over (column, value), combined per task before the shuffle, so a
    value that a task meets often moves once, and a row moves none of its other columns. Values
    stand as what their type compares by: whole numbers, dates and timestamps as longs,
    floats as doubles (NaN and the two zeros group as Spark groups them), anything else as itself if it
    is text, bytes or a decimal, or as its JSON text. Equal only if equal: no hash decides.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    families: dict[str, list[tuple[str, Column]]] = {}
    for c in columns:
        kind, v = kinds[c], F.col(c)
        if isinstance(kind, (IntegralType, BooleanType)):
            family, v = "long", v.cast("long")
        elif isinstance(kind, DateType):
            family, v = "long", F.unix_date(v).cast("long")
        elif isinstance(kind, TimestampType):
            family, v = "long", F.unix_micros(v)
        elif isinstance(kind, (FloatType, DoubleType)):
            family, v = "double", v.cast("double")
        elif isinstance(kind, (StringType, BinaryType)):
            family = kind.simpleString()
        elif isinstance(kind, (DecimalType, TimestampNTZType)):
            family, v = "string", v.cast("string")
        else:
            family, v = "string", F.to_json(F.struct(v))
            v = F.when(F.col(c).isNotNull(), v)
        families.setdefault(family, []).append((c, v))
    # One entry per column and row: its number, and its value in the field of its family.
    fields = sorted(families)
    entries = [
        F.struct(F.lit(columns.index(c)).alias("i"), *[(v if f == family else F.lit(None).cast(f)).alias(f) for f in fields])
        for family in fields for c, v in families[family]
    ]
    one = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    present = reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in fields])
    values = one.where(present).groupBy("i", *fields).agg(F.count(F.lit(1)).alias("rows"))
    names = F.array(*[F.lit(c) for c in columns])
    return values.groupBy(F.element_at(names, F.col("i") + 1).alias("column_name")).agg(F.count(F.lit(1)).alias("values"))


def issue_summary(issues: DataFrame, by: Sequence[str] = ("issue_type", "severity")) -> DataFrame:
    """Issue counts per group (``issue_count``)."""
    return issues.groupBy(*by).agg(F.count(F.lit(1)).alias("issue_count"))


def preview(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows by ``order_by``: a repeatable top-n.

    Planned as a per-partition top-n then a merge of n rows per partition,
    never a full sort.
    """
    return df.orderBy(*order_by).limit(n)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that fills in when an action (e.g. a write) runs.

    Counts ride on the write itself: no second pass over the data.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def observed_rows(obs: Observation) -> int:
    return int(obs.get["rows"])
