"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.sources.scratch import scratch_path


def fresh(columns: Iterable[str], base: str) -> str:
    """``base``, or ``base`` with underscores before it until no column has that name."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambda functions."""
    return F.transform(F.array(value), body)[0]


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new Parquet folder under the shared checkpoint folder and read it
    back. Lineage ends there: a lost executor costs a read, not the work before it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    saved = df.sparkSession.read.schema(df.schema).parquet(path)
    saved._saved_at = path
    return saved


def drop_saved(*frames: DataFrame) -> None:
    """Delete tables written by ``save`` that nothing reads any more, and let Spark's cleaner
    find the shuffle files of their jobs (it follows the driver's garbage collection)."""
    for df in frames:
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(df._saved_at)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    gc.collect()
    context._jvm.System.gc()


#: A key is hot if it has over this many rows and over one thousandth of all rows.
HOT_ROWS = 100_000
HOT_SHARE = 1000
#: Where keys are counted already, splitting them costs no pass over the rows.
HOT_LEAST = 1000


def join_one(rows: DataFrame, one: DataFrame, key: list[str], hot_rows: int = HOT_ROWS, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``one``, which has one row per ``key``; no null keys. ``how`` is inner or left.

    Hot keys, fewer than a thousand by their definition, are matched by a broadcast of their
    rows of ``one``, so that a key with a third of all rows never meets in one task. The
    others are shuffled. Both inputs are read more than once: pass saved tables."""
    total = rows.count()
    least = max(hot_rows, total // HOT_SHARE)
    if total <= least:
        return rows.join(one, key, how)
    hot = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least).select(*key)
    hot = save(hot, "hot-keys")
    if hot.isEmpty():
        return rows.join(one, key, how)
    picked = save(one.join(F.broadcast(hot), key), "hot-matches")
    of_hot = rows if how == "inner" else rows.join(F.broadcast(hot), key, "left_semi")
    return of_hot.join(F.broadcast(picked), key, how).unionByName(
        rows.join(F.broadcast(hot), key, "left_anti").join(one, key, how))


def join_counted(rows: DataFrame, one: DataFrame, key: list[str], how: str = "inner", count: str = "n") -> DataFrame:
    """``rows`` joined to ``one``, which has one row per ``key`` and in ``count`` (left out of the result) the number of the key's
    rows; ``how`` is inner or left_semi. Pass saved tables. Keys with over a thousandth of all rows, fewer than a
    thousand of them, are matched by a broadcast, so no key with a share of all rows meets in one task."""
    total = one.agg(F.sum(count)).first()[0] or 0
    least = max(HOT_LEAST, total // HOT_SHARE)
    hot = one.filter(F.col(count) > least).drop(count)
    if hot.isEmpty():
        return rows.join(one.drop(count), key, how)
    return rows.join(F.broadcast(hot), key, how).unionByName(
        rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(one.filter(F.col(count) <= least).drop(count), key, how))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without its columns of these names (upper and lower case alike)."""
    names = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in names])
