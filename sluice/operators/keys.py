"""Key operators: dedup, first-match lookups, distinct keys and values.

Dedup keeps one row per key as the minimum of a struct of (order columns,
then every other column); a single fixed-width payload column is a plain
min/max, which keeps a hash aggregate. By default only rows of duplicated
keys are aggregated (see ``dedup``). Either way it is an aggregate with
partial aggregation before the shuffle: a key that holds a third of the table is
reduced to one row per map task, where a ``row_number`` window would sort all
of its rows in one task. The full tie-break makes the kept row independent of
partitioning and input order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    IntegralType,
    MapType,
    TimestampNTZType,
    TimestampType,
)

_FIXED_WIDTH = (IntegralType, DoubleType, FloatType, BooleanType, DateType, TimestampType, TimestampNTZType)

from sluice.functions.columns import ColumnOrName, col_of
from sluice.operators.integrity import DEFAULT_MAX_BROADCAST_BYTES
from sluice.operators.skew import KeyFilter, join_unique, key_size
from sluice.sources.scratch import materialize


# Hashes of duplicated keys up to this many (16 bytes each) are broadcast so that
# only their rows are aggregated (the set is counted first). More of them go into a
# filter of that size.
DEFAULT_MAX_DUPLICATE_KEYS = 2_000_000
# A filter that would let more than this share of unique rows pass is not worth its job.
MAX_FALSE_SHARE = 0.5
# Below this many rows one full aggregate is cheaper than the extra jobs of
# the duplicated-only plan (a shuffle of 10M rows takes seconds).
DEFAULT_SMALL_ROWS = 10_000_000


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    keep: str = "first",
    count_col: str | None = None,
    strategy: str = "auto",
    max_duplicate_keys: int = DEFAULT_MAX_DUPLICATE_KEYS,
    small_rows: int = DEFAULT_SMALL_ROWS,
    duplicated: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """One row per key value; null keys form one group.

    ``keep="first"`` keeps the row with the smallest ``order_by`` values,
    ``"last"`` the largest; remaining ties are broken on all other columns.
    Column order of ``df`` is kept. ``count_col`` adds the number of input
    rows of each key (from the same aggregation).

    ``strategy="auto"`` counts the rows first (from Parquet footers when
    ``df`` is a scan or projection of one). A table of at most
    ``small_rows`` rows gets one aggregate over every row. A larger table
    shuffles whole rows only where it must: keys are reduced to 64-bit hashes,
    so a key of any width costs a long, and the hashes that occur more than
    once are found with a hash aggregate (partial first) and counted. With
    none, ``df`` comes back as it is. With at most ``max_duplicate_keys`` (16
    bytes each), rows of other hashes have unique keys and pass map-only past
    the broadcast set; only the rest, null-key rows among them, goes through
    the aggregate, which compares full keys. More hashes than that become a
    ``skew.KeyFilter`` of at most ``max_duplicate_keys`` words (16 bytes each,
    64 bits of filter), built per task and merged: rows it does not mark have
    unique keys and stay where they are, a few unique rows pass along with
    the repeated ones. Every row is aggregated only where the filter would let
    over half of the unique rows pass (about 44 recurring hashes a word) or with
    ``strategy="shuffle"``; ``strategy="duplicated"``
    skips the row count. ``duplicated`` passes a ready ``duplicated_keys``
    result (shared with the unique-key rule) and implies that plan.
    """
    keys = list(keys)
    if duplicated is not None or (
        keys and (strategy == "duplicated" or (strategy == "auto" and df.count() > small_rows))
    ):
        return _dedup_duplicated_only(df, keys, order_by, keep, count_col, max_duplicate_keys, duplicated)
    return _dedup_all(df, keys, order_by, keep, count_col)


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """Non-null key values that occur more than once, with their row count
    ``__n``, and how many there are. Key-only hash aggregate, partial first."""
    keys = list(keys)
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    dup = materialize(
        df.where(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    )
    return dup, dup.count()


def _dedup_duplicated_only(df, keys, order_by, keep, count_col, max_duplicate_keys, duplicated=None):
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    key_hash = F.xxhash64(*keys)
    if duplicated is not None:
        dup = duplicated[0].select(key_hash.alias("__hash")).distinct()
    else:
        dup = df.where(~any_null).groupBy(key_hash.alias("__hash")).agg(F.count(F.lit(1)).alias("__n"))
        dup = dup.where(F.col("__n") > 1).select("__hash")
    dup = materialize(dup)
    n_dup = dup.count()
    # One map-only pass marks the rows to aggregate: a hash that recurs, or a
    # null in the key (one group per null pattern; a hot one collapses in the
    # partial aggregation before the shuffle).
    hashed = df.withColumn("__hash", key_hash)
    if n_dup > max_duplicate_keys:
        recurring = KeyFilter(dup, ["__hash"], n_dup, max_duplicate_keys)
        if recurring.false_share > MAX_FALSE_SHARE:
            return _dedup_all(df, keys, order_by, keep, count_col)
        marked = recurring.mark(hashed, "__again")
        again = any_null | F.col("__again")
    else:
        marked = hashed.join(F.broadcast(dup.withColumn("__again", F.lit(True))), "__hash", "left")
        again = any_null | F.col("__again").isNotNull()
    singles = marked.where(~again).select(
        *df.columns, *([F.lit(1).cast("long").alias(count_col)] if count_col else []))
    rest = marked.where(again).select(*df.columns)
    return singles.unionByName(_dedup_all(rest, keys, order_by, keep, count_col))


def _dedup_all(df, keys, order_by, keep, count_col):
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    maps = {f.name for f in df.schema.fields if isinstance(f.dataType, MapType)}
    rest = [c for c in df.columns if c not in keys and c not in order_by and c not in maps]
    payload = order_by + rest
    pick = F.min if keep == "first" else F.max
    aggs = [F.count(F.lit(1)).alias(count_col)] if count_col else []
    if not payload and not maps:
        out = df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
        return out.select(*df.columns, *([count_col] if count_col else []))
    types = {f.name: f.dataType for f in df.schema.fields}
    if len(payload) == 1 and not maps and isinstance(types[payload[0]], _FIXED_WIDTH):
        # One fixed-width column: a plain min/max keeps a hash aggregate.
        # Nulls order first, as in the struct form: "first" keeps a null.
        c = F.col(payload[0])
        value = pick(c)
        if keep == "first":
            value = F.when(F.count(F.lit(1)) > F.count(c), F.lit(None)).otherwise(value)
        out = df.groupBy(*keys).agg(value.alias(payload[0]), *aggs)
        return out.select(*df.columns, *([count_col] if count_col else []))
    if payload:
        aggs.append(pick(F.struct(*[F.col(c) for c in payload])).alias("__kept"))
    order_struct = F.struct(*[F.col(c) for c in payload]) if payload else None
    for m in sorted(maps):
        # Maps are not orderable: carry the value of the kept row's order.
        by = order_struct if order_struct is not None else F.lit(0)
        aggs.append((F.min_by if keep == "first" else F.max_by)(F.col(m), by).alias(m))
    out = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(f"__kept.{c}").alias(c) if c in payload else F.col(c) for c in df.columns]
    return out.select(*cols, *([F.col(count_col)] if count_col else []))


def distinct_values(df: DataFrame, column: ColumnOrName) -> DataFrame:
    """Distinct values of one column, null included."""
    return df.select(col_of(column)).distinct()


def distinct_keys(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Distinct non-null key values."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.select(*keys).dropna(how="any").distinct()


# Parent rows per broadcast lookup (deduplicated rows, counted first).
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
# A child key with more rows than this is "hot".
DEFAULT_HOT_KEY_ROWS = 1_000_000


def lookup_first(
    child: DataFrame,
    parent: DataFrame,
    key: str | Sequence[str],
    columns: Sequence[str],
    parent_key: str | Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add parent ``columns`` to each child row by key; one parent row per key.

    Parents are deduplicated first (``order_by`` picks the row), so a child row
    never multiplies; a child without a parent, or with a null key, keeps
    nulls. The parent's rows (Parquet footers for a scan) and bytes are measured first:

    - up to ``max_broadcast_rows`` rows and ``max_broadcast_bytes`` (or, for a
      larger parent, up to that many deduplicated rows, checkpointed and
      measured) it is broadcast and the lookup is map-only (the child never
      moves);
    - a larger parent is joined with a shuffle by ``skew.join_unique``: of child
      keys with more than ``hot_key_rows`` rows (counted map-side first), the
      hottest that fit the bounds are matched map-only against their broadcast
      parent rows; the others are salted over several buckets, each with a copy
      of the parent row. So no task receives a hot key, however many there are.

    Null child keys never enter a shuffle.
    """
    ck = [key] if isinstance(key, str) else list(key)
    pk = ([parent_key] if isinstance(parent_key, str) else list(parent_key)) if parent_key else ck
    renamed = parent.select(
        *[F.col(p).alias(c) for p, c in zip(pk, ck)],
        *[F.col(c) for c in columns],
        *[F.col(o) for o in order_by if o not in columns and o not in pk],
    )
    present = renamed.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ck]))

    def small(df: DataFrame) -> bool:
        n, size = key_size(df, df.columns)
        return n <= max_broadcast_rows and size <= max_broadcast_bytes

    if small(renamed):
        # The measured rows bound the deduplicated parent. Null keys cannot
        # crowd a map-only join: one scan of the child.
        one = dedup(present, ck, order_by, strategy="shuffle").select(*ck, *columns)
        return child.join(F.broadcast(one), on=ck, how="left")
    one = materialize(dedup(present, ck, order_by).select(*ck, *columns))
    if small(one):
        return child.join(F.broadcast(one), on=ck, how="left")
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in ck])
    types = dict(renamed.dtypes)
    keyed = child.where(~any_null)
    unkeyed = child.where(any_null).select(
        *[F.col(c) for c in ck], *[F.col(c) for c in child.columns if c not in ck],
        *[F.lit(None).cast(types[c]).alias(c) for c in columns],
    )
    hot = materialize(
        keyed.groupBy(*ck).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > hot_key_rows)
    )
    return join_unique(keyed, one, ck, "left", hot, hot_key_rows, max_broadcast_rows, max_broadcast_bytes).unionByName(unkeyed)


def lookup_constant(
    key: ColumnOrName,
    table: Mapping[object, Mapping[str, object]],
    columns: Sequence[str],
) -> list[Column]:
    """Columns looked up in a small constant table held in the plan.

    ``table`` maps a key to its attributes. The lookup is a map literal
    inside the projection: no join, no broadcast, no shuffle. Missing keys
    give nulls.
    """
    if not table:
        raise ValueError("empty lookup table")
    # One type per attribute: a column with any float is double throughout.
    floats = {c for c in columns if any(isinstance(a.get(c), float) for a in table.values())}

    def value(attrs, c):
        v = F.lit(attrs.get(c))
        return v.cast("double") if c in floats else v

    entries = []
    for k, attrs in table.items():
        entries += [F.lit(k), F.struct(*[value(attrs, c).alias(c) for c in columns])]
    hit = F.try_element_at(F.create_map(*entries), col_of(key))
    return [hit.getField(c).alias(c) for c in columns]
