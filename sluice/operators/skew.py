"""Key filters and joins that stay even when key sets outgrow every broadcast bound.

``KeyFilter`` is a Bloom filter kept as a small table: one row per 64-bit word that has a
bit set. Each task ORs the words of its own keys (partial aggregation) and the shuffle merges them,
so it takes any number of keys in a fixed size. It answers "may be one of the keys" as a
function of the key alone; false positives cost work, never rows.

``join_unique`` joins rows to a side with one row per key while some keys are hot:

1. the hottest keys, as many as fit the broadcast bounds, are matched map-only;
2. there may be any number of hot keys left. A ``KeyFilter`` marks them on both sides and says how
   many buckets each needs, one for ``hot_rows`` of its rows: marked rows are dealt over that many, marked
   keys are copied into each, so no task gets more than about ``hot_rows`` rows of one key, and the copies
   are about as many as all rows of hot keys by ``hot_rows``. The filter keeps few bits in many words, as a key that is
   marked by mistake is copied too;
3. all other keys take the same shuffled join with a single bucket.

The salt of a row is a hash of its place in its input partition, so a repeated task deals the same rows to the
same buckets as long as it reads them in the same order, as scans and checkpoints do.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DataType, DateType, DecimalType, NumericType, StringType, TimestampNTZType, TimestampType

from sluice.sources.scratch import materialize

#: Words of a filter at most: a row of 16 bytes each, 32 MB in all, is what is broadcast.
MAX_WORDS = 2_000_000


def fixed_width(kind: DataType) -> int | None:
    """Bytes of a value in a row, None for variable-width types."""
    if isinstance(kind, DecimalType):
        return 16
    return 8 if isinstance(kind, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)) else None


def variable_length(df: DataFrame, column: str) -> Column:
    """Bytes of a variable-width value (of its JSON text, if it is nested)."""
    c = F.col(column) if isinstance(df.schema[column].dataType, (StringType, BinaryType)) else F.to_json(F.struct(column))
    return F.coalesce(F.octet_length(c), F.lit(0))


def key_size(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows, and bytes of the key columns: widths for fixed-width types (rows come from
    Parquet footers for a scan), measured text lengths for others."""
    fixed, measured = 0, []
    for k in keys:
        width = fixed_width(df.schema[k].dataType)
        if width is None:
            measured.append(F.coalesce(F.sum(variable_length(df, k)), F.lit(0)))
            width = 16  # place and length of a variable value
        fixed += width
    if not measured:
        rows, extra = df.count(), 0
    else:
        rows, *lengths = df.agg(F.count(F.lit(1)), *measured).first()
        extra = sum(lengths)
    return rows, rows * fixed + extra


class KeyFilter:
    """Marks rows whose key may be among ``keys`` (a frame of the key columns ``names``, no nulls).

    ``rows`` is the number of keys, ``false_share`` the expected share of other keys that
    are marked. Words of the filter are checkpointed, at most ``max_words`` of them.

    ``buckets``, a column of ``keys``, makes it a filter for ``deal``: a word keeps the largest number of
    its keys. Keys then have all ``max_words`` words to fall into, of which those without a key take no room."""

    def __init__(self, keys: DataFrame, names: Sequence[str], rows: int, max_words: int = MAX_WORDS, buckets: str | None = None):
        self.names = list(names)
        self.words = max(1, max_words if buckets else min(max_words, rows // 4))  # 16 bits a key, while the bound allows
        load = max(rows, 1) / self.words
        self.bits = max(1, min(8, round(64 / load * 0.69)))
        self.false_share, chance = 0.0, math.exp(-min(load, 500))  # over the Poisson number of keys a word holds
        for held in range(1, int(min(load, 500) + 10 * load ** 0.5) + 10):
            chance *= min(load, 500) / held
            self.false_share += chance * (1 - (1 - 1 / 64) ** (held * self.bits)) ** self.bits
        word, mask = self._word(), self._mask()
        most = [F.max(buckets).alias("__buckets")] if buckets else []
        self.table = materialize(keys.groupBy(word.alias("__word")).agg(F.bit_or(mask).alias("__bits"), *most))

    def _word(self) -> Column:
        return F.pmod(F.xxhash64(*self.names), F.lit(self.words))

    def _mask(self) -> Column:
        """Six bits of a second hash choose each bit."""
        second = F.xxhash64(F.lit("bits"), *self.names)
        one = F.lit(1).cast("long")
        chosen = [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(self.bits)]
        return reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", one, c) for c in chosen])

    def mark(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with boolean ``column``, map-only. A key with a null is never marked."""
        return self._look_up(df, column, lambda hit: F.coalesce(hit, F.lit(False)))

    def deal(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with the number of buckets of each row's key in ``column``, map-only: 1 if it is not marked."""
        return self._look_up(df, column, lambda hit: F.when(hit, F.col("__buckets")).otherwise(1))

    def _look_up(self, df: DataFrame, column: str, value: Callable[[Column], Column]) -> DataFrame:
        mask = self._mask()
        hit = (F.col("__bits").bitwiseAND(mask) == mask)
        no_null = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in self.names])
        joined = df.withColumn("__word", self._word()).join(F.broadcast(self.table), "__word", "left")
        return joined.withColumn(column, value(hit & no_null)).drop(*self.table.columns)


def join_unique(
    rows: DataFrame,
    one: DataFrame,
    names: Sequence[str],
    how: str,
    hot: DataFrame,
    hot_rows: int,
    max_keys: int,
    max_bytes: int,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """``rows`` joined on ``names`` (no nulls) to ``one``, which has one row per key; ``how`` is left,
    inner or left_semi. ``hot`` holds the keys with over ``hot_rows`` rows and their number
    ``__rows``; pass it checkpointed. ``max_keys`` and ``max_bytes`` bound what is broadcast."""
    names, hot_rows = list(names), max(1, hot_rows)
    if (n_hot := hot.count()) == 0:
        return rows.join(one, names, how)
    # Both sides hash the same type: a number that the other side's type does not hold matches nothing.
    for name in names:
        kind, other = rows.schema[name].dataType, one.schema[name].dataType
        if kind != other:
            if not (isinstance(kind, NumericType) and isinstance(other, NumericType)):
                return rows.join(one, names, how)
            cast = F.col(name).try_cast(kind)
            one = one.where(F.col(name) == cast).withColumn(name, cast)
    payload = names if how == "left_semi" else one.columns
    # Of ``one``, only what may be hot is shuffled for that.
    asked = KeyFilter(hot.select(*names), names, n_hot, max_words).mark(one.select(*payload), "__held").where("__held")
    found = materialize(hot.join(asked, names, "left"))
    widths = [fixed_width(one.schema[c].dataType) for c in payload]
    size = sum(w or 16 for w in widths) + sum((variable_length(found, c) for c, w in zip(payload, widths) if w is None), F.lit(0))
    tier = F.floor(F.log2(F.col("__rows"))).cast("int")
    tiers = found.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).collect()  # 64 rows at most
    n = total = 0
    least = None  # lowest tier that is broadcast with those above it
    for t in sorted(tiers, reverse=True):
        n, total = n + t.n, total + t.bytes
        if n > max_keys or total > max_bytes:
            break
        least = t.tier
    rest = [t for t in tiers if least is None or t.tier < least]
    parts, others = [], rows
    if least is not None:
        top = found.filter(tier >= least)
        others = rows.join(F.broadcast(top.select(*names)), names, "left_anti")
        if how == "left":
            parts.append(rows.join(F.broadcast(top.drop("__rows", "__held")), names, "inner"))
        else:
            parts.append(rows.join(F.broadcast(top.filter("__held").drop("__rows", "__held")), names, how))
    if not rest:
        parts.append(others.join(one, names, how))
    else:
        keys = found.where(tier < least) if least is not None else found
        needed = F.ceil(F.col("__rows") / hot_rows).cast("int").alias("__needed")
        marks = KeyFilter(keys.select(*names, needed), names, sum(t.n for t in rest), max_words, "__needed")
        place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("__dealt")).cast("int")
        dealt = marks.deal(others, "__dealt").withColumn("__salt", place).drop("__dealt")
        salts = F.sequence(F.lit(0), F.col("__dealt") - 1)
        spread = marks.deal(one, "__dealt").withColumn("__salt", F.explode(salts)).drop("__dealt")
        # A plain shuffled join: the spread side may be small enough for Spark to broadcast, which is as even.
        parts.append(dealt.join(spread, [*names, "__salt"], how).drop("__salt"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
