"""Repeated-passage removal by buckets of suffixes, refined from anchored blocks.

A byte goes if some ``length``-byte string covers it that also starts at another place
of the corpus, in the same text or another. Suffixes are compared by bucket identifiers:

1. **Initial q-gram buckets.** In each text, the bucket identifier of the 64 bytes at
   every offset is built from its 8-grams by pointer doubling: id16(p) = (id8(p),
   id8(p + 8)), up to 128. Each level mixes
   the identifiers that the level before has made. Each string start (a *window*) belongs to the least 64-gram within it, the
   leftmost of equals. Equal windows hold it at equal places, so they share its bucket.
   Neighbouring windows with the same 64-gram form a *block*, which is one row: about
   one row per 55 bytes moves instead of one per byte.
2. **Singletons settle.** A 64-gram found once ends its windows there.
3. **Blocks that repeat whole settle.** Every window in a block found twice repeats.
4. **Refinement.** Other blocks are bucketed by the identifiers at two later offsets:
   128 bytes from the 64-gram, or 128 bytes around it. Every window holds one or the
   other, so two blocks that share neither share no window.
5. **Last refinement.** The windows that remain are bucketed by their bytes.

Identifiers of 64 and 128 bytes are 64-bit mixes; unequal bytes may share one, so they only ever add
candidates. What settles is equal in a 128-bit BLAKE2b digest of its bytes: of a whole block in
step 3, of a window in step 5.

This is not the whole of bucket-pointer refinement: identifiers of later offsets come from the bytes, not from the
numbers of sorted buckets, so no bucket waits for another. The README has the figures of the dense form.

Between levels, the surviving buckets are
written to the shared checkpoint folder and the level before is deleted. Counts are
combined before each shuffle, joins go from many rows to one row per bucket with hot buckets
matched by a bounded broadcast, and windows
of copied texts arrive as whole blocks, so no group is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import drop_saved, fresh, join_counted, save

GRAM = 64
#: Bytes handled at once; a memory bound only, results do not depend on it.
CHUNK = 1 << 16
#: Shares of the last buckets that are settled one after another; a disk bound only.
PARTS = 4
_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_PLACE = np.uint64(CHUNK * 2 - 1)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The identifier of a pair of identifiers."""
    h = a * _K1
    h += b * _K2
    h ^= h >> np.uint64(29)
    h *= _K3
    h ^= h >> np.uint64(32)
    return h


def _identifiers(data: np.ndarray) -> dict[int, np.ndarray]:
    """Bucket identifiers of 64 and 128 bytes at each offset that has so many."""
    n = len(data) - 7
    level = np.empty(n, np.uint64)
    for k in range(8):
        part = level[k::8]
        part[:] = np.frombuffer(data, "<u8", count=len(part), offset=k)
    ids, size = {}, 8
    while size < 128:
        level = _mix(level[:-size], level[size:])
        size *= 2
        ids[size] = level
    return ids


def _least(gram: np.ndarray, width: int) -> np.ndarray:
    """For each start of a run of ``width`` grams, the place of the least gram in it."""
    key = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < width:
        key = np.minimum(key[: len(key) - (width - size)], key[width - size:])
    return (key & _PLACE).astype(np.int64)


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column in one array, and where each text begins and ends in it."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, count=len(column) + 1, offset=4 * column.offset)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets.astype(np.int64)


def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """The digests of the bytes in each span, as two columns of integers."""
    view = memoryview(data)
    made = b"".join([blake2b(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist())])
    pairs = np.frombuffer(made, "<i8").reshape(-1, 2)
    return [pairs[:, 0], pairs[:, 1]]


def _middle(length: int) -> int:
    """A window whose gram is at most this far in holds 128 bytes from the gram on; any other
    holds the 64 before it and the gram."""
    return (length - 128 + GRAM - 1) // 2


def _find_blocks(length: int):
    """Rows (gram, block1, block2, ahead, around, key columns, place) of every text's blocks; ``block`` is their bytes' digest.

    ``place`` packs the block's first window, its number of windows less one and the
    gram's distance from the first window."""
    width, middle = length - GRAM + 1, _middle(length)

    def blocks(data, starts, ends, base):
        ids = _identifiers(data)
        windows = np.arange(len(data) - length + 1)
        text = np.searchsorted(ends, windows + base, side="right")
        inside = windows + base + length <= ends[text]
        windows, text = windows[inside], text[inside]
        if not len(windows):
            return None
        at = _least(ids[GRAM], width)[windows]
        cut = np.flatnonzero((np.diff(at) != 0) | (np.diff(text) != 0)) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(windows)]]) - 1
        anchor, text = at[first], text[first]
        first, last = windows[first], windows[last]
        gram = ids[GRAM][anchor]
        block = _digests(data, first, last + length)
        most = len(ids[128]) - 1
        ahead = np.where(anchor - last <= middle, ids[128][np.minimum(anchor, most)], 0)
        around = np.where(anchor - first > middle, ids[128][np.maximum(anchor - GRAM, 0)], 0)
        place = (first + base - starts[text]) << 16 | (last - first) << 8 | anchor - first
        return gram, *block, ahead, around, text, place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _buffer(batch.column(0))
            starts, ends = offsets[:-1], offsets[1:]
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)]
            for base in range(int(offsets[0]), int(offsets[-1]), CHUNK):
                part = data[base: min(base + CHUNK + length - 1, int(offsets[-1]))]
                found = blocks(part, starts, ends, base) if len(part) >= length else None
                if found is not None:
                    *ids, text, place = found
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(x.view(np.int64)) for x in ids), *(pa.array(k[text]) for k in keys), pa.array(place)],
                        ["gram", "block1", "block2", "ahead", "around", "key1", "key2", "place"])

    return run


def _find_windows(length: int):
    """Rows (digest, key columns, start, copies) of the windows asked for in each text."""
    middle = _middle(length)

    def wanted(place, ahead):
        first, count, anchor = place >> 16, (place >> 8 & 255) + 1, place & 255
        turn = max(0, min(count, anchor - middle))  # windows from the first whose gram is far off
        return (first + turn, count - turn) if ahead else (first, turn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            data, offsets = _buffer(batch.column(0))
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            for i, asked in enumerate(batch.column(3)):
                if keys[i] in seen:  # a copy of a text done before
                    continue
                seen.add(keys[i])
                place, ahead, many = (asked.values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                rows = [wanted(int(p), bool(a)) for p, a in zip(place, ahead, strict=True)]
                order = sorted((s, n, bool(m)) for (s, n), m in zip(rows, many, strict=True) if n)
                if not order:
                    continue
                starts = np.concatenate([np.arange(s, s + n, dtype=np.int32) for s, n, _ in order])
                copies = np.repeat(np.array([2 if m else 1 for _, _, m in order], np.int32), [n for _, n, _ in order])
                for low in range(0, len(starts), CHUNK):
                    at = starts[low: low + CHUNK]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(d) for d in _digests(data[offsets[i]: offsets[i + 1]], at, at + length)),
                         *(pa.array(np.full(len(at), x)) for x in (np.int64(keys[i][0]), np.int32(keys[i][1]))), pa.array(at), pa.array(copies[low: low + CHUNK])],
                        ["d1", "d2", "key1", "key2", "start", "copies"])

    return run


def repeated_spans(docs: DataFrame, text: str = "text", length: int = 200) -> DataFrame:
    """One row per text that has bytes to remove: its key columns and ``spans``, an array of
    (start, size) in no order, which may overlap. Repeated rows share a row."""
    if not 191 <= length <= 255:
        raise ValueError("length must be between 191 and 255 bytes")
    keyed = docs.select(*text_key(text), F.col(text).alias("text")).filter(F.octet_length("text") >= length)
    keyed = keyed.select("text", "key1", "key2")
    blocks = save(keyed.mapInArrow(
        _find_blocks(length), "gram long, block1 long, block2 long, ahead long, around long, key1 long, key2 int, place long"), "blocks")
    # q-gram buckets with two members or more; in `whole` ones all members are one block
    same = (F.min("block1") == F.max("block1")) & (F.min("block2") == F.max("block2"))
    grams = save(blocks.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), same.alias("whole")).filter("n > 1"), "grams")
    live = save(join_counted(blocks, grams, ["gram"]), "live-blocks")
    drop_saved(blocks, grams)
    kinds = save(live.filter("not whole").groupBy("block1", "block2").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key1", "key2", "place")).alias("at"),
        F.first("ahead").alias("ahead"), F.first("around").alias("around")).select(
        "block1", "block2", "n", (F.col("n") > 1).alias("many"), "at.*", "ahead", "around"), "block-kinds")
    settled = live.filter("whole").drop("whole").unionByName(join_counted(
        live.filter("not whole").drop("whole"), kinds.filter("many").select("block1", "block2", "n"), ["block1", "block2"], "left_semi"))
    settled = save(settled.select(
        "key1", "key2", F.struct(F.shiftright("place", 16).alias("start"), (
            F.shiftright("place", 8).bitwiseAND(255) + length).alias("size")).alias("span")).distinct(), "settled")
    drop_saved(live)
    sides = kinds.select("key1", "key2", "place", "many", F.explode(F.array(
        F.struct(F.lit(True).alias("ahead"), F.col("ahead").alias("bucket")),
        F.struct(F.lit(False).alias("ahead"), F.col("around").alias("bucket")))).alias("s")).select(
        "key1", "key2", "place", "many", "s.*").filter("bucket != 0")
    shared = save(sides.groupBy("ahead", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("many").alias("all_many")).filter("n > 1 and not all_many").drop("all_many"), "shared-sides")
    asked = save(join_counted(sides, shared, ["ahead", "bucket"], "left_semi").groupBy("key1", "key2").agg(
        F.collect_list(F.struct("place", "ahead", "many")).alias("asked")), "asked")
    drop_saved(kinds, shared)
    windows = save(keyed.join(asked.hint("shuffle_hash"), ["key1", "key2"]).select(
        "text", "key1", "key2", "asked").mapInArrow(
        _find_windows(length), "d1 long, d2 long, key1 long, key2 int, start int, copies int"), "windows")
    drop_saved(asked)
    found, parts = settled, []
    for part in range(PARTS):  # one share of the buckets at a time, so that only its rows lie in shuffle files
        mine = windows.filter(F.pmod("d1", F.lit(PARTS)) == part)
        repeated = save(mine.groupBy("d1", "d2").agg(F.sum("copies").alias("n"), F.min("copies").alias("least")).filter(
            "n > 1 and least = 1").drop("least"), "repeated")
        some = save(join_counted(mine.filter("copies = 1").drop("copies"), repeated, ["d1", "d2"], "left_semi").select(
            "key1", "key2", F.struct(F.col("start").cast("long").alias("start"), F.lit(length).cast("long").alias("size")).alias("span")), "repeated-windows")
        drop_saved(repeated)
        found, parts = found.unionByName(some), [*parts, some]
    drop_saved(windows)
    spans = save(found.groupBy("key1", "key2").agg(F.collect_list("span").alias("spans")), "spans")
    drop_saved(settled, *parts)
    return spans


def text_key(text: str, names: tuple[str, str] = ("key1", "key2")):
    """The first 92 bits of a text's SHA-256 stand for it; equal texts have equal spans, whatever their row."""
    digest = F.sha2(F.col(text), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias(names[0]), (
        F.conv(F.substring(digest, 16, 8), 16, 10).cast("long") - (1 << 31)).cast("int").alias(names[1])


def _union(spans: pa.StructArray) -> np.ndarray:
    """Maximal runs (start, end) of the spans, in order."""
    start, size = (spans.field(k).to_numpy(zero_copy_only=False) for k in range(2))
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate((start + size)[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])
    return np.stack([start[new], end[last]], axis=1)


def _remove(n_columns: int, text_at: int, as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _buffer(batch.column(text_at))
            kept, n_bytes, removed, runs = [], np.diff(offsets), np.zeros(batch.num_rows, np.int64), []
            for i, found in enumerate(batch.column(n_columns)):
                body = data[offsets[i]: offsets[i + 1]]
                if not found.is_valid:
                    kept.append(body.tobytes())
                    runs.append([])
                    continue
                cut = _union(found.values)
                edges = np.concatenate([[0], cut.ravel(), [len(body)]])
                kept.append(b"".join(body[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True)))
                removed[i] = (cut[:, 1] - cut[:, 0]).sum()
                runs.append([{"start": int(a), "end": int(b)} for a, b in cut])
            if as_text:
                kept = [k.decode("utf-8", "ignore") for k in kept]
            names = batch.schema.names[:n_columns]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n_columns], pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(n_bytes), pa.array(removed),
                 pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                [*names, "kept", "n_bytes", "n_removed", "removed"])

    return run


def remove_repeats(docs: DataFrame, text: str = "text", length: int = 200, as_text: bool = False) -> DataFrame:
    """``docs`` with ``kept`` (the remaining bytes joined), ``n_bytes``, ``n_removed`` and
    ``removed`` (the maximal removed runs as (start, end) in bytes, in order).

    Null and empty texts, and texts under ``length`` bytes, keep all they have. Repeated
    rows repeat each other, so both lose every byte from ``length`` on. Matches never cross
    texts. With ``as_text`` the kept bytes are text, without pieces of cut characters.
    Other columns stay; those named like a result column are replaced.
    """
    names = fresh(docs.columns, "key1"), fresh(docs.columns, "key2")
    body = docs.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    spans = repeated_spans(body, text, length).withColumnsRenamed({"key1": names[0], "key2": names[1]})
    kept_names = [c for c in docs.columns if c == text or c not in ("kept", "n_bytes", "n_removed", "removed")]
    found = fresh(docs.columns, "spans")
    joined = body.select(*kept_names, *text_key(text, names)).join(
        spans.withColumnRenamed("spans", found).hint("shuffle_hash"), list(names), "left").select(*kept_names, found)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:-1])
    kind = "string" if as_text else "binary"
    return joined.mapInArrow(
        _remove(len(kept_names), kept_names.index(text), as_text),
        f"{schema}, kept {kind}, n_bytes long, n_removed long, removed array<struct<start:long,end:long>>")
