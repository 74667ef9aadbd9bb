"""SimHash near-duplicates by covering locality-sensitive hashing.

Every text gets a 64-bit fingerprint of its word shingles. For a radius r there are
2^(r+1) - 1 bit masks: bit i of the fingerprint carries a label m(i) of r+1 bits, not
zero, and mask v holds the bits with <m(i), v> odd. Two fingerprints that differ in at
most r bits D agree under mask v if <m(i), v> is even for every i in D. These are at
most r linear conditions on r+1 unknown bits, so some v other than zero meets them all:
every pair within the radius shares a bucket of some mask, with no luck involved (Pagh's
covering LSH). Labels are dealt evenly, so a mask keeps about half of the 64 bits.

Equal fingerprints are one row before the masks apply. Buckets up to ``max_bucket``
fingerprints are compared inside and give the links of a spanning forest, not all pairs.
In larger ones every member is dealt again by each point within r/2 of it on the bits
that its mask leaves free: two members meet at a point just when they are within r of
each other, so a meeting needs no check and a star per point holds every link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import drop_saved, fresh, join_counted, join_one, save, without
from sluice.llm.components import components


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """The 2^(radius+1) - 1 masks, as unsigned integers."""
    n = (1 << radius + 1) - 1
    label = [i % n + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (label[i] & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint: a bit is 1 if set in over half of the shingles' XXH64 (seed 42).

    A-Z are lower-cased, words are runs without the six ASCII spaces, shingles are joined
    by one space and count as often as they occur. Under ``shingle`` words, the whole
    sequence is the one shingle; no word (null, empty, blank) gives zero."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    votes, n = np.zeros(64, np.int64), len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, 1 << 14):  # bounded memory for very long texts
        high = min(n, low + (1 << 14))
        part = zip(starts[low:high].tolist(), ends[low + shingle - 1: high + shingle - 1].tolist(), strict=True)
        hashes = np.fromiter((digest(line[a:b], 42) for a, b in part), np.uint64, high - low)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def _add_fingerprints(text_at: int, shingle: int, drop_text: bool, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([_signed(fingerprint(t.as_py(), shingle)) for t in batch.column(text_at)], pa.int64())
            keep = [i for i in range(batch.num_columns) if not (drop_text and i == text_at)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), made], [*(batch.schema.names[i] for i in keep), name])

    return run


def add_fingerprints(docs: DataFrame, text: str, shingle: int, drop_text: bool, name: str) -> DataFrame:
    kept = [f for f in docs.schema.fields if not (drop_text and f.name == text)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{name}` long"])
    return docs.mapInArrow(_add_fingerprints(docs.columns.index(text), shingle, drop_text, name), schema)


def _forest(radius: int):
    """Links (a, b) that connect what is within the radius inside each bucket."""

    def links(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, label = len(members), np.arange(len(members))
        rows = max(1, (1 << 20) // n)
        while True:
            new = label.copy()
            for low in range(0, n, rows):
                near = np.bitwise_count(members[low: low + rows, None] ^ members[None, :]) <= radius
                new[low: low + rows] = np.where(near, label[None, :], n).min(axis=1)
            new = np.minimum(new, new[new])
            if (new == label).all():
                tied = np.flatnonzero(label != np.arange(n))
                return members[tied], members[label[tied]]
            label = new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [links(m.values.to_numpy().view(np.uint64)) for m in batch.column(0)]
            a, b = (np.concatenate([f[k] for f in found]).view(np.int64) if found else np.empty(0, np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _points(masks: list[int], radius: int):
    """Rows (point, mask, fp): all points within half the radius on the bits a mask leaves free."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = []
        for m in masks:
            free = [1 << i for i in range(64) if not m >> i & 1]
            flips.append(np.array([sum(c) for k in range(radius // 2 + 1) for c in combinations(free, k)], np.uint64))
        for batch in batches:
            which, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for low in range(0, len(fps), 256):
                part = [(fps[i] ^ flips[which[i]], which[i], fps[i]) for i in range(low, min(low + 256, len(fps)))]
                n = [len(p[0]) for p in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([p[0] for p in part]).view(np.int64)),
                     pa.array(np.repeat(np.array([p[1] for p in part], np.int32), n)),
                     pa.array(np.repeat(np.array([p[2] for p in part], np.uint64).view(np.int64), n))], ["point", "mask", "fp"])

    return run


def fingerprint_links(fps: DataFrame, radius: int = 4, max_bucket: int = 4096) -> DataFrame:
    """Links ``(a, b)`` over the distinct long column ``fp``: their components are those of
    all pairs within ``radius`` bits, and every link is within it."""
    if radius % 2:
        raise ValueError("radius must be even")
    masks = covering_masks(radius)
    keys = [F.struct(F.lit(i).alias("mask"), F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))).alias("bucket"))
            for i, m in enumerate(masks)]
    dealt = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.mask", "k.bucket", "fp")
    sizes = save(dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn("rows", F.col("n")), "bucket-sizes")
    shared = save(join_counted(dealt, sizes, ["bucket"], count="rows"), "shared-buckets")
    drop_saved(sizes)
    small = shared.filter(F.col("n") <= max_bucket).groupBy("bucket").agg(F.collect_list("fp").alias("members"))
    links = small.select("members").mapInArrow(_forest(radius), "a long, b long").distinct()
    large = shared.filter(F.col("n") > max_bucket).select("mask", "fp")
    if large.isEmpty():
        return links
    points = save(large.mapInArrow(_points(masks, radius), "point long, mask int, fp long"), "points")
    least = points.groupBy("mask", "point").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = points.join(least, ["mask", "point"]).filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return links.unionByName(stars).distinct()


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with the one row of each group that ``near_duplicates`` keeps, all columns as
    they are. Texts are shuffled once and never written: the choice is made on ids and text
    hashes. Of rows that repeat id and text one is taken."""
    text_key = [fresh(docs.columns, "text_hash"), fresh(docs.columns, "text_hash2")]
    keyed = docs.withColumns({text_key[0]: F.xxhash64(text), text_key[1]: F.hash(text)})
    found = near_duplicates(keyed.select(id, text, *text_key), id, text, shingle, radius, carry_text=False)
    names = {id: fresh(keyed.columns, "chosen_id"), **{k: fresh(keyed.columns, f"chosen_{k}") for k in text_key}}
    again = fresh(keyed.columns, "again")
    chosen = found.groupBy(id, *text_key).agg(F.max("kept").alias("kept"), (F.count(F.lit(1)) > 1).alias(again)).filter("kept").drop("kept")
    chosen = save(chosen.withColumnsRenamed(names), "chosen")
    same = (keyed[text_key[0]] == F.col(names[text_key[0]])) & (keyed[text_key[1]] == F.col(names[text_key[1]]))
    kept = keyed.join(chosen, same & F.col(id).eqNullSafe(F.col(names[id])))
    if chosen.filter(again).isEmpty():
        return kept.select(*docs.columns)
    once = kept.filter(~F.col(again)).select(*docs.columns)
    return once.unionByName(kept.filter(again).dropDuplicates([id, *text_key]).select(*docs.columns))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4,
                    carry_text: bool = True, max_bucket: int = 4096) -> DataFrame:
    """``docs`` with ``fingerprint`` (16 hex digits), ``component_id`` and ``kept``.

    ``component_id`` is the least id of the group (null only if the whole group has null
    ids); ``kept`` is true for one row of each group: the least id, nulls last, and among
    repeated rows any one of them. Texts without a word share the fingerprint zero and
    link like others. Columns of the result's names are replaced.
    """
    docs = without(docs, [c for c in ("fingerprint", "component_id", "kept") if c not in (id, text)])
    fp, row = fresh(docs.columns, "fp"), fresh(docs.columns, "row")
    made = add_fingerprints(docs, text, shingle, not carry_text, fp)
    made = save(made.withColumn(row, F.monotonically_increasing_id()), "fingerprints")
    first = F.struct(F.col(id).isNull().alias("no_id"), F.col(id).alias("id"), F.col(row).alias("row"))
    groups = save(made.groupBy(F.col(fp).alias("fp")).agg(F.min(first).alias("first")), "fingerprint-groups")
    labels = components(fingerprint_links(groups.select("fp"), radius, max_bucket))
    groups = groups.join(labels, groups["fp"] == labels["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    groups = save(groups, "labelled-groups")
    least = save(groups.groupBy("component").agg(F.min("first").alias("least")), "least-of-component")
    least_row = fresh(made.columns, "least_row")
    least = save(join_one(groups, least, ["component"]).select(
        F.col("fp").alias(fp), F.col("least.id").alias("component_id"), F.col("least.row").alias(least_row)), "least-of-fingerprint")
    return join_one(made, least, [fp]).withColumns(
        {"fingerprint": F.lower(F.lpad(F.hex(fp), 16, "0")), "kept": F.col(row) == F.col(least_row)}).drop(
        fp, row, least_row)
