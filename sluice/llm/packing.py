"""Best-fit packing of token sequences with swap-based local search.

Texts are tokenized where they lie and cut into pieces of at most ``capacity`` tokens.
Only a piece's key and length move: pieces are dealt by row number into shards of about
``shard_bins`` full sequences, so neither a shard's size nor its work grows with the input
and no key can crowd one. Within a shard, pieces go in by decreasing length, each into
the fullest bin that holds it. Local search then works on the underfull bins: it moves a
piece, exchanges one for one or two for one between two bins whenever that raises the sum
of squared fills. Space gathers in few bins until bins empty. Each step raises an integer
that is bounded, so the search ends; it runs until no step is left.

What a shard leaves in bins that are still underfull is dealt again over fewer shards,
round by round, so the loss at shard borders shrinks to that of one shard.
"""

from __future__ import annotations

import itertools
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import fresh, save, without
from sluice.llm.tokens import BATCH_BYTES, ChunkIds, built, byte_symbols, shared_text


def _library_ids(source: str) -> ChunkIds:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(source)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    # A lower-case word in normal form is split no further: its bytes go to the model as symbols.
    merge, symbols = tokenizer.model.tokenize, dict(enumerate(byte_symbols()))
    return ChunkIds(lambda chunk: array("I", tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes(),
                    lambda word: array("I", [t.id for t in merge(word.encode().decode("latin-1").translate(symbols))]).tobytes())


def cut_pieces(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = 4096, end_id: int = 1,
               keep: list[str] | None = None) -> DataFrame:
    """One row per piece: the columns ``keep`` (default: all but the text), ``piece`` from 0,
    ``start`` (ids of the document before it), ``length`` and ``ids`` (little-endian
    unsigned 32-bit). A document's ids end with ``end_id``, so a null or empty text is one
    piece of one id. Only documents over ``capacity`` are cut, every piece but the last full."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    keep = [c for c in keep if c.lower() not in ("piece", "start", "length", "ids")]
    shared, end = shared_text(docs.sparkSession, tokenizer), array("I", [end_id]).tobytes()
    chosen = docs.select(*keep, docs[text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = built("library ids", shared.value, _library_ids).of
        for batch in batches:
            rows, size = [], 0

            def out():
                at, piece, start, length, ids = zip(*rows, strict=True)
                part = batch.take(pa.array(at))  # noqa: B023
                return pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    [*part.schema.names[: len(keep)], "piece", "start", "length", "ids"])

            for i, value in enumerate(batch.column(len(keep))):
                ids = ids_of(value.as_py()) + end
                for k, low in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[low: low + 4 * capacity]
                    rows.append((i, k, low // 4, len(piece) // 4, piece))
                size += len(ids)
                if size >= BATCH_BYTES:
                    yield out()
                    rows, size = [], 0
            if rows:
                yield out()

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[: len(keep)]),
                        "piece int, start long, length long, ids binary"])
    return chosen.mapInArrow(run, schema)


#: Bins of a shard filled to this share are not dealt again.
FULL = 0.95


class Bins:
    """Bins of one shard: each a list of piece numbers, with its fill."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Pieces by decreasing length, each into the fullest bin that holds it."""
        room: list[list[int]] = [[] for _ in range(self.capacity + 1)]  # bins by free space
        present = 0  # bit f is set if a bin has f free
        for i in sorted(range(len(self.lengths)), key=lambda i: -self.lengths[i]):
            n = self.lengths[i]
            above = present >> n
            if above:
                free = n + (above & -above).bit_length() - 1
                b = room[free].pop()
                if not room[free]:
                    present ^= 1 << free
                self.bins[b].append(i)
                self.fill[b] += n
            else:
                free, b = self.capacity, len(self.bins)
                self.bins.append([i])
                self.fill.append(n)
            if free > n:
                room[free - n].append(b)
                present |= 1 << free - n

    def _apply(self, a: int, out: list[int], b: int, into: list[int]) -> None:
        """Give the pieces ``out`` of bin ``a`` for the pieces ``into`` of bin ``b``."""
        for x in out:
            self.bins[a].remove(x)
        for y in into:
            self.bins[b].remove(y)
        self.bins[a] += into
        self.bins[b] += out
        gain = sum(self.lengths[y] for y in into) - sum(self.lengths[x] for x in out)
        self.fill[a] += gain
        self.fill[b] -= gain

    def _step(self, a: int, b: int) -> bool:
        """The exchange that raises the fill of ``a`` most at the cost of ``b``, if the sum
        of squares rises: a move, one for one, or two of ``b`` for one of ``a``."""
        free, least = self.capacity - self.fill[a], max(0, self.fill[b] - self.fill[a])
        if free <= least:
            return False
        size, best = self.lengths, (least, None, None)  # the gain must be over `least`
        ones = sorted(self.bins[b], key=size.__getitem__)
        for x in [None, *{size[i]: i for i in self.bins[a]}.values()]:
            given = 0 if x is None else size[x]
            low, high = 0, len(ones) - 1
            for y in reversed(ones):  # the longest that fits: a move or one for one
                if size[y] - given <= free:
                    if size[y] - given > best[0]:
                        best = (size[y] - given, x, [y])
                    break
            while x is not None and low < high:  # the longest pair that fits
                gain = size[ones[low]] + size[ones[high]] - given
                if gain > free:
                    high -= 1
                    continue
                if gain > best[0]:
                    best = (gain, x, [ones[low], ones[high]])
                low += 1
            if best[0] == free:
                break
        if best[2] is None:
            return False
        self._apply(a, [] if best[1] is None else [best[1]], b, best[2])
        return True

    def local_search(self) -> None:
        """Steps between underfull bins, fuller ones first, until none raises the squares, or
        no more than the least possible number of bins is in use."""
        least = -(-sum(self.lengths) // self.capacity)
        changed = set(range(len(self.bins)))
        while changed and sum(1 for f in self.fill if f) > least:
            before, changed = changed, set()
            under = sorted((b for b in range(len(self.bins)) if 0 < self.fill[b] < self.capacity), key=lambda b: -self.fill[b])
            for a, b in itertools.permutations(under, 2):
                if a not in before and b not in before and a not in changed and b not in changed:
                    continue
                while self.fill[a] < self.capacity and self.fill[b] and self._step(a, b):
                    changed |= {a, b}


def _pack_shard(capacity: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        bins = Bins(table["length"].to_pylist(), capacity)
        bins.best_fit()
        bins.local_search()
        n = table.num_rows
        number, offset, full = [0] * n, [0] * n, [False] * n
        for k, members in enumerate(bins.bins):
            at = 0
            for i in members:
                number[i], offset[i], full[i] = k, at, bins.fill[k] >= FULL * capacity
                at += bins.lengths[i]
        return pa.table({"row": table["row"], "length": table["length"], "shard": pa.array([shard] * n, pa.int64()),
                         "number": pa.array(number, pa.int64()), "offset": pa.array(offset, pa.int64()), "full": pa.array(full)})

    return run


def pack(pieces: DataFrame, capacity: int = 4096, length: str = "length", shard_bins: int = 1024) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: every piece lies whole in one sequence
    of at most ``capacity`` tokens, without gaps from 0 on.

    Lengths must be within 1 and ``capacity``, as ``cut_pieces`` makes them; they are not checked, and a longer piece would
    overfill its sequence. Sequences filled to 95 % (``FULL``) are final once packed, so with more than one shard at worst
    5 % of the room stays empty. Repeated rows are pieces of their own, ties
    are free. Columns of the result's names are replaced; an empty table stays empty."""
    pieces = without(pieces, ["sequence_id", "offset"])
    row = fresh(pieces.columns, "row")
    pieces = save(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    todo, done, base = pieces.select(F.col(row).alias("row"), F.col(length).cast("long").alias("length")), [], 0
    before = None
    while True:
        tokens = todo.agg(F.sum("length")).first()[0] or 0
        shards = max(1, -(-tokens // (capacity * shard_bins)))
        last = shards == 1 or (before is not None and tokens > 0.9 * before)
        dealt = todo.select("row", "length", F.pmod(F.xxhash64("row", F.lit(base)), F.lit(shards)).alias("shard"))
        packed = save(dealt.groupBy("shard").applyInArrow(
            _pack_shard(capacity), "row long, length long, shard long, number long, offset long, full boolean"), "packed")
        done.append(packed.filter(F.lit(last) | F.col("full")).select(
            "row", "offset", ((F.lit(base).cast("long") + F.col("shard")).bitwiseOR(F.shiftleft("number", 32))).alias("sequence_id")))
        if last:
            break
        todo, base, before = packed.filter("not full").select("row", "length"), base + shards, tokens
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    names = {"row": fresh([*pieces.columns, "sequence_id", "offset"], "placed_row")}
    placed = placed.withColumnsRenamed(names)
    return pieces.join(placed, F.col(row) == F.col(names["row"])).drop(row, names["row"])
