"""Ranked lexical search: the ``k`` best documents of each item, exact, by hybrid TAAT-DAAT.

``ranked_search(docs, items)`` runs in two passes over blocks of documents:

1. **Index.** Each task turns its documents into blocks of postings of the items' terms (one
   Parquet row a block). Nothing is shuffled but one number per term and task.
2. **Search.** Each task reads blocks and answers every item. Term at a time, the short
   lists of an item are summed into one sorted list of accumulators. That list is then one
   more iterator, with bounds of its own, beside the long lists, which are read document at
   a time: 64-document windows whose bound is under the item's ``k``-th best score so far are
   skipped, candidates come from the iterators that can lift a document over that score
   alone, and the others are probed only for candidates that still can reach it.

Only ``k`` rows an item leave a task; two rounds of ranking give the result. Bounds use
``<``, so equal scores are never skipped and ties are decided by the document id.

Items go through in blocks of a measured size, so what is broadcast does not grow with them.

Terms are runs of ASCII letters, digits and all characters from U+0080 on, only A-Z
lower-cased. Scores are 64-bit integers (see ``weights`` and ``impacts``).

Defined results: a null or empty text has no term and counts for nothing; texts of any
length are read whole; rows that share an item id are one item with the terms of all of them; an item
without terms, or whose terms stand in no document, has no rows; repeated document rows
are documents of their own; ids are integers or text, a null id is an id and comes first;
equal scores are ranked by ascending document id; empty tables give no rows. Further
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from sluice.llm.common import drop_saved, save

#: A block of the index holds at most so many documents, and ends behind the document with
#: which it has so many terms of items, repeats counted, or more.
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 1 << 21
#: Documents per skip bound, and windows read between two looks at the score to beat.
WINDOW = 64
STRIDE = 32
#: A list is short where it holds at most this share of a block's documents.
SHORT_SHARE = 1 / 16
#: (item, term) pairs of one block of items; a pair is an id of 4 bytes in the broadcast.
PAIRS = 1 << 18

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return text.translate(_FOLD).split()


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """The distinct terms of each item: ``item``, ``term``."""
    words = F.regexp_extract_all(F.translate(F.col(text), _UPPER, _LOWER), F.lit(TERM), 0)
    return items.select(F.col(item_id).alias("item"), F.explode(F.array_distinct(words)).alias("term")).distinct()


# ------------------------------------------------------------------ index
def _block(ids: list, lengths: list[int], found: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    """One row: the documents of a block and the postings of each term in it, by document."""
    doc = np.repeat(np.arange(len(ids), dtype=np.int64), [len(f) for f in found])
    key = np.concatenate(found) * len(ids) + doc if len(doc) else doc
    key, tf = np.unique(key, return_counts=True)
    term, first, n = np.unique(key // len(ids), return_index=True, return_counts=True)
    columns = {
        "ids": (pa.array(ids, kind), kind),
        "lengths": (np.array(lengths, np.int64), pa.int64()), "terms": (term.astype(np.int32), pa.int32()),
        "sizes": (n.astype(np.int32), pa.int32()), "docs": ((key % len(ids)).astype(np.int32), pa.int32()),
        "tfs": (tf.astype(np.int32), pa.int32())}
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t)) for v, t in columns.values()], list(columns))


def build_index(docs: DataFrame, doc_id: str, text: str, terms: list[bytes]) -> DataFrame:
    """Blocks of postings of ``terms`` (by their place in the list): ``ids``, ``lengths`` (terms
    of each document), ``terms``, ``sizes`` (postings of each term), ``docs``, ``tfs``."""
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    known = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, kind = known.value, None
        ids, lengths, found, postings = [], [], [], 0
        for batch in batches:
            kind = batch.column(0).type
            texts = batch.column(1).cast(pa.binary())
            for name, value in zip(batch.column(0).to_pylist(), texts):
                words = terms_of(value.as_py() or b"")
                ids.append(name)
                lengths.append(len(words))
                found.append(np.array([place[w] for w in words if w in place], dtype=np.int64))
                postings += len(found[-1])
                if len(ids) >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    yield _block(ids, lengths, found, kind)
                    ids, lengths, found, postings = [], [], [], 0
        if ids:
            yield _block(ids, lengths, found, kind)

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"ids array<{kind}>, lengths array<long>, terms array<int>, sizes array<int>, docs array<int>, tfs array<int>")


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """``floor(1000 * ln((2N + 2) / (2df + 1)))`` of each term."""
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df.astype(np.float64) + 1))).astype(np.int64)


def impacts(tf: np.ndarray, lengths: np.ndarray, docs: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """``(10^9 tf) div (1000 tf + 20 m)`` of each posting, ``m = 50 + (50 n N) div L`` of its document."""
    if 50 * int(lengths.max()) * n_docs < 1 << 63:
        m = 50 + 50 * lengths * n_docs // n_terms
    else:
        m = np.array([50 + 50 * int(n) * n_docs // n_terms for n in lengths], dtype=np.int64)
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m[docs])


# ------------------------------------------------------------------ search
class Best:
    """The ``k`` best (score, id) of one item so far; ids are compared as (not null, value)."""

    def __init__(self, k: int):
        self.k, self.scores, self.given, self.ids = k, np.zeros(0, np.int64), None, None

    @property
    def least(self) -> int:
        """The least score that can still enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, given: np.ndarray, ids: np.ndarray) -> None:
        if len(self.scores):
            scores, given, ids = (np.concatenate(x) for x in ((self.scores, scores), (self.given, given), (self.ids, ids)))
        if len(scores) > 4 * self.k:  # the k-th best score bounds what has to be sorted
            near = scores >= np.partition(scores, -self.k)[-self.k]
            scores, given, ids = scores[near], given[near], ids[near]
        top = np.lexsort((ids, given, -scores))[: self.k]
        self.scores, self.given, self.ids = scores[top], given[top], ids[top]


class Block:
    """Postings of one block with impacts, window bounds and places for skipping."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.n = len(row["lengths"])
        self.terms, self.sizes, self.docs = row["terms"], row["sizes"].astype(np.int64), row["docs"].astype(np.int64)
        self.impact = impacts(row["tfs"], row["lengths"], self.docs, n_docs, n_terms)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        n_windows = -(-self.n // WINDOW)
        owner = np.repeat(np.arange(len(self.terms)), self.sizes)
        self.bounds = _maxima(owner * n_windows + self.docs // WINDOW, self.impact, len(self.terms) * n_windows).reshape(-1, n_windows)
        self.strides = np.arange(0, n_windows + STRIDE, STRIDE).clip(max=n_windows)
        edges = (self.strides * WINDOW).clip(max=self.n)
        self.cuts = np.searchsorted(owner * self.n + self.docs, np.arange(len(self.terms))[:, None] * self.n + edges)
        # A cut at the block's end is the start of the next term's list.
        self.cuts[:, -1] = self.starts[1:]


def _maxima(key: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """The largest value of each key of ``range(size)``, 0 where there is none; keys are sorted."""
    out = np.zeros(size, np.int64)
    if len(key):
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        out[key[first]] = np.maximum.reduceat(value, first)
    return out


def search_block(block: Block, terms: np.ndarray, weight: np.ndarray, best: Best, given: np.ndarray, ids: np.ndarray) -> None:
    """Add to ``best`` what this block has for an item with these terms (sorted) and weights."""
    at = np.searchsorted(block.terms, terms)
    held = at < len(block.terms)
    held[held] = block.terms[at[held]] == terms[held]
    at, weight = at[held & (weight > 0)], weight[held & (weight > 0)]
    if not len(at):
        return
    # Term at a time: short lists become one list of summed accumulators.
    short = block.sizes[at] <= max(1, int(block.n * SHORT_SHARE))
    lists = []  # (documents, scores, places of the strides, window bounds)
    if short.any():
        spans = [(slice(block.starts[t], block.starts[t + 1]), w) for t, w in zip(at[short], weight[short])]
        docs, inverse = np.unique(np.concatenate([block.docs[s] for s, _ in spans]), return_inverse=True)
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, inverse, np.concatenate([w * block.impact[s] for s, w in spans]))
        bounds = _maxima(docs // WINDOW, scores, block.bounds.shape[1])
        lists.append((docs, scores, np.searchsorted(docs, block.strides * WINDOW), bounds))
    for t, w in zip(at[~short], weight[~short]):
        low = block.starts[t]
        span = slice(low, block.starts[t + 1])
        lists.append((block.docs[span], (block.impact[span], w), block.cuts[t] - low, w * block.bounds[t]))
    total = sum(x[3] for x in lists)
    # Document at a time: strides in order, windows under the score to beat are skipped.
    for s in range(len(block.strides) - 1):
        low, high = block.strides[s], block.strides[s + 1]
        alive = total[low:high] >= best.least
        if low == high or not alive.any():
            continue
        tops = [int(x[3][low:high][alive].max()) for x in lists]
        order = sorted(range(len(lists)), key=tops.__getitem__)
        rest, reach = 0, 0  # lists that cannot lift a document to the least score, even together
        while rest < len(order) and reach + tops[order[rest]] < best.least:
            reach += tops[order[rest]]
            rest += 1
        score = np.zeros((high - low) * WINDOW, np.int64)
        for i in order[rest:]:
            docs, scores, cut, _ = lists[i]
            span = slice(cut[s], cut[s + 1])
            add = scores[span] if isinstance(scores, np.ndarray) else scores[1] * scores[0][span]
            score[docs[span] - low * WINDOW] += add
        found = np.flatnonzero(score & -np.repeat(alive, WINDOW).astype(np.int64))
        for i in reversed(order[:rest]):
            found = found[score[found] + reach >= best.least]
            if not len(found):
                break
            reach -= tops[i]
            docs, scores, cut, _ = lists[i]
            part = docs[cut[s]: cut[s + 1]]
            place = np.searchsorted(part, found + low * WINDOW)
            hit = place < len(part)
            hit[hit] = part[place[hit]] == found[hit] + low * WINDOW
            place = place[hit] + cut[s]
            score[found[hit]] += scores[place] if isinstance(scores, np.ndarray) else scores[1] * scores[0][place]
        found = found[score[found] >= best.least]
        if len(found):
            doc = found + low * WINDOW
            best.add(score[found], given[doc], ids[doc])


def _id_arrays(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(not null, value) of ids in a form that sorts as Spark sorts them."""
    given = np.asarray(values.is_valid())
    if pa.types.is_integer(values.type):
        return given, values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return given, np.array(values.fill_null("").to_pylist(), dtype=str)


def search_index(index: DataFrame, id_type: str, items: list[np.ndarray], df: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Per task, the ``k`` best documents of each item: ``item_no``, ``id``, ``score``."""
    shared = index.sparkSession.sparkContext.broadcast((items, weights(n_docs, df)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = shared.value
        best, kind = [Best(k) for _ in asked], None
        for batch in batches:
            kind = batch.column("ids").type.value_type
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("lengths", "terms", "sizes", "docs", "tfs")}
                if not len(row["terms"]):
                    continue
                block = Block(row, n_docs, n_terms)
                given, ids = _id_arrays(batch.column("ids")[i].values)
                for terms, b in zip(asked, best):
                    search_block(block, terms, weight[terms], b, given, ids)
        for no, b in enumerate(best):
            if len(b.scores):
                values = pa.array([v if g else None for g, v in zip(b.given.tolist(), b.ids.tolist())], kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([no] * len(b.scores), pa.int32()), values, pa.array(b.scores)], ["item_no", "id", "score"])

    return index.mapInArrow(run, f"item_no int, id {id_type}, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item with their ranks; first among a 64th of the rows at a time."""
    order = [F.desc("score"), F.asc("id")]
    some = Window.partitionBy("item_no", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy(*order)
    whole = Window.partitionBy("item_no").orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
    return few.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", pairs: int = PAIRS) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of each item, score over 0.

    ``pairs`` bounds the (item, term) pairs searched at once; more items take more passes over
    the documents."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType
    if not isinstance(kind, (IntegralType, StringType)):
        raise TypeError(f"document ids must be integers or text, not {kind.simpleString()}")
    saved = save(item_terms(items, item_id, item_text), "search-items")
    n_blocks = max(1, -(-saved.count() // pairs))
    wanted = saved.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(n_blocks)))
    results = []
    for part in range(n_blocks):
        rows = (wanted.filter(F.col("part") == part).groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"))
                .collect())  # about `pairs` terms
        if not rows:
            continue
        terms = sorted({t.encode() for r in rows for t in r.terms})
        place = {t: i for i, t in enumerate(terms)}
        asked = [np.array(sorted(place[t.encode()] for t in r.terms), dtype=np.int32) for r in rows]
        index = save(build_index(docs, doc_id, text, terms), "search-index")
        n_docs, n_terms = index.select(F.explode("lengths").alias("n")).agg(
            F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if n_terms:
            sizes = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t")).groupBy("t.terms").agg(F.sum("t.sizes"))
            df = np.zeros(len(terms), np.int64)
            for t, n in sizes.collect():  # a row per term of this block of items
                df[t] = n
            names = spark.createDataFrame([(i, r.item) for i, r in enumerate(rows)], f"item_no int, item {dict(wanted.dtypes)['item']}")
            best = _ranked(search_index(index, kind.simpleString(), asked, df, n_docs, n_terms, k), k)
            results.append(save(best.join(F.broadcast(names), "item_no").select(
                F.col("item").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(doc_id), "score"), "search-result"))
        drop_saved(index)
    drop_saved(saved)
    if not results:
        return spark.createDataFrame([], f"`{item_id}` {items.schema[item_id].dataType.simpleString()}, rank int, `{doc_id}` {kind.simpleString()}, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
