"""Ranked search against scoring every document."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """{item: [(rank, id, score)]} by the definition; ids sort with null first."""
    texts = [(i, words(t)) for i, t in docs]
    texts = [(i, w) for i, w in texts if w]
    n_docs, n_terms = len(texts), sum(len(w) for _, w in texts)
    df = {}
    for _, w in texts:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words(t))
    out = {}
    for item, terms in wanted.items():
        scored = []
        for i, w in texts:
            m = 50 + 50 * len(w) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 20 * m))
                    for t in terms if t in w)
            if s > 0:
                scored.append((-s, i is not None, i, s))
        scored.sort(key=lambda x: (x[0], x[1], x[2] if x[1] else 0))
        if scored:
            out[item] = [(r + 1, x[2], x[3]) for r, x in enumerate(scored[:k])]
    return out


def rows(found):
    out = {}
    for r in found.collect():
        out.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return {i: sorted(v) for i, v in out.items()}


def corpus(n, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(4000)] + ["Éa", "é", "日本", "x_y", "A1"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(40)]  # ties
    docs += [(n + 100, None), (n + 101, ""), (n + 102, " .,- "), (n + 103, "long " * 30000 + "w1 w2"), (3, docs[3][1]), (None, "w1 w2 w3"), (None, None)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 30)))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "none-of-these zzz"), (23, docs[5][1]), (23, docs[5][1]), (24, "w1 W1 w2"), (24, "w3"), (None, "w1")]
    return docs, items


@pytest.mark.parametrize("k", [1, 7, 50])
def test_every_rank_and_score_is_that_of_brute_force(spark, k):
    docs, items = corpus(900)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert rows(R.ranked_search(d, q, k)) == brute(docs, items, k)


def test_small_blocks_windows_and_item_blocks_change_nothing(spark, monkeypatch):
    docs, items = corpus(700, 2)
    want = brute(docs, items, 5)
    d, q = spark.createDataFrame(docs, "doc_id long, text string").repartition(2), spark.createDataFrame(items, "item_id long, text string")
    assert rows(R.ranked_search(d, q, 5, pairs=20)) == want  # several blocks of items


def test_skipping_is_exact_in_one_block():
    """Blocks, strides and windows by hand: the same top rows as summing everything, with fewer postings read."""
    rng = np.random.default_rng(5)
    n, terms = 8192, 30
    tf = rng.poisson(0.02 * np.arange(1, terms + 1)[:, None] * np.ones(n)).astype(np.int64)
    lengths = tf.sum(axis=0) + rng.integers(1, 50, n)
    t, doc = np.nonzero(tf)
    row = {"lengths": lengths, "terms": np.unique(t), "sizes": np.bincount(t)[np.unique(t)], "docs": doc, "tfs": tf[t, doc]}
    block = R.Block(row, n, int(lengths.sum()))
    weight = R.weights(n, (tf > 0).sum(axis=1))
    scores = np.zeros(n, np.int64)
    np.add.at(scores, doc, weight[t] * block.impact)
    for k in (1, 10, 200):
        best = R.Best(k)
        R.search_block(block, np.arange(terms), weight, best, np.ones(n, bool), np.arange(n))
        want = np.lexsort((np.arange(n), -scores))[:k]
        assert best.ids.tolist() == want.tolist() and best.scores.tolist() == scores[want].tolist()
        R.search_block(block, np.arange(terms), weight, best, np.ones(n, bool), np.arange(n) + n)  # the same again under later ids
        both = np.lexsort((np.concatenate((np.arange(n), np.arange(n) + n)), -np.concatenate((scores, scores))))[:k]
        assert best.ids.tolist() == both.tolist()


def test_text_ids_empty_tables_and_clashing_names(spark):
    d = spark.createDataFrame([("b", "one two", "x"), ("a", "one two", "x"), (None, "one", "x"), ("é", "one two three", "x")], "doc_id string, text string, score string")
    q = spark.createDataFrame([(1, "ONE two", 5)], "item_id int, text string, rank int")
    got = R.ranked_search(d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == brute([(r.doc_id, r.text) for r in d.collect()], [(1, "one two")], 50)
    assert R.ranked_search(d.limit(0), q).count() == 0 and R.ranked_search(d, q.limit(0)).count() == 0
    with pytest.raises(TypeError):
        R.ranked_search(d.withColumn("doc_id", F.lit(1.5)), q)


def test_terms_are_those_of_the_pattern(spark):
    for text in ("Ab-c1 ÀÉ x\x80y \x7f\x00q {z} 日本、 a_b [c] `d`", "".join(map(chr, range(300)))):
        assert [t.decode() for t in R.terms_of(text.encode())] == words(text)
        df = spark.createDataFrame([(1, text.replace("\x00", " "))], "i int, t string")
        assert {r.term for r in R.item_terms(df, "i", "t").collect()} == set(words(text))
