"""Repeated bytes against a brute-force count of every 200-byte string."""

import random
from collections import Counter

import pytest

from sluice.llm.suffix_dedup import remove_repeats


def brute(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i: i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone, end = bytearray(len(b)), 0
        for i in range(len(b) - length + 1):
            if seen[b[i: i + length]] > 1:
                gone[max(i, end): i + length] = b"\x01" * (i + length - max(i, end))
                end = i + length
        runs = [i for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1])]
        out.append((bytes(x for x, g in zip(b, gone) if not g), sum(gone), len(runs)))
    return out


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, line = prose(60), prose(12)
    texts = [prose(rng.randint(1, 250)) for _ in range(40)]
    texts += [t + " " + shared + " " + prose(5) for t in texts[:10]]  # whole copies of other texts within
    texts += [prose(30) + shared[k:] + prose(30) for k in range(0, 60, 7)]
    texts += [prose(20) + line + prose(20) for _ in range(12)]  # a common line under 200 bytes
    copy = prose(150)
    texts += [copy] * 4 + [copy[:400] + "X" + copy[401:], copy[:300], copy[700:]]
    texts += ["a" * 150, "a" * 200, "a" * 201, "ab" * 400, "b" * 5000, None, "", "x", prose(40) * 6]
    texts += [shared[:199], shared[:200], "é" * 300]
    return texts


@pytest.mark.parametrize("length", [200, 191, 255])
def test_matches_brute_force(spark, length):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "i int, text string, key1 string").repartition(5)
    got = {r.i: (bytes(r.kept), r.n_removed, len(r.removed)) for r in remove_repeats(df, length=length).collect()}
    want = dict(enumerate(brute(texts, length)))
    assert {i for i in want if want[i] != got[i]} == set()


def test_text_longer_than_a_chunk(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(200_000))
    texts = [long, "start" + long[65_400:66_000] + "end", long[131_000:131_250]]
    got = {r.i: (bytes(r.kept), r.n_removed, len(r.removed)) for r in remove_repeats(
        spark.createDataFrame(list(enumerate(texts)), "i int, text string")).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_empty_table_and_text_form(spark):
    assert remove_repeats(spark.createDataFrame([], "text string")).count() == 0
    body = "é" * 100  # 200 bytes, found at odd places too
    df = spark.createDataFrame([("x" + body + "z",), ("yy" + body,)], "text string")
    assert sorted(r.kept for r in remove_repeats(df, as_text=True).collect()) == ["xz", "yy"]


def test_equal_identifiers_of_unequal_bytes_are_no_repeat(spark):
    """Two texts whose first 16 bytes are made to share every 64-bit identifier that holds them."""
    import numpy as np

    from sluice.llm import suffix_dedup as D

    tail = "".join(random.Random(1).choice("abcdefgh ") for _ in range(184))
    pair = ["abcdefghijklmnop" + tail, "=e^HX8&>5j]'0`pi" + tail]
    ids = [D._identifiers(np.frombuffer(t.encode(), np.uint8)) for t in pair]
    assert all(ids[0][n][0] == ids[1][n][0] for n in (64, 128))  # the collision is there
    df = spark.createDataFrame(list(enumerate(pair)), "i int, text string")
    assert [r.n_removed for r in remove_repeats(df).collect()] == [0, 0]
    # The same pair beside true copies of one of them, and as the ends of longer texts.
    texts = [*pair, pair[0], "x" * 300 + pair[1], "y" * 300 + pair[1] + "z"]
    got = {r.i: (bytes(r.kept), r.n_removed, len(r.removed)) for r in remove_repeats(
        spark.createDataFrame(list(enumerate(texts)), "i int, text string")).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_hot_buckets_are_split(spark, monkeypatch):
    """Every counted join with a broadcast of its hot keys: the same result."""
    from sluice.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 1)
    monkeypatch.setattr(common, "HOT_SHARE", 1 << 40)
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    got = {r.i: (bytes(r.kept), r.n_removed, len(r.removed)) for r in remove_repeats(df).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_registered_query_is_brute_force(spark, sf):
    import hashlib

    from sluice.llm import queries

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.queries()["op10_suffix_dedup"](spark, sf).collect()}
    want = {d.doc_id: (len((d.text or "").encode()), n, runs, hashlib.sha256(kept).hexdigest())
            for d, (kept, n, runs) in zip(docs, brute([d.text for d in docs]))}
    assert got == want
