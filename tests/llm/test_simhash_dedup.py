"""Fingerprints and linking against all pairs, in small and in large buckets; components."""

import random

import numpy as np
import pytest
import xxhash

from sluice.llm import simhash_dedup as S
from sluice.llm.components import components


def plain_fingerprint(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i: i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, fps, radius=4):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = np.array(fps, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius):
            a, b = find(i), find(int(j))
            parent[max(a, b, key=lambda x: ids[x])] = min(a, b, key=lambda x: ids[x])
    return {ids[i]: ids[find(i)] for i in range(len(ids))}


def test_masks_cover_every_pair_within_the_radius():
    rng, masks = random.Random(1), S.covering_masks(4)
    assert len(masks) == 31
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
        assert any(diff & m == 0 for m in masks)


def test_fingerprint_matches_a_plain_reading():
    for text in (None, "", "  \n", "One", "a b c", "A b C d", "x y z w v", "é É ß q r s t", "w " * 40, "a b c d " * 9 + "e"):
        assert S.fingerprint(text, 4) == plain_fingerprint(text)


@pytest.mark.parametrize("max_bucket", [4096, 3])
def test_components_match_all_pairs(spark, max_bucket):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(50)]
    texts = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(words)
            texts.append(" ".join(near))
    texts += [None, "", "Same text HERE now", "same TEXT here now"]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, fp string").repartition(4)
    out = S.near_duplicates(df, max_bucket=max_bucket).collect()
    want = groups(list(range(len(texts))), [plain_fingerprint(t) for t in texts])
    assert {r.doc_id: r.component_id for r in out} == want
    assert sorted(r.doc_id for r in out if r.kept) == sorted(set(want.values()))
    assert {r.fingerprint for r in out if r.doc_id == len(texts) - 3} == {"0" * 16} and out[0].fp == "c"


def test_large_buckets_find_the_same_links(spark):
    """A chain of fingerprints a bit apart each, in buckets over the limit."""
    fps = [0]
    for i in range(40):
        fps.append(fps[-1] ^ (1 << i))
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    for limit in (4096, 2):
        nodes = components(S.fingerprint_links(df, max_bucket=limit)).collect()
        assert len({r.component for r in nodes}) == 1 and len(nodes) == 41


def test_nulls_ties_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (None, "z"), (None, None)], "doc_id long, text string")
    out = S.near_duplicates(df).collect()
    assert [r.component_id for r in out if r.text == "a b c d e"] == [5, 5, 5]
    assert sum(r.kept for r in out if r.text == "a b c d e") == 1 and all(r.component_id is None for r in out if r.text != "a b c d e")
    assert S.near_duplicates(df.limit(0)).count() == 0
    same = df.withColumn("text_hash", df.doc_id)
    kept = S.one_of_each(same).collect()
    assert sorted(((r.doc_id, r.text, r.text_hash) for r in kept), key=str) == sorted([(5, "a b c d e", 5), (None, "z", None), (None, None, None)], key=str)
    assert S.one_of_each(same.limit(0)).count() == 0


def test_components_of_random_links(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(0, i) for i in range(300, 900)] + [(i, i + 1) for i in range(1000, 1060)]
    links += [(None, 1), (7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_joins_with_hot_keys_lose_and_repeat_nothing(spark):
    from sluice.llm.common import join_one, save

    rows = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN id % 5 ELSE id END AS k")
    one = save(spark.range(3000).selectExpr("id AS k", "id * 2 AS v").where("k % 11 <> 4"), "one")
    want = sorted(map(tuple, rows.join(one, "k").collect()))
    for limit in (10, 500, 10_000):
        assert sorted(map(tuple, join_one(save(rows, "rows"), one, ["k"], hot_rows=limit).collect())) == want
