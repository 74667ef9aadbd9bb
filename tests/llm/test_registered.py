"""The registered queries that SQL cannot express, over whole tables, against plain readings."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

from sluice.llm import queries


def run(spark, sf, name):
    return queries.queries()[name](spark, sf).collect()


def table(spark, sf, name, *columns):
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns).collect()


def library_ids(texts):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t, [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_op3_packs_every_piece_of_every_document(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    _, ids = library_ids([d.text for d in docs])
    want = {}
    for d, i in zip(docs, ids):
        whole = [*i, 1]
        for k, low in enumerate(range(0, len(whole), 4096)):
            piece = whole[low: low + 4096]
            want[d.doc_id, k] = (low, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()))
    rows = run(spark, sf, "op3_packing")
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and sum(s[-1]) <= 4096
    assert len(sequences) <= -(-sum(w[1] for w in want.values()) // 4096) + 1


def test_op5_links_as_all_pairs_do(spark, sf):
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    x = np.array([v.embedding for v in vectors], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = np.equal.outer([v.label for v in vectors], [v.label for v in vectors])
    near = (x @ x.T >= 0.93) & same & ~np.eye(len(x), dtype=bool)
    label = np.array([v.vec_id for v in vectors])
    while True:
        new = np.minimum(label, np.where(near, label[None, :], label.max()).min(axis=1))
        if (new == label).all():
            break
        label = new
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in run(spark, sf, "op5_lattice_dedup")}
    assert got == {v.vec_id: (int(n), int(c), v.vec_id == c) for v, n, c in zip(vectors, near.sum(axis=1), label)}


def test_op6_encodes_and_decodes_as_the_library(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    t, ids = library_ids([d.text for d in docs])
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {d.doc_id: (len(i), sha(np.array(i, "<u4").tobytes()), sha(t.decode(i, skip_special_tokens=False).encode())) for d, i in zip(docs, ids)}
    assert {r.doc_id: tuple(r)[1:] for r in run(spark, sf, "op6_bpe")} == want


def test_op8_fingerprints_and_components(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    prints = []
    for d in docs:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), d.text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        bits = np.array([[h >> k & 1 for k in range(64)] for h in (xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams)]).reshape(-1, 64)
        prints.append(sum(1 << k for k in range(64) if 2 * bits[:, k].sum() > len(bits)))
    component = {d.doc_id: d.doc_id for d in docs}

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                x, y = sorted((root(docs[i].doc_id), root(docs[j].doc_id)))
                component[y] = x
    want = {d.doc_id: (f"{p:016x}", root(d.doc_id)) for d, p in zip(docs, prints)}
    assert {r.doc_id: tuple(r)[1:] for r in run(spark, sf, "op8_simhash_dedup")} == want


def test_clashing_names_pass_through_or_are_replaced(spark):
    """Columns named like a result's."""
    from sluice.llm.bpe import decode, encode

    path = public_tokenizers.path("word_bpe_49k.json")
    df = spark.createDataFrame([(1, "some text", "mine", 3, "x"), (2, None, "mine", 3, "x")], "doc_id long, text string, tag string, ids int, decoded string")
    got = decode(encode(df, path, keep=["doc_id", "tag"]), path).collect()
    assert {(r.doc_id, r.tag, bytes(r.ids) == b"") for r in got} == {(1, "mine", False), (2, "mine", True)}
