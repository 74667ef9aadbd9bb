"""BPE against the tokenizers library; pieces and packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm.bpe import Bpe, _chunk_ids, decode, encode
from sluice.llm.packing import Bins, _library_ids, cut_pieces, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(1)
    odd = [chr(c) for c in [*range(1, 0x250), *range(0x300, 0x370), *range(0x390, 0x3D0), *range(0x2000, 0x2070), 0x1F600, 0x3000, 0xAC00, 0x1100, 0x1161]]
    out = [None, "", " \n ", "Hello, World! Don't stop. we've I'LL x'sy", "a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|>.", "ΑΣ. Σ, ς; É! İ. ß: J̌ ﬁ Ⅷ ½", "x\x1cy\x85z q",
           "a" * 700, "ab" * 3000 + ".", "漢字かな 한글 😀👍🏽", "... ,, a,, A1. %%% *** a%%% don't. 'tis"]
    return out + ["".join(rng.choice(odd) for _ in range(50)) for _ in range(150)]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_chunk_ids_equal_the_library_on_whole_texts(library):
    source = open(PATH, encoding="utf-8").read()
    for cache in (_chunk_ids(source), _library_ids(source)):
        for t in texts() * 2:  # the second time from the cache
            assert np.frombuffer(cache.of(t), np.uint32).tolist() == ids_of(library, t)


def test_small_caches_change_nothing(library, monkeypatch):
    import sluice.llm.tokens as T

    monkeypatch.setattr(T, "CACHED_CHUNKS", 3)
    cache = _chunk_ids(open(PATH, encoding="utf-8").read())
    text = "one two, Three four. two one five six Two one, " * 3
    assert np.frombuffer(cache.of(text), np.uint32).tolist() == ids_of(library, text)


def test_segment_tree_merges_leftmost_lowest_first():
    bpe = Bpe(open(PATH, encoding="utf-8").read())
    rng = random.Random(2)
    for n in (1, 2, 3, 4, 5, 8, 17, 64):
        for _ in range(20):
            start = bpe.symbols("".join(rng.choice("etaoinshr") for _ in range(n)))
            ids = list(start)
            while True:  # the plain rule, quadratic
                pairs = [(bpe.rank[a << 32 | b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (a << 32 | b) in bpe.rank]
                if not pairs:
                    break
                i = min(pairs)[1]
                ids[i: i + 2] = [bpe.merged[ids[i] << 32 | ids[i + 1]]]
            assert bpe.merge(list(start)) == ids


def test_encode_and_decode_frames(spark, library):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "i int, text string")
    out = {r.i: r for r in decode(encode(df, PATH), PATH).collect()}
    for i, t in rows:
        ids = ids_of(library, t)
        assert np.frombuffer(bytes(out[i].ids), np.uint32).tolist() == ids and out[i].text == t
        assert out[i].decoded == library.decode(ids, skip_special_tokens=False)
    assert decode(encode(df.limit(0), PATH), PATH).count() == 0


def test_pieces_cover_every_document(spark, library):
    rows = list(enumerate([*texts(), "word " * 5000]))
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = defaultdict(list)
    for r in cut_pieces(df, PATH, capacity=100).collect():
        got[r.doc_id].append((r.piece, r.start, r.length, bytes(r.ids)))
    for i, t in rows:
        ids = np.array([*ids_of(library, t), 1], np.uint32).tobytes()
        assert sorted(got[i]) == [(k, k * 100, len(ids[s: s + 400]) // 4, ids[s: s + 400]) for k, s in enumerate(range(0, len(ids), 400))]
    assert zlib.crc32(got[0][0][3]) == zlib.crc32(b"\x01\0\0\0")


@pytest.mark.parametrize("lengths", [
    lambda r: [r.randint(1, 100) for _ in range(500)], lambda r: [r.choice([51, 34, 67, 26]) for _ in range(300)],
    lambda r: [60] * 50, lambda r: [100] * 10, lambda r: [1], lambda r: []])
def test_local_search_keeps_every_piece_and_never_needs_more_bins(lengths):
    sizes = lengths(random.Random(3))
    bins = Bins(sizes, 100)
    bins.best_fit()
    before, squares = sum(f > 0 for f in bins.fill), sum(f * f for f in bins.fill)
    bins.local_search()
    assert sorted(i for b in bins.bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) == f <= 100 for b, f in zip(bins.bins, bins.fill))
    assert sum(f > 0 for f in bins.fill) <= before and sum(f * f for f in bins.fill) >= squares


def test_steps_move_swap_and_swap_two_for_one():
    for sizes, bins, want in (
            ([50, 30, 40], [[0, 1], [2]], 2), ([60, 20, 30, 50], [[0, 1], [2, 3]], 2), ([40, 10, 40, 60], [[0, 1], [2], [3]], 2),
            ([70, 15, 10, 75, 30], [[0, 1], [3, 2], [4]], 2)):
        b = Bins(sizes, 100)
        b.bins, b.fill = [list(x) for x in bins], [sum(sizes[i] for i in x) for x in bins]
        b.local_search()
        assert sum(f > 0 for f in b.fill) == want
    b = Bins([55, 20, 25, 20], 100)  # two small ones for a larger one
    b.bins, b.fill = [[0, 2], [1, 3]], [80, 40]
    assert b._step(0, 1) and b.fill == [100, 20]


@pytest.mark.parametrize("shard_bins", [1024, 3])
def test_pack_is_gapless_and_dense(spark, shard_bins):
    rng = random.Random(6)
    rows = [(i // 2, rng.randint(1, 100), "x") for i in range(400)]
    out = pack(spark.createDataFrame(rows, "id int, length int, row string"), capacity=100, shard_bins=shard_bins).collect()
    assert sorted((r.id, r.length, r.row) for r in out) == sorted(rows)
    seqs = defaultdict(list)
    for r in out:
        seqs[r.sequence_id].append((r.offset, r.length))
    for placed in seqs.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at
            at += n
        assert at <= 100
    plain = Bins([r[1] for r in rows], 100)
    plain.best_fit()
    assert len(seqs) <= len(plain.bins) * (1 if shard_bins == 1024 else 1.1)
    assert pack(spark.createDataFrame([], "id int, length int")).count() == 0
