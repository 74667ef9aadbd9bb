"""BPE encoding with a segment tree over adjacent pair ranks, and decoding.

A word starts as a row of symbols. Every adjacent pair has its merge rank (or none) at a
leaf of a segment tree whose nodes hold the least (rank, place) below them. The root is
the leftmost pair of the lowest rank. Merging it changes three leaves: the pair itself,
the one before and the one after. Each is a point update of logarithmic cost, and the
word is done when the root holds no pair. So a word of n symbols costs O(n log n) at any
length.

Texts are spread by Spark; each Python worker keeps a bounded cache of chunks.
"""

from __future__ import annotations

import json
import unicodedata
from array import array

import regex
from pyspark.sql import DataFrame

from sluice.llm.common import without
from sluice.llm.tokens import ChunkIds, built, byte_symbols, map_column, shared_text

_NONE = 1 << 62
_PLACE = (1 << 32) - 1


class Bpe:
    """The model of a tokenizer file: NFC, lower case, words by pattern, byte-level BPE."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.rank, self.merged = {}, {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair = vocab[a] << 32 | vocab[b]
            self.rank[pair] = rank << 32
            self.merged[pair] = vocab[a + b]
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.suffix] for s in symbols]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in (*vocab.items(), *self.special.items()):
            self.tokens[i] = token

    def merge(self, ids: list[int]) -> list[int]:
        """The ids after all merges, lowest rank first, leftmost of equals first."""
        n, rank = len(ids), self.rank
        if n < 2:
            return ids
        size = 1 << (n - 2).bit_length()
        tree = [_NONE] * (2 * size)
        for i in range(n - 1):
            found = rank.get(ids[i] << 32 | ids[i + 1])
            if found is not None:
                tree[size + i] = found | i
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            i += size
            tree[i] = value
            while i > 1:
                i >>= 1
                least = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == least:
                    break
                tree[i] = least

        def ranked(i: int, j: int) -> int:
            found = rank.get(ids[i] << 32 | ids[j])
            return _NONE if found is None else found | i

        while (top := tree[1]) != _NONE:
            i = top & _PLACE
            j = after[i]
            k = after[i] = after[j]
            ids[i], ids[j] = self.merged[ids[i] << 32 | ids[j]], -1
            if j < n - 1:
                put(j, _NONE)
            if k < n:
                before[k] = i
                put(i, ranked(i, k))
            else:
                put(i, _NONE)
            if before[i] >= 0:
                put(before[i], ranked(before[i], i))
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> bytes:
        """The ids of a piece of text, as little-endian unsigned 32-bit integers."""
        ids = array("I")
        for part in self.cut.split(text):
            if part in self.special:
                ids.append(self.special[part])
                continue
            plain = unicodedata.normalize("NFC", part)
            plain = plain.lower() if plain.isascii() else "".join(map(str.lower, plain))
            for word in self.words.findall(plain):
                ids.extend(self.merge(self.symbols(word)))
        return ids.tobytes()

    def symbols(self, word: str) -> list[int]:
        """The ids that a word starts from: one per byte, the last with the end mark."""
        raw = word.encode()
        return [*map(self.inner.__getitem__, raw[:-1]), self.last[raw[-1]]]

    def encode_word(self, word: str) -> bytes:
        """``encode`` for a word of lower-case letters in normal form."""
        return array("I", self.merge(self.symbols(word))).tobytes()

    def decode(self, ids: bytes | None) -> str:
        """The tokens of the ids, special ones too, joined by one space."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in memoryview(ids).cast("I")]) if ids else ""


def _chunk_ids(source: str) -> ChunkIds:
    model = built("bpe", source, Bpe)
    return ChunkIds(model.encode, model.encode_word)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", out: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``out``: the whole text's ids in binary.

    Null and empty texts have no ids. A column named ``out`` is replaced. Rows are
    independent: repeated rows give equal ids, an empty table gives an empty one."""
    source = shared_text(docs.sparkSession, tokenizer)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != out.lower()]
    make = lambda: built("bpe ids", source.value, _chunk_ids).of
    return map_column(docs, text, make, out, "binary", keep)


def decode(docs: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``: the text of its binary ids (null or empty: empty)."""
    source = shared_text(docs.sparkSession, tokenizer)
    docs = without(docs, [out])
    make = lambda: built("bpe", source.value, Bpe).decode
    return map_column(docs, ids, make, out, "string", docs.columns)
