"""Token ids of whole texts, with a bounded cache of white-space-separated chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path
from unicodedata import is_normalized

import pyarrow as pa
from pyspark.sql import DataFrame

#: Chunks kept by a Python worker in each of two generations, and the bytes of the longest
#: one kept; memory bounds only.
CACHED_CHUNKS = 300_000
CACHED_BYTES = 64
#: Text bytes per result batch.
BATCH_BYTES = 4 << 20
# Marks that end a word and are a token of their own behind letters.
_MARKS = ".,;:!?"


class ChunkIds(dict):
    """Ids (little-endian unsigned 32-bit) by chunk; what is missing is encoded.

    ``encode`` takes any text, ``encode_word`` lower-case letters in normal form only. The
    tokenizer lower-cases and never joins letters and marks, so ``Word,`` is looked up as
    ``word`` and ``,``, and kept in its own spelling once its word is known. When a generation
    is full it becomes the old one, from which used chunks return."""

    def __init__(self, encode: Callable[[str], bytes], encode_word: Callable[[str], bytes]):
        self.encode, self.encode_word, self.old = encode, encode_word, {}

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            text = chunk.decode()
            body = text[:-1] if text[-1] in _MARKS else text
            lower = body.lower()
            if lower.isalpha() and "\u03c2" not in lower:  # letters alone: no special token, nothing to compose
                if body != text:
                    word = lower.encode()
                    known = word in self
                    ids = self[word] + self[chunk[-1:]]
                    if not known:
                        return ids
                elif lower != text:
                    word = lower.encode()
                    known = word in self
                    ids = self[word]
                    if not known:
                        return ids
                else:
                    ids = self.encode_word(text) if is_normalized("NFC", text) else self.encode(text)
            else:
                ids = self.encode(text)
        if len(chunk) <= CACHED_BYTES:
            if len(self) >= CACHED_CHUNKS:
                self.old = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def of(self, text: str | None) -> bytes:
        """The ids of a whole text. Only the six ASCII spaces cut chunks: the tokenizer joins
        nothing across them, so the chunks' ids side by side are the text's."""
        return b"".join(map(self.__getitem__, text.encode().split())) if text else b""


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself
    where it is printable, else the next free one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


_BUILT: dict = {}


def built(kind: str, source: str, build: Callable[[str], object]):
    """``build(source)``, once per Python worker."""
    key = (kind, hash(source))
    if key not in _BUILT:
        _BUILT[key] = build(source)
    return _BUILT[key]


def shared_text(spark, path: str):
    """A tokenizer file (1.7 MB for the one used here) sent to the executors once."""
    return spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def map_column(df: DataFrame, column: str, make: Callable[[], Callable], out: str, kind: str, keep: list[str]) -> DataFrame:
    """``df.select(keep)`` with ``out``: ``make()(value)`` of every value of ``column``, in
    result batches bounded by the size of the values."""
    source = df.select(*keep, df[column])
    arrow = pa.binary() if kind == "binary" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            values, low, made, size = batch.column(len(keep)), 0, [], 0
            for i in range(batch.num_rows):
                made.append(f(values[i].as_py()))
                size += len(made[-1])
                if size >= BATCH_BYTES or i == batch.num_rows - 1:
                    part = batch.slice(low, len(made))
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(made, arrow)], [*batch.schema.names[: len(keep)], out])
                    low, made, size = i + 1, [], 0

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(keep)]), f"`{out}` {kind}"])
    return source.mapInArrow(run, schema)
