"""WARC archives with a two-level capture index.

**Archives.** Each partition of pages writes WARC 1.1 files of one gzip member per record
into the shared folder, under names of their own per attempt; a file counts only if the
attempt that wrote it is the one whose manifest rows Spark kept. Of pages with equal large
payloads one is a response and the others are revisits that refer to it. Only digests and
ids are shuffled for that, not pages, while the repeated digests, counted first, fit a
broadcast.

**Index.** Archives are read back record by record. Lines (reversed-host URL key, record,
file, offset, length) are range-partitioned and sorted. Each partition writes blocks of
lines, compressed one by one, and behind them its part of the sparse directory: the first
key and page of each block with its place. The list of parts, one small row per partition,
is the top level.

**Lookup.** Queries are sorted the same way. A task finds the part, then the block in the
part's directory, then the line in the block by binary search on key and page, reading only
those byte ranges, so a URL with a large share of all rows is never gathered. What it found
is read from the archives by range, in file order.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import join_one, save
from sluice.llm.files import open_read, open_write, read_range
from sluice.sources.scratch import scratch_path

#: Repeated digests up to this many rows are broadcast (40 hex digits and an id each).
MAX_BROADCAST_DIGESTS = 200_000
#: An archive file ends after the record that takes it over this size.
FILE_BYTES = 1 << 30
BLOCK_LINES = 1000
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_ID = "urn:page:"


def clean_uri(url: str) -> str:
    """``url`` on one line: white space and control characters percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f-\xa0\u2028\u2029]", lambda m: quote(m[0]), url)


def surt(url: str | None) -> str:
    """The sort key of a URL: its host reversed, then port, path and query. No fragment.

    ``https://a.b.com/x?y#z`` gives ``com,b,a)/x?y``. Null gives the empty key; what has no
    host is kept as it is."""
    if not url:
        return ""
    url = clean_uri(url)
    try:
        parts = urlsplit(url)
        host, port = parts.hostname, parts.port
    except ValueError:
        return url
    if not host:
        return url
    port = f":{port}" if port and (parts.scheme, port) not in (("http", 80), ("https", 443)) else ""
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + query


def record_types(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """``pages (page, url, html)`` with ``digest`` and ``refers_to``, null for responses."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    sized = pages.select("page", "url", F.coalesce("html", F.lit("")).alias("html"), F.sha1(body).alias("digest"),
                         F.octet_length(body).alias("size"))
    large = sized.filter(F.col("size") >= least_bytes).groupBy(F.col("digest").alias("of")).agg(
        F.max("page").alias("response"), F.min("page").alias("least"), F.count("page").alias("ids"), F.count(F.lit(1)).alias("rows"))
    repeated = save(large.filter((F.col("response") > F.col("least")) | (F.col("ids").between(1, F.col("rows") - 1))).select("of", "response"), "repeated-digests")
    repeated, few = repeated.withColumnRenamed("of", "digest"), repeated.count() <= MAX_BROADCAST_DIGESTS
    joined = sized.join(F.broadcast(repeated), "digest", "left") if few else join_one(sized, repeated, ["digest"], how="left")
    same = F.col("page").eqNullSafe(F.col("response"))
    return joined.select(
        "page", "url", "html", "digest", F.when(~same, F.col("response")).alias("refers_to"))


def _record(page: str | None, url: str | None, html: str, digest: str, refers_to: str | None, date: str) -> bytes:
    payload = b"" if refers_to is not None else html.encode()
    block = _HTTP + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{_ID}{quote(page or '', safe='')}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + clean_uri(url))
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_ID}{quote(refers_to, safe='')}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _id(urn: str) -> str:
    return unquote(urn[1 + len(_ID):-1])


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def _write_archives(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, out, path, at, n = [], None, "", 0, 0
        try:
            for batch in batches:
                for values in zip(*(c for c in batch.columns), strict=True):
                    if out is None:
                        path, at, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = open_write(path)
                    member = _gzip(_record(*(v.as_py() for v in values), date))
                    out.write(member)
                    at, n = at + len(member), n + 1
                    if at >= FILE_BYTES:
                        out.close()
                        out = None
                        rows.append((path, at, n))
        finally:
            if out is not None:
                out.close()
        if out is not None:
            rows.append((path, at, n))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["file", "bytes", "records"])

    return run


def write_archives(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 1000,
                   date: str = "1970-01-01T00:00:00Z", folder: str | None = None) -> DataFrame:
    """Write one record per row and return the manifest: ``file, bytes, records``.

    The payload is the html in UTF-8, empty for null. Of rows with equal payloads of at
    least ``least_bytes`` bytes, the one with the largest page id is a response and the
    others are revisits; rows that repeat its id too are responses like it. A null id is
    less than any other. An empty table writes no file."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    typed = record_types(pages.select(F.col(page).alias("page"), F.col(url).alias("url"), F.col(html).alias("html")), least_bytes)
    text = typed.select(F.col("page").cast("string"), F.col("url").cast("string"), "html", "digest", F.col("refers_to").cast("string"))
    return save(text.mapInArrow(_write_archives(folder, date), "file string, bytes long, records long"), "manifest")


def _read_members(path: str) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of a file's gzip members, reading it once in order."""
    with open_read(path) as f:
        data, base = f.read(1 << 20), 0
        while data:
            z, parts, length = zlib.decompressobj(31), [], 0
            while data and not z.eof:
                parts.append(z.decompress(data))
                length += len(data) - len(z.unused_data)
                data = z.unused_data or f.read(1 << 20)
            yield base, length, b"".join(parts)
            base += length


def _index_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "page", "file", "offset", "length", "type", "digest"]
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows: list = []
            for offset, length, data in _read_members(path):
                headers, _ = parse_record(data)
                rows.append((surt(headers.get("warc-target-uri")), _id(headers["warc-record-id"]), path, offset, length,
                             headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")))
                if len(rows) >= 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


def _write_index(folder: str, block_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, at, directory, lines, last, part = f"{folder}/{uuid.uuid4().hex}.idx", None, 0, [], [], None, b""

        def flush():
            nonlocal at, out, lines
            if out is None:
                out = open_write(path)
            block = zlib.compress("\n".join(json.dumps(x) for x in lines).encode())
            out.write(block)
            directory.append((lines[0][:2], at, len(block)))
            at, lines = at + len(block), []

        try:
            for batch in batches:
                for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    lines.append(line)
                    last = line[:2]
                    if len(lines) == block_lines:
                        flush()
            if lines:
                flush()
            if out is not None:
                part = zlib.compress(json.dumps(directory).encode())
                out.write(part)
        finally:
            if out is not None:
                out.close()
        if directory:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (*directory[0][0], *last, path, at, len(part))],
                ["first", "first_page", "last", "last_page", "file", "offset", "length"])

    return run


def build_index(manifest: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Index the archives and return the top level: the first and last key and page of each
    part and the place of its directory, ``first, first_page, last, last_page, file, offset,
    length``, one row per partition of the sort."""
    spark = manifest.sparkSession
    files = manifest.repartition(max(1, manifest.count())).select("file")
    lines = save(files.mapInArrow(
        _index_lines, "key string, page string, file string, offset long, length long, type string, digest string"), "capture-lines")
    ordered = lines.repartitionByRange("key", "page").sortWithinPartitions("key", "page", "file", "offset")
    folder = scratch_path(spark, "capture-index")
    return save(ordered.mapInArrow(
        _write_index(folder, block_lines), "first string, first_page string, last string, last_page string, file string, offset long, length long"), "index-parts")


class Lookup:
    """Binary search on (key, page) through parts, directory and block; keeps the block used last."""

    def __init__(self, parts: list[tuple]):
        self.parts = sorted(parts)
        self.last = [p[2:4] for p in self.parts]
        self.opened: tuple = (None, None, None)
        self.block: tuple = (None, None, None)

    def _directory(self, part: int) -> tuple[list[tuple], list]:
        if self.opened[0] != part:
            path, offset, length = self.parts[part][4:]
            entries = json.loads(zlib.decompress(read_range(path, offset, length)))
            self.opened = (part, [tuple(e[0]) for e in entries], entries)
        return self.opened[1:]

    def _lines(self, part: int, number: int, entry: list) -> tuple[list[tuple], list]:
        if self.block[0] != (part, number):
            raw = zlib.decompress(read_range(self.parts[part][4], entry[1], entry[2]))
            lines = [json.loads(x) for x in raw.split(b"\n")]
            self.block = ((part, number), [tuple(x[:2]) for x in lines], lines)
        return self.block[1:]

    def find(self, key: str, page: str | None = None) -> Iterator[list]:
        """All lines of a key, or of a key and page, in order, over as many blocks and parts as they have."""
        wanted = (key,) if page is None else (key, page)
        width = len(wanted)
        head = lambda place: place[:width]
        part = bisect_left(self.last, wanted, key=head)
        while part < len(self.parts) and head(self.parts[part][:2]) <= wanted:
            firsts, entries = self._directory(part)
            number = max(0, bisect_left(firsts, wanted, key=head) - 1)
            while number < len(entries) and head(firsts[number]) <= wanted:
                places, lines = self._lines(part, number, entries[number])
                yield from lines[bisect_left(places, wanted, key=head): bisect_right(places, wanted, key=head)]
                number += 1
            part += 1


def _look_up(parts: list[tuple]):
    names = ["page", "file", "offset", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Lookup(parts)
        for batch in batches:
            rows: list = []
            for key, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for line in index.find(key, page):
                    rows.append((page, *line[2:5]))
                    if len(rows) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(map(surt, batch.column(0).to_pylist()), pa.string()), batch.column(1)], ["key", "page"])


def look_up(parts: DataFrame, wanted: DataFrame, page: str = "page_id", url: str = "url") -> DataFrame:
    """Where the records of the pages ``wanted`` lie: ``page, file, offset, length``.

    The parts' list, one row per partition of the index, goes to every task."""
    top = [tuple(r) for r in parts.collect()]  # as many rows as the sort had partitions
    asked = wanted.select(F.col(url).cast("string").alias("url"), F.coalesce(F.col(page).cast("string"), F.lit("")).alias("page"))
    queries = asked.mapInArrow(_keys, "key string, page string").distinct()
    ordered = queries.repartitionByRange("key", "page").sortWithinPartitions("key", "page")
    return ordered.mapInArrow(_look_up(top), "page string, file string, offset long, length long")


def _read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, path, f = ["page", "record_type", "digest", "refers_to", "payload"], None, None
    for batch in batches:
        rows, size = [], 0
        for page, file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if file != path:
                if f is not None:
                    f.close()
                path, f = file, open_read(file)
            f.seek(offset)
            headers, block = parse_record(zlib.decompress(f.read(length), 31))
            refers = headers.get("warc-refers-to")
            rows.append((page, headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:"),
                         _id(refers) if refers else None, block.partition(b"\r\n\r\n")[2]))
            size += len(rows[-1][4])
            if size >= 4 << 20:
                yield pa.RecordBatch.from_arrays(_typed(rows), names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays(_typed(rows), names)
    if f is not None:
        f.close()


def _typed(rows: list) -> list[pa.Array]:
    return [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string()] * 4 + [pa.binary()], strict=True)]


def read_records(places: DataFrame) -> DataFrame:
    """The records at ``places``: ``page, record_type, digest, refers_to, payload``, read by
    range in file order. A revisit's payload is empty: it lies with the record it refers to."""
    ordered = places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return ordered.select("page", "file", "offset", "length").mapInArrow(
        _read_records, "page string, record_type string, digest string, refers_to string, payload binary")


def archive_round_trip(spark: SparkSession, pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html",
                       least_bytes: int = 1000, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write ``pages`` to archives, index them, look every page up and read it back:
    ``page, payload_bytes, payload_digest, record_type, refers_to``, sizes and digests taken
    from the payloads read, a revisit's from the response it refers to.

    A null html is an empty payload, a null id stays null and a null URL has the empty key; repeated rows are
    records of their own and come back as often; an empty table gives no rows."""
    parts = build_index(write_archives(pages, page, url, html, least_bytes), block_lines)
    read = read_records(look_up(parts, pages, page, url))
    read = save(read.select("page", "record_type", "digest", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
                            F.sha1("payload").alias("payload_digest")), "records-read")
    whole = read.filter("record_type = 'response'").select(
        F.col("page").alias("refers_to"), F.col("payload_digest").alias("digest"), "payload_digest", "payload_bytes").dropDuplicates(["refers_to", "digest"])
    own = read.filter("record_type = 'response'").select("page", "payload_bytes", "payload_digest", "record_type", "refers_to")
    others = join_one(read.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest"), whole, ["refers_to", "digest"], how="left").select(
        "page", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return own.unionByName(others)
