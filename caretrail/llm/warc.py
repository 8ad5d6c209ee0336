"""WARC archives of captured pages, and an index over them merged from sorted runs.

Writing: of the records with equal payloads the one with the largest page_id carries the payload, the others are
revisits that refer to it. Spark's text writer writes the archives: a record is one value, and the line separator is the
CRLF that ends a record. Reading: each archive is unzipped and parsed by content lengths as a stream, so a task holds one
compressed archive and one record. Each archive gives one run of captures, sorted where it was read.

Index: the runs are merged externally. Splitters sampled from the runs cut the key space (URL key, time, then page, run and place,
so that no key repeats) into ranges; a range gathers its stretch of every run and a loser tree merges the stretches, which
gives capture histories in global order: by `segment`, then `position`.

Defined cases: a null html is an empty payload, and empty payloads are equal payloads too. A null url is left out of the record and
has an empty URL key. A null page_id is smaller than any other; where all records of a payload lack one, each is a
response. Repeated rows with the largest page_id are responses each. Control characters in a url are percent-escaped.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.llm.stored import Scratch

EPOCH = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = (
    "page_id long, url string, captured string, url_key string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to long, archive string, place long"
)
COLUMNS = [field.split()[0] for field in CAPTURE.split(", ")]


def urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def of_urn(text: str | None) -> int | None:
    name = (text or "").strip("<>").rpartition(":")[2]
    return int(name) if name not in ("", "none") else None


def capture_time(page_id: int | None) -> str:
    """The pages have no time of their own: one second a page, from a fixed day on."""
    seconds = abs(page_id or 0) % (10 * 365 * 86400)
    return (EPOCH + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then the rest in lower case: captures of a site lie side by side."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*://)?([^/?#]*)([^#]*)", (url or "").lower(), re.DOTALL)
    return f"{','.join(reversed(m[1].split('.')))}){m[2] or '/'}" if url else ""


def record(page_id: int | None, url: str | None, html: str | None, sha1: str, first: int | None) -> str:
    """One record without the CRLF that ends it."""
    payload = html or ""
    size = len(payload.encode())
    revisit = page_id != first
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}"]
    if url is not None:
        escaped = re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {escaped}")
    lines.append(f"WARC-Date: {capture_time(page_id)}")
    lines.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {urn(first)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + size * (not revisit)}", "", ""]
    return "\r\n".join(lines) + http + ("" if revisit else payload) + "\r\n"


def write_archives(pages: DataFrame, scratch: Scratch, records_per_file: int = 2_000) -> None:
    """Archives (.gz) of all pages below `scratch`, as `archives`. The largest page_id of a payload is an aggregate with a map-side
    combine; it is stored, so that Spark deals both sides of the join to the pages and splits hot payloads."""
    page = pages.select("page_id", "url", "html", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("sha1"))
    first = scratch.store(page.groupBy("sha1").agg(F.max("page_id").alias("first")), "first")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for done in _chunks((record(*r) for r in rows), 8 << 20):
                yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["value"])

    joined = page.join(first, "sha1").select("page_id", "url", "html", "sha1", "first")
    joined.mapInArrow(records, "value string").write.option("lineSep", "\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file
    ).text(scratch.path("archives"))


def _chunks(values: Iterator[str], most: int) -> Iterator[list[str]]:
    held, size = [], 0
    for value in values:
        held.append(value)
        size += len(value)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


class Reader:
    """Bytes of a gzip file, unzipped as they are asked for."""

    def __init__(self, packed: bytes):
        self.packed, self.at, self.held, self.gz = memoryview(packed), 0, bytearray(), zlib.decompressobj(31)

    def more(self) -> bool:
        if self.gz.eof:  # the next member of the file
            rest = self.gz.unused_data
            if not rest and self.at >= len(self.packed):
                return False
            self.gz = zlib.decompressobj(31)
            self.held += self.gz.decompress(rest)
            return True
        if self.at >= len(self.packed):
            return False
        self.held += self.gz.decompress(self.packed[self.at : self.at + 65536])
        self.at += 65536
        return True

    def until(self, mark: bytes) -> bytes | None:
        """All up to the mark, which is passed over."""
        start = 0
        while (found := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self.more():
                return None
        out = bytes(self.held[:found])
        del self.held[: found + len(mark)]
        return out

    def take(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self.more():
                raise EOFError(f"a record ends {size - len(self.held)} bytes early")
        out = bytes(self.held[:size])
        del self.held[:size]
        return out


def parse(packed: bytes, archive: str) -> list[tuple]:
    """The captures of one archive, in order of URL key, time and page."""
    reader, out = Reader(packed), []
    while (head := reader.until(b"\r\n\r\n")) is not None:
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        block = reader.take(int(fields["Content-Length"]))
        if reader.take(4) != b"\r\n\r\n":
            raise ValueError(f"{archive}: a record does not end where its length says")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"{archive}: a payload does not match its digest")
        url = fields.get("WARC-Target-URI")
        refers = of_urn(fields.get("WARC-Refers-To"))
        out.append((of_urn(fields["WARC-Record-ID"]), url, fields["WARC-Date"], url_key(url), kind, digest, size, refers, archive))
    out.sort(key=lambda r: (r[3], r[2], -1 if r[0] is None else r[0]))
    return [(*r, i) for i, r in enumerate(out)]


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One sorted run of captures per archive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")

    def captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = parse(content.as_py(), path.rpartition("/")[2])
                yield _batch(rows)

    return files.mapInArrow(captures, CAPTURE)


KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]


def _batch(rows: list[tuple], extra: dict[str, list] | None = None) -> pa.RecordBatch:
    arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(KINDS)]
    extra = extra or {}
    return pa.RecordBatch.from_arrays([*arrays, *(pa.array(v, pa.int64()) for v in extra.values())], names=[*COLUMNS, *extra])


def key(row: tuple) -> tuple:
    """Order of the index; no two captures share a key."""
    return row[3], row[2], -1 if row[0] is None else row[0], row[8], row[9]


class LoserTree:
    """Merge of sorted runs: each step replays the path of the last winner, one comparison a level."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.next = runs, [0] * len(runs)
        self.size = max(1, 1 << (len(runs) - 1).bit_length()) if runs else 1
        self.keys = [key(r[0]) if r else None for r in runs] + [None] * (self.size - len(runs))
        self.losers = [0] * self.size
        self.winner = self._play(1)

    def _beats(self, a: int, b: int) -> bool:
        return self.keys[b] is None or self.keys[a] is not None and self.keys[a] <= self.keys[b]

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return won

    def __iter__(self) -> Iterator[tuple]:
        while self.keys[self.winner] is not None:
            run = self.winner
            yield self.runs[run][self.next[run]]
            self.next[run] += 1
            self.keys[run] = key(self.runs[run][self.next[run]]) if self.next[run] < len(self.runs[run]) else None
            node = (run + self.size) >> 1
            while node:
                if self._beats(self.losers[node], self.winner):
                    self.winner, self.losers[node] = self.losers[node], self.winner
                node >>= 1


def merge_index(runs: DataFrame, range_rows: int = 100_000, least_ranges: int = 64, samples_per_range: int = 32) -> DataFrame:
    """The captures with `segment` and `position`, their place in global order. `runs` must be stored, as it is read thrice.

    The sample is the only thing that comes to the driver: `samples_per_range` keys for each `range_rows` captures.
    """
    total = runs.count()
    parts = max(least_ranges, -(-total // range_rows))
    chance = min(1.0, parts * samples_per_range / max(1, total))
    drawn = runs.where(F.xxhash64("archive", "place").bitwiseAND(0xFFFFFF) < int(chance * (1 << 24)))
    sample = sorted(key(tuple(r)) for r in drawn.select(*COLUMNS).collect())
    splitters = sorted({sample[i * len(sample) // parts] for i in range(1, parts)}) if sample else []

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            yield _batch(rows, {"segment": [bisect_right(splitters, key(r)) for r in rows]})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(segment: int, runs: dict[str, list]) -> pa.RecordBatch:
            rows = list(LoserTree(list(runs.values())))
            return _batch(rows, {"segment": [segment] * len(rows), "position": list(range(len(rows)))})

        at, held = None, {}
        for batch in batches:
            for *row, segment in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != at:
                    if held:
                        yield done(at, held)
                    at, held = segment, {}
                held.setdefault(row[8], []).append(tuple(row))
        if held:
            yield done(at, held)

    ranged = runs.select(*COLUMNS).mapInArrow(dealt, f"{CAPTURE}, segment long")
    stretches = ranged.repartition(parts, "segment").sortWithinPartitions("segment", "archive", "place")
    return stretches.mapInArrow(merged, f"{CAPTURE}, segment long, position long")


def archive_and_index(pages: DataFrame) -> DataFrame:
    """Write all pages as archives, read them back, and return the merged index of captures."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    write_archives(pages, scratch)
    runs = scratch.store(read_archives(spark, scratch.path("archives")), "runs")
    return merge_index(runs).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "segment", "position"
    )


def archive_digest(pages: DataFrame) -> DataFrame:
    return archive_and_index(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS first FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
 array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST(((('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS BIGINT), 5))::BIGINT >> CAST(15 - (i % 4) * 5 AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '')
  AS payload_digest,
 CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM w"""
