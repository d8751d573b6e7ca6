"""Operator 1: WARC archives and a globally ordered capture index.

Writing.  Records of equal payloads of ``least`` bytes or more are one
response (the smallest page_id) and revisits that refer to it.  The smallest
ids come from a partial aggregate per digest; revisits are found by a join on
digest and salt, of rows without payloads.  Archives are gzip members, one per
record, gathered to about ``archive_bytes`` of payload, one archive a row of a
written table.

Reading.  Every archive is parsed member by member and gives one capture run:
its records sorted by URL key, capture time and page_id.

Index merge.  Spark's range sampler (a fixed sample, at most a million keys)
cuts the key space; every run is dealt to the ranges by (URL key, capture time,
page_id, run, offset), and each range merges its parts of the runs with a loser
tree, so ranges in order are the capture histories of all URLs in order.  One
URL with very many captures, or rows that tie in all keys, spread over many ranges.

Defined results: a null html is an empty payload; a null page_id is always a
response; rows that repeat a page_id are records of their own; a null url is
archived as ``urn:page:<page_id>``.  The capture time, which pages lack, is
``EPOCH`` plus page_id seconds (modulo 10**9).
"""

from __future__ import annotations

import gzip
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime, timedelta
from itertools import islice
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from returnscope.llm.common import slices, small_batches, written

EPOCH = datetime(2024, 1, 1, tzinfo=UTC)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = pa.struct(
    [
        ("url_key", pa.string()), ("timestamp", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()),
    ]
)
ENTRY_DDL = (
    "struct<url_key:string,timestamp:string,page_id:bigint,payload_bytes:bigint,payload_digest:string,"
    "record_type:string,refers_to:bigint,offset:bigint,length:bigint>"
)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the right, then port, path and query; no scheme, user or fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    usual = {"http": 80, "https": 443}.get(parts.scheme)
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port != usual else "") + ")" + (parts.path or "/")
    return (key + (f"?{parts.query}" if parts.query else "")).lower()


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=page_id % (1 << 64))}>"


def page_of(identifier: str) -> int:
    value = uuid.UUID(identifier.strip("<>").removeprefix("urn:uuid:")).int
    return value - (1 << 64) if value >= 1 << 63 else value


def capture_time(page_id: int | None) -> datetime:
    return EPOCH + timedelta(seconds=(page_id or 0) % 10**9)


def write_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit without its payload."""
    uri = quote(url, safe="/:?#[]@!$&'()*+,;=%-._~") if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {capture_time(page_id):%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if page_id is not None:
        head.insert(2, f"WARC-Record-ID: {record_id(page_id)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def members(archive: bytes, step: int = 1 << 14) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of every gzip member."""
    view, at = memoryview(archive), 0
    while at < len(view):
        inflate, begin, parts = zlib.decompressobj(31), at, []
        while not inflate.eof:
            piece = view[at : at + step]
            if not len(piece):
                raise ValueError("the archive ends inside a record")
            parts.append(inflate.decompress(piece))
            at += len(piece)
        at -= len(inflate.unused_data)
        yield begin, at - begin, b"".join(parts)


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def read_record(record: bytes) -> tuple[dict[str, str], int, bytes]:
    """Header fields, stated payload length and payload (empty for a revisit) of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _headers(head)
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    return fields, int(_headers(http)["content-length"]), payload


def capture_run(archive: bytes) -> list[dict]:
    """The sorted index entries of an archive; digests of responses are computed anew."""
    out = []
    for offset, length, record in members(archive):
        fields, size, payload = read_record(record)
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        revisit = fields["warc-type"] == "revisit"
        if not revisit and (digest != hashlib.sha256(payload).hexdigest() or size != len(payload)):
            raise ValueError(f"damaged record at {offset}")
        page = fields.get("warc-record-id")
        out.append(
            {
                "url_key": url_key(fields["warc-target-uri"]),
                "timestamp": fields["warc-date"].translate({ord(c): None for c in "-:TZ"}),
                "page_id": page_of(page) if page else None,
                "payload_bytes": size,
                "payload_digest": digest,
                "record_type": fields["warc-type"],
                "refers_to": page_of(fields["warc-refers-to"]) if revisit else None,
                "offset": offset,
                "length": length,
            }
        )
    return sorted(out, key=entry_key)


def entry_key(entry: dict) -> tuple[str, str, int]:
    return entry["url_key"], entry["timestamp"], -1 << 63 if entry["page_id"] is None else entry["page_id"]


class LoserTree:
    """Merges k sorted runs: inner nodes hold the losers of their matches, the winner stands on top."""

    def __init__(self, runs: list[Iterable], key):
        self.runs = [iter(r) for r in runs]
        self.key = key
        self.k = len(runs)
        self.head: list = [next(r, None) for r in self.runs]
        self.keys = [key(h) if h is not None else None for h in self.head]
        self.losers = [-1] * max(1, self.k)
        self.winner = self._play(1) if self.k > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        """A run that is over loses; equal keys go by run, so the merge is stable."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None or (self.keys[b] is None and a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator:
        while self.k and self.head[self.winner] is not None:
            run = self.winner
            yield self.head[run]
            self.head[run] = next(self.runs[run], None)
            self.keys[run] = self.key(self.head[run]) if self.head[run] is not None else None
            node = (run + self.k) // 2
            while node >= 1 and self.k > 1:  # only the matches on its path are played again
                if self._beats(self.losers[node], run):
                    run, self.losers[node] = self.losers[node], run
                node //= 2
            self.winner = run


def write_archives(pages: DataFrame, least: int = 100, archive_bytes: int = 8 << 20, salts: int = 16) -> DataFrame:
    """A written table of archives (run, data) with one record per page."""
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.encode("html", "utf-8"), 256))
    light = rows.filter(f"octet_length(html) >= {least} AND page_id IS NOT NULL").select("page_id", "digest")
    first = light.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    copies = light.withColumn("salt", F.pmod("page_id", F.lit(salts)).cast("int")).join(first, ["digest", "salt"])
    copies = copies.filter("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, size, records = TaskContext.get().partitionId(), 0, 0, []

        def archive() -> pa.RecordBatch:
            name = f"capture-{part:06d}-{number:06d}.warc.gz"
            return pa.record_batch([pa.array([name]), pa.array([b"".join(records)], pa.binary())], names=["run", "data"])

        for batch in slices(batches, "html"):
            for page, url, html, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body = html.encode()
                records.append(gzip.compress(write_record(page, url, body, digest, refers), 1, mtime=0))
                size += len(body)
                if size >= archive_bytes:
                    yield archive()
                    number, size, records = number + 1, 0, []
        if records:
            yield archive()

    typed = rows.join(copies, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")
    return written(typed.mapInArrow(run, "run string, data binary"), "archives")


def _table(entries: list[dict], **more: pa.Array) -> pa.RecordBatch:
    columns = {f.name: pa.array([e[f.name] for e in entries], f.type) for f in ENTRY}
    columns["run"] = pa.array([e["run"] for e in entries], pa.string())
    return pa.RecordBatch.from_pydict(columns | more)


def capture_index(archives: DataFrame, ranges: int, rows: int = 2_000) -> DataFrame:
    """The records of all archives: range and position give the global order of the histories."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("run").to_pylist(), batch.column("data"), strict=True):
                entries = [e | {"run": name} for e in capture_run(data.as_py())]
                for i in range(0, len(entries), rows):
                    yield _table(entries[i : i + rows])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, runs = TaskContext.get().partitionId(), {}
        for batch in batches:
            for entry in batch.to_pylist():
                runs.setdefault(entry["run"], []).append(entry)
        # parts of a run may arrive in any order; sorting joined sorted parts is a merge
        merged = iter(LoserTree([sorted(run, key=lambda e: (*entry_key(e), e["offset"])) for _, run in sorted(runs.items())], entry_key))
        at = 0
        while part := list(islice(merged, rows)):
            yield _table(part, range=pa.array([number] * len(part), pa.int32()), position=pa.array(range(at, at + len(part)), pa.int32()))
            at += len(part)

    schema = ENTRY_DDL.removeprefix("struct<").removesuffix(">").replace(":", " ") + ", run string"
    entries = archives.mapInArrow(read, schema)
    return entries.repartitionByRange(ranges, "url_key", "timestamp", "page_id", "run", "offset").mapInArrow(merge, schema + ", range int, position int")


def archive_pages(pages: DataFrame, range_records: int = 20_000, **settings) -> DataFrame:
    """Writes the pages as WARC archives, reads them back and returns their capture index in ranges of about ``range_records``."""
    return capture_index(write_archives(pages, **settings), max(1, math.ceil(pages.count() / range_records)))


def placed(index: DataFrame) -> DataFrame:
    """The capture index with ``place``, each record's number (from 1) in the global order of all histories.

    The index is written once; a range's first place is the count of the ranges before it, one row a range.
    """
    index = written(index, "index")
    sizes = index.groupBy("range").agg(F.max("position").cast("long").alias("_last"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("range", F.coalesce(F.sum(F.col("_last") + 1).over(earlier), F.lit(0)).alias("_before"))
    return index.join(sizes, "range").withColumn("place", F.col("_before") + F.col("position") + 1).drop("_before")
