"""WARC archives of pages, and their index by external merging.

Writing: equal payloads of at least `MIN_BYTES` are one response, that of the smallest id, and
revisits of it. A record is one gzip member; Spark's text writer puts members end to end, so archives
go wherever Spark can write. Its line separator is a zero byte: a member ends with one (the high byte
of its length), which is left to the writer; where it does not, an empty member follows.

Reading: an archive is one row of `binaryFile`, `max_records` bounds its size. Records are found by
gzip member and Content-Length; the payload of each response is hashed again and must match.

Index: each archive's captures, sorted by URL key, timestamp and id, are one run. Runs are dealt out
by ranges of that key and merged in each range by a loser tree, so capture histories are ordered over
all ranges. A URL captured very often is split by timestamp and id. Only index rows are shuffled then.

Defined results: null html is an empty payload; a null url is `urn:no-url`; repeated rows of the
smallest id of a group are each a response; rows without an id never are one if another has an id; a very long
payload is one record, and a task holds the archive it is in.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.llm.tables import partitions, saved
from cardflow.plans.workspace import new_dir

MIN_BYTES = 100
#: An archive holds at most so many records and, unless one record alone is longer, bytes.
MAX_RECORDS = 50_000
MAX_BYTES = 128 << 20
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STEP = 1 << 16

CAPTURE = (
    "page_id long, url string, url_key string, timestamp string, payload_bytes long, "
    "payload_digest string, record_type string, refers_to long, run string, start long, length long"
)


def decisions(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, date, payload, digest and the first id of each larger group of equal payloads.

    Groups are reduced to one row before the join, and a group of a third of all pages is a skewed
    join key, which adaptive execution splits."""
    hashed = pages.withColumn("digest", F.sha2("payload", 256)).withColumn(
        "size", F.octet_length("payload").cast("long")
    )
    groups = (
        hashed.where(F.col("size") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first_id")
    )
    return hashed.join(groups, "digest", "left")


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = z.compress(data) + z.flush()
    if out[-1]:
        z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        out += z.flush()
    return out[:-1]


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, date: str, payload: bytes, digest: str, first_id: int | None) -> bytes:
    """One WARC record: a response, or a revisit of the record of `first_id`."""
    revisit = first_id is not None and first_id != page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url is not None else "urn:no-url"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Bytes: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {_record_id(first_id)}",
            f"X-Refers-To-Page-Id: {first_id}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", source: str = "html", date: str | None = None, max_records: int = MAX_RECORDS, max_bytes: int = MAX_BYTES) -> None:
    """Archives of all pages under `path`: a task begins another `part` where one would grow too long."""
    rows = decisions(
        pages.select(
            F.col(id).cast("long").alias("page_id"),
            F.col(url).cast("string").alias("url"),
            (F.col(date).cast("string") if date else F.lit(DATE)).alias("date"),
            F.coalesce(F.col(source), F.lit("")).cast("binary").alias("payload"),
        )
    ).select("page_id", "url", "date", "payload", "digest", "first_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = records = size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                columns = batch.slice(at, 500).to_pydict()
                made = [
                    _member(record(i, u, d or DATE, p, h, f))
                    for i, u, d, p, h, f in zip(*(columns[c] for c in ("page_id", "url", "date", "payload", "digest", "first_id")))
                ]
                parts = []
                for member in made:
                    length = len(member) + 1
                    if records and (records == max_records or size + length > max_bytes):
                        part, records, size = part + 1, 0, 0
                    records, size = records + 1, size + length
                    parts.append(part)
                yield pa.RecordBatch.from_pydict({"value": pa.array(made, pa.binary()), "part": pa.array(parts, pa.int32())})

    (
        rows.mapInArrow(run, "value binary, part int")
        .select(F.col("value").cast("string"), "part")
        .write.option("lineSep", "\0")
        .partitionBy("part")
        .text(path)
    )


def url_key(url: str) -> str:
    """The url with its host's parts reversed, without scheme, port of the scheme, fragment."""
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split(".")))
    except ValueError:
        return url
    return f"{host}){parts.path.lower() or '/'}" + (f"?{parts.query}" if parts.query else "")


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Start, length and content of each gzip member."""
    view, at = memoryview(data), 0
    while at < len(data):
        z, out, pos = zlib.decompressobj(31), [], at
        while not z.eof and pos < len(data):
            out.append(z.decompress(view[pos : pos + STEP]))
            pos += STEP
        if not z.eof:
            raise ValueError("an archive ends inside a record")
        end = min(pos, len(data)) - len(z.unused_data)
        yield at, end - at, b"".join(out)
        at = end


_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def captures(data: bytes, run: str) -> Iterator[tuple]:
    """The records of an archive as index rows."""
    for start, length, content in members(data):
        if not content:
            continue
        end = content.index(b"\r\n\r\n") + 4
        head = {k.lower(): v.decode() for k, v in _HEADER.findall(content[:end])}
        block = content[end : end + int(head[b"content-length"])]
        if len(block) != int(head[b"content-length"]) or not content.startswith(b"WARC/1."):
            raise ValueError(f"a broken record at {start} of {run}")
        size, digest = int(head[b"x-payload-bytes"]), head[b"warc-payload-digest"].removeprefix("sha256:")
        kind = head[b"warc-type"]
        if kind == "response":
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"a payload at {start} of {run} is not what its digest says")
        page, refers = head.get(b"x-page-id"), head.get(b"x-refers-to-page-id")
        uri = head[b"warc-target-uri"]
        yield (
            int(page) if page is not None else None, uri, url_key(uri), head[b"warc-date"], size, digest, kind,
            int(refers) if refers is not None else None, run, start, length,
        )


def _order(row: tuple) -> tuple:
    return row[2], row[3], row[0] is not None, row[0] or 0


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner goes on."""

    def __init__(self, runs: list[list], key: Callable):
        self.key, self.runs = key, [iter(r) for r in runs]
        self.k = len(runs)
        self.heads = [next(r, None) for r in self.runs]
        self.keys = [None if h is None else key(h) for h in self.heads]
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._play(leaf, first=True)

    def _less(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and self.keys[a] is not None
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, winner: int, first: bool = False) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            loser = self.losers[node]
            if loser < 0 and first:
                self.losers[node] = winner  # waits for the other side
                return
            if self._less(loser, winner):
                self.losers[node], winner = winner, loser
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.k:
            w = self.losers[0]
            if self.keys[w] is None:
                return
            yield self.heads[w]
            self.heads[w] = next(self.runs[w], None)
            self.keys[w] = None if self.heads[w] is None else self.key(self.heads[w])
            self._play(w)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


_TYPES = {"long": pa.int64(), "string": pa.string()}
_SCHEMA = pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in CAPTURE.split(", "))])


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of each archive under `path`, sorted."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                found = sorted(captures(data.as_py(), "/".join(name.as_py().split("/")[-2:])), key=_order)
                yield from _batches(iter(found), _SCHEMA)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(F.col("length") > 0).select("path", "content").mapInArrow(read, CAPTURE)


def merged(index: DataFrame) -> DataFrame:
    """Capture histories in order of URL key, timestamp and id, over all partitions."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_run: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                by_run.setdefault(row[8], []).append(row)
        # the exchange mixes a run's blocks: the sort finds them in order, or puts them so
        tree = LoserTree([sorted(by_run[r], key=_order) for r in sorted(by_run)], _order)
        yield from _batches(iter(tree), _SCHEMA)

    ranges = index.repartitionByRange(partitions(index.sparkSession), "url_key", "timestamp", "page_id")
    return ranges.mapInArrow(merge, CAPTURE)


def archive(pages: DataFrame) -> DataFrame:
    """Writes the pages and returns the merged index of what was read back."""
    spark = pages.sparkSession
    path = new_dir(spark, "warc")
    write(pages, path)
    return merged(saved(runs(spark, path), "warc-runs"))
