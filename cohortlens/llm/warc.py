"""WARC archives with an externally merged capture index (operator 2).

Writing: one WARC/1.1 record per capture, through Spark's text sink with the record end as line separator, so any
file system that Spark writes to will do and task retries are safe. The first capture of a payload (smallest id) is
a ``response``; equal later ones are ``revisit`` records that refer to it and hold no payload.

Reading: every archive is parsed by Content-Length, digests are checked against the payloads, and its captures are
sorted by (URL key, timestamp, id): one run per archive. The runs are cut at common range boundaries, and each range
merges its pieces of the runs with a loser tree, so the ranges in turn hold the globally ordered capture history. A
hot URL key is spread over ranges by its timestamps.

Defined cases: a null html is an empty payload; a null url is the empty URL; captures of one url in one second are
ordered by id; repeated rows are archived one by one (with the smallest id of their payload, each as a response); a page
without an id is archived as a response with an empty record id, is nobody's first capture and is dated as id 0; a URL with
control characters, which a header line can't hold, also travels as hex digits and is read back whole; an empty table gives
empty archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.shared import scratch
from cohortlens.session import cut_lineage

END = "\r\n\r\n"
_CONTROL = r"[\x00-\x1f]"
CAPTURE = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, "
           "url_key string, captured string, archive string, record_offset long, record_length long")
_NAMES = [x.split()[0] for x in CAPTURE.split(", ")]


def url_key(url: str) -> str:
    """Sort key of a URL: lower-case host labels from the top domain down, then path and query; no scheme, ``www``,
    default port or fragment."""
    rest = url.split("#", 1)[0]
    rest = rest.split("://", 1)[1] if "://" in rest else rest
    host, slash, path = rest.partition("/")
    host, _, port = host.lower().rsplit("@", 1)[-1].partition(":")
    labels = host.split(".")
    if len(labels) > 1 and labels[0] == "www":
        labels = labels[1:]
    port = "" if port in ("", "80", "443") else ":" + port
    return ",".join(reversed(labels)) + port + ")" + (slash + path or "/")


class LoserTree:
    """K-way merge of sorted sequences: inner nodes keep the loser of their match, the root's winner is next."""

    def __init__(self, runs: Sequence[Iterator], key: Callable):
        self.key, self.runs = key, [iter(r) for r in runs]
        self.n = max(len(self.runs), 1)
        self.heads = [self._next(i) for i in range(len(self.runs))] or [None]
        self.loser = [0] * self.n
        self.winner = self._build(1) if self.n > 1 else 0

    def _next(self, i: int):
        item = next(self.runs[i], None)
        return None if item is None else (self.key(item), i, item)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and x[:2] <= y[:2]

    def _build(self, node: int) -> int:
        if node >= self.n:
            return node - self.n
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (a, b) if self._before(a, b) else (b, a)
        self.loser[node] = lose
        return win

    def __iter__(self) -> Iterator:
        while (head := self.heads[self.winner]) is not None:
            yield head[2]
            i = self.winner
            self.heads[i] = self._next(i)
            node = (i + self.n) // 2
            while node:
                if self._before(self.loser[node], i):
                    self.loser[node], i = i, self.loser[node]
                node //= 2
            self.winner = i


def _base32(hexa: str) -> str:
    return base64.b32encode(bytes.fromhex(hexa)).decode()


def write_archives(pages: DataFrame, path: str, records_per_file: int = 4000) -> None:
    """Archive captures (page_id, url, payload, captured) under ``path`` as gzip-compressed WARC files."""
    c = pages.withColumn("sha1", F.sha1("payload"))
    first = c.groupBy("sha1").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1")
    c = c.join(first, "sha1", "left")
    revisit = F.coalesce(F.col("page_id") != F.col("first_id"), F.lit(False))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    lines = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:capture:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", _CONTROL, "")),
        F.when(F.col("url").rlike(_CONTROL), F.concat(F.lit("X-Target-URI-Hex: "), F.hex(F.encode("url", "UTF-8")))),
        F.concat(F.lit("WARC-Date: "), "captured"), F.concat(F.lit("WARC-Payload-Digest: sha1hex:"), "sha1"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:capture:"), "first_id", F.lit(">"))),
        F.when(revisit, F.concat(F.lit("X-Payload-Length: "), F.octet_length("payload"))),
        F.concat(F.lit("Content-Length: "), F.octet_length(body)))
    record = F.concat(lines, F.lit(END), body)
    (c.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(headers, block, offset, length) of every record of an uncompressed archive."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        yield head, data[stop + 4:stop + 4 + size], at, stop + 4 + size - at
        at = stop + 8 + size


def _ident(urn: str) -> int | None:
    number = urn.rsplit(":", 1)[1][:-1]
    return int(number) if number else None


def _uri(head: dict[str, str]) -> str:
    return bytes.fromhex(head["X-Target-URI-Hex"]).decode() if "X-Target-URI-Hex" in head else head["WARC-Target-URI"]


def _read_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The captures of each archive as one locally sorted run."""
    for batch in batches:
        for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            rows = []
            data = zlib.decompress(content.as_buffer(), 47)
            for head, block, offset, length in parse_archive(data):
                hexa, revisit = head["WARC-Payload-Digest"].rsplit(":", 1)[1], head["WARC-Type"] == "revisit"
                if not revisit and hashlib.sha1(block).hexdigest() != hexa:
                    raise ValueError(f"payload of record at {offset} of {name} does not match its digest")
                rows.append((_ident(head["WARC-Record-ID"]), int(head["X-Payload-Length"]) if revisit else len(block),
                             _base32(hexa), head["WARC-Type"], _ident(head["WARC-Refers-To"]) if revisit else None,
                             _uri(head), url_key(_uri(head)), head["WARC-Date"],
                             name.rsplit("/", 1)[1], offset, length))
            rows.sort(key=_order)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)],
                                                 names=_NAMES)


def _order(row: Sequence) -> tuple:
    return row[6], row[7], row[0] is not None, row[0] or 0


def _merge_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the pieces of the runs that fall into this range; a piece keeps the order of its run."""
    runs: dict[str, list] = {}
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in _NAMES], strict=True):
            runs.setdefault(row[8], []).append(row)
    for run in runs.values():
        if any(_order(a) > _order(b) for a, b in zip(run, run[1:], strict=False)):
            run.sort(key=_order)  # the shuffle is free to deliver a run's rows in another order
    part, out = TaskContext.get().partitionId(), []

    def flush(at: int) -> pa.RecordBatch:
        cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)]
        return pa.RecordBatch.from_arrays([*cols, pa.array([part] * len(out), pa.int64()),
                                           pa.array(range(at, at + len(out)), pa.int64())], names=[*_NAMES, "part", "pos"])
    at = 0
    for row in LoserTree([runs[k] for k in sorted(runs)], _order):
        out.append(row)
        if len(out) == 10_000:
            yield flush(at)
            at += len(out)
            out.clear()
    if out:
        yield flush(at)


_TYPES = [pa.int64() if x.split()[1] == "long" else pa.string() for x in CAPTURE.split(", ")]


def read_index(spark: SparkSession, path: str, captures_per_range: int = 50_000) -> DataFrame:
    """Captures of all archives under ``path`` with their place (from 0) in the order by URL key, timestamp, id."""
    archives = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    runs = cut_lineage(archives.mapInArrow(_read_run, CAPTURE))  # read twice: range bounds, then the merge
    ranges = max(1, -(-runs.count() // captures_per_range))
    merged = cut_lineage(runs.repartitionByRange(ranges, "url_key", "captured", "page_id")
                         .mapInArrow(_merge_range, CAPTURE + ", part long, pos long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    bases = merged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return merged.join(bases, "part").select(*_NAMES, (F.col("base") + F.col("pos")).alias("index_pos"))


#: Ids whose dates have years of four digits; others are dated by their remainder.
_DATED = (-1_700_000_000, 200_000_000_000)


def capture_time(page_id: str = "page_id") -> Column:
    """The tables hold no capture time; captures are dated one second apart by id (null: as 0), in years of four digits, so
    that dates sort as strings do."""
    n = F.coalesce(F.col(page_id).cast("long"), F.lit(0).cast("long"))
    n = F.when(n.between(*_DATED), n).otherwise(F.pmod(n, F.lit(_DATED[1])))
    return F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + n), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def archive_and_index(pages: DataFrame) -> DataFrame:
    """Write one record per page (page_id, url, html), read the archives back, return the ordered index."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(pages.select(
        F.col("page_id").cast("long"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"), capture_time().alias("captured")), path)
    return read_index(spark, path)
