"""WARC archives of pages, and their index in global order.

Each task writes its pages as records sorted by URL key and time, so that every archive is a
sorted run of captures. Archives are compressed as a whole, so offsets count bytes of the plain stream
(``read_record`` reads on to them). Pages of like size share archives, whose number of records bounds
their bytes. Archives are read back as streams and parsed by the lengths in their headers. The index entries of all runs are dealt by
ranges of (URL key, time), as many as keep a range near ``RANGE_ENTRIES``, and in each
range the runs' slices are merged by a loser tree: the ranges in turn are the global
order. A hot URL is split by time and page.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, work_path

END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
#: Payloads of up to so many bytes, and how many of them an archive has at most.
SIZES = ((1 << 16, 2000), (1 << 20, 128), (1 << 24, 8), (1 << 31, 1))
RANGE_ENTRIES = 250_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string's UTF-8 bytes: 20 bits become four digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.lower(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32)), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789abcdefghijklmnopqrstuv", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: Column) -> Column:
    """Host labels in reverse, then path and query, in lower case: ``com,example)/a?b``."""
    rest = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)^.*?://", ""))
    host = F.regexp_replace(F.regexp_extract(rest, r"^([^/?#]*)", 1), r":\d+$", "")
    tail = F.regexp_extract(rest, r"(?s)^[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(tail.startswith("/"), tail).otherwise(F.concat(F.lit("/"), tail)))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """One record per page, in archives of at most about 128 MB below ``path``.

    Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the smallest
    id is a response and the others are revisits of it; a null payload is empty. The capture
    time follows from the page id, as the table has none.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload"))
    copies = rows.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    rows = rows.join(copies, "digest", "left").withColumn("revisit", (F.col("bytes") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
    when = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = rows.withColumn("key", F.regexp_replace(url_key(F.col("url")), r"[\x00-\x20]", "")).withColumn("time", when)
    line = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value.cast("string"))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    body = F.when(F.col("revisit"), F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), "payload"))
    record = F.concat(
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.coalesce(line("WARC-Record-ID", name(F.col("page_id"))), F.lit("")),
        line("WARC-Date", F.col("time")),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20]", "")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(F.col("revisit"), F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("first"))))).otherwise(""),
        line("X-Payload-Length", F.col("bytes")),
        line("X-URL-Key", F.col("key")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(body)),
        F.lit(END),
        body,
    )
    above = [-1, *(most for most, _ in SIZES[:-1])]
    inside = [(F.col("bytes") > low) & (F.col("bytes") <= most) for low, (most, _) in zip(above, SIZES)]
    there = pages.select(F.octet_length(F.coalesce(F.col(payload_col).cast("string"), F.lit(""))).alias("bytes")).agg(*map(F.count_if, inside)).first()
    for k, (own, (_, most), n) in enumerate(zip(inside, SIZES, there)):
        if n or not k:
            ordered = rows.where(own).sortWithinPartitions("key", "time", "page_id").select(record.alias("value"))
            ordered.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", most).text(f"{path}/size-{k}")


INDEX = "run string, place long, url_key string, capture_time string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, offset long, length long"


def parse(stream: BinaryIO) -> Iterator[tuple]:
    """``(url_key, time, page_id, type, payload bytes, digest, refers to, offset, length)`` of each record; a response whose digest does not fit is an error.

    One record at a time is in memory.
    """
    at, end = 0, END.encode()
    number = lambda v: int(v.rsplit(":", 1)[1].rstrip(">")) if v else None
    while first := stream.readline():
        size, head = len(first), {}
        while (line := stream.readline()) != b"\r\n":
            if not line:
                raise ValueError(f"the record at {at} is cut off")
            size += len(line)
            name, _, value = line[:-2].decode().partition(":")
            head[name] = value.strip(" ")
        body = stream.read(int(head["Content-Length"]))
        size += 2 + len(body) + len(stream.read(len(end)))
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response":
            payload = memoryview(body)[body.index(end) + len(end) :]
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != int(head["X-Payload-Length"]):
                raise ValueError(f"the payload at {at} does not fit its digest")
        yield head["X-URL-Key"], head["WARC-Date"], number(head.get("WARC-Record-ID")), head["WARC-Type"], int(head["X-Payload-Length"]), digest, number(head.get("WARC-Refers-To")), at, size
        at += size


def read_record(content: bytes, offset: int, length: int) -> bytes:
    """One record of an archive's content, by its place in the index."""
    with gzip.open(io.BytesIO(content)) as stream:
        stream.seek(offset)
        return stream.read(length)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives, each archive a run in its own order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, number = pa.string(), pa.int64()
        kinds = [text, text, number, text, number, text, number, number, number]
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                with gzip.open(pa.BufferReader(content.as_buffer())) as stream:
                    entries = list(parse(stream))
                columns = list(zip(*entries)) or [()] * 9
                own = name.as_py().rsplit("/", 1)[-1]
                yield pa.RecordBatch.from_arrays([pa.array([own] * len(entries), text), pa.array(range(len(entries)), number), *(pa.array(c, k) for c, k in zip(columns, kinds))], INDEX_NAMES)

    stored = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    return stored.select("path", "content").mapInArrow(run, INDEX)


INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]


class LoserTree:
    """Merges sorted sequences: inner nodes keep the loser of each match, and a new head plays only on its own path."""

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)
        self.k = max(1, len(runs))
        self.losers = [-1] * self.k
        self.winner = -1
        for i in range(len(runs)):
            self._play(i)

    def _head(self, i: int):
        return self.runs[i][self.at[i]] if self.at[i] < len(self.runs[i]) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        return y is None if x is None else y is None or (x, a) < (y, b)

    def _play(self, i: int) -> None:
        node = (i + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = i
                return
            if self._beats(other, i):
                self.losers[node], i = i, other
            node //= 2
        self.winner = i

    def __iter__(self) -> Iterator:
        while self.winner >= 0 and (head := self._head(self.winner)) is not None:
            yield head
            i = self.winner
            self.at[i] += 1
            self._play(i)


def merge_index(entries: DataFrame, partitions: int | None = None) -> DataFrame:
    """The entries in the order of URL key, time and page, with ``position`` rising over the whole result. Null page ids come first."""
    partitions = partitions or max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-entries.count() // RANGE_ENTRIES))
    order = ["url_key", "capture_time", "page_id"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        ids = [-1 if x is None else x for x in table["page_id"].to_pylist()]
        keys = list(zip(table["url_key"].to_pylist(), table["capture_time"].to_pylist(), ids, range(len(ids))))
        run = table["run"].to_pylist()
        cut = [0, *(i for i in range(1, len(run)) if run[i] != run[i - 1]), len(run)]
        merged = table.take(pa.array([k[3] for k in LoserTree([keys[a:b] for a, b in zip(cut[:-1], cut[1:])])], pa.int64()))
        first = TaskContext.get().partitionId() << 40
        yield from merged.append_column("position", pa.array(np.arange(first, first + len(ids)))).to_batches()

    dealt = entries.repartitionByRange(partitions, *order).sortWithinPartitions("run", "place")
    return dealt.mapInArrow(merge, INDEX + ", position long")


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages as WARC records, read the archives back and return their merged index.

    One row per page: ``page_id, payload_bytes, payload_digest, record_type, refers_to, url_key,
    capture_time, run, offset, length, position``. A null payload is empty. A page without an id is never referred to; rows
    that repeat the smallest id of a payload are all responses. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    spark = pages.sparkSession
    path = work_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    found = merge_index(materialise(read_archives(spark, path), "captures"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "capture_time", "run", "offset", "length", "position")
