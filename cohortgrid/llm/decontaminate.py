"""Benchmark decontamination over a positional inverted index.

``build_index`` cuts the documents into segments of a few MB of text. For each segment
it stores every term once, with the positions of its tokens as gaps in variable-length
integers, and a table of the segment's documents; a document never spans segments, so
no shuffle is needed. ``search`` fetches the lists of the test terms, and within a
segment intersects the lists of a window from the rarest term on, each shifted by the
term's offset. With ``slop`` the terms may also lie up to so many words further apart,
in order (proximity). Test items are taken in blocks of bounded size, one after the other, so that neither
what is broadcast nor what the driver holds grows with the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, work_path
from .arrow import slices
from .words import ALNUM, LOWER, Words

SEGMENT_BYTES = 1 << 21
BLOCK_BYTES = 1 << 22


def encode_gaps(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length integers of 7 bits a byte, the last byte of each under 128, and each one's length."""
    size = np.ones(len(gaps), np.int64)
    for bits in (7, 14, 21, 28):
        size += gaps >= 1 << bits
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]) if len(end) else 0, np.uint8)
    for place in range(5):
        has = size > place
        value = (gaps[has] >> (7 * place)) & 127
        out[end[has] - 1 - place] = value | (128 if place else 0)
    return out, size


def decode_gaps(data: bytes) -> np.ndarray:
    """The numbers behind ``encode_gaps``, summed up to positions."""
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    first = np.concatenate(([0], last[:-1] + 1))
    place = np.repeat(last, last - first + 1) - np.arange(len(raw))
    values = np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), first)
    return np.cumsum(values)


def _segment(w: Words) -> tuple[pa.Array, pa.Array, pa.Array, np.ndarray]:
    """Terms, token counts, posting lists; and the documents' first positions, one free position apart."""
    at = np.arange(len(w.hash)) + w.doc
    order = np.argsort(w.hash, kind="stable")
    sorted_hash, at = w.hash[order], at[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_hash[1:] != sorted_hash[:-1]))) if len(order) else np.zeros(0, int)
    gaps = np.diff(at, prepend=0)
    gaps[first] = at[first]
    data, size = encode_gaps(gaps)
    count = np.diff(np.append(first, len(order)))
    list_end = np.cumsum(np.add.reduceat(size, first)) if len(first) else np.zeros(0, np.int64)
    start, length = w.start[order[first]], (w.end - w.start)[order[first]]
    term_end = np.cumsum(length)
    letters = LOWER[w.data[np.arange(int(length.sum())) + np.repeat(start - (term_end - length), length)]]

    def packed(kind, ends, values):
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])

    return packed(pa.string(), term_end, letters), pa.array(count, pa.int64()), packed(pa.binary(), list_end, data), w.bounds[:-1] + np.arange(w.n_docs)


_INDEX = "part string, segment long, term string, n long, postings binary, doc_id long, doc_key long"


def build_index(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the index of all words of all documents below the shared folder; returns its path.

    ``part=terms`` has ``segment, term, n, postings``; ``part=docs`` has ``segment, doc_id,
    doc_key`` (hash of id and text), ``postings`` (first position) and ``n`` (words).
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", SEGMENT_BYTES):
            w = Words(batch.column(1), ALNUM)
            terms, count, postings, base = _segment(w)
            words = np.diff(w.bounds)
            names = ["part", "segment", "term", "n", "postings", "doc_id", "doc_key"]
            n = len(terms)
            yield pa.RecordBatch.from_arrays([pa.array(["terms"] * n, pa.string()), pa.array(np.full(n, segment)), terms, count, postings, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)
            n = w.n_docs
            first = pa.array([int(b).to_bytes(8, "little") for b in base], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(["docs"] * n, pa.string()), pa.array(np.full(n, segment)), pa.nulls(n, pa.string()), pa.array(words, pa.int64()), first, batch.column(0), batch.column(2)], names)
            segment += 1

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("doc_key", F.xxhash64("doc_id", "text"))
    path = work_path(documents.sparkSession, "index")
    rows.mapInArrow(index, _INDEX).write.partitionBy("part").option("compression", "zstd").parquet(path)
    return path


class Tests:
    """A block of test items: windows of ``width`` consecutive words as rows of term numbers, -1 beyond a short item's end."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        w = Words(pa.array([t for _, t in items], pa.string()), ALNUM)
        self.names = [name for name, _ in items]
        self.vocabulary: dict[str, int] = {}
        ids = np.array([self.vocabulary.setdefault(w.text(i), len(self.vocabulary)) for i in range(len(w.hash))], np.int64)
        rows, owner = [], []
        for item, (a, b) in enumerate(zip(w.bounds[:-1], w.bounds[1:])):
            for s in range(a, max(a + 1, b - width + 1)) if b > a else ():
                row = np.full(width, -1)
                row[: min(width, b - s)] = ids[s : min(b, s + width)]
                rows.append(row)
                owner.append(item)
        self.windows = np.array(rows, np.int64).reshape(-1, width)
        self.owner = np.array(owner, np.int64)
        self.length = (self.windows >= 0).sum(1)


def _matches(tests: Tests, lists: dict[int, np.ndarray | bytes], counts: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first position, last position + 1, item)`` of all occurrences in one segment."""

    def positions(t: int) -> np.ndarray:
        if isinstance(lists[t], bytes):
            lists[t] = decode_gaps(lists[t])
        return lists[t]

    size = np.where(tests.windows >= 0, counts[tests.windows], np.iinfo(np.int64).max)
    starts, ends, items = [], [], []
    for k in np.flatnonzero((size > 0).all(1)):
        terms, length = tests.windows[k], int(tests.length[k])
        if slop:
            s = e = positions(terms[0])
            for t in terms[1:length]:
                p = positions(t)
                after = np.searchsorted(p, e, "right")
                ok = after < len(p)
                s, e = s[ok], p[after[ok]]
                ok = e - s < length + slop
                s, e = s[ok], e[ok]
            e = e + 1
        else:
            order = np.argsort(size[k], kind="stable")[:length]
            s = positions(terms[order[0]]) - order[0]
            for j in order[1:]:
                if not len(s):
                    break
                p = positions(terms[j])
                at = np.minimum(np.searchsorted(p, s + j), len(p) - 1)
                s = s[p[at] == s + j]
            e = s + length
        if len(s):
            starts.append(s)
            ends.append(e)
            items.append(np.full(len(s), tests.owner[k]))
    if not starts:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(items)


def _matcher(shared, slop: int):
    def match(lists: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        tests = shared.value
        base = np.array([int.from_bytes(x, "little") for x in docs.postings], np.int64)
        by = np.argsort(base, kind="stable")
        docs, base = docs.iloc[by], base[by]
        found, counts = {}, np.zeros(len(tests.vocabulary) + 1, np.int64)
        for t, n, p in zip(lists.term, lists.n, lists.postings):
            k = tests.vocabulary[t]
            found[k], counts[k] = bytes(p), n
        s, e, item = _matches(tests, found, counts, slop)
        at = np.searchsorted(base, s, "right") - 1
        inside = at == np.searchsorted(base, e - 1, "right") - 1
        s, e, item, at = s[inside], e[inside], item[inside], at[inside]
        hits, names = [[] for _ in base], [[] for _ in base]
        order = np.lexsort((s, at))
        for i in order:
            own, lo, hi = hits[at[i]], int(s[i] - base[at[i]]), int(e[i] - base[at[i]])
            if own and lo <= own[-1]["e"]:
                own[-1]["e"] = max(own[-1]["e"], hi)
            else:
                own.append({"s": lo, "e": hi})
        for o, i in np.unique(np.stack((at, item), 1), axis=0) if len(at) else ():
            names[o].append(tests.names[i])
        return pd.DataFrame({"segment": docs.segment, "ord": np.arange(len(docs)), "doc_id": docs.doc_id.astype("Int64"), "doc_key": docs.doc_key, "n_words": docs.n, "hits": hits, "items": names})

    return match


_FOUND = "segment long, ord long, doc_id long, doc_key long, n_words long, hits array<struct<s:long,e:long>>, items array<string>"


def search(index: str, tests: DataFrame, width: int = 10, slop: int = 0, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per indexed document: ``doc_id, doc_key, n_words, n_hit, items, contaminated``.

    ``items`` are the ids, as sorted strings, of the test items of which a window of
    ``width`` words occurs; ``n_hit`` counts the document's words inside any occurrence.
    An item of fewer words is one window; null or wordless items never match and null
    or wordless documents have zero words. An item without an id is called ``null``. Documents may repeat, each row
    is judged; an empty index gives no rows and an empty benchmark no hits. Other columns are ignored, whatever their names.
    """
    spark = tests.sparkSession
    stored = lambda part: spark.read.schema(_INDEX).parquet(index).where(F.col("part") == part)
    terms = stored("terms").select("segment", "term", "n", "postings")
    docs = stored("docs").select("segment", "doc_id", "doc_key", "n", "postings")
    items = tests.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_BYTES))
    found = None
    for b in range(n_blocks):
        block = Tests([tuple(r) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == b).collect()], width)
        shared = spark.sparkContext.broadcast(block)
        words = F.broadcast(spark.createDataFrame([(t,) for t in block.vocabulary], "term string"))
        wanted = terms.join(words, "term", "left_semi")
        part = wanted.groupBy("segment").cogroup(docs.groupBy("segment")).applyInPandas(_matcher(shared, slop), _FOUND)
        if n_blocks > 1:
            # The first block's part lists all documents, later ones those with hits.
            part = materialise(part.where("size(hits) > 0") if b else part, "block")
            shared.destroy()
        found = part if found is None else found.unionByName(part)
    if n_blocks > 1:
        found = found.groupBy("segment", "ord", "doc_id", "doc_key", "n_words").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"))
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("end"))
    step = lambda acc, x: F.struct((acc["total"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["end"]))).alias("total"), F.greatest(acc["end"], x["e"]).alias("end"))
    n_hit = F.aggregate(F.array_sort("hits"), zero, step)["total"]
    return found.select("doc_id", "doc_key", "n_words", n_hit.alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items")).withColumn("contaminated", F.col("n_hit") > 0)
