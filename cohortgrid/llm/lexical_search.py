"""Ranked lexical search with interval bounds.

``build_index`` cuts the documents into segments of a few MB of text and stores, for each segment, every
term with the numbers of its documents (as gaps) and their counts, and the documents' ids and lengths. ``search`` takes the
queries in blocks. A task reads its segments one after the other: the posting lists of the
query's terms get a sparse table of the places of their maxima, so that the largest impact
of each term between two documents takes two look-ups. The sum of these maxima bounds every document of an interval.
Intervals are taken best bound first and split at the document of the largest weighted impact, which is
scored; short ones are scored whole. An interval is given up when its bound is below the k-th score that the task
has, in this segment or an earlier one, so the result is exact.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, work_path
from .arrow import slices
from .decontaminate import decode_gaps, encode_gaps
from .words import ALNUM, LOWER, Words

SEGMENT_BYTES = 1 << 21
BLOCK_BYTES = 1 << 21
#: Intervals of up to so many documents are scored whole.
SHORT = 128

_INDEX = "part string, segment long, term string, n long, docs binary, counts binary, ids array<long>, lengths array<long>"


def _packed(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The numbers from each of ``first`` to the next as one run of variable-length integers."""
    data, size = encode_gaps(values)
    ends = np.cumsum(np.add.reduceat(size, first)) if len(first) else np.zeros(0, np.int64)
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _plain(data: bytes) -> np.ndarray:
    """The numbers behind ``encode_gaps`` as they are."""
    return np.diff(decode_gaps(data), prepend=0)


def _postings(w: Words) -> tuple[pa.Array, np.ndarray, pa.Array, pa.Array]:
    """Terms, document counts, and the lists of documents and of counts."""
    order = np.argsort(w.hash, kind="stable")
    term, doc, n = w.hash[order], w.doc[order], len(order)
    new_term = np.concatenate(([True], term[1:] != term[:-1])) if n else np.zeros(0, bool)
    new = new_term | np.concatenate(([True], doc[1:] != doc[:-1])) if n else new_term
    at = np.flatnonzero(new)
    count, docs = np.diff(np.append(at, n)), doc[at]
    first = np.flatnonzero(new_term[at])
    gaps = np.diff(docs, prepend=0)
    gaps[first] = docs[first]
    words = order[at[first]]
    start, length = w.start[words], (w.end - w.start)[words]
    ends = np.cumsum(length)
    letters = LOWER[w.data[np.arange(int(length.sum())) + np.repeat(start - (ends - length), length)]]
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    terms = pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())])
    return terms, np.diff(np.append(first, len(at))), _packed(gaps, first), _packed(count, first)


def build_index(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the index of all terms of all documents below the shared folder; returns its path.

    Null and termless texts are documents of length 0. Ids may be null or repeated: each row is a document of its own. Of an empty table the index is empty. Other columns are ignored.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        names = [x.split()[0] for x in _INDEX.split(", ")]
        for batch in slices(batches, "text", SEGMENT_BYTES):
            w = Words(batch.column(1), ALNUM)
            terms, n, docs, counts = _postings(w)
            m = len(terms)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(["terms"] * m, pa.string()), pa.array(np.full(m, segment)), terms, pa.array(n, pa.int64()), docs, counts, pa.nulls(m, longs), pa.nulls(m, longs)], names)
            none = pa.nulls(1, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(["docs"]), pa.array([segment]), pa.array([""]), pa.array([w.n_docs], pa.int64()), none, none, pa.array([batch.column(0).to_pylist()], longs), pa.array([np.diff(w.bounds)], longs)], names)
            segment += 1

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    path = work_path(documents.sparkSession, "lexical")
    rows.mapInArrow(index, _INDEX).write.partitionBy("part").option("compression", "zstd").parquet(path)
    return path


class Lists:
    """The posting lists of a segment for one block of queries: documents, impacts, and a sparse table of maxima."""

    def __init__(self, terms: np.ndarray, docs: list[np.ndarray], impacts: list[np.ndarray], n_docs: int):
        self.number = {int(t): i for i, t in enumerate(terms)}
        sizes = np.array([len(d) for d in docs], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.n_docs = n_docs
        self.doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        self.impact = np.concatenate(impacts) if docs else np.zeros(0, np.int64)
        #: Sorted by list, then document.
        self.place = self.doc + np.repeat(np.arange(len(docs)), sizes) * n_docs
        # Row j holds the place of the largest of the 2**j impacts from each place on, the first of equal ones.
        self.table = [np.arange(len(self.doc), dtype=np.int32)]
        span = 1
        while 2 * span <= (sizes.max() if len(sizes) else 0):
            a, b = self.table[-1][:-span], self.table[-1][span:]
            self.table.append(np.where(self.impact[b] > self.impact[a], b, a))
            span *= 2

    def between(self, lists: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The parts of the lists with documents from ``lo`` up to but not including ``hi``."""
        base = lists * self.n_docs
        return np.searchsorted(self.place, base + lo), np.searchsorted(self.place, base + hi)

    def largest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the largest impact of each of the parts, none of which is empty."""
        level = np.frexp(b - a)[1] - 1
        x = np.empty(len(a), np.int64)
        y = np.empty(len(a), np.int64)
        for j in np.unique(level):
            own = level == j
            x[own], y[own] = self.table[j][a[own]], self.table[j][b[own] - (1 << int(j))]
        return np.where(self.impact[y] > self.impact[x], y, x)


def _best_first(lists: Lists, own: np.ndarray, weight: np.ndarray, ids: list, best: list, k: int) -> None:
    """Bring the best ``k`` of a query, a heap of (score, order of id, id), up to date with a segment's documents."""

    def offer(score: int, doc: int) -> None:
        # Of equal scores the smaller id is the better; a null id is the last.
        entry = (score, -math.inf if ids[doc] is None else -ids[doc])
        if len(best) < k:
            heapq.heappush(best, entry)
        elif entry > best[0]:
            heapq.heapreplace(best, entry)

    def bounded(lo: int, hi: int) -> None:
        a, b = lists.between(own, lo, hi)
        held = b > a
        if not held.any():
            return
        places = lists.largest(a[held], b[held])
        worth = weight[held] * lists.impact[places]
        bound = int(worth.sum())
        if bound > 0 and (len(best) < k or bound >= best[0][0]):
            heapq.heappush(waiting, (-bound, lo, hi, int(lists.doc[places[worth.argmax()]])))

    waiting: list[tuple[int, int, int, int]] = []
    bounded(0, lists.n_docs)
    while waiting:
        bound, lo, hi, middle = heapq.heappop(waiting)
        if len(best) == k and -bound < best[0][0]:
            return
        if hi - lo <= SHORT:
            a, b = lists.between(own, lo, hi)
            size = b - a
            places = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
            # Sums stay far below 2**53, so that adding them as doubles is exact.
            scores = np.bincount(lists.doc[places] - lo, np.repeat(weight, size) * lists.impact[places], hi - lo)
            least = max(1, best[0][0]) if len(best) == k else 1
            for d in np.flatnonzero(scores >= least):
                offer(int(scores[d]), lo + int(d))
            continue
        a, b = lists.between(own, middle, middle + 1)
        has = b > a
        offer(int((weight[has] * lists.impact[a[has]]).sum()), middle)
        bounded(lo, middle)
        bounded(middle + 1, hi)


def _searcher(shared, k: int):
    """Best documents of each query among a partition's segments, whose rows come together, the documents first."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, queries, n_texts, n_words = shared.value
        best: list[list] = [[] for _ in queries]

        def one(ids: list, lengths: np.ndarray, rows: list[tuple[str, bytes, bytes]]) -> None:
            less = 8 * (25 + (75 * lengths * n_texts) // max(1, n_words))
            terms, docs, impacts = [], [], []
            for term, d, c in rows:
                d, c = decode_gaps(d), _plain(c)
                terms.append(vocabulary[term])
                docs.append(d)
                impacts.append((1_000_000_000 * c) // (1000 * c + less[d]))
            lists = Lists(np.array(terms, np.int64), docs, impacts, len(ids))
            for query, heap in zip(queries, best):
                own = [(lists.number[t], w) for t, w in query if t in lists.number]
                if own:
                    _best_first(lists, *(np.array(x, np.int64) for x in zip(*own)), ids, heap, k)

        ids = lengths = None
        rows: list[tuple] = []
        for batch in batches:
            for term, d, c, i, n in zip(*(batch.column(x).to_pylist() for x in ("term", "docs", "counts", "ids", "lengths"))):
                if i is not None:
                    if rows:
                        one(ids, lengths, rows)
                    ids, lengths, rows = i, np.array(n, np.int64), []
                elif term in vocabulary:
                    rows.append((term, d, c))
        if rows:
            one(ids, lengths, rows)
        out = [(q, None if o == -math.inf else -o, s) for q, heap in enumerate(best) for s, o in heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["query", "doc_id", "score"])

    return search


def search(index: str, queries: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of the highest score above 0 for each query, equal scores by doc_id.

    A term of df documents weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))``; the score sums weight times
    ``10^9 tf div (1000 tf + 8 m)`` over the query's terms with repeats, m being ``25 + (75 n N) div L``. Queries equal in id and text are one;
    null and termless ones, an empty index and an empty query table give no rows. Null doc_ids come last among equals. Other columns are ignored.
    """
    spark = queries.sparkSession
    stored = lambda part: spark.read.schema(_INDEX).parquet(index).where(F.col("part") == part)
    terms, docs = stored("terms"), stored("docs")
    lengths = docs.select(F.explode("lengths").alias("n"))
    n_texts, n_words = lengths.agg(F.sum((F.col("n") > 0).cast("long")), F.sum("n")).first()
    n_texts, n_words = n_texts or 0, n_words or 0
    items = queries.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_BYTES))
    found = None
    for block in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()
        w = Words(pa.array([r.text for r in rows], pa.string()), ALNUM)
        counts = [Counter(w.text(i) for i in range(a, b)) for a, b in zip(w.bounds[:-1], w.bounds[1:])]
        vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for c in counts for t in c))}
        asked = F.broadcast(spark.createDataFrame([(t,) for t in vocabulary], "term string"))
        wanted = terms.join(asked, "term", "left_semi")
        frequency = dict(wanted.groupBy("term").agg(F.sum("n")).collect())
        weight = {t: math.floor(1000 * math.log((2 * n_texts + 2) / (2 * n + 1))) for t, n in frequency.items()}
        plans = [[(vocabulary[t], n * weight[t]) for t, n in c.items() if weight.get(t, 0) > 0] for c in counts]
        useful = {t: vocabulary[t] for t, x in weight.items() if x > 0}
        shared = spark.sparkContext.broadcast((useful, plans, n_texts, n_words))
        rows_of = lambda df: df.select("segment", "term", "docs", "counts", "ids", "lengths")
        dealt = rows_of(wanted).unionByName(rows_of(docs)).repartition("segment").sortWithinPartitions("segment", F.col("ids").isNull())
        part = dealt.mapInArrow(_searcher(shared, k), "query long, doc_id long, score long")
        place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        part = part.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"query long, item_id {queries.schema[id_col].dataType.simpleString()}")
        part = part.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
        if n_blocks > 1:
            part = materialise(part, "block")
            shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found
