"""Language identification by fusing four kinds of evidence.

The text's likelihood comes from byte trigrams, with counts summed over all labelled rows. The
reliability of a declared markup language is the share with which it meets each language of the
texts. Texts that fit every language worse than the languages' own texts fit each other's models
are of none of them. The prior of a host is smoothed towards its address suffix, and that towards the whole
corpus; the counts behind all of these are grouped sums of the texts' own posteriors, and a row's own share is
taken out before it is judged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .arrow import lists, slices
from .words import LOWER

BUCKETS = 1 << 14
#: Up to so many languages a task counts in one dense table.
DENSE = 256
#: Each character is in three trigrams, which are far from independent.
TEMPER = 1 / 6

_KEEP = np.zeros(256, bool)
_KEEP[97:123] = _KEEP[128:] = True


class Model(NamedTuple):
    """Languages, and log-probabilities ``(language, bucket)`` of trigrams."""

    languages: list[str]
    table: np.ndarray


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each trigram of letters, A-Z in lower case and all else as one space."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    buffer = texts.buffers()[2]
    if buffer is None or offsets[-1] - offsets[0] < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    b = LOWER[np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]]]
    letter = _KEEP[b]
    b = np.where(letter, b, 32).astype(np.uint32)
    code = ((b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))) >> np.uint32(32 - 14)
    ends = offsets[1:] - offsets[0]
    row = np.repeat(np.arange(n), np.diff(offsets))[:-2]
    ok = (np.arange(len(code)) + 3 <= ends[row]) & letter[1:-1]
    return row[ok], code[ok].astype(np.int64)


def fit(rows: DataFrame, languages: Sequence[str] | None = None, text_col: str = "text", label_col: str = "lang", least_rows: int = 1) -> Model:
    """The model of all rows labelled with one of ``languages``; by default those that label ``least_rows`` rows, however small their share.

    Labels are compared in lower case. Null texts and labels count for nothing; a table without labels gives a model of no language,
    by which every text is ``und``. One table reaches the driver: 128 KB a language, however many rows there are.
    """
    labelled = rows.select(F.col(text_col).cast("string").alias("text"), F.lower(F.trim(F.col(label_col).cast("string"))).alias("label")).where("label <> ''")
    if languages is None:
        languages = sorted(r[0] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") >= least_rows).collect())
    names = list(languages) or ["und"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names) * BUCKETS if len(names) <= DENSE else 0, np.int64)
        for batch in slices(batches, "text"):
            label = pc.fill_null(pc.index_in(batch.column(1), pa.array(names)), -1).to_numpy(zero_copy_only=False)
            row, code = trigrams(batch.column(0))
            if len(total):
                total += np.bincount(label[row] * BUCKETS + code, minlength=len(total))
            else:
                at, n = np.unique(label[row] * BUCKETS + code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n, pa.int64())], ["at", "n"])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    sums = labelled.where(F.col("label").isin(names)).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.full(len(names) * BUCKETS, 0.1)
    counts[sums["at"].to_numpy(np.int64)] += sums["n"].to_numpy(float)
    counts = counts.reshape(len(names), BUCKETS)
    return Model(names, np.log(counts / counts.sum(1, keepdims=True)))


def background(model: np.ndarray) -> float:
    """The log-probability per trigram below which a text is of no language of the model.

    That is what text of a fitted language has on average under the best of the other
    models: about what text of an unknown language has. Where only one language has labelled rows,
    it is that of a trigram drawn at random.
    """
    seen = np.exp(model) - np.exp(model.min(1, keepdims=True))
    fitted = np.flatnonzero(seen.sum(1) > 1e-9)
    if len(fitted) < 2:
        return -np.log(model.shape[1])
    p = seen[fitted] / seen[fitted].sum(1, keepdims=True)
    cross = p @ model[fitted].T
    np.fill_diagonal(cross, -np.inf)
    return float(cross.max(1).mean())


def identify(rows: DataFrame, model: Model, smoothing: float = 20.0, min_confidence: float = 0.5) -> DataFrame:
    """Judge rows with the columns ``key, text, declared, suffix, host``; any but ``key`` may be null.

    Returns ``key, language, confidence, text_language, accepted``. A text without letters, or one
    less likely than ``background`` under each language, has no language (``und``) and is not
    accepted, nor is one whose best language has less than ``min_confidence`` of the posterior. Null evidence is left out of the product. Ties go to the language
    first by name. Each row gives one row, also where keys are null or repeated, and an empty table none; repeated rows count
    towards the priors each. Other columns are ignored, whatever their names.
    """
    names = model.languages
    shared, floor = rows.sparkSession.sparkContext.broadcast(model.table), background(model.table) * TEMPER

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in slices(batches, "text"):
            row, code = trigrams(batch.column(1))
            n = batch.num_rows
            ll = np.stack([np.bincount(row, table[k][code], n) for k in range(len(names))], 1) * TEMPER
            size = np.bincount(row, minlength=n)
            known = (size > 0) & (ll.max(1) >= size * floor)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(known), lists(list(ll - ll.max(1, keepdims=True)), pa.float64())], ["key", "declared", "suffix", "host", "known", "ll"])

    rows = rows.select(F.col("key").cast("long").alias("key"), *(F.col(c).cast("string").alias(c) for c in ("text", "declared", "suffix", "host")))
    scored = rows.mapInArrow(score, "key long, declared string, suffix string, host string, known boolean, ll array<double>")
    scored = materialise(scored.withColumn("p", _softmax(F.col("ll"))).withColumn("p", F.when(F.col("known"), F.col("p")).otherwise(F.array(*[F.lit(0.0)] * len(names)))), "evidence")

    def sums(by: str | None, name: str) -> DataFrame:
        vector = F.array(*(F.sum(F.col("p")[k]) for k in range(len(names)))).alias(name)
        return scored.where(F.col(by).isNotNull()).groupBy(by).agg(vector) if by else scored.agg(vector)

    all_p = sums(None, "v").first()[0]
    total = [x or 0.0 for x in all_p]
    whole = sum(total)
    base = F.array(*(F.lit((x + 1.0) / (whole + len(names))) for x in total))
    n_declared = scored.where("declared is not null").select("declared").distinct().count()
    out = scored.join(sums("declared", "n_declared"), "declared", "left").join(sums("suffix", "n_suffix"), "suffix", "left").join(sums("host", "n_host"), "host", "left")

    def shrunk(counts: str, towards: Column) -> Column:
        own = F.zip_with(counts, "p", lambda n, p: F.greatest(n - p, F.lit(0.0)))
        size = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        return F.when(F.col(counts).isNull(), towards).otherwise(F.zip_with(own, towards, lambda n, t: (n + t * smoothing) / (size + smoothing)))

    prior = shrunk("n_host", shrunk("n_suffix", base))
    of_language = F.array(*(F.lit(x) for x in total))
    met = F.zip_with(F.zip_with("n_declared", "p", lambda n, p: F.greatest(n - p, F.lit(0.0)) + 1.0), of_language, lambda n, t: n / (t + 1.0 + n_declared))
    declared = F.when(F.col("n_declared").isNull(), F.transform("p", lambda x: F.lit(1.0))).otherwise(met)
    fused = F.zip_with(F.zip_with("ll", prior, lambda a, b: a + F.ln(b)), declared, lambda a, b: a + F.ln(b))
    out = out.withColumn("fused", _softmax(fused)).withColumn("confidence", F.array_max("fused"))
    labels = F.array(*(F.lit(x) for x in names))
    pick = lambda v: F.element_at(labels, F.array_position(v, F.array_max(v)).cast("int"))
    language = F.when(F.col("known"), pick(F.col("fused"))).otherwise("und")
    return out.select("key", language.alias("language"), F.round("confidence", 6).alias("confidence"), F.when(F.col("known"), pick(F.col("p"))).otherwise("und").alias("text_language"), (F.col("known") & (F.col("confidence") >= min_confidence)).alias("accepted"))


def _softmax(v: Column) -> Column:
    raised = F.transform(v, lambda x: F.exp(x - F.array_max(v)))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def document_evidence(documents: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Evidence rows of a documents table: its declared language, and the source as host."""
    return documents.select(F.xxhash64(id_col, "lang", "source", "text").alias("key"), "text", F.lower("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))


def page_evidence(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Evidence rows of raw pages: ``<html lang>``, the last label of the host, and the host."""
    host = F.lower(F.regexp_extract("url", r"(?s)^.*?://([^/?#:]*)", 1))
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z#0-9]+;", " ")
    declared = F.lower(F.regexp_extract("html", r"(?is)<html[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1))
    empty = lambda c: F.when(c != "", c)
    return pages.select(F.col(id_col).alias("key"), text.alias("text"), empty(declared).alias("declared"), empty(F.element_at(F.split(host, r"\."), -1)).alias("suffix"), empty(host).alias("host"))
