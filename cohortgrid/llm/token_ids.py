"""Token ids as ORC files.

Documents are dealt by ranges of doc_id and sorted, encoded, and written as ORC, one file
for each range: integers in run-length encoding, row indexes, and Bloom filters on
``doc_id``. Readers take stripes in parallel and skip those whose statistics or filters
rule a document out (``lookup``). Each row has its place inside its file; the places of
the files follow from one sum per file, so no window runs over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_path
from .arrow import lists, slices
from .encoding import crc, encoded, vocabulary, with_end

SCHEMA = "part int, row long, doc_id long, local_start long, n_tokens int, ids array<int>"
ORC = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20), "orc.compress": "zstd"}


def write_token_ids(documents: DataFrame, path: str, tokenizer: str, end_id: int = 2, partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write the ids in ascending doc_id order.

    A null text is empty and has the end id alone. Null ids come first; rows with equal
    ids follow each other in the order of their texts' hashes, so a repeated id is cut into ranges too. Rows equal in id and
    text stay in one range, each written; their pre-tokens are encoded once. An empty table
    writes no rows. Other columns are ignored, whatever their names.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, row = TaskContext.get().partitionId(), 0, 0
        for batch, found in encoded(slices(batches, "text"), 1, tokenizer):
            found = [with_end(x, end_id) for x in found]
            size = np.array([len(x) for x in found], np.int64)
            place = at + np.cumsum(size) - size
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n)), batch.column(0), pa.array(place), pa.array(size.astype(np.int32)), lists([x.view(np.int32) for x in found], pa.int32())],
                ["part", "row", "doc_id", "local_start", "n_tokens", "ids"],
            )
            at, row = at + int(size.sum()), row + n

    spark = documents.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(partitions, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    ordered.mapInArrow(write, SCHEMA).write.options(**ORC).orc(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` as written, ``start`` counting the ids of all documents before."""
    rows = spark.read.schema(SCHEMA).orc(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # One row for each file written, so the size is bounded by the number of partitions.
    return rows.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def lookup(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """One document's ids; files, stripes and row groups are skipped by statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id") == doc_id).select("doc_id", "n_tokens", "ids")


def token_digests(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of rows with ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            flat, at = ids.flatten().to_numpy(), np.cumsum([0, *ids.value_lengths().to_pylist()])
            sums = [crc(flat[a:b].view(np.uint32)) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(documents: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write all documents' ids and return ``doc_id, start, n_tokens, ids_crc32`` from the files read back."""
    spark = documents.sparkSession
    path = work_path(spark, "token-ids")
    write_token_ids(documents, path, tokenizer or vocabulary("byte_bpe_50k.json"), end_id)
    return token_digests(read_token_ids(spark, path))
