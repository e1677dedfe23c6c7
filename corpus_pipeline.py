"""A corpus pipeline: the stages in order, each a function of (spark, docs, sf_dir).

Each stage keeps every column it is given, whatever its name. Documents without a recognisable language go, boilerplate lines are cut, one document
of each group of near-duplicates stays, documents with benchmark passages go, and what
is left is packed into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgrid.llm.decontaminate import build_index, search
from cohortgrid.llm.language_id import document_evidence, fit, identify
from cohortgrid.llm.line_dedup import remove_boilerplate
from cohortgrid.llm.minhash_dedup import near_duplicates
from cohortgrid.llm.packing import pack
from cohortgrid.session import materialise


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """Rows as one struct ``doc`` with a hash ``key`` of ``columns``, so that no column of theirs meets a name used here."""
    return docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("doc"), F.xxhash64(*columns).alias("key"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go: null and letterless texts, and text in none of the labelled languages.

    Ids may be null or repeated: rows equal in id, language, source and text stay or go together. An empty table stays empty.
    """
    rejected = identify(document_evidence(docs), fit(docs)).where("not accepted").select("key").distinct()
    return _keyed(docs, "doc_id", "lang", "source", "text").join(rejected, "key", "left_anti").select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites are cut from the texts, and ``n_chars`` follows.

    All rows stay, repeated ones too; a null text stays null, a text of such lines alone becomes empty. An empty table stays empty.
    """
    return remove_boilerplate(docs, counts=False).withColumn("n_chars", F.length("text").cast("long"))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id.

    Rows are told apart by doc_id and text, so ids may repeat or be null; of full repeats one row stays. Null and
    empty texts have no near-duplicates and stay, as does every row of a repeated id that no other text is near to. An empty table stays empty.
    """
    keyed = _keyed(docs, "doc_id", "text")
    found = materialise(near_duplicates(keyed.select("key", "doc.text"), id_col="key").where("n_shingles > 0").select(F.col("doc_id").alias("key"), "component_id"), "groups")
    named = found.join(keyed.select("key", "doc.doc_id").distinct(), "key")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"].alias("first"))
    rows = found.groupBy("key", "component_id").agg(F.count("*").alias("n")).join(first, "component_id")
    # Rows that don't simply stay: those of the other keys, and the kept key's own where they repeat.
    touched = materialise(rows.where("key <> first or n > 1").select("key", (F.col("key") == F.col("first")).alias("again")), "touched")
    repeats = keyed.join(touched.where("again").select("key"), "key", "left_semi")
    one = repeats.groupBy("key").agg(F.min("doc").alias("doc")).select("doc.*")
    return keyed.join(touched, "key", "left_anti").select("doc.*").unionByName(one)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go.

    Null and wordless texts have none and stay; rows equal in id and text stay or go together. An empty benchmark or table changes nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = search(build_index(docs), benchmark).where("contaminated").select("doc_key").distinct()
    return _keyed(docs, "doc_id", "text").join(gone.withColumnRenamed("doc_key", "key"), "key", "left_anti").select("doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents with their token ids, by sequence.

    Each row is a document of its own, also where ids are null or repeated; a null or empty text packs its end id. An empty table gives no pieces.
    """
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Language scores, near-duplicate components and tokens have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
