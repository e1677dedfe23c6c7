"""Readers of text dumps and tables; every path may be a folder of many files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise


def read_tagged_records(spark: SparkSession, path: str, record_tag: str) -> DataFrame:
    """``(record_id, key, value, pos)`` of text dumps in which a line ``^TAG = id`` opens a record and ``!key = value`` lines follow.

    Records are cut by the tag itself, so files are read in splits; a record has to fit a row.
    """
    lines = spark.read.option("lineSep", f"^{record_tag} = ").text(path)
    return split_tagged(lines.where(~F.trim("value").startswith("!") & ~F.trim("value").startswith("^") & (F.trim("value") != "")).select("value"))


def split_tagged(records: DataFrame) -> DataFrame:
    """``(record_id, key, value, pos)`` of one record per row: its id on the first line, then ``!key = value`` lines."""
    parts = records.select(F.split("value", r"\r?\n").alias("lines"))
    rows = parts.select(F.trim(F.get("lines", 0)).alias("record_id"), F.posexplode("lines").alias("pos", "line")).where("pos > 0")
    key, value = F.regexp_extract("line", r"^!([^=]*?)\s*=", 1), F.regexp_extract("line", r"^![^=]*=\s*(.*)$", 1)
    return rows.where(F.col("line").rlike(r"^![^=]+=")).select("record_id", key.alias("key"), F.trim(value).alias("value"), F.col("pos").cast("long").alias("pos"))


def numbered_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Lines ``(file, split, id, value)`` of text files, and ``(file, split, first, base)`` of their splits: line ``id`` is number ``base + id - first`` of its file, from 0.

    Files are read in splits, whose lines have consecutive ids. The lines are written once, since ids hang on the reading. Only one row
    for each split takes part in the numbering.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")
    lines = materialise(lines.withColumn("id", F.monotonically_increasing_id()), "lines")
    splits = lines.groupBy("file", "split").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return lines, materialise(splits.select("file", "split", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "splits")


def read_block_table(spark: SparkSession, path: str, begin: str, end: str, sep: str = "\t") -> DataFrame:
    """``(file, row, fields)`` of the delimited block between two marker lines: a map from header to trimmed text.

    A block reaches from the first line of a file that begins with the pattern ``begin`` to the next that begins with ``end``; files without
    both have no rows. Its first line is the header, and ``row`` counts the lines from there on. Blank lines are no rows. Short rows are padded with nulls
    and surplus fields dropped. Files may be of any size and many splits: a block is an interval of line numbers, which each
    split is told, so that lines meet it by split and not by file.
    """
    lines, splits = numbered_lines(spark, path)
    number = F.col("base") + F.col("id") - F.col("first")
    marks = lines.where(F.col("value").rlike(f"^(?:{begin}|{end})")).join(splits, ["file", "split"])
    marks = materialise(marks.select("file", "split", number.alias("line"), F.col("value").rlike(f"^{begin}").alias("opens"), F.col("value").rlike(f"^{end}").alias("closes")), "marks")
    opened = marks.where("opens").groupBy("file").agg(F.min("line").alias("begin"))
    # The first closing line after the opening one: within a split first, then over the splits of a file.
    spread = splits.select("file", "split").join(opened, "file")
    closed = marks.where("closes").join(spread, ["file", "split"]).where("line > begin").groupBy("file", "split", "begin").agg(F.min("line").alias("end"))
    blocks = closed.groupBy("file", "begin").agg(F.min("end").alias("end"))
    parts = splits.join(blocks, "file")
    # Headers are found once for each file, and told to its splits.
    heads = lines.join(parts, ["file", "split"]).where((number == F.col("begin") + 1) & (number < F.col("end"))).select("file", F.split("value", sep).alias("head"))
    parts = materialise(parts.join(heads, "file"), "blocks")
    rows = lines.where(F.col("value") != "").join(parts, ["file", "split"]).where((number > F.col("begin") + 1) & (number < F.col("end")))
    cells = F.split("value", sep, -1)
    fields = F.map_from_arrays(F.transform("head", lambda h: F.trim(h)), F.transform("head", lambda h, i: F.trim(F.get(cells, i))))
    return rows.select("file", (number - F.col("begin") - 1).cast("int").alias("row"), fields.alias("fields"))


def wide_to_long(wide: DataFrame, id_col: str) -> DataFrame:
    """``(feature, sample, value)`` of a table with one column per sample; blanks and text that is no number are null."""
    others = [c for c in wide.columns if c != id_col]
    text = wide.select(F.col(id_col).cast("string").alias("feature"), *(F.col(c).cast("string").alias(c) for c in others))
    return text.unpivot("feature", others, "sample", "value").withColumn("value", F.expr("try_cast(value AS double)"))


def read_wide_matrix(spark: SparkSession, path: str, id_col: str, sep: str = "\t") -> DataFrame:
    return wide_to_long(spark.read.option("sep", sep).option("header", True).csv(path), id_col)


def read_edges(spark: SparkSession, path: str, min_score: int = 400) -> DataFrame:
    """``(a, b, score)`` of a space-separated, possibly gzipped edge list with a header, from ``min_score`` on."""
    rows = spark.read.option("sep", " ").option("header", True).schema("a string, b string, score int").csv(path)
    return rows.where(F.col("score") >= min_score)


def write_edges(edges: DataFrame, path: str, least: int = 400, group_bytes: int = 32 << 20) -> None:
    """A Parquet copy of the edges from score ``least`` on, sorted by score, so that files and row groups below an asked score are skipped.

    Ranges of score hold about equal numbers of rows, ties being spread by their ends. ``least`` is kept with the column.
    """
    kept = edges.where(F.col("score") >= least).withColumn("score", F.col("score").alias("score", metadata={"least": least}))
    kept.repartitionByRange("score", "a", "b").sortWithinPartitions("score", "a", "b").write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)


def stored_edges(spark: SparkSession, source: str, copy: str, min_score: int = 400, least: int = 400) -> DataFrame:
    """``(a, b, score)`` from ``min_score`` on, read from the pre-filtered ``copy`` of the edge list ``source``, which is made where it is missing.

    A score below that the copy starts from is answered by the source. A copy is not renewed when its source changes: remove it for that.
    """
    if min_score < least:
        return read_edges(spark, source, min_score)
    try:
        stored = spark.read.parquet(copy)
    except AnalysisException:  # no copy yet
        write_edges(read_edges(spark, source, least), copy, least)
        stored = spark.read.parquet(copy)
    if min_score < stored.schema["score"].metadata.get("least", least):
        return read_edges(spark, source, min_score)
    return stored.where(F.col("score") >= min_score)


def signed_sets(rows: DataFrame, confidence: Sequence[str] | None = None) -> DataFrame:
    """``(source, target, sign, confidence, coverage)`` of declared confidence levels; all where none are named."""
    kept = rows.where(F.col("confidence").isin(list(confidence))) if confidence else rows
    return kept.select("source", "target", F.signum("mor").cast("int").alias("sign"), "confidence", F.lit("declared").alias("coverage"))


def read_signed_sets(spark: SparkSession, path: str, confidence: Sequence[str] | None = None, fallback: str | None = None) -> DataFrame:
    """Tab-separated relations with ``#`` comments; where there are none, those of ``fallback``, labelled so."""
    read = lambda p: spark.read.option("sep", "\t").option("header", True).option("comment", "#").schema("source string, target string, mor double, confidence string").csv(p)
    found = signed_sets(read(path), confidence)
    if fallback and not found.limit(1).count():
        return signed_sets(read(fallback), confidence).withColumn("coverage", F.lit("fallback"))
    return found


def signed_sets_vocab(rows: DataFrame, sign_map: Mapping[str, int | None]) -> DataFrame:
    """``(source, target, sign, mode)``; a mode outside ``sign_map`` is an error in the row that has it."""
    sign = F.lit(None).cast("int")
    for mode, value in sign_map.items():
        sign = F.when(F.col("mode") == mode, F.lit(value).cast("int")).otherwise(sign)
    known = F.col("mode").isin(list(sign_map))
    checked = F.when(F.coalesce(known, F.lit(False)), F.col("mode")).otherwise(F.raise_error(F.concat(F.lit("unknown mode: "), F.coalesce("mode", F.lit("null")))))
    return rows.select("source", "target", sign.alias("sign"), checked.alias("mode"))


def read_signed_sets_vocab(spark: SparkSession, path: str, sign_map: Mapping[str, int | None]) -> DataFrame:
    """Headerless ``source, target, mode, reference`` rows."""
    return signed_sets_vocab(spark.read.option("sep", "\t").schema("source string, target string, mode string, reference string").csv(path), sign_map)


def write_results(df: DataFrame, path: str, dataset: str, fmt: str = "parquet") -> None:
    """One folder per dataset; a rerun replaces only its own."""
    df.withColumn("dataset", F.lit(dataset)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset").format(fmt).save(path)


def sort_members(df: DataFrame, cols: Sequence[str], sep: str = "/") -> DataFrame:
    """List columns in a stable order, so that reruns compare equal."""
    return df.withColumns({c: F.array_join(F.array_sort(F.split(c, sep)), sep) for c in cols})


def table_fingerprint(df: DataFrame, name: str, keys: Sequence[str] | None = None) -> DataFrame:
    """``(name, n_rows, content_hash)``: an order-insensitive sum over 15 hex digits of each row's MD5."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in (keys or df.columns)]
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.lit(name).alias("name"), F.count("*").alias("n_rows"), F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).cast("string").alias("content_hash"))


def expectations(tables: Mapping[str, DataFrame], rules: Sequence[tuple[str, str, str, bool]]) -> DataFrame:
    """``(name, ok, required)`` of rules ``(name, table, SQL aggregate giving a boolean, required)``; a missing table or column is not ok."""
    out, spark = None, next((t.sparkSession for t in tables.values()), None) or SparkSession.active()
    for name, table, expression, required in rules:
        try:
            one = tables[table].agg(F.coalesce(F.expr(expression), F.lit(False)).alias("ok")) if table in tables else None
        except AnalysisException:  # a column the rule names is missing
            one = None
        if one is None:
            one = spark.range(1).select(F.lit(False).alias("ok"))
        one = one.select(F.lit(name).alias("name"), "ok", F.lit(required).alias("required"))
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], "name string, ok boolean, required boolean") if out is None else out
