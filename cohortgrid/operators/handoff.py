"""Merged shortlists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .matrix import first_wins


def shortlist(df: DataFrame, label: str, id_col: str, rank_col: str, desc: bool = True, cap: int = 200) -> DataFrame:
    """``(source, feature, key, source_rank)``: the first ``cap`` features by absolute key, or by the key itself where small is good."""
    key = F.abs(F.col(rank_col)) if desc else F.col(rank_col)
    x = df.select(F.col(id_col).alias("feature"), key.alias("key")).where(F.col("feature").isNotNull() & F.col("key").isNotNull() & ~F.isnan("key"))
    order = [F.col("key").desc() if desc else F.col("key").asc(), F.col("feature")]
    top = first_wins(x, ["feature"], order[0]).orderBy(*order).limit(cap)
    return top.select(F.lit(label).alias("source"), "feature", "key", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)).alias("source_rank"))


def merge_shortlists(sources: list[DataFrame], test: DataFrame) -> DataFrame:
    """One row per feature: the row of the first source that names it, ``n_sources``, and its change from the test table."""
    x = None
    for i, s in enumerate(sources):
        s = s.withColumn("priority", F.lit(i))
        x = s if x is None else x.unionByName(s)
    n = x.groupBy("feature").agg(F.count_distinct("source").alias("n_sources"))
    best = first_wins(x, ["feature"], "priority", "source_rank").join(n, "feature").join(test.select("feature", "lfc"), "feature", "left")
    return best.select("feature", "source", "source_rank", "n_sources", "lfc").orderBy(F.col("n_sources").desc(), "source_rank", "feature")
