"""Boilerplate lines by the number of different sites that have them.

Each task counts a line hash's occurrences and sketches its sites by HyperLogLog; the
counts and sketches of tasks merge, so a very common line reaches the merge as one row per task. Lines whose
estimate is within ``margin`` of the threshold are counted exactly from different (line, site) pairs, so the
result is that of exact counts but for an estimate off by more than the margin, six
standard errors here.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import materialise

LG_K = 12
#: Up to so many line keys (16 bytes each) are sent to all tasks; of more, only the commonest.
MOST_KEYS = 200_000
HOT_SHARE = 1000


def line_key(line: Column) -> Column:
    """128 bits of a line without the spaces around it."""
    return F.struct(F.xxhash64(F.trim(line)).alias("a"), F.xxhash64(F.lit(1), F.trim(line)).alias("b"))


def boilerplate_lines(documents: DataFrame, min_sites: int = 10, margin: float = 0.1, text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``(line, n, sites, exact)``: the keys of lines on at least ``min_sites`` sites, with their occurrences. Rows without a site count for none, blank lines never."""
    lines = documents.select(F.col(site_col).cast("string").alias("site"), F.explode(F.split(F.col(text_col).cast("string"), "\n")).alias("text")).where(F.trim("text") != "")
    keyed = lines.select(line_key(F.col("text")).alias("line"), "site").where("site is not null")
    spread = keyed.groupBy("line").agg(F.count("*").alias("n"), F.hll_sketch_agg("site", LG_K).alias("sketch")).where(F.col("n") >= min_sites)
    spread = materialise(spread.select("line", "n", F.hll_sketch_estimate("sketch").alias("sites")), "spread")
    close = F.abs(F.col("sites") - min_sites) <= F.ceil(F.lit(margin * min_sites))
    # The pairs are made different before they meet the close lines, so that a common line has one row for each site.
    exact = keyed.distinct().join(spread.where(close).select("line", "n"), "line").groupBy("line", "n").agg(F.count("*").alias("sites"))
    clear = spread.where(~close & (F.col("sites") > min_sites)).select("line", "n", "sites", F.lit(False).alias("exact"))
    return clear.unionByName(exact.where(F.col("sites") >= min_sites).select("line", "n", "sites", F.lit(True).alias("exact")))


def _occurrences(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` (``row, place, line``) of which ``known`` has the line.

    Few lines go to all tasks. Of more, those that make up a thousandth of all occurrences each, a thousand at most, do; the others
    are joined by line, none of them common.
    """
    count, total = known.agg(F.count("*"), F.sum("n")).first()
    if count <= MOST_KEYS:
        return found.join(F.broadcast(known.select("line")), "line")
    hot = F.col("n") * HOT_SHARE >= total
    common, others = F.broadcast(known.where(hot).select("line")), known.where(~hot).select("line")
    return found.join(common, "line").unionByName(found.join(common, "line", "left_anti").join(others, "line"))


@F.pandas_udf(StringType())
def _without(texts: pd.Series, places: pd.Series) -> pd.Series:
    """The texts without the lines at ``places``; array functions would read all lines again for each that goes."""
    out = []
    for text, gone in zip(texts, places):
        if text is None or gone is None:
            out.append(None)
            continue
        keep = np.ones(text.count("\n") + 1, bool)
        keep[gone] = False
        out.append("\n".join(compress(text.split("\n"), keep)))
    return pd.Series(out, dtype=object)


def remove_boilerplate(documents: DataFrame, min_sites: int = 10, margin: float = 0.1, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", counts: bool = True) -> DataFrame:
    """All columns of ``documents`` with boilerplate lines cut from the text, and with ``counts`` the columns ``lines_before`` and ``lines_removed`` after them.

    Lines end at newlines; blank lines stay. Each occurrence goes, on every site, also from rows
    without a site. A null text stays null and has no lines. Ids may be null or repeated, and equal rows all stay;
    an empty table gives no rows. Other columns stay as they are, whatever their names. The work on a document is linear in its lines.
    """
    known = materialise(boilerplate_lines(documents, min_sites, margin, text_col, site_col), "boilerplate").select("line", "n")
    text = F.col(text_col).cast("string")
    names = [f"`{c}`" for c in documents.columns]
    # The row travels as one struct, so that no name of its own meets the operator's.
    keyed = documents.select(F.struct(*names).alias("doc"), text.alias("text"), F.struct(F.xxhash64(id_col, text).alias("a"), F.xxhash64(F.lit(1), id_col, text).alias("b")).alias("row"))
    found = keyed.select("row", F.posexplode(F.split("text", "\n")).alias("place", "line")).where(F.trim("line") != "").select("row", "place", line_key(F.col("line")).alias("line"))
    marked = _occurrences(found, known).groupBy("row").agg(F.sort_array(F.collect_set("place")).alias("bad"))
    out = keyed.join(marked, "row", "left")
    out = out.withColumn("clean", F.coalesce(_without(F.when(F.col("bad").isNotNull(), F.col("text")), F.col("bad")), F.col("text")))
    columns = [F.col("clean").alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in documents.columns]
    before, removed = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long"), F.coalesce(F.size("bad"), F.lit(0)).cast("long")
    return out.select(*columns, *([before.alias("lines_before"), removed.alias("lines_removed")] if counts else []))
