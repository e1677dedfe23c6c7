"""Quality control: summaries, principal components and correlation structure."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import average_rank
from ..session import materialise
from .graph import components
from .matrix import present, top_variance
from .pairs import all_pairs, close_pairs, every_cell, least, narrow, sums, visit_pairs, whole_sums
from .subspace import large_pca


def box_summary(measurements: DataFrame, by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Quartiles and whiskers (the last values within 1.5 quartile ranges) of each sample."""
    q = present(measurements).groupBy(*by).agg(F.percentile("value", F.array(*(F.lit(x) for x in (0.25, 0.5, 0.75)))).alias("q"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = q.select(*by, "min", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "max")
    spread = (F.col("q3") - F.col("q1")) * 1.5
    inside = present(measurements).join(q, list(by)).where((F.col("value") >= F.col("q1") - spread) & (F.col("value") <= F.col("q3") + spread))
    return inside.groupBy(*by, "min", "q1", "median", "q3", "max").agg(F.min("value").alias("whisker_low"), F.max("value").alias("whisker_high"))


def density_bins(measurements: DataFrame, bins: int = 32) -> DataFrame:
    """``(sample, bin, n, share)`` over ``bins`` equal steps between the table's least and largest value."""
    ends = present(measurements).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    x = present(measurements).join(F.broadcast(ends), F.lit(True))
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))).otherwise(0)
    n = x.groupBy("sample", at.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("sample")))


#: Features up to which the covariance matrix is made.
MOST_COLUMNS = 2000


def pca(measurements: DataFrame, k: int = 3, top_n: int = 2000) -> DataFrame:
    """``(sample, component, score, share)``: centred, unscaled components of samples over the ``top_n`` features of most variance, all where it is not positive.

    Up to ``MOST_COLUMNS`` features become columns with a covariance matrix; of more, no matrix is made (:func:`.subspace.large_pca`), so that features and
    samples may be any number. Features with gaps are left out. The sign is such that the largest loading is positive. Fewer
    features than ``k`` give as many components; an empty table, or one whose features all have gaps, gives no rows.
    """
    cells = materialise(present(top_variance(measurements, top_n)).select("sample", "feature", F.col("value").cast("double").alias("value")), "cells")
    n = cells.select("sample").distinct().count()
    full = cells.groupBy("feature").agg(F.count("*").alias("c"), F.avg("value").alias("mean")).where(F.col("c") == n)
    centred = cells.join(full, "feature").select("sample", "feature", (F.col("value") - F.col("mean")).alias("value"))
    width = full.count()
    if not width or width > MOST_COLUMNS:
        return large_pca(materialise(centred, "centred"), k)
    wide = centred.groupBy("sample").agg(F.transform(F.array_sort(F.collect_list(F.struct("feature", "value"))), lambda x: x["value"]).alias("v")).withColumn("features", array_to_vector("v"))
    model = PCA(k=min(k, width), inputCol="features", outputCol="scores").fit(wide)
    loadings, share = model.pc.toArray(), model.explainedVariance.toArray()
    sign = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(loadings.shape[1])]
    out = model.transform(wide).select("sample", vector_to_array("scores").alias("s"))
    rows = F.array(*(F.struct(F.lit(j + 1).alias("component"), (F.col("s")[j] * sign[j]).alias("score"), F.lit(float(share[j])).alias("share")) for j in range(len(sign))))
    return out.select("sample", F.inline(rows))


def normal_ellipse(points: DataFrame, chi2: float = 5.991464547107979, n: int = 120) -> DataFrame:
    """``(arm, step, x, y)`` on the 95 % ellipse of ``(arm, x, y)``; none for fewer than 3 points or a flat cloud."""
    m = points.groupBy("arm").agg(F.count("*").alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.var_samp("x").alias("a"), F.var_samp("y").alias("c"), F.covar_samp("x", "y").alias("b"))
    m = m.where((F.col("n") >= 3) & (F.col("a") * F.col("c") - F.col("b") * F.col("b") > 0))
    half, gap = (F.col("a") + F.col("c")) / 2, F.sqrt(F.pow((F.col("a") - F.col("c")) / 2, 2) + F.pow("b", 2))
    m = m.withColumns({"r1": F.sqrt((half + gap) * chi2), "r2": F.sqrt((half - gap) * chi2), "turn": F.atan2(2 * F.col("b"), F.col("a") - F.col("c")) / 2})
    m = m.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("t", F.col("step") * (2 * math.pi / n))
    u, v = F.col("r1") * F.cos("t"), F.col("r2") * F.sin("t")
    return m.select("arm", "step", (F.col("mx") + u * F.cos("turn") - v * F.sin("turn")).alias("x"), (F.col("my") + u * F.sin("turn") + v * F.cos("turn")).alias("y"))


#: Items and cells of one block of a pair product.
BLOCK_ITEMS, BLOCK_CELLS = 256, 4096
SUMS = ("a", "b", "n", "sa", "sb", "saa", "sbb", "sab")


def _pair_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts and sums over the cells that each pair of items of two blocks has in common, as matrix products."""
    own = pdf.i.iat[0] == pdf.j.iat[0]
    left, right = (pdf, pdf) if own else (pdf[pdf.side == 0], pdf[pdf.side == 1])
    if left.empty or right.empty:
        return pd.DataFrame({c: pd.Series([], dtype=object if c in "ab" else float) for c in SUMS})
    names, at = np.unique(np.concatenate([*left.h, *right.h]), return_inverse=True)
    cut = int(left.h.map(len).sum())

    def dense(rows: pd.DataFrame, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values, has = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names)))
        owner = np.repeat(np.arange(len(rows)), rows.h.map(len).to_numpy())
        if len(owner):
            values[owner, at], has[owner, at] = np.concatenate(list(rows.v)), 1.0
        return values, has

    (x, mx), (y, my) = dense(left, at[:cut]), dense(right, at[cut:])
    sums = {"n": mx @ my.T, "sa": x @ my.T, "sb": mx @ y.T, "saa": (x * x) @ my.T, "sbb": mx @ (y * y).T, "sab": x @ y.T}
    a, b = left.item.to_numpy()[:, None], right.item.to_numpy()[None, :]
    parts = []
    # Each pair is named with the smaller item first, whichever block that is in.
    p, q = np.nonzero((a < b) & (sums["n"] > 0))
    parts.append((a[p, 0], b[0, q], *(sums[c][p, q] for c in ("n", "sa", "sb", "saa", "sbb", "sab"))))
    if not own:
        p, q = np.nonzero((a > b) & (sums["n"] > 0))
        parts.append((b[0, q], a[p, 0], *(sums[c][p, q] for c in ("n", "sb", "sa", "sbb", "saa", "sab"))))
    found = pd.DataFrame(dict(zip(SUMS, map(np.concatenate, zip(*parts)))))
    return found.astype({"a": object, "b": object, "n": "int64"})


def pair_sums(cells: DataFrame) -> DataFrame:
    """``(a, b, n, sa, sb, saa, sbb, sab)`` of every two items ``a < b`` of ``(item, h, value)`` that have a cell ``h`` in common, summed over those.

    Items go in blocks, and each pair of blocks is a matrix product over a bounded slice of the cells, so no row is made
    for a pair and a shared cell.
    """
    size = cells.agg(F.approx_count_distinct("item"), F.approx_count_distinct("h")).first()
    blocks, slices = max(1, -(-size[0] // BLOCK_ITEMS)), max(1, -(-size[1] // BLOCK_CELLS))
    rows = cells.withColumn("slice", F.pmod("h", F.lit(slices)).cast("int")).groupBy("item", "slice").agg(F.collect_list(F.struct("h", "value")).alias("cells"))
    rows = rows.select("item", "slice", F.transform("cells", lambda c: c["h"]).alias("h"), F.transform("cells", lambda c: c["value"]).alias("v"), F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block"))
    meets = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda j: F.struct(F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j"), F.when(j < F.col("block"), 1).otherwise(0).alias("side")))
    rows = rows.withColumn("meet", F.explode(meets)).select("item", "slice", "h", "v", "meet.*")
    kind = rows.schema["item"].dataType.simpleString()
    sums = ("sa", "sb", "saa", "sbb", "sab")
    found = rows.groupBy("i", "j", "slice").applyInPandas(_pair_sums, f"a {kind}, b {kind}, n long, " + ", ".join(f"{c} double" for c in sums))
    if slices > 1:
        found = found.groupBy("a", "b").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in sums))
    return found


def _cells(measurements: DataFrame, axis: str) -> DataFrame:
    other = "feature" if axis == "sample" else "sample"
    return present(measurements).select(F.col(axis).alias("item"), F.xxhash64(F.col(other)).alias("h"), F.col("value").cast("double").alias("value"))


def pair_correlation(measurements: DataFrame, axis: str = "sample", method: str = "pearson") -> DataFrame:
    """``(a, b, n, r)`` with ``a < b`` along ``axis`` over cells both have; Spearman ranks within each item first.

    Items of few cells are compared whole (:mod:`.pairs`), of more by sums over slices of the cells (:func:`pair_sums`).
    A pair with one shared cell, or with equal values of an item, has a null ``r``.
    """
    cells = _cells(measurements, axis)
    if method == "spearman":
        cells = cells.withColumn("value", average_rank("value", ["item"]))
    if narrow(measurements, axis):
        kind = cells.schema["item"].dataType.simpleString()
        return visit_pairs(cells, all_pairs, f"a {kind}, b {kind}, n long, r double")
    # Correlation doesn't change with an item's level; without it the sums lose fewer digits.
    level = cells.groupBy("item").agg(F.avg("value").alias("level"), F.max(F.abs("value")).alias("top"))
    cells = cells.join(level, "item").select("item", "h", (F.col("value") - F.col("level")).alias("value"))
    found = pair_sums(cells).join(level.select(F.col("item").alias("a"), F.col("top").alias("ta")), "a").join(level.select(F.col("item").alias("b"), F.col("top").alias("tb")), "b")
    va, vb = (F.col(f"s{c}{c}") - F.col(f"s{c}") * F.col(f"s{c}") / F.col("n") for c in "ab")
    varies = (F.col("n") > 1) & (va > F.pow(F.col("ta") * 1e-12, F.lit(2)) * F.col("n")) & (vb > F.pow(F.col("tb") * 1e-12, F.lit(2)) * F.col("n"))
    r = (F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")) / (F.sqrt(va) * F.sqrt(vb))
    return found.select("a", "b", "n", F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))


def symmetric(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b", "r").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))


def correlation_outliers(pairs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``(sample, min_r, outlier)``: the least correlation with any other sample."""
    return symmetric(pairs).groupBy(F.col("a").alias("sample")).agg(F.min("r").alias("min_r")).withColumn("outlier", F.col("min_r") < threshold)


def sample_correlation_outliers(measurements: DataFrame, threshold: float = 0.8) -> DataFrame:
    """:func:`correlation_outliers` of the samples of a matrix, without a table of pairs where they have few cells."""
    if not narrow(measurements):
        return correlation_outliers(pair_correlation(measurements), threshold)
    cells = _cells(measurements, "sample")
    found = visit_pairs(cells, least, f"item {cells.schema['item'].dataType.simpleString()}, least double")
    return found.groupBy(F.col("item").alias("sample")).agg(F.min("least").alias("min_r")).withColumn("outlier", F.col("min_r") < threshold)


def correlation_sums(measurements: DataFrame, labels: DataFrame) -> DataFrame:
    """``(item, label, same, n_same, other, n_other)``: sums and numbers of the correlations of each sample with samples of its label and of others.

    ``labels`` is ``(item, label)``, with one label an item; a sample without one doesn't count.
    """
    if narrow(measurements):
        cells, kinds = _cells(measurements, "sample"), dict(labels.dtypes)
        if every_cell(cells):
            return whole_sums(cells, labels)
        found = visit_pairs(cells, sums, f"item {kinds['item']}, label {kinds['label']}, same double, n_same long, other double, n_other long", labels)
        return found.groupBy("item", "label").agg(*(F.sum(c).alias(c) for c in ("same", "n_same", "other", "n_other")))
    side = lambda c: labels.select(F.col("item").alias(c), F.col("label").alias(f"l{c}"))
    both = symmetric(pair_correlation(measurements)).join(side("a"), "a").join(side("b"), "b")
    same = F.col("la") == F.col("lb")
    parts = [(F.coalesce(F.sum(F.when(c, F.col("r"))), F.lit(0.0)).alias(k), F.count(F.when(c, F.col("r"))).alias(f"n_{k}")) for k, c in (("same", same), ("other", ~same))]
    return both.groupBy(F.col("a").alias("item"), F.col("la").alias("label")).agg(*(c for part in parts for c in part))


def _mean(total: Column, n: Column) -> Column:
    return F.when(n > 0, total / n)


def arm_correlation(measurements: DataFrame, samples: DataFrame) -> DataFrame:
    """``(sample, arm, within, between)`` of each sample, its mean correlation with samples of its arm and of others, and the same over all pairs in a row with null sample."""
    labels = samples.where("arm is not null").select(F.col("sample").alias("item"), F.col("arm").alias("label"))
    one = materialise(correlation_sums(measurements, labels), "arms")
    each = one.select(F.col("item").alias("sample"), F.col("label").alias("arm"), _mean(F.col("same"), F.col("n_same")).alias("within"), _mean(F.col("other"), F.col("n_other")).alias("between"))
    total = one.agg(*(F.sum(c).alias(c) for c in ("same", "n_same", "other", "n_other")))
    overall = total.select(F.lit(None).cast("string").alias("sample"), F.lit(None).cast("string").alias("arm"), _mean(F.col("same"), F.col("n_same")).alias("within"), _mean(F.col("other"), F.col("n_other")).alias("between"))
    return each.unionByName(overall)


def shift_confounded(arm_corr: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row: the overall means and whether the arms correlate less than ``threshold`` with each other."""
    return arm_corr.where("sample is null").select("within", "between", (F.col("between") < threshold).alias("shift_confounded"))


def correlation_clusters(measurements: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``(sample, cluster)``: samples connected by correlations of at least ``threshold``; the others alone. Only such pairs become rows."""
    if narrow(measurements):
        cells = _cells(measurements, "sample")
        kind = cells.schema["item"].dataType.simpleString()
        # Read twice by the components.
        near = materialise(visit_pairs(cells, close_pairs(threshold), f"a {kind}, b {kind}"), "near")
    else:
        pairs = materialise(pair_correlation(measurements), "pairs")
        near = pairs.where(F.col("r") >= threshold).select("a", "b").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("a")).distinct().select("a", F.col("a").alias("b")))
    return components(near).select(F.col("node").alias("sample"), F.col("component").alias("cluster"))


def cluster_verdict(measurements: DataFrame, clusters: DataFrame, gap: float = 0.1) -> DataFrame:
    """One row: number of clusters, mean correlation within and between them, and ``one_cluster``, ``separated`` or ``weak``."""
    clusters = materialise(clusters, "clusters")
    total = correlation_sums(measurements, clusters.select(F.col("sample").alias("item"), F.col("cluster").alias("label")))
    total = total.agg(*(F.sum(c).alias(c) for c in ("same", "n_same", "other", "n_other")))
    means = total.select(_mean(F.col("same"), F.col("n_same")).alias("within"), _mean(F.col("other"), F.col("n_other")).alias("between"))
    one = clusters.agg(F.count_distinct("cluster").alias("n_clusters")).join(means, F.lit(True))
    return one.withColumn("verdict", F.when(F.col("n_clusters") == 1, "one_cluster").when(F.col("within") - F.col("between") >= gap, "separated").otherwise("weak"))
