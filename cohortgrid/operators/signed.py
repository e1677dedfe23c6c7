"""Signed sets (regulons): ``(source, target, sign)`` with sign 1, -1 or null."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import average_rank, bh_adjust, hyper_sf, norm_sf2
from ..session import materialise
from .matrix import row_zscore
from .testing import significant


def signed_set_overlap(signed: DataFrame, selected: DataFrame, detected: DataFrame, min_targets: int = 5) -> DataFrame:
    """One-sided exact test of each source's targets among the selected features, within the detected ones."""
    # The detected features are asked for four times; measurements are read for them once.
    detected = materialise(detected.select("feature").distinct(), "detected")
    inside = signed.select("source", F.col("target").alias("feature")).join(detected, "feature", "left_semi").distinct()
    chosen = selected.join(detected, "feature", "left_semi").select("feature").distinct().withColumn("hit", F.lit(1))
    per = inside.join(chosen, "feature", "left").groupBy("source").agg(F.count("*").alias("n_targets"), F.count("hit").alias("overlap")).where(F.col("n_targets") >= min_targets)
    counts = detected.agg(F.count("*").alias("n_detected")).join(chosen.agg(F.count("*").alias("n_selected")), F.lit(True))
    per = per.join(F.broadcast(counts), F.lit(True))
    a, b = F.col("overlap"), F.col("n_targets") - F.col("overlap")
    c = F.col("n_selected") - F.col("overlap")
    d = F.col("n_detected") - F.col("n_targets") - c
    per = per.withColumn("expected", F.col("n_targets") * F.col("n_selected") / F.col("n_detected")).withColumn("cross_odds", F.when(b * c > 0, a * d / (b * c)))
    return bh_adjust(per.withColumn("p", hyper_sf("overlap", "n_detected", "n_targets", "n_selected")), "p")


def _conditional_odds(k: int, n: int, m: int, d: int) -> float:
    """The log odds at which the mean overlap is ``k``, by bisection, with the ends met by Newton steps that stay inside them."""
    lo, hi = max(0, d + m - n), min(m, d)
    if k <= lo or k >= hi:
        return 0.0 if k <= lo else math.inf
    i = np.arange(lo, hi)
    # Logarithms of the weights less that of the first, from the ratios of neighbours.
    logs = np.concatenate([[0.0], np.cumsum(np.log(m - i) + np.log(d - i) - np.log(i + 1.0) - np.log(n - m - d + i + 1.0))])
    i = np.arange(lo, hi + 1, dtype=float)
    a, b, x = -40.0, 40.0, 0.0
    for _ in range(200):
        w = logs + x * i
        w = np.exp(w - w.max())
        w /= w.sum()
        mean = w @ i
        a, b = (x, b) if mean < k else (a, x)
        var = w @ (i - mean) ** 2
        to = x + (k - mean) / var if var > 0 else math.inf
        to = to if a < to < b else (a + b) / 2
        done = abs(to - x) <= 1e-14 * max(1.0, abs(x))
        x = to
        if done:
            break
    return math.exp(x)


def conditional_odds(overlap: DataFrame) -> DataFrame:
    """``(source, odds)``: the odds ratio of greatest conditional likelihood, given the margins."""

    @F.pandas_udf("double")
    def odds(k: pd.Series, n: pd.Series, m: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([_conditional_odds(*map(int, row)) for row in zip(k, n, m, d)], dtype=float)

    return overlap.select("source", odds("overlap", "n_detected", "n_targets", "n_selected").alias("odds"))


def signed_set_activity(measurements: DataFrame, signed: DataFrame, min_targets: int = 5) -> DataFrame:
    """``(source, sample, activity, n_targets)``: the mean of the targets' z-scores by sign; an unknown sign counts as +1."""
    z = row_zscore(measurements)
    known = signed.select("source", F.col("target").alias("feature"), F.coalesce("sign", F.lit(1)).alias("sign")).dropDuplicates(["source", "feature"])
    per = z.join(known, "feature").groupBy("source", "sample").agg((F.sum(F.col("sign") * F.col("value")) / F.sum(F.abs("sign"))).alias("activity"), F.count("*").alias("n_targets"))
    return per.where(F.col("n_targets") >= min_targets)


def two_arm_scores(activity: DataFrame, samples: DataFrame) -> DataFrame:
    """``(source, n_first, n_second, difference, cohens_d, z, p, adj_p)`` between the two arms, by name.

    Rank sums with ties at their mean, tie and continuity correction; the difference is second minus first.
    """
    x = activity.join(samples.select("sample", "arm"), "sample").where("arm is not null")
    ends = samples.agg(F.min("arm").alias("first"), F.max("arm").alias("second"))
    x = x.join(F.broadcast(ends), F.lit(True)).withColumn("r", average_rank("activity", ["source"]))
    ties = x.groupBy("source", "activity").agg(F.count("*").alias("t")).groupBy("source").agg(F.sum(F.pow("t", F.lit(3)) - F.col("t")).alias("ties"))
    a, b = F.col("arm") == F.col("first"), F.col("arm") == F.col("second")
    pick = lambda c, v: F.when(c, F.col(v))
    per = x.groupBy("source").agg(
        F.count_if(a).alias("n1"), F.count_if(b).alias("n2"), F.sum(pick(b, "r")).alias("w"), F.avg(pick(a, "activity")).alias("m1"), F.avg(pick(b, "activity")).alias("m2"), F.var_samp(pick(a, "activity")).alias("v1"), F.var_samp(pick(b, "activity")).alias("v2")
    )
    per = per.join(ties, "source").where("n1 > 0 and n2 > 0")
    n = F.col("n1") + F.col("n2")
    u = F.col("w") - F.col("n2") * (F.col("n2") + 1) / 2 - F.col("n1") * F.col("n2") / 2
    sd = F.sqrt(F.col("n1") * F.col("n2") / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    z = F.when(sd > 0, (u - F.signum(u) * 0.5) / sd).otherwise(0.0)
    gap, spread = F.col("m2") - F.col("m1"), F.sqrt((F.col("v1") + F.col("v2")) / 2)
    # Without spread any difference is infinitely many of them, and none is no number.
    d = F.when(spread > 0, gap / spread).when(spread == 0, F.when(gap == 0, float("nan")).otherwise(F.signum(gap) * float("inf")))
    per = per.select("source", F.col("n1").alias("n_first"), F.col("n2").alias("n_second"), gap.alias("difference"), d.alias("cohens_d"), z.alias("z"))
    return bh_adjust(per.withColumn("p", norm_sf2("z")), "p")


def overlap_input(test: DataFrame, adj_p: float = 0.05, fallback_n: int = 200) -> DataFrame:
    """Features below ``adj_p`` whatever their size of change, or where there are none the first ``fallback_n`` by p, labelled."""
    sig = significant(test, adj_p, -1.0).select("feature", "p")
    n = sig.agg(F.count("*").alias("n"))
    a = sig.join(F.broadcast(n), F.lit(True)).where("n > 0").withColumn("selection", F.lit("fdr"))
    b = test.orderBy("p", "feature").limit(fallback_n).select("feature", "p").join(F.broadcast(n), F.lit(True)).where("n = 0").withColumn("selection", F.lit("ranked_fallback"))
    return a.unionByName(b).drop("n")


def match_report(ids: DataFrame, samples: DataFrame) -> DataFrame:
    """One row: how many ids match a sample, how many don't, and ``ok``, ``partial`` or ``none``."""
    x = ids.select("sample").distinct().join(samples.select("sample").distinct().withColumn("hit", F.lit(1)), "sample", "left")
    one = x.agg(F.count("hit").alias("matched"), F.count_if(F.col("hit").isNull()).alias("unmatched"))
    return one.withColumn("status", F.when(F.col("matched") == 0, "none").when(F.col("unmatched") > 0, "partial").otherwise("ok"))
