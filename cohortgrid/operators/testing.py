"""Per-feature two-group tests. A test table has ``feature, lfc, ave, t, p, adj_p``."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import bh_adjust, digamma_at, exact_quantiles, global_row_number, t_sf2, t_size, trigamma_inverse, digamma
from ..session import materialise
from .matrix import present

TINY = 1e-300


def two_group_fit(measurements: DataFrame, samples: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """``(feature, lfc, ave, n1, n0, s2, df, se_unscaled)``: difference of means and pooled residual variance of each feature."""
    x = present(measurements).join(samples.select("sample", "arm"), "sample").where(F.col("arm").isin(numerator, denominator))
    one, zero = F.when(F.col("arm") == numerator, F.col("value")), F.when(F.col("arm") == denominator, F.col("value"))
    fit = x.groupBy("feature").agg(F.avg(one).alias("m1"), F.avg(zero).alias("m0"), F.var_samp(one).alias("v1"), F.var_samp(zero).alias("v0"), F.count(one).alias("n1"), F.count(zero).alias("n0"), F.avg("value").alias("ave"))
    fit = fit.where("n1 > 0 and n0 > 0 and n1 + n0 > 2")
    ss = F.coalesce(F.col("v1") * (F.col("n1") - 1), F.lit(0.0)) + F.coalesce(F.col("v0") * (F.col("n0") - 1), F.lit(0.0))
    df = (F.col("n1") + F.col("n0") - 2).cast("double")
    return fit.select("feature", (F.col("m1") - F.col("m0")).alias("lfc"), "ave", "n1", "n0", (ss / df).alias("s2"), df.alias("df"), F.sqrt(1 / F.col("n1") + 1 / F.col("n0")).alias("se_unscaled"))


def paired_fit(measurements: DataFrame, samples: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """As :func:`two_group_fit` for samples with a ``pair_id``: the mean difference within complete pairs, df = pairs - 1."""
    x = present(measurements).join(samples.select("sample", "arm", "pair_id"), "sample")
    side = lambda arm, name: x.where(F.col("arm") == arm).groupBy("feature", "pair_id").agg(F.avg("value").alias(name))
    both = side(numerator, "x").join(side(denominator, "y"), ["feature", "pair_id"]).withColumn("d", F.col("x") - F.col("y"))
    fit = both.groupBy("feature").agg(F.avg("d").alias("lfc"), F.avg((F.col("x") + F.col("y")) / 2).alias("ave"), F.count("*").alias("n1"), F.var_samp("d").alias("s2")).where("n1 > 1")
    return fit.select("feature", "lfc", "ave", "n1", F.col("n1").alias("n0"), "s2", (F.col("n1") - 1).cast("double").alias("df"), F.sqrt(1 / F.col("n1")).alias("se_unscaled"))


def paired_or_plain_fit(measurements: DataFrame, samples: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """:func:`paired_fit` where the pairs allow it, else :func:`two_group_fit`; ``design`` and ``reason`` say which and why.

    Pairs serve where every sample of both arms has one, there are two or more, and one of them at least has both arms (the design is of full rank).
    """
    own = samples.where(F.col("arm").isin(numerator, denominator))
    if "pair_id" not in samples.columns:
        reason = "no pair_id column"
    else:
        pair = F.trim(F.col("pair_id").cast("string"))
        blank = pair.isNull() | (pair == "")
        per = own.groupBy(F.when(~blank, pair).alias("pair")).agg(F.count("*").alias("n"), F.count_distinct("arm").alias("arms"))
        loose, levels, whole = per.agg(F.coalesce(F.sum(F.when(F.col("pair").isNull(), F.col("n"))), F.lit(0)), F.count("pair"), F.count_if(F.col("pair").isNotNull() & (F.col("arms") == 2))).first()
        reason = "samples without a pair" if loose else "fewer than two pairs" if levels < 2 else "no pair has both arms" if not whole else None
    fit = (two_group_fit if reason else paired_fit)(measurements, samples, numerator, denominator)
    return fit.withColumns({"design": F.lit("two_group" if reason else "paired"), "reason": F.lit(reason).cast("string")})


def moderate(fit: DataFrame, trend: bool = False, robust: bool = False) -> DataFrame:
    """The test table of a fit, its variances shrunk towards a prior.

    The prior's two parameters come from the mean and variance of the log variances; with ``trend`` the mean
    is a cubic in the average level, fitted by normal equations aggregated in Spark; with ``robust`` log
    variances are pulled in to their 5 and 95 % quantiles first, unless these are undefined. Two or fewer features are not moderated.
    ``b`` is that of :func:`log_odds`.
    """
    fit = materialise(fit, "fit")  # read many times below
    e = fit.where("s2 > 0").withColumn("z", F.log("s2") - digamma(F.col("df") / 2) + F.log(F.col("df") / 2))
    if robust:
        q = exact_quantiles(e, "z", [0.05, 0.95])
        if q[0] is not None:
            e = e.withColumn("z", F.greatest(F.lit(q[0]), F.least(F.lit(q[1]), F.col("z"))))
    centre = F.lit(0.0)
    if trend:
        import numpy as np

        lo, hi = e.agg(F.min("ave"), F.max("ave")).first()
        if lo is not None and hi > lo:
            basis = lambda c: [F.pow((c - lo) / (hi - lo), F.lit(float(j))) for j in range(4)]
            b = basis(F.col("ave"))
            sums = e.agg(*(F.sum(b[i] * b[j]) for i in range(4) for j in range(4)), *(F.sum(b[i] * F.col("z")) for i in range(4))).first()
            beta = np.linalg.lstsq(np.array(sums[:16]).reshape(4, 4), np.array(sums[16:]), rcond=None)[0]
            centre = sum((F.lit(float(x)) * y for x, y in zip(beta, b)), F.lit(0.0))
    n, mean, var, mean_df = e.agg(F.count("*"), F.avg(F.col("z") - centre), F.var_samp(F.col("z") - centre), F.avg("df")).first()
    prior_df, log_s0 = math.inf, mean or 0.0
    if n and n > 2 and var is not None:
        from ..functions.stats import _psi
        import numpy as np

        excess = var - float(_psi(np.array([mean_df / 2]), 1)[0])
        if excess > 0:
            prior_df = 2 * trigamma_inverse(excess)
            log_s0 = mean + digamma_at(prior_df / 2) - math.log(prior_df / 2)
    else:
        prior_df = 0.0
    s0 = F.exp(centre + log_s0)
    if prior_df == math.inf:
        post, total = s0, F.lit(1e6)
    elif prior_df == 0.0:
        post, total = F.col("s2"), F.col("df")
    else:
        post, total = (s0 * prior_df + F.col("s2") * F.col("df")) / (F.col("df") + prior_df), F.col("df") + prior_df
    t = fit.withColumns({"s2_post": post, "s2_prior": s0}).withColumn("df_total", total).withColumn("t", F.col("lfc") / (F.sqrt("s2_post") * F.col("se_unscaled")))
    t = log_odds(materialise(t.withColumn("p", t_sf2("t", "df_total")), "moderated"), normal=prior_df == math.inf)
    return bh_adjust(t.drop("s2_prior"), "p")


def log_odds(test: DataFrame, share: float = 0.01, normal: bool = False) -> DataFrame:
    """``test`` with ``b``, the log odds that a feature differs, where a ``share`` of all do.

    The variance of the true differences, in units of the residual variance, is the mean of what the largest statistics (half the share)
    exceed chance by, each held between spreads of 0.1 and 4. Statistics of fewer degrees of freedom count as those of the most with the same p.
    ``normal``: the variance is known, so t is normal. A null t gives a null.
    """
    rows = test.where("t is not null and not isnan(t)")
    n, most = rows.agg(F.count("*"), F.max("df_total")).first()
    middle = exact_quantiles(rows, "s2_prior", [0.5])[0]
    if not n or not middle:
        return test.withColumn("b", F.lit(None).cast("double"))
    top = math.ceil(share / 2 * n)
    share_top = max(top / n, share)
    size = F.when(F.col("df_total") < most, F.coalesce(t_size("p", F.lit(float(most))), F.abs("t"))).otherwise(F.abs("t"))
    ranked = global_row_number(rows.select("feature", size.alias("size"), "se_unscaled"), [F.col("size").desc(), F.col("feature")], "place").where(F.col("place") <= top)
    p0 = t_sf2("size", F.lit(float(most)))
    ranked = ranked.withColumn("p0", p0).withColumn("wanted", ((F.col("place") - 0.5) / n - (1 - share_top) * F.col("p0")) / share_top)
    v = F.col("se_unscaled") * F.col("se_unscaled") * (F.pow(F.col("size") / t_size(F.least(F.lit(1.0), "wanted"), F.lit(float(most))), F.lit(2)) - 1)
    v = F.when(F.col("wanted") > F.col("p0"), F.coalesce(v, F.lit(0.0))).otherwise(0.0)
    spread = ranked.agg(F.avg(F.greatest(F.lit(0.01 / middle), F.least(F.lit(16.0 / middle), v)))).first()[0]
    ratio = 1 + spread / (F.col("se_unscaled") * F.col("se_unscaled"))
    t2, df = F.col("t") * F.col("t"), F.col("df_total")
    gain = t2 * (1 - 1 / ratio) / 2 if normal else (1 + df) / 2 * F.log((t2 + df) / (t2 / ratio + df))
    return test.withColumn("b", math.log(share / (1 - share)) - F.log(ratio) / 2 + gain)


def plain_test(fit: DataFrame) -> DataFrame:
    """The test table without moderation."""
    t = fit.withColumn("t", F.when(F.col("s2") > 0, F.col("lfc") / (F.sqrt("s2") * F.col("se_unscaled"))))
    return bh_adjust(t.withColumn("p", t_sf2("t", "df")), "p")


def guard_null_p(test: DataFrame) -> DataFrame:
    """Null or NaN p-values count as 1."""
    one = lambda c: F.when(F.col(c).isNull() | F.isnan(c), 1.0).otherwise(F.col(c))
    return test.withColumns({"p": one("p"), "adj_p": one("adj_p")})


def significant(test: DataFrame, adj_p: float = 0.05, lfc: float = 1.0) -> DataFrame:
    return test.where((F.col("adj_p") < adj_p) & (F.abs("lfc") > lfc)).withColumn("direction", F.when(F.col("lfc") > 0, "up").otherwise("down"))


def tiers(test: DataFrame, adj_p: float = 0.05, lfc: float = 1.0) -> DataFrame:
    """``test`` with ``tier`` (``fdr``, ``nominal``, ``ns``), ``direction`` and ``y = -log10(p)``."""
    large = F.abs("lfc") > lfc
    tier = F.when((F.col("adj_p") < adj_p) & large, "fdr").when((F.col("p") < 0.05) & large, "nominal").otherwise("ns")
    return test.withColumns({"tier": tier, "direction": F.when(F.col("lfc") > 0, "up").otherwise("down"), "y": -F.log10(F.greatest(F.col("p"), F.lit(TINY)))})


def label_rows(tiered: DataFrame, k: int = 10, k_nominal: int = 8) -> DataFrame:
    """The rows to label: the first ``k`` by p of each direction in tier ``fdr``, or ``k_nominal`` of ``nominal`` where no row is ``fdr``."""
    n_fdr = tiered.agg(F.count_if(F.col("tier") == "fdr").alias("n_fdr"))
    ranked = tiered.where("tier <> 'ns'").withColumn("label_rank", F.row_number().over(Window.partitionBy("tier", "direction").orderBy("p", "feature")))
    ranked = ranked.join(F.broadcast(n_fdr), F.lit(True))
    return ranked.where(((F.col("n_fdr") > 0) & (F.col("tier") == "fdr") & (F.col("label_rank") <= k)) | ((F.col("n_fdr") == 0) & (F.col("label_rank") <= k_nominal))).drop("n_fdr")


def p_histogram(test: DataFrame, bins: int = 40) -> DataFrame:
    at = F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int")
    return test.where("p is not null").groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def p_value_diagnosis(test: DataFrame) -> DataFrame:
    """One row: features, share below 0.05, excess over chance, and a verdict."""
    one = test.where("p is not null").agg(F.count("*").alias("n"), F.avg((F.col("p") < 0.05).cast("double")).alias("share"), F.avg((F.col("p") > 0.95).cast("double")).alias("high"))
    one = one.withColumn("excess", F.col("share") / 0.05)
    verdict = F.when(F.col("excess") >= 2, "strong_signal").when(F.col("excess") >= 1.2, "weak_signal").when(F.col("high") > 0.1, "conservative").otherwise("no_signal")
    return one.select("n", "share", "excess", verdict.alias("verdict"))


def select_features(test: DataFrame, adj_p: float = 0.05, lfc: float = 1.0, min_n: int = 5, fallback_n: int = 500) -> DataFrame:
    """Significant features, or where there are fewer than ``min_n`` the ``fallback_n`` smallest p-values beyond ``lfc``, labelled ``ranked_fallback``; ``reason`` says why, and is null for significant ones.

    One plan: the count of significant rows is a scalar, and the ranking a sort with a limit.
    """
    sig = significant(test, adj_p, lfc).select("feature", "lfc", "p", "adj_p", "direction")
    n = sig.agg(F.count("*").alias("n_significant"))
    ranked = test.where(F.abs("lfc") > lfc).orderBy("p", "feature").limit(fallback_n).select("feature", "lfc", "p", "adj_p", F.when(F.col("lfc") > 0, "up").otherwise("down").alias("direction"))
    a = sig.join(F.broadcast(n), F.lit(True)).where(F.col("n_significant") >= min_n).withColumns({"selection": F.lit("fdr"), "reason": F.lit(None).cast("string")})
    b = ranked.join(F.broadcast(n), F.lit(True)).where(F.col("n_significant") < min_n).withColumns({"selection": F.lit("ranked_fallback"), "reason": F.concat(F.lit("only "), F.col("n_significant").cast("string"), F.lit(f" significant features, of at least {min_n}"))})
    return a.unionByName(b)


def heatmap_rows(test: DataFrame, adj_p: float = 0.05, lfc: float = 1.0, top_n: int = 50, none_n: int = 20) -> DataFrame:
    """The ``top_n`` significant features by adjusted p, or the ``none_n`` smallest p-values where none is significant."""
    sig = significant(test, adj_p, lfc)
    n = sig.agg(F.count("*").alias("n"))
    a = sig.orderBy("adj_p", "p", "feature").limit(top_n).select("feature", "adj_p", "p").join(F.broadcast(n), F.lit(True)).where("n > 0")
    b = test.orderBy("p", "feature").limit(none_n).select("feature", "adj_p", "p").join(F.broadcast(n), F.lit(True)).where("n = 0")
    return a.unionByName(b).drop("n")


def test_summary(test: DataFrame, adj_p: float = 0.05, lfc: float = 1.0) -> DataFrame:
    """One row: counts by direction, the least adjusted p and the first ten features by p."""
    sig = (F.col("adj_p") < adj_p) & (F.abs("lfc") > lfc)
    one = test.agg(F.count("*").alias("n"), F.count_if(sig & (F.col("lfc") > 0)).alias("n_up"), F.count_if(sig & (F.col("lfc") < 0)).alias("n_down"), F.min("adj_p").alias("min_adj_p"))
    top = test.orderBy("p", "feature").limit(10).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "feature"))), lambda x: x["feature"]), ",").alias("top"))
    return one.join(top, F.lit(True))


def ranked_by_p(test: DataFrame) -> DataFrame:
    """``test`` with ``rank`` by p over the whole table, in parallel ranges."""
    return global_row_number(test, [F.col("p").asc_nulls_last(), F.col("feature")])
