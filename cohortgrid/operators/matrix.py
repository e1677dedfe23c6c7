"""Feature mapping and cleaning of long measurement tables ``(feature, sample, value)``.

A missing cell is an absent row, null or NaN.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import exact_quantiles
from ..session import materialise


def present(measurements: DataFrame) -> DataFrame:
    """Cells with a value that is neither null nor NaN."""
    return measurements.where(F.col("value").isNotNull() & ~F.isnan("value"))


def pick_annotation(features: DataFrame, candidates: list[str], min_filled: int = 100) -> DataFrame:
    """``(column, filled, priority, picked)`` of candidate annotation columns; the first with more than ``min_filled`` non-blank values is picked."""
    one = features.agg(*(F.count_if(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "").alias(f"c{i}") for i, c in enumerate(candidates)))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("filled"), F.lit(i).alias("priority")) for i, c in enumerate(candidates)))
    usable = F.when(F.col("filled") > min_filled, F.col("priority"))
    return one.select(F.inline(rows)).withColumn("picked", F.coalesce(F.col("priority") == F.min(usable).over(Window.partitionBy(F.lit(1))), F.lit(False)))


def normalise_key(col: Column) -> Column:
    """Lower case, without parenthesised parts, letters and digits only."""
    return F.regexp_replace(F.regexp_replace(F.lower(col), r"\([^)]*\)", ""), r"[^a-z0-9]", "")


def strip_version(col: Column) -> Column:
    """An accession without its ``.version``."""
    return F.regexp_replace(F.trim(col), r"\.\d+$", "")


def is_refseq(col: Column) -> Column:
    return F.upper(F.trim(col)).rlike(r"^[NX][MR]_\d+")


def route_coverage(features: DataFrame, routes: Mapping[str, tuple[Column, DataFrame]]) -> DataFrame:
    """``(route, position, n, covered, coverage, n_targets)``: each route looks up a key expression in a table ``(key, target)``; no routes give no rows."""
    if not routes:
        return features.sparkSession.createDataFrame([], "route string, position int, n long, covered long, n_targets long, coverage double")
    parts = []
    for i, (name, (key, table)) in enumerate(routes.items()):
        found = features.withColumn("key", key).join(first_wins(table, ["key"], "target").select("key", "target"), "key", "left")
        parts.append(found.agg(F.lit(name).alias("route"), F.lit(i).alias("position"), F.count("*").alias("n"), F.count("target").alias("covered"), F.count_distinct("target").alias("n_targets")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("coverage", F.when(F.col("n") > 0, F.col("covered") / F.col("n")).otherwise(0.0))


def map_features(features: DataFrame, routes: Mapping[str, tuple[Column, DataFrame]]) -> DataFrame:
    """``(feature, target, route)`` by the route with the largest coverage, the first of equals; unmapped features are left out."""
    best = route_coverage(features, routes).orderBy(F.col("covered").desc(), "position").first()["route"]
    key, table = routes[best]
    found = features.withColumn("key", key).join(first_wins(table, ["key"], "target").select("key", "target"), "key")
    return found.select("feature", "target", F.lit(best).alias("route"))


def mapping_gate(coverage: DataFrame, min_cover: float = 0.5, min_distinct: int = 5000) -> DataFrame:
    """``coverage`` with ``usable``: unusable only if coverage and distinct targets are both too low."""
    return coverage.withColumn("usable", ~((F.col("coverage") < min_cover) & (F.col("n_targets") < min_distinct)))


def first_wins(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The first row of each key in ``order``."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def feature_variance(measurements: DataFrame) -> DataFrame:
    """``(feature, n, variance)`` over present cells; 0 with fewer than two."""
    return present(measurements).groupBy("feature").agg(F.count("*").alias("n"), F.coalesce(F.var_samp("value"), F.lit(0.0)).alias("variance"))


def collapse_max_var(measurements: DataFrame, mapping: DataFrame) -> DataFrame:
    """Measurements renamed to ``mapping`` ``(feature, target)``; of several features of a target the one with the largest variance stays."""
    ranked = feature_variance(measurements).join(mapping.select("feature", "target").distinct(), "feature")
    chosen = first_wins(ranked, ["target"], F.col("variance").desc(), "feature").select("feature", "target")
    return measurements.join(chosen, "feature").select(F.col("target").alias("feature"), "sample", "value")


def align_samples(measurements: DataFrame, samples: DataFrame) -> DataFrame:
    """Measurements of the listed samples; a listed sample without any cell is an error."""
    missing = samples.join(measurements.select("sample").distinct(), "sample", "left_anti").limit(1).collect()
    if missing:
        raise ValueError(f"no measurements for sample {missing[0]['sample']}")
    return measurements.join(samples.select("sample").distinct(), "sample", "left_semi")


def alignment_report(measurements: DataFrame, samples: DataFrame) -> DataFrame:
    """``(sample, status)`` of every sample on one side only: ``missing`` measurements or ``extra`` ones."""
    have, listed = measurements.select("sample").distinct(), samples.select("sample").distinct()
    return listed.join(have, "sample", "left_anti").withColumn("status", F.lit("missing")).unionByName(have.join(listed, "sample", "left_anti").withColumn("status", F.lit("extra")))


def filter_low_information(measurements: DataFrame, min_obs: int = 2, least_features: int = 0) -> DataFrame:
    """Features with at least ``min_obs`` present cells that are not all equal (a standard deviation of equal values may round to more than 0); fewer than ``least_features`` of them are an error."""
    good = present(measurements).groupBy("feature").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).where((F.col("n") >= min_obs) & (F.col("lo") < F.col("hi")))
    if least_features and (left := good.limit(least_features).count()) < least_features:
        raise ValueError(f"only {left} features vary, of at least {least_features}")
    return measurements.join(good.select("feature"), "feature", "left_semi")


def knn_impute(measurements: DataFrame, samples: DataFrame, k: int = 10) -> DataFrame:
    """``measurements`` with missing cells set to the mean of the ``k`` nearest features that have the sample.

    Distance is the mean squared difference over shared samples; ties go to the smaller
    feature. Distances follow from sums of squares and products, which are products of blocks of features, so no row is made for two
    features and a sample. Only features with gaps look for neighbours. A cell none of the
    features has stays missing. ``imputed`` marks the new cells.
    """
    from .qc import pair_sums

    cells = materialise(present(measurements).select("feature", "sample", F.col("value").cast("double").alias("value")), "cells")
    n = samples.count()
    gappy = cells.groupBy("feature").agg(F.count("*").alias("n")).where(F.col("n") < n).select(F.col("feature").alias("f"))
    # Differences don't change with a common level; without it the sums lose fewer digits.
    middle = cells.agg(F.avg("value")).first()[0] or 0.0
    sums = pair_sums(cells.select(F.col("feature").alias("item"), F.xxhash64("sample").alias("h"), (F.col("value") - middle).alias("value")))
    sums = materialise(sums.select("a", "b", (F.greatest(F.lit(0.0), F.col("saa") + F.col("sbb") - 2 * F.col("sab")) / F.col("n")).alias("d")), "distances")
    both = sums.select(F.col("a").alias("f"), F.col("b").alias("g"), "d").unionByName(sums.select(F.col("b").alias("f"), F.col("a").alias("g"), "d"))
    near = both.join(gappy, "f", "left_semi")
    gaps = gappy.join(F.broadcast(samples.select("sample")), F.lit(True)).join(cells.select(F.col("feature").alias("f"), "sample"), ["f", "sample"], "left_anti")
    options = gaps.join(near, "f").join(cells.select(F.col("feature").alias("g"), "sample", "value"), ["g", "sample"])
    # The limit on the row number is applied before the shuffle, too.
    nearest = options.withColumn("r", F.row_number().over(Window.partitionBy("f", "sample").orderBy("d", "g"))).where(F.col("r") <= k)
    filled = nearest.groupBy(F.col("f").alias("feature"), "sample").agg(F.avg("value").alias("value"))
    return cells.select("feature", "sample", "value", F.lit(False).alias("imputed")).unionByName(filled.withColumn("imputed", F.lit(True)))


def detect_scale(measurements: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: 1, 50 and 99 % quantiles, the share of negatives and ``scale`` (``log2`` or ``linear``)."""
    shares, cells = [0.01, 0.5, 0.99], present(measurements).select(F.col("value").cast("double").alias("value"))
    cells = cells if approximate else materialise(cells, "values")
    if approximate:
        q = F.percentile_approx("value", F.array(*map(F.lit, shares)), F.lit(100000))
    else:
        q = F.array(*(F.lit(v).cast("double") for v in exact_quantiles(cells, "value", shares, written=True)))
    one = cells.agg(F.avg((F.col("value") < 0).cast("double")).alias("negative"), *([q.alias("q")] if approximate else []))
    one = (one if approximate else one.withColumn("q", q)).select(F.col("q")[0].alias("q01"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q99"), "negative")
    scale = F.when(F.col("negative") > 0.001, "log2").when(F.col("q99") > 100, "linear").when(F.col("q50") > 50, "linear").otherwise("log2")
    return one.withColumn("scale", scale)


def to_log2(measurements: DataFrame, mode: str = "auto", early: float | None = None) -> DataFrame:
    """``log2(value + 1)`` of linear values; ``auto`` asks :func:`detect_scale`, ``never`` changes nothing.

    Negatives on a linear scale are an error. With ``early``, a rule for raw tables, a table whose median is above that is linear without further questions.
    """
    if mode == "never":
        return measurements
    linear = mode != "auto"
    measurements = materialise(measurements.select("feature", "sample", "value"), "cells")
    if mode == "auto":
        linear = early is not None and (exact_quantiles(present(measurements), "value", [0.5])[0] or 0.0) > early
        linear = linear or detect_scale(measurements).first()["scale"] == "linear"
    if not linear:
        return measurements.select("feature", "sample", "value")
    if present(measurements).where("value < 0").limit(1).count():
        raise ValueError("a linear scale has no negative values")
    return measurements.select("feature", "sample", F.log2(F.col("value") + 1).alias("value"))


def quantile_normalise(measurements: DataFrame, ties: str = "average") -> DataFrame:
    """Give every sample the same distribution: the mean over samples at each rank.

    Tied values take the mean of their ranks' values (``average``) or one each in the order of features
    (``first``). Samples should have equally many cells; others are compared by rank alone.
    """
    ranked = present(measurements).withColumn("r", F.row_number().over(Window.partitionBy("sample").orderBy("value", "feature")))
    means = ranked.groupBy("r").agg(F.avg("value").alias("m"))
    out = ranked.join(means, "r")
    value = F.col("m") if ties == "first" else F.avg("m").over(Window.partitionBy("sample", "value"))
    return out.select("feature", "sample", value.alias("value"))


def stabilise(measurements: DataFrame) -> DataFrame:
    """Approximate variance stabilisation: ``asinh`` of values centred on each sample's median and scaled by its quartile range."""
    q = present(measurements).groupBy("sample").agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    spread = F.col("q")[2] - F.col("q")[0]
    value = F.asinh((F.col("value") - F.col("q")[1]) / F.when(spread > 0, spread).otherwise(1.0))
    return present(measurements).join(q, "sample").select("feature", "sample", value.alias("value"))


def row_zscore(measurements: DataFrame, clip: float | None = None) -> DataFrame:
    """Each feature centred and scaled to unit standard deviation; a constant one becomes 0. Optionally clipped to ``+-clip``."""
    by = Window.partitionBy("feature")
    sd = F.stddev_samp("value").over(by)
    z = F.when(sd > 0, (F.col("value") - F.avg("value").over(by)) / sd).otherwise(0.0)
    if clip is not None:
        z = F.greatest(F.lit(-clip), F.least(F.lit(clip), z))
    return present(measurements).select("feature", "sample", z.alias("value"))


def top_variance(measurements: DataFrame, n: int) -> DataFrame:
    """Cells of the ``n`` features with the largest variance; all where ``n`` is not positive."""
    if n <= 0:
        return measurements
    top = feature_variance(measurements).orderBy(F.col("variance").desc(), "feature").limit(n)
    return measurements.join(top.select("feature"), "feature", "left_semi")


def cleaning_report(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: features, samples and cells before and after, and the scale found."""
    count = lambda df, s: present(df).agg(F.count_distinct("feature").alias(f"features_{s}"), F.count_distinct("sample").alias(f"samples_{s}"), F.count("*").alias(f"cells_{s}"))
    return count(raw, "before").join(count(clean, "after"), F.lit(True)).join(detect_scale(raw).select("scale"), F.lit(True))
