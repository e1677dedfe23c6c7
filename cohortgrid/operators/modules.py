"""Co-expression modules. Pairs are ``(a, b, r)`` of features, modules ``(feature, module)`` with 0 for unassigned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import average_rank, bh_adjust, exact_quantiles, t_sf2
from ..session import materialise
from .graph import components
from .matrix import present, row_zscore, top_variance
from .qc import correlation_sums, pair_correlation, pair_sums, symmetric


def module_input(measurements: DataFrame, samples: DataFrame, arm: str, top_n: int = 5000) -> DataFrame:
    """Cells of one arm's samples and the features of most variance among them."""
    own = measurements.join(samples.where(F.col("arm") == arm).select("sample"), "sample", "left_semi")
    return top_variance(own, top_n)


def input_gates(measurements: DataFrame, min_samples: int = 15, min_features: int = 2000) -> DataFrame:
    one = present(measurements).agg(F.count_distinct("sample").alias("n_samples"), F.count_distinct("feature").alias("n_features"))
    return one.withColumn("ok", (F.col("n_samples") >= min_samples) & (F.col("n_features") >= min_features))


def good_samples_features(measurements: DataFrame, min_fraction: float = 0.5, rounds: int = 10) -> DataFrame:
    """Cells left when features and samples with too many gaps, and constant features, are dropped until nothing changes."""
    x = materialise(present(measurements), "cells")
    size = None
    for _ in range(rounds):
        n = x.agg(F.count_distinct("sample").alias("s"), F.count_distinct("feature").alias("f"), F.count("*").alias("c")).first()
        if tuple(n) == size or not n["c"]:
            break
        size = tuple(n)
        features = x.groupBy("feature").agg(F.count("*").alias("n"), F.var_samp("value").alias("v")).where((F.col("n") >= n["s"] * min_fraction) & (F.col("v") > 0))
        x = x.join(features.select("feature"), "feature", "left_semi")
        left = features.count()
        good = x.groupBy("sample").agg(F.count("*").alias("n")).where(F.col("n") >= left * min_fraction)
        x = materialise(x.join(good.select("sample"), "sample", "left_semi"), "cells")
    return x


def sample_outliers(measurements: DataFrame, factor: float = 1.5) -> DataFrame:
    """``(sample, distance, outlier)``: mean ``1 - r`` to the other samples, above ``factor`` times the median."""
    every = present(measurements).select(F.col("sample").alias("item"), F.lit(0).alias("label")).distinct()
    mean = F.when(F.col("n_same") > 0, 1 - F.col("same") / F.col("n_same"))
    d = materialise(correlation_sums(measurements, every).select(F.col("item").alias("sample"), mean.alias("distance")), "distances")
    middle = exact_quantiles(d, "distance", [0.5])[0]
    return d.withColumn("outlier", F.col("distance") > F.lit(None if middle is None else middle * factor).cast("double"))


def soft_threshold_table(pairs: DataFrame, powers: Sequence[int] = (*range(1, 11), *range(12, 21, 2)), bins: int = 10) -> DataFrame:
    """``(power, r2, slope, mean_k, median_k)`` of signed adjacencies ``((1 + r) / 2) ** power``: the scale-free fit over ``bins`` of connectivity."""
    adj = symmetric(pairs).select("a", ((1 + F.col("r")) / 2).alias("s"))
    k = adj.groupBy("a").agg(*(F.sum(F.pow("s", F.lit(float(p)))).alias(f"p{p}") for p in powers))
    k = k.select(F.inline(F.array(*(F.struct(F.lit(p).alias("power"), F.col(f"p{p}").alias("k")) for p in powers))))
    ends = k.groupBy("power").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.avg("k").alias("mean_k"), F.median("k").alias("median_k"), F.count("*").alias("n"))
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("k") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))).otherwise(0)
    binned = k.join(F.broadcast(ends), "power").withColumn("bin", at).groupBy("power", "bin", "n", "mean_k", "median_k").agg(F.avg("k").alias("kb"), F.count("*").alias("nb"))
    fit = binned.withColumns({"x": F.log10("kb"), "y": F.log10(F.col("nb") / F.col("n"))}).groupBy("power", "mean_k", "median_k").agg(F.regr_slope("y", "x").alias("slope"), F.regr_r2("y", "x").alias("r2"))
    return fit.select("power", (-F.signum("slope") * F.col("r2")).alias("r2"), "slope", "mean_k", "median_k")


def pick_power(table: DataFrame, r2: float = 0.8, min_k: float = 1.0) -> DataFrame:
    """One row: the smallest power with a good fit and enough connectivity, else with a good fit, else of the best fit (``reached`` false)."""
    ok = F.col("r2") >= r2
    one = table.agg(F.min(F.when(ok & (F.col("mean_k") >= min_k), F.col("power"))).alias("a"), F.min(F.when(ok, F.col("power"))).alias("b"), F.max_by("power", F.struct("r2", -F.col("power"))).alias("c"))
    return one.select(F.coalesce("a", "b", "c").alias("power"), F.coalesce("a", "b").isNotNull().alias("reached"))


def topological_overlap(pairs: DataFrame, power: int, keep: float = 0.01) -> DataFrame:
    """``(a, b, tom)`` from adjacencies of at least ``keep``; smaller ones count as zero.

    What two features have in common is the product of their rows of adjacencies, so the sums over neighbours are products of blocks of the sparse table.
    """
    adj = materialise(pairs.select("a", "b", F.pow((1 + F.col("r")) / 2, F.lit(float(power))).alias("w")).where(F.col("w") >= keep), "adjacency")
    both = adj.unionByName(adj.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))
    k = both.groupBy("a").agg(F.sum("w").alias("k"))
    through = pair_sums(both.select(F.col("a").alias("item"), F.xxhash64("b").alias("h"), F.col("w").alias("value"))).select("a", "b", F.col("sab").alias("l"))
    j = adj.join(through, ["a", "b"], "left").join(k.select("a", F.col("k").alias("ka")), "a").join(k.select(F.col("a").alias("b"), F.col("k").alias("kb")), "b")
    return j.select("a", "b", ((F.coalesce("l", F.lit(0.0)) + F.col("w")) / (F.least("ka", "kb") + 1 - F.col("w"))).alias("tom"))


def modules(pairs: DataFrame, power: int, min_size: int = 30, quantile: float = 0.9) -> DataFrame:
    """``(feature, module)``: components of the strongest topological overlaps; those below ``min_size`` are module 0, the others numbered by size."""
    tom = materialise(topological_overlap(pairs, power), "tom")
    limit = exact_quantiles(tom, "tom", [quantile])[0]
    strong = tom.where(F.col("tom") >= F.lit(limit).cast("double"))
    named = components(strong.select("a", "b"))
    features = pairs.select(F.explode(F.array("a", "b")).alias("feature")).distinct()
    sizes = named.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") >= min_size)
    ranked = sizes.withColumn("module", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("n").desc(), "component")))
    found = named.join(ranked.select("component", "module"), "component").select(F.col("node").alias("feature"), "module")
    return features.join(found, "feature", "left").select("feature", F.coalesce("module", F.lit(0)).alias("module"))


def module_sizes(named: DataFrame) -> DataFrame:
    return named.groupBy("module").agg(F.count("*").alias("size"))


def eigen_profiles(measurements: DataFrame, named: DataFrame, rounds: int = 30) -> DataFrame:
    """``(module, sample, value)``: the first principal component of each module's standardised members, signed like their mean.

    Power iteration, all modules at once, so that no module has to fit one task. A sample's cells of a module are one row, written once; a round is a pass over
    these rows that sends each of them the module's weights, one number a feature, and adds up new weights, so that no cell is shuffled.
    """
    cells = present(measurements).join(named.where("module > 0").select("feature", "module"), "feature")
    features = cells.groupBy("module", "feature").agg(F.avg("value").alias("centre"), F.stddev_samp("value").alias("sd"))
    features = materialise(features.withColumn("at", F.row_number().over(Window.partitionBy("module").orderBy("feature")) - 1), "features")
    z = F.when(F.col("sd") > 0, (F.col("value") - F.col("centre")) / F.col("sd")).otherwise(0.0)
    rows = cells.join(features, ["module", "feature"]).groupBy("module", "sample").agg(F.collect_list(F.struct("at", z.alias("z"))).alias("c"), F.avg(z).alias("mean"))
    rows = materialise(rows, "rows")

    def weighted(weights: DataFrame) -> DataFrame:
        """``rows`` with ``y``, each one's cells times the weights of its module."""
        u = weights.groupBy("module").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "u"))), lambda x: x["u"]).alias("u"))
        return rows.join(u, "module").withColumn("y", F.aggregate("c", F.lit(0.0), lambda acc, x: acc + x["z"] * F.get("u", x["at"]))).drop("u")

    def gathered(df: DataFrame, y: str) -> DataFrame:
        """New weights ``(module, at, u)`` of unit length; a module without any variance has none."""
        u = df.select("module", y, F.explode("c").alias("x")).groupBy("module", F.col("x.at").alias("at")).agg(F.sum(F.col("x.z") * F.col(y)).alias("u"))
        size = u.groupBy("module").agg(F.sqrt(F.sum(F.col("u") * F.col("u"))).alias("l")).where("l > 0")
        return u.join(size, "module").select("module", "at", (F.col("u") / F.col("l")).alias("u"))

    u = materialise(gathered(rows, "mean"), "weights")
    for _ in range(rounds - 1):
        new = materialise(gathered(weighted(u), "y"), "weights")
        # Profiles move by no more than about twice what the weights of unit length do.
        moved = new.join(u.withColumnRenamed("u", "old"), ["module", "at"]).groupBy("module").agg(F.sqrt(F.sum(F.pow(F.col("u") - F.col("old"), F.lit(2)))).alias("d")).agg(F.max("d")).first()[0]
        u = new
        if moved is None or moved < 1e-10:
            break
    v = weighted(u)
    size = v.groupBy("module").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("l"), F.when(F.sum(F.col("y") * F.col("mean")) < 0, -1.0).otherwise(1.0).alias("s")).where("l > 0")
    return v.join(materialise(size, "sizes"), "module").select("module", "sample", (F.col("y") / F.col("l") * F.col("s")).alias("value"))


def merge_modules(measurements: DataFrame, named: DataFrame, cut: float = 0.25, rounds: int = 5) -> DataFrame:
    """Modules whose profiles correlate above ``1 - cut`` become one, named by the smallest, until none do."""
    for _ in range(rounds):
        close = eigen_correlation(eigen_profiles(measurements, named)).where(F.col("r") > 1 - cut)
        comp = materialise(components(close), "merged")
        if not comp.limit(1).count():
            break
        named = materialise(named.join(comp.select(F.col("node").alias("module"), "component"), "module", "left").select("feature", F.coalesce("component", "module").alias("module")), "modules")
    return named


def membership(measurements: DataFrame, eigen: DataFrame, named: DataFrame) -> DataFrame:
    """``(module, feature, kme, place)``: correlation of members with their module's profile, the strongest first."""
    j = present(measurements).join(named.where("module > 0"), "feature").join(eigen.withColumnRenamed("value", "e"), ["module", "sample"])
    k = j.groupBy("module", "feature").agg(F.corr("value", "e").alias("kme"))
    return k.withColumn("place", F.row_number().over(Window.partitionBy("module").orderBy(F.col("kme").desc(), "feature")))


def module_trait(eigen: DataFrame, traits: DataFrame, min_n: int = 3) -> DataFrame:
    """``(module, trait, n, r, t)`` for every module and trait with ``min_n`` samples in common; :func:`with_p` adds p-values."""
    j = eigen.join(traits.where("x is not null"), "sample").groupBy("module", "trait").agg(F.count("*").alias("n"), F.corr("value", "x").alias("r")).where(F.col("n") >= min_n)
    return j.withColumn("t", F.when(F.abs("r") < 1, F.col("r") * F.sqrt((F.col("n") - 2) / (1 - F.col("r") * F.col("r")))))


def with_p(table: DataFrame) -> DataFrame:
    return bh_adjust(table.withColumn("p", t_sf2("t", (F.col("n") - 2).cast("double"))), "p")


def eigen_correlation(eigen: DataFrame) -> DataFrame:
    """``(a, b, r)`` between module profiles."""
    return pair_correlation(eigen.select(F.col("module").alias("feature"), "sample", "value"), "feature").select("a", "b", "r")


def relevance_vs_membership(measurements: DataFrame, traits: DataFrame, kme: DataFrame, hi: float = 0.8, gs: float = 0.2) -> DataFrame:
    """``(trait, module, feature, gs, kme, zone)``: absolute correlation with the trait against membership, in four zones."""
    g = present(measurements).join(traits.where("x is not null"), "sample").groupBy("trait", "feature").agg(F.abs(F.corr("value", "x")).alias("gs"))
    j = g.join(kme.select("module", "feature", F.abs("kme").alias("kme")), "feature")
    zone = F.when((F.col("kme") >= hi) & (F.col("gs") >= gs), "hub_relevant").when(F.col("kme") >= hi, "hub").when(F.col("gs") >= gs, "relevant").otherwise("background")
    return j.select("trait", "module", "feature", "gs", "kme", zone.alias("zone"))


def relevance_summary(relevance: DataFrame, table: DataFrame, q: float = 0.99, top: int = 5) -> DataFrame:
    """``(trait, module, n, rho, labels)``: for each trait the module of largest absolute correlation in ``table``, Spearman's rho of relevance
    and membership over its features, and the features beyond the quantile ``q`` of both, at most ``top`` by membership, comma-joined (null where there are none)."""
    best = table.where("r is not null").groupBy("trait").agg(F.max_by("module", F.struct(F.abs("r"), -F.col("module"))).alias("module"))
    x = relevance.where("gs is not null and kme is not null").join(F.broadcast(best), ["trait", "module"])
    ranked = x.withColumns({"rg": average_rank("gs", ["trait"]), "rk": average_rank("kme", ["trait"])})
    one = ranked.groupBy("trait", "module").agg(F.count("*").alias("n"), F.corr("rg", "rk").alias("rho"))
    cuts = x.groupBy("trait").agg(F.percentile("gs", F.lit(q)).alias("cut_gs"), F.percentile("kme", F.lit(q)).alias("cut_kme"))
    high = x.join(F.broadcast(cuts), "trait").where((F.col("gs") > F.col("cut_gs")) & (F.col("kme") > F.col("cut_kme")))
    high = high.withColumn("place", F.row_number().over(Window.partitionBy("trait").orderBy(F.col("kme").desc(), "feature"))).where(F.col("place") <= top)
    labels = high.groupBy("trait").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "feature"))), lambda v: v["feature"]), ",").alias("labels"))
    return one.join(labels, "trait", "left")


def module_significance(relevance: DataFrame, min_features: int = 3) -> DataFrame:
    return relevance.groupBy("trait", "module").agg(F.avg("gs").alias("significance"), F.count("*").alias("n")).where(F.col("n") >= min_features)


def strongest_module(table: DataFrame, kme: DataFrame, measurements: DataFrame, top: int = 50) -> DataFrame:
    """``(module, feature, place, sample, value)``: standardised cells of the module with the largest absolute trait correlation."""
    best = table.agg(F.max_by("module", F.struct(F.abs("r"), -F.col("module"))).alias("module"))
    own = kme.join(F.broadcast(best), "module").where(F.col("place") <= top)
    return row_zscore(measurements).join(own.select("module", "feature", "place"), "feature").select("module", "feature", "place", "sample", "value")
