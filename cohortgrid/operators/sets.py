"""Set enrichment: sets are long ``(set_id, feature)``."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import bh_adjust, global_row_number, hyper_sf
from ..session import materialise
from .graph import components, shared_edges
from .matrix import first_wins


def ranked_list(test: DataFrame, id_map: DataFrame | None = None, stat: str = "t", min_n: int = 100) -> DataFrame:
    """``(feature, stat, rank)`` sorted by the statistic, largest first; ids are translated by ``id_map`` ``(feature, id)``.

    Null and non-finite statistics go; of repeated names the one with the largest absolute statistic stays. Fewer
    than ``min_n`` features give an empty list.
    """
    x = test.select("feature", F.col(stat).alias("stat")).where(F.col("stat").isNotNull() & ~F.isnan("stat") & (F.abs("stat") < float("inf")))
    x = first_wins(x, ["feature"], F.abs("stat").desc())
    if id_map is not None:
        x = x.join(id_map, "feature").select(F.col("id").alias("feature"), "stat")
        x = first_wins(x, ["feature"], F.abs("stat").desc())
    enough = x.agg((F.count("*") >= min_n).alias("enough"))
    x = x.join(F.broadcast(enough), F.lit(True)).where("enough").drop("enough")
    return global_row_number(x, [F.col("stat").desc(), F.col("feature")])


def size_window(sets: DataFrame, ranked: DataFrame, lo: int = 15, hi: int = 500) -> DataFrame:
    """Members present in the list, of sets that have between ``lo`` and ``hi`` of them."""
    inside = sets.join(ranked.select("feature"), "feature", "left_semi").distinct()
    sizes = inside.groupBy("set_id").agg(F.count("*").alias("size")).where(F.col("size").between(lo, hi))
    return inside.join(sizes, "set_id")


def _walk(ranked: DataFrame, sets: DataFrame) -> DataFrame:
    """Hits of each set in rank order with the running sum just before and at each hit."""
    n = ranked.agg(F.count("*").alias("n_all"))
    hits = sets.select("set_id", "feature").join(ranked, "feature").join(F.broadcast(n), F.lit(True)).withColumn("w", F.abs("stat"))
    up, whole = Window.partitionBy("set_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow), Window.partitionBy("set_id")
    hits = hits.withColumns({"i": F.row_number().over(Window.partitionBy("set_id").orderBy("rank")), "m": F.count("*").over(whole), "total": F.sum("w").over(whole), "cum": F.sum("w").over(up)})
    miss = F.when(F.col("n_all") > F.col("m"), (F.col("rank") - F.col("i")) / (F.col("n_all") - F.col("m"))).otherwise(0.0)
    return hits.where("total > 0").withColumns({"at": F.col("cum") / F.col("total") - miss, "before": (F.col("cum") - F.col("w")) / F.col("total") - miss})


def running_sum(ranked: DataFrame, sets: DataFrame) -> DataFrame:
    """``(set_id, size, es)``: the extreme of the weighted running sum, from the hits alone."""
    one = _walk(ranked, sets).groupBy("set_id").agg(F.max("m").alias("size"), F.max("at").alias("up"), F.min("before").alias("down"))
    return one.select("set_id", "size", F.when(F.col("up") >= -F.col("down"), F.col("up")).otherwise(F.col("down")).alias("es"))


def leading_edge(ranked: DataFrame, sets: DataFrame) -> DataFrame:
    """``(set_id, es, edge)``: the sorted members up to the extreme, or from it on where the score is negative."""
    walk = _walk(ranked, sets).join(running_sum(ranked, sets).select("set_id", "es"), "set_id")
    ends = walk.groupBy("set_id").agg(F.min(F.when(F.col("at") == F.col("es"), F.col("rank"))).alias("hi"), F.max(F.when(F.col("before") == F.col("es"), F.col("rank"))).alias("lo"))
    inside = walk.join(ends, "set_id").where(F.when(F.col("es") >= 0, F.col("rank") <= F.col("hi")).otherwise(F.col("rank") >= F.col("lo")))
    return inside.groupBy("set_id", "es").agg(F.array_join(F.array_sort(F.collect_list("feature")), "/").alias("edge"))


def _draws(features: DataFrame, perms: int, size: int, seed: int) -> DataFrame:
    """``(perm, feature, place)``: the first ``size`` features of each of ``perms`` hash orders.

    Only features whose hash lies below a bound are ranked, all permutations together over ranges; where a bound was too low
    for a permutation, it is raised.
    """
    n = features.count()
    share = (size + 6 * math.sqrt(size) + 16) / max(1, n)
    hashed = features.withColumn("perm", F.explode(F.sequence(F.lit(1), F.lit(perms)))).withColumn("key", F.xxhash64("feature", "perm", F.lit(seed)))
    while True:
        few = materialise(hashed.where(F.col("key") < F.lit(int(-(2**63) + min(1.0, share) * 2**64 - 1))) if share < 1 else hashed, "draws")
        counts = few.groupBy("perm").agg(F.count("*").alias("n"))
        if share >= 1 or counts.where(F.col("n") >= min(size, n)).count() == perms:
            break
        share *= 2
    ranked = global_row_number(few, [F.col("perm"), F.col("key"), F.col("feature")], "at")
    ranked = materialise(ranked.select("perm", "feature", "at"), "ranked")
    first = ranked.groupBy("perm").agg(F.min("at").alias("first"))
    return ranked.join(F.broadcast(first), "perm").select("perm", "feature", (F.col("at") - F.col("first") + 1).alias("place")).where(F.col("place") <= size)


def set_null(ranked: DataFrame, sets: DataFrame, perms: int = 200, seed: int = 1) -> DataFrame:
    """``(set_id, size, es, nes, p, adj_p)`` against random sets of the same size.

    The random sets of a permutation are prefixes of one hash order of the list, shared by all sets
    of a size, so that results repeat. The least p-value is ``1 / (perms + 1)``.
    """
    observed = running_sum(ranked, sets)
    sizes = observed.select("size").distinct()
    largest = sizes.agg(F.max("size")).first()[0] or 0
    draws = _draws(ranked.select("feature"), perms, largest, seed)
    random_sets = draws.join(F.broadcast(sizes), F.col("place") <= F.col("size")).select(F.struct("size", "perm").alias("set_id"), "feature")
    null = running_sum(ranked, random_sets).select(F.col("set_id.size").alias("size"), F.col("es").alias("null_es"))
    per = observed.join(null, "size").groupBy("set_id", "size", "es").agg(
        F.avg(F.when(F.signum("null_es") == F.signum("es"), F.abs("null_es"))).alias("scale"),
        F.count_if((F.signum("null_es") == F.signum("es")) & (F.abs("null_es") >= F.abs("es"))).alias("beyond"),
        F.count_if(F.signum("null_es") == F.signum("es")).alias("same"),
    )
    per = per.select("set_id", "size", "es", (F.col("es") / F.col("scale")).alias("nes"), ((F.col("beyond") + 1) / (F.col("same") + 1)).alias("p"))
    return bh_adjust(per, "p")


def universe(test: DataFrame, every: DataFrame, mode: str = "detected") -> DataFrame:
    """The features an overlap is judged against: those measured, or all."""
    return (test if mode == "detected" else every).select("feature").distinct()


def overlap_counts(selected: DataFrame, sets: DataFrame, universe: DataFrame) -> DataFrame:
    """``(direction, set_id, k, set_size, n_input, n_universe)`` of ``selected`` ``(feature, direction)``."""
    inside = sets.join(universe, "feature", "left_semi").distinct()
    chosen = selected.join(universe, "feature", "left_semi").select("feature", "direction").distinct()
    sizes, inputs = inside.groupBy("set_id").agg(F.count("*").alias("set_size")), chosen.groupBy("direction").agg(F.count("*").alias("n_input"))
    k = inside.join(chosen, "feature").groupBy("direction", "set_id").agg(F.count("*").alias("k"))
    return k.join(sizes, "set_id").join(inputs, "direction").join(F.broadcast(universe.agg(F.count("*").alias("n_universe"))), F.lit(True))


def overlap_test(selected: DataFrame, sets: DataFrame, universe: DataFrame, min_input: int = 5) -> DataFrame:
    """Over-representation of sets among the selected features of each direction: ``p, adj_p, q`` and the counts."""
    k = overlap_counts(selected, sets, universe).where(F.col("n_input") >= min_input)
    tested = bh_adjust(k.withColumn("p", hyper_sf("k", "n_universe", "set_size", "n_input")), "p", ["direction"])
    return q_values(tested, "p", ["direction"])


def stack_common(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames on the columns they share, in the order of the first; of no frames there are no columns, so that is an error."""
    if not frames:
        raise ValueError("no tables to stack")
    shared = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
    out = frames[0].select(shared)
    for f in frames[1:]:
        out = out.unionByName(f.select(shared))
    return out


#: Lists of more sets than ``SHORT`` are compared in blocks of ``BLOCK`` sets.
SHORT, BLOCK = 64, 512
#: Up to this threshold all members list a set, unless they make more than ``MOST_COUNTED`` pairs for each set.
ALL_MEMBERS, MOST_COUNTED = 0.3, 20_000


def _compare(threshold: float):
    """Pairs of two blocks of a list that reach the threshold, by counting common members of one set with all others at once."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf.i.iat[0] == pdf.j.iat[0]
        left, right = (pdf, pdf) if own else (pdf[pdf.side == 0], pdf[pdf.side == 1])
        if left.empty or right.empty:
            return pd.DataFrame(columns=["a", "b", "jaccard"])
        names = right.set_id.to_numpy()
        sizes = right.members.map(len).to_numpy()
        flat = np.concatenate(list(right.members))
        owner = np.repeat(np.arange(len(right)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        out = []
        for name, x in zip(left.set_id, left.members):
            first = np.searchsorted(flat, x, "left")
            spans = np.searchsorted(flat, x, "right") - first
            shared = np.bincount(owner[np.repeat(first - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())], minlength=len(right))
            jaccard = shared / (len(x) + sizes - shared)
            at = np.flatnonzero((jaccard >= threshold) & (names > name if own else names != name))
            out += [(min(name, names[k]), max(name, names[k]), float(jaccard[k])) for k in at]
        return pd.DataFrame(out, columns=["a", "b", "jaccard"])

    return compare


def _one_row(members: DataFrame) -> DataFrame:
    """``(set_id, members, content)`` of each set, written: the sorted hashes of its members, and what tells equal sets. Null members and sets don't count."""
    named = members.where("set_id is not null and feature is not null").groupBy("set_id").agg(F.array_sort(F.collect_set("feature")).alias("f"))
    content = F.struct(F.xxhash64("f").alias("a"), F.size("f").alias("n"), F.aggregate("f", F.lit(0).cast("long"), lambda x, f: x.bitwiseXOR(F.xxhash64(F.lit(1), f))).alias("b"))
    return materialise(named.select("set_id", content.alias("content"), F.array_sort(F.transform("f", lambda f: F.xxhash64(f))).alias("members")), "sets")


def _first(size: Column, threshold: float) -> Column:
    """So many of the rarest members must hold one that a set at the threshold has too."""
    return F.greatest(F.lit(1), F.least(size, size - F.ceil(size * F.lit(threshold) - 1e-9).cast("int") + 1))


def _shared(lists: DataFrame, sizes: DataFrame, numbers: DataFrame, threshold: float, lacking: bool) -> DataFrame:
    """``(a, b, na, nb, score)`` of numbers of sets with ``score`` equal ``h`` in ``lists`` ``(number, h)`` of ``sizes`` ``(via, n)``, where these may do for the threshold.

    ``numbers`` ``(number, size, set_id)`` are in the order of size. Pairs are counted where a set's followers in all lists are (:func:`shared_edges`), so none is a row
    before it is counted. Where ``lacking``, the lists are of the rarest members, and the others of either set count as common.
    """
    end = lambda c: numbers.select(F.col("number").alias(c), F.col("size").alias(f"n{c}"))
    reach = lambda most, other: most >= (F.col("na") + other - most) * F.lit(threshold) - 1e-9
    pair = shared_edges(lists, "number", "h", sizes).join(end("a"), "a")
    if not lacking:
        pair = pair.where(reach(F.col("score"), F.col("na")))
    pair = pair.join(end("b"), "b")
    most = F.col("score") + F.greatest(*(F.col(n) - _first(F.col(n), threshold) for n in ("na", "nb"))) if lacking else F.col("score")
    return pair.where(reach(F.least(most, F.col("na")), F.col("nb"))).select("a", "b", "na", "nb", "score")


def jaccard_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, jaccard)`` of sets that share a member and reach the threshold. A set must fit a row. Null members and sets of none don't count."""
    return _similar(_one_row(members), threshold)


def _similar(whole: DataFrame, threshold: float) -> DataFrame:
    """The pairs of :func:`jaccard_pairs` among rows ``(set_id, members)``.

    Two sets at the threshold share one of the rarest members of each, as many as leave too few for it. Where these make much fewer pairs than all members, only these
    list a set; pairs are counted in place, and those whose count, with all that the lists lack, may reach the threshold are compared. Otherwise
    all members list a set, and the count is the number of common ones. The sets of a list of more than ``SHORT`` rare members are compared in blocks, so that a member
    of very many sets makes no pair for each two of them.
    """
    numbered = global_row_number(whole.select("set_id", F.size("members").alias("size")), [F.col("size"), F.col("set_id")], "number")
    numbers = materialise(numbered.select("set_id", "size", F.col("number").cast("int").alias("number")), "numbers")
    each = whole.select("set_id", F.explode("members").alias("h"))
    df = materialise(each.groupBy("h").agg(F.count("*").alias("df")), "frequencies")
    every = df.agg(F.sum(F.col("df") * (F.col("df") - 1) / 2)).first()[0] or 0
    name = lambda pair: pair.join(numbers.select(F.col("number").alias("a"), F.col("set_id").alias("x")), "a").join(numbers.select(F.col("number").alias("b"), F.col("set_id").alias("y")), "b")
    jaccard = lambda shared: (shared / (F.col("na") + F.col("nb") - shared)).alias("jaccard")
    ends = [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")]
    # Below a threshold of 0.3 the rarest are more than two thirds of a set, and spare less than half the pairs.
    if threshold <= ALL_MEMBERS and every <= MOST_COUNTED * max(1, whole.count()):
        pair = _shared(whole.join(numbers, "set_id").select("number", F.explode("members").alias("h")), df.select(F.col("h").alias("via"), F.col("df").alias("n")), numbers, threshold, False)
        return name(pair).select(*ends, jaccard(F.col("score"))).where(F.col("jaccard") >= threshold)
    ranked = each.join(df, "h").groupBy("set_id").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("m"))
    first = F.transform(F.slice("m", F.lit(1), _first(F.size("m"), threshold)), lambda x: x["h"])
    listed = materialise(ranked.select("set_id", F.explode(first).alias("h")), "first")
    n = materialise(listed.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "lengths")
    listed = materialise(listed.join(n, "h").join(numbers, "set_id"), "lists")
    # A pair that a long list holds as well is compared there.
    pair = _shared(listed.where(F.col("n") <= SHORT).select("number", "h"), n.where(F.col("n") <= SHORT).select(F.col("h").alias("via"), "n"), numbers, threshold, True)
    side = lambda name, x: whole.select(F.col("set_id").alias(name), F.col("members").alias(x))
    near = name(pair).select("x", "y", "na", "nb").join(side("x", "mx"), "x").join(side("y", "my"), "y")
    near = near.select(*ends, jaccard(F.size(F.array_intersect("mx", "my")))).where(F.col("jaccard") >= threshold)
    rows = listed.where(F.col("n") > SHORT).select("set_id", "h", "n").join(whole.select("set_id", "members"), "set_id").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("set_id", "h"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j"), F.when(j < F.col("block"), 1).otherwise(0).alias("side")))
    rows = rows.withColumn("meet", F.explode(meets)).select("h", "set_id", "members", "meet.*")
    kind = whole.schema["set_id"].dataType.simpleString()
    return near.unionByName(rows.groupBy("h", "i", "j").applyInPandas(_compare(threshold), f"a {kind}, b {kind}, jaccard double")).distinct()


def fold_redundant(terms: DataFrame, members: DataFrame, jaccard: float = 0.5) -> DataFrame:
    """``terms`` ``(set_id, adj_p)`` with ``cluster, cluster_size, representative``: single linkage by Jaccard, the lowest adjusted p represents. A threshold of 1 or more folds nothing.

    Equal sets are linked to the smallest name among them, which alone is compared with others.
    """
    if jaccard < 1:
        whole = _one_row(members.select("set_id", "feature").join(terms.select("set_id"), "set_id", "left_semi"))
        equal = whole.select("set_id", "content").join(whole.groupBy("content").agg(F.min("set_id").alias("first")), "content").select("set_id", "first")
        alone = whole.select("set_id", "members").join(equal.where(F.col("set_id") == F.col("first")).select("set_id"), "set_id", "left_semi")
        links = _similar(alone, jaccard).select("a", "b").unionByName(equal.where(F.col("set_id") != F.col("first")).select(F.col("set_id").alias("a"), F.col("first").alias("b")))
        found = components(links).select(F.col("node").alias("set_id"), F.col("component").alias("cluster"))
        named = terms.join(found, "set_id", "left").withColumn("cluster", F.coalesce("cluster", "set_id"))
    else:
        named = terms.withColumn("cluster", F.col("set_id"))
    by = Window.partitionBy("cluster")
    best = F.row_number().over(by.orderBy("adj_p", "set_id")) == 1
    return named.withColumn("cluster_size", F.count("*").over(by)).withColumn("representative", best)


def top_terms(terms: DataFrame, n: int = 15, by: str = "direction", order: str = "adj_p") -> DataFrame:
    """The first ``n`` terms of each ``by`` in ``order``."""
    return terms.withColumn("term_rank", F.row_number().over(Window.partitionBy(by).orderBy(order, "set_id"))).where(F.col("term_rank") <= n)


def q_values(df: DataFrame, p_col: str, by: list[str], lam: float = 0.5) -> DataFrame:
    """``df`` with ``q``: adjusted p-values scaled by the share of true nulls, from the p-values above ``lam``."""
    share = lambda above, n: F.least(F.lit(1.0), above / (n * (1 - lam)))
    above, n = F.count(F.when(F.col(p_col) > lam, 1)), F.count(p_col)
    if by:
        whole = Window.partitionBy(*by)
        pi0, rows = share(above.over(whole), n.over(whole)), df
    else:
        pi0, rows = share(F.col("_above"), F.col("_n")), df.join(F.broadcast(df.agg(above.alias("_above"), n.alias("_n"))), F.lit(True))
    out = bh_adjust(rows, p_col, by, "_bh").withColumn("_pi0", F.when(pi0 > 0, pi0).otherwise(1.0))
    return out.withColumn("q", F.col("_bh") * F.col("_pi0")).drop("_bh", "_pi0", "_above", "_n")
