"""Set enrichment and signed sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sets, signed
from ..functions.stats import bh_adjust
from .bindings import Data
from .registry import bh, chi2_p, query, r, rough_p


def ranked(d: Data) -> DataFrame:
    return sets.ranked_list(d.part_stat, stat="t", min_n=10)


def members(d: Data) -> DataFrame:
    return d.sets.join(d.part_stat.select("feature"), "feature", "left_semi")


def selected(d: Data) -> DataFrame:
    return d.part_stat.where("abs(t) > 0.5").select("feature", F.when(F.col("t") > 0, "up").otherwise("down").alias("direction"))


@query("f1_ranked_list", f"SELECT feature, {r('stat', 'stat')}, rank FROM ranked")
def f1(d: Data) -> DataFrame:
    return ranked(d)


@query("f2_size_window", "WITH z AS (SELECT set_id, count(*) AS size FROM members GROUP BY set_id) SELECT set_id, feature, size FROM members JOIN z USING (set_id) WHERE size BETWEEN 2 AND 900")
def f2(d: Data) -> DataFrame:
    return sets.size_window(d.sets, ranked(d), 2, 900)


@query("f3_running_sum", f"SELECT set_id, size, {r('es', 'es')} FROM es")
def f3(d: Data) -> DataFrame:
    return sets.running_sum(ranked(d), members(d))


@query("f4_set_null")
def f4(d: Data) -> DataFrame:
    return sets.set_null(ranked(d), members(d))


@query("f5_leading_edge", f"WITH x AS (SELECT walk.*, es FROM walk JOIN es USING (set_id)), e AS (SELECT set_id, min(rank) FILTER (hit_at = es) AS hi, max(rank) FILTER (hit_before = es) AS lo FROM x GROUP BY set_id) SELECT set_id, {r('es', 'es')}, string_agg(feature, '/' ORDER BY feature) AS edge FROM x JOIN e USING (set_id) WHERE CASE WHEN es >= 0 THEN rank <= hi ELSE rank >= lo END GROUP BY set_id, es")
def f5(d: Data) -> DataFrame:
    return sets.leading_edge(ranked(d), members(d))


_COUNTS = "c AS (SELECT direction, set_id, count(*) AS k FROM members JOIN selected USING (feature) GROUP BY 1, 2), z AS (SELECT set_id, count(*) AS set_size FROM members GROUP BY 1), i AS (SELECT direction, count(*) AS n_input FROM selected GROUP BY 1), ov AS (SELECT direction, set_id, k, set_size, n_input, (SELECT count(*) FROM part_stat) AS n_universe FROM c JOIN z USING (set_id) JOIN i USING (direction)), tail AS (SELECT *, (SELECT least(1.0, sum(exp(lgamma(set_size + 1) - lgamma(j + 1) - lgamma(set_size - j + 1) + lgamma(n_universe - set_size + 1) - lgamma(n_input - j + 1) - lgamma(n_universe - set_size - n_input + j + 1) - lgamma(n_universe + 1) + lgamma(n_input + 1) + lgamma(n_universe - n_input + 1)))) FROM (SELECT unnest(generate_series(k, least(set_size, n_input))) AS j)) AS p FROM ov)"


@query("f6_overlap_counts", f"WITH {_COUNTS} SELECT * FROM ov")
def f6_counts(d: Data) -> DataFrame:
    return sets.overlap_counts(selected(d), members(d), d.part_stat.select("feature"))


@query("f6_overlap_test", f"WITH {_COUNTS} SELECT direction, set_id, k, set_size, n_input, n_universe, {r('p', 'p')}, {r('adj', 'adj_p')}, {r('adj * CASE WHEN pi0 > 0 THEN least(1.0, pi0) ELSE 1.0 END', 'q')} FROM (SELECT *, least(1.0, min(p * m / place) OVER (PARTITION BY direction ORDER BY p DESC)) AS adj FROM (SELECT *, count(*) OVER (PARTITION BY direction) AS m, count(*) OVER (PARTITION BY direction ORDER BY p) AS place, count(*) FILTER (p > 0.5) OVER (PARTITION BY direction) / (count(*) OVER (PARTITION BY direction) * 0.5) AS pi0 FROM tail WHERE n_input >= 5))")
def f6(d: Data) -> DataFrame:
    return sets.overlap_test(selected(d), members(d), d.part_stat.select("feature"))


@query("f7_universe", "SELECT feature FROM part_stat")
def f7(d: Data) -> DataFrame:
    return sets.universe(d.part_stat, d.sets, "detected")


@query("f8_stack_common", f"WITH {_COUNTS} SELECT direction, set_id, k FROM ov WHERE direction = 'up' UNION ALL SELECT direction, set_id, k FROM ov WHERE direction = 'down'")
def f8(d: Data) -> DataFrame:
    x = sets.overlap_counts(selected(d), members(d), d.part_stat.select("feature"))
    return sets.stack_common([x.where("direction = 'up'").select("direction", "set_id", "k", "set_size"), x.where("direction = 'down'").select("direction", "set_id", "k", "n_input")])


_FOLD = "mem AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS set_id, CAST(l_partkey AS VARCHAR) AS feature FROM lineitem), z AS (SELECT set_id, count(*) AS n FROM mem GROUP BY 1), jp AS (SELECT x.set_id AS a, y.set_id AS b FROM mem x JOIN mem y ON x.feature = y.feature AND x.set_id <> y.set_id JOIN z zx ON zx.set_id = x.set_id JOIN z zy ON zy.set_id = y.set_id GROUP BY 1, 2, zx.n, zy.n HAVING count(*) * 1.0 / (zx.n + zy.n - count(*)) >= 0.16), reach(a, b) AS (SELECT set_id, set_id FROM z UNION SELECT reach.a, jp.b FROM reach JOIN jp ON reach.b = jp.a), comp AS (SELECT a AS set_id, min(b) AS cluster FROM reach GROUP BY a)"


@query("f9_fold_redundant", f"WITH {_FOLD} SELECT set_id, {r('1.0 / (CAST(set_id AS INT) + 1)', 'adj_p')}, cluster, count(*) OVER (PARTITION BY cluster) AS cluster_size, row_number() OVER (PARTITION BY cluster ORDER BY 1.0 / (CAST(set_id AS INT) + 1), set_id) = 1 AS representative FROM comp", recursive=True)
def f9(d: Data) -> DataFrame:
    mem = d.table("lineitem").select(F.col("l_suppkey").cast("string").alias("set_id"), F.col("l_partkey").cast("string").alias("feature"))
    terms = mem.select("set_id").distinct().withColumn("adj_p", 1.0 / (F.col("set_id").cast("int") + 1))
    return sets.fold_redundant(terms, mem, 0.16).select("set_id", "adj_p", "cluster", "cluster_size", "representative")


@query("f10_top_terms", f"WITH {_COUNTS}, t AS (SELECT direction, set_id, k, CAST(row_number() OVER (PARTITION BY direction ORDER BY k, set_id) AS INT) AS term_rank FROM ov) SELECT * FROM t WHERE term_rank <= 15")
def f10(d: Data) -> DataFrame:
    x = sets.overlap_counts(selected(d), members(d), d.part_stat.select("feature")).select("direction", "set_id", "k")
    return sets.top_terms(x, 15, "direction", "k")


@query("f11_q_values", f"WITH x AS (SELECT feature, p, adj_p, (SELECT count(*) FILTER (p > 0.5) / (count(*) * 0.5) FROM test) AS pi0 FROM test) SELECT feature, {r('p', 'p')}, {r('adj_p * CASE WHEN pi0 > 0 THEN least(1.0, pi0) ELSE 1.0 END', 'q')} FROM x")
def f11(d: Data) -> DataFrame:
    from .test_queries import test

    return sets.q_values(test(d).select("feature", "p"), "p", [])


def words(d: Data) -> DataFrame:
    """``(feature, n)``: in how many documents each word is, so that the texts are read once for all that the overlap asks of them."""
    from ..session import materialise

    return materialise(d.m3.groupBy("feature").agg(F.count("*").alias("n")), "words")


def chosen_words(detected: DataFrame) -> DataFrame:
    return detected.where("n >= 20").select("feature")


def overlap(d: Data) -> DataFrame:
    w = words(d)
    return signed.signed_set_overlap(d.signed_words(w), chosen_words(w), w)


_OVER = "det AS (SELECT DISTINCT feature FROM m3), sel AS (SELECT feature FROM m3 GROUP BY feature HAVING count(*) >= 20), per AS (SELECT source, count(*) AS n_targets, count(sel.feature) AS overlap FROM signed JOIN det ON det.feature = target LEFT JOIN sel ON sel.feature = target GROUP BY source HAVING count(*) >= 5), o AS (SELECT *, (SELECT count(*) FROM det) AS n_detected, (SELECT count(*) FROM sel) AS n_selected FROM per)"


@query("t1_signed_overlap", f"WITH {_OVER} SELECT source, n_targets, overlap, n_detected, n_selected, {r('n_targets * 1.0 * n_selected / n_detected', 'expected')}, {r('CASE WHEN (n_targets - overlap) * (n_selected - overlap) > 0 THEN overlap * 1.0 * (n_detected - n_targets - n_selected + overlap) / ((n_targets - overlap) * (n_selected - overlap)) END', 'cross_odds')} FROM o")
def t1(d: Data) -> DataFrame:
    return overlap(d).drop("p", "adj_p")


_HYPER = "lgamma(n_targets + 1) - lgamma(j + 1) - lgamma(n_targets - j + 1) + lgamma(n_detected - n_targets + 1) - lgamma(n_selected - j + 1) - lgamma(n_detected - n_targets - n_selected + j + 1) - lgamma(n_detected + 1) + lgamma(n_selected + 1) + lgamma(n_detected - n_selected + 1)"


@query(
    "t1_signed_overlap_p",
    f"WITH {_OVER}, tp AS (SELECT source, (SELECT least(1.0, sum(exp({_HYPER}))) FROM (SELECT unnest(generate_series(greatest(overlap, n_targets + n_selected - n_detected), least(n_targets, n_selected))) AS j)) AS p FROM o) SELECT source, {r('p', 'p')}, {r('least(1.0, min(p * m / place) OVER (ORDER BY p DESC))', 'adj_p')} FROM (SELECT *, count(*) OVER () AS m, count(*) OVER (ORDER BY p) AS place FROM tp)",
)
def t1_p(d: Data) -> DataFrame:
    return overlap(d).select("source", "p", "adj_p")


@query("t1_conditional_odds")
def t1_odds(d: Data) -> DataFrame:
    x = overlap(d)
    return signed.conditional_odds(x)


@query("t2_activity", f"SELECT source, sample, {r('activity', 'activity')}, n_targets FROM activity")
def t2(d: Data) -> DataFrame:
    return signed.signed_set_activity(d.m3, d.signed)


_TWO = "x AS (SELECT source, round(activity, 9) AS activity, arm FROM activity JOIN s3 USING (sample)), k AS (SELECT *, rank() OVER (PARTITION BY source ORDER BY activity) + (count(*) OVER (PARTITION BY source, activity) - 1) / 2.0 AS rk FROM x), ti AS (SELECT source, sum(t * t * t - t) AS ties FROM (SELECT source, activity, count(*) AS t FROM x GROUP BY 1, 2) GROUP BY 1), g AS (SELECT source, count(*) FILTER (arm = 'bad') AS n1, count(*) FILTER (arm = 'good') AS n2, sum(rk) FILTER (arm = 'good') AS w, avg(activity) FILTER (arm = 'bad') AS m1, avg(activity) FILTER (arm = 'good') AS m2, var_samp(activity) FILTER (arm = 'bad') AS v1, var_samp(activity) FILTER (arm = 'good') AS v2 FROM k GROUP BY 1), u AS (SELECT *, w - n2 * (n2 + 1) / 2.0 - n1 * n2 / 2.0 AS u, sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1.0)))) AS sd FROM g JOIN ti USING (source) WHERE n1 > 0 AND n2 > 0)"


@query("t3_two_arm_scores", f"WITH {_TWO} SELECT source, n1 AS n_first, n2 AS n_second, {r('m2 - m1', 'difference')}, {r('(m2 - m1) / sqrt((v1 + v2) / 2)', 'cohens_d')}, {r('CASE WHEN sd > 0 THEN (u - sign(u) * 0.5) / sd ELSE 0.0 END', 'z')} FROM u")
def t3(d: Data) -> DataFrame:
    x = signed.signed_set_activity(d.m3, d.signed).withColumn("activity", F.round("activity", 9))
    return signed.two_arm_scores(x, d.s3).drop("p", "adj_p")


_TWO_P = f"{_TWO}, zz AS (SELECT source, CASE WHEN sd > 0 THEN (u - sign(u) * 0.5) / sd ELSE 0.0 END AS z FROM u), pv AS (SELECT source, {chi2_p('z * z')} AS p FROM zz)"


@query("t3_two_arm_p", f"WITH {_TWO_P} SELECT source, {r('p', 'p')}, {r('adj_p', 'adj_p')} FROM ({bh('pv')})")
def t3_p(d: Data) -> DataFrame:
    x = signed.signed_set_activity(d.m3, d.signed).withColumn("activity", F.round("activity", 9))
    return signed.two_arm_scores(x, d.s3).select("source", "p", "adj_p")


@query("t4_overlap_input", f"WITH n AS (SELECT count(*) AS n FROM test WHERE adj_p < 0.05) SELECT feature, {r('p', 'p')}, 'fdr' AS selection FROM test, n WHERE adj_p < 0.05 AND n > 0 UNION ALL SELECT * FROM (SELECT feature, {r('p', 'p')}, 'ranked_fallback' FROM test, n WHERE n = 0 ORDER BY test.p, feature LIMIT 20)")
def t4(d: Data) -> DataFrame:
    from .test_queries import test

    return signed.overlap_input(test(d), 0.05, 20)


@query("t5_match_report", "WITH i AS (SELECT DISTINCT sample FROM m2), m AS (SELECT count(*) FILTER (s2.sample IS NOT NULL) AS matched, count(*) FILTER (s2.sample IS NULL) AS unmatched FROM i LEFT JOIN s2 USING (sample)) SELECT *, CASE WHEN matched = 0 THEN 'none' WHEN unmatched > 0 THEN 'partial' ELSE 'ok' END AS status FROM m")
def t5(d: Data) -> DataFrame:
    return signed.match_report(d.m2, d.s2)
