"""Quality control and per-feature tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import bh_adjust
from ..operators import qc, testing
from .bindings import Data
from .registry import bh, query, r, rough_p, t_p

LFC = 0.01


def fit(d: Data) -> DataFrame:
    return testing.two_group_fit(d.m1, d.s1, "a1", "a0")


def test(d: Data) -> DataFrame:
    """Test table with ``rough_p``."""
    t = fit(d).withColumn("t", F.col("lfc") / (F.sqrt("s2") * F.col("se_unscaled")))
    return bh_adjust(t.withColumn("p", rough_p(F.col("t"))), "p").select("feature", "lfc", "ave", "t", "p", "adj_p")


@query("d1_box_summary", f"WITH q AS (SELECT sample, quantile_cont(value, [0.25, 0.5, 0.75]) AS q, min(value) AS lo, max(value) AS hi FROM m2 GROUP BY sample) SELECT sample, {r('lo', 'min')}, {r('q[1]', 'q1')}, {r('q[2]', 'median')}, {r('q[3]', 'q3')}, {r('hi', 'max')}, {r('min(value)', 'whisker_low')}, {r('max(value)', 'whisker_high')} FROM m2 JOIN q USING (sample) WHERE value >= q[1] - 1.5 * (q[3] - q[1]) AND value <= q[3] + 1.5 * (q[3] - q[1]) GROUP BY sample, lo, hi, q")
def d1(d: Data) -> DataFrame:
    return qc.box_summary(d.m2)


@query("d2_density_bins", f"WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM m1), n AS (SELECT sample, CAST(least(floor((value - lo) / (hi - lo) * 32), 31) AS INT) AS bin, count(*) AS n FROM m1, e GROUP BY 1, 2) SELECT sample, bin, n, {r('n * 1.0 / sum(n) OVER (PARTITION BY sample)', 'share')} FROM n")
def d2(d: Data) -> DataFrame:
    return qc.density_bins(d.m1)


@query("d3_pca")
def d3(d: Data) -> DataFrame:
    return qc.pca(d.m1, 3)


_ELL = "WITH p AS (SELECT arm, max(value) FILTER (feature = 'f00') AS x, max(value) FILTER (feature = 'f01') AS y FROM m1 JOIN s1 USING (sample) GROUP BY arm, sample), m AS (SELECT arm, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_samp(x) AS a, var_samp(y) AS c, covar_samp(x, y) AS b FROM p GROUP BY arm), e AS (SELECT *, sqrt(((a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b)) * 5.991464547107979) AS r1, sqrt(((a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b)) * 5.991464547107979) AS r2, atan2(2 * b, a - c) / 2 AS turn FROM m WHERE n >= 3 AND a * c - b * b > 0), s AS (SELECT *, unnest(range(120)) AS step FROM e)"


@query("d4_normal_ellipse", f"{_ELL} SELECT arm, CAST(step AS INT) AS step, {r('mx + r1 * cos(step * 2 * pi() / 120) * cos(turn) - r2 * sin(step * 2 * pi() / 120) * sin(turn)', 'x')}, {r('my + r1 * cos(step * 2 * pi() / 120) * sin(turn) + r2 * sin(step * 2 * pi() / 120) * cos(turn)', 'y')} FROM s")
def d4(d: Data) -> DataFrame:
    x = d.m1.where("feature in ('f00', 'f01')").join(d.s1, "sample").groupBy("arm", "sample").agg(F.max(F.when(F.col("feature") == "f00", F.col("value"))).alias("x"), F.max(F.when(F.col("feature") == "f01", F.col("value"))).alias("y"))
    return qc.normal_ellipse(x)


@query("d5_pair_correlation", f"SELECT a, b, n, {r('r', 'r')} FROM cpairs")
def d5(d: Data) -> DataFrame:
    return qc.pair_correlation(d.m1)


@query("d6_spearman", f"WITH k AS (SELECT feature, sample, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS value FROM m1) SELECT x.feature AS a, y.feature AS b, count(*) AS n, {r('corr(x.value, y.value)', 'r')} FROM k x JOIN k y ON x.sample = y.sample AND x.feature < y.feature GROUP BY 1, 2")
def d6(d: Data) -> DataFrame:
    return qc.pair_correlation(d.m1, "feature", "spearman")


@query("d7_outliers", f"SELECT a AS sample, {r('min(r)', 'min_r')}, min(r) < 0.8 AS outlier FROM csym GROUP BY a")
def d7(d: Data) -> DataFrame:
    return qc.sample_correlation_outliers(d.m1)


_ARM = "arms AS (SELECT c.a, x.arm AS arm_a, y.arm AS arm_b, r FROM csym c JOIN s1 x ON x.sample = c.a JOIN s1 y ON y.sample = c.b)"


@query("d8_arm_correlation", f"WITH {_ARM} SELECT a AS sample, arm_a AS arm, {r('avg(r) FILTER (arm_a = arm_b)', 'within')}, {r('avg(r) FILTER (arm_a <> arm_b)', 'between')} FROM arms GROUP BY a, arm_a UNION ALL SELECT NULL, NULL, {r('avg(r) FILTER (arm_a = arm_b)', 'within')}, {r('avg(r) FILTER (arm_a <> arm_b)', 'between')} FROM arms")
def d8(d: Data) -> DataFrame:
    return qc.arm_correlation(d.m1, d.s1)


@query("d9_shift_confounded", f"WITH {_ARM} SELECT {r('avg(r) FILTER (arm_a = arm_b)', 'within')}, {r('avg(r) FILTER (arm_a <> arm_b)', 'between')}, avg(r) FILTER (arm_a <> arm_b) < 0.8 AS shift_confounded FROM arms")
def d9(d: Data) -> DataFrame:
    return qc.shift_confounded(qc.arm_correlation(d.m1, d.s1))


@query("d10_clusters", "WITH e AS (SELECT a, b FROM csym WHERE r >= 0.9), nodes AS (SELECT DISTINCT a FROM csym), reach(a, b) AS (SELECT a, a FROM nodes UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a) SELECT a AS sample, min(b) AS cluster FROM reach GROUP BY a", recursive=True)
def d10(d: Data) -> DataFrame:
    return qc.correlation_clusters(d.m1)


@query(
    "d10_cluster_verdict",
    f"WITH e AS (SELECT a, b FROM csym WHERE r >= 0.9), nodes AS (SELECT DISTINCT a FROM csym), reach(a, b) AS (SELECT a, a FROM nodes UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a), cl AS (SELECT a, min(b) AS c FROM reach GROUP BY a), m AS (SELECT avg(r) FILTER (x.c = y.c) AS within, avg(r) FILTER (x.c <> y.c) AS between FROM cpairs p JOIN cl x ON x.a = p.a JOIN cl y ON y.a = p.b) SELECT (SELECT count(DISTINCT c) FROM cl) AS n_clusters, {r('within', 'within')}, {r('between', 'between')}, CASE WHEN (SELECT count(DISTINCT c) FROM cl) = 1 THEN 'one_cluster' WHEN within - between >= 0.1 THEN 'separated' ELSE 'weak' END AS verdict FROM m",
    recursive=True,
)
def d10_verdict(d: Data) -> DataFrame:
    return qc.cluster_verdict(d.m1, qc.correlation_clusters(d.m1))


@query("e1_two_group_fit", f"SELECT feature, {r('lfc', 'lfc')}, {r('ave', 'ave')}, n1, n0, {r('s2', 's2')}, df, {r('sqrt(1.0 / n1 + 1.0 / n0)', 'se_unscaled')} FROM fit")
def e1(d: Data) -> DataFrame:
    return fit(d)


@query(
    "e2_paired_fit",
    f"WITH x AS (SELECT p.feature, s.pair_id, max(value) FILTER (arm = 'F') - max(value) FILTER (arm = 'O') AS diff, (max(value) FILTER (arm = 'F') + max(value) FILTER (arm = 'O')) / 2 AS mid FROM pairs p JOIN pair_samples s USING (sample) GROUP BY 1, 2) SELECT feature, {r('avg(diff)', 'lfc', 4)}, {r('avg(mid)', 'ave', 4)}, count(diff) AS n1, count(diff) AS n0, {r('var_samp(diff)', 's2', 2)}, CAST(count(diff) - 1 AS DOUBLE) AS df, {r('sqrt(1.0 / count(diff))', 'se_unscaled')} FROM x WHERE diff IS NOT NULL GROUP BY feature HAVING count(diff) > 1",
)
def e2(d: Data) -> DataFrame:
    x = testing.paired_fit(d.pairs, d.pair_samples, "F", "O")
    return x.withColumns({"lfc": F.round("lfc", 4), "ave": F.round("ave", 4), "s2": F.round("s2", 2)})


@query("e2_paired_or_plain", f"SELECT feature, {r('lfc', 'lfc')}, n1, n0, df, 'two_group' AS design, 'no pair_id column' AS reason FROM fit")
def e2_plain(d: Data) -> DataFrame:
    return testing.paired_or_plain_fit(d.m1, d.s1, "a1", "a0").select("feature", "lfc", "n1", "n0", "df", "design", "reason")


@query("e3_plain_t", f"WITH pv AS (SELECT feature, lfc, t, {t_p('t', 'df')} AS p FROM tstat) SELECT feature, {r('lfc', 'lfc')}, {r('t', 't')}, {r('p', 'p')}, {r('adj_p', 'adj_p')} FROM ({bh('pv')})")
def e3(d: Data) -> DataFrame:
    return testing.plain_test(fit(d)).select("feature", "lfc", "t", "p", "adj_p")


@query("e3_moderated")
def e3_moderated(d: Data) -> DataFrame:
    return testing.moderate(fit(d))


@query("e3_moderated_trend_robust")
def e3_trend(d: Data) -> DataFrame:
    return testing.moderate(testing.two_group_fit(d.m3, d.s3, "good", "bad"), trend=True, robust=True)


@query("e4_bh_adjust", f"SELECT feature, {r('p', 'p')}, {r('adj_p', 'adj_p')} FROM test")
def e4(d: Data) -> DataFrame:
    return test(d).select("feature", "p", "adj_p")


@query("e4_ranks_at_scale", f"SELECT l_orderkey, l_linenumber, {r('l_extendedprice', 'l_extendedprice')}, row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber) AS rank FROM lineitem")
def e4_ranks(d: Data) -> DataFrame:
    from ..functions.stats import global_row_number

    return global_row_number(d.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), [F.col("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")])


@query("e5_guard_null_p", f"SELECT feature, {r('coalesce(CASE WHEN t > 0 THEN p END, 1.0)', 'p')}, {r('coalesce(CASE WHEN t > 0 THEN adj_p END, 1.0)', 'adj_p')} FROM test")
def e5(d: Data) -> DataFrame:
    x = test(d).withColumns({"p": F.when(F.col("t") > 0, F.col("p")), "adj_p": F.when(F.col("t") > 0, F.col("adj_p"))})
    return testing.guard_null_p(x).select("feature", "p", "adj_p")


@query("e6_significant", f"SELECT feature, {r('lfc', 'lfc')}, {r('adj_p', 'adj_p')}, CASE WHEN lfc > 0 THEN 'up' ELSE 'down' END AS direction FROM test WHERE adj_p < 0.5 AND abs(lfc) > {LFC}")
def e6(d: Data) -> DataFrame:
    return testing.significant(test(d), 0.5, LFC).select("feature", "lfc", "adj_p", "direction")


_TIER = f"SELECT *, CASE WHEN adj_p < 0.05 AND abs(lfc) > {LFC} THEN 'fdr' WHEN p < 0.05 AND abs(lfc) > {LFC} THEN 'nominal' ELSE 'ns' END AS tier, CASE WHEN lfc > 0 THEN 'up' ELSE 'down' END AS direction, -log10(greatest(p, 1e-300)) AS y FROM test"


@query("e7_tiers", f"SELECT feature, {r('lfc', 'lfc')}, {r('t', 't')}, tier, direction, {r('y', 'y')} FROM ({_TIER})")
def e7(d: Data) -> DataFrame:
    return testing.tiers(test(d), 0.05, LFC).select("feature", "lfc", "t", "tier", "direction", "y")


@query("e8_label_rows", f"WITH x AS ({_TIER}), k AS (SELECT feature, tier, direction, CAST(row_number() OVER (PARTITION BY tier, direction ORDER BY p, feature) AS INT) AS label_rank, (SELECT count(*) FROM x WHERE tier = 'fdr') AS n FROM x WHERE tier <> 'ns') SELECT feature, tier, direction, label_rank FROM k WHERE (n > 0 AND tier = 'fdr' AND label_rank <= 10) OR (n = 0 AND label_rank <= 8)")
def e8(d: Data) -> DataFrame:
    return testing.label_rows(testing.tiers(test(d), 0.05, LFC)).select("feature", "tier", "direction", "label_rank")


@query("e9_p_histogram", "SELECT CAST(least(floor(p * 40), 39) AS INT) AS bin, count(*) AS n FROM test GROUP BY 1")
def e9(d: Data) -> DataFrame:
    return testing.p_histogram(test(d))


@query("e9_diagnosis", f"WITH o AS (SELECT count(*) AS n, avg(CASE WHEN p < 0.05 THEN 1.0 ELSE 0.0 END) AS share, avg(CASE WHEN p > 0.95 THEN 1.0 ELSE 0.0 END) AS high FROM test) SELECT n, {r('share', 'share')}, {r('share / 0.05', 'excess')}, CASE WHEN share / 0.05 >= 2 THEN 'strong_signal' WHEN share / 0.05 >= 1.2 THEN 'weak_signal' WHEN high > 0.1 THEN 'conservative' ELSE 'no_signal' END AS verdict FROM o")
def e9_diagnosis(d: Data) -> DataFrame:
    return testing.p_value_diagnosis(test(d))


@query(
    "e10_select_features",
    f"WITH s AS (SELECT feature FROM test WHERE adj_p < 0.05 AND abs(lfc) > {LFC}), f AS (SELECT feature FROM test WHERE abs(lfc) > {LFC} ORDER BY p, feature LIMIT 20), n AS (SELECT count(*) AS n FROM s), pick AS (SELECT feature, 'fdr' AS selection FROM s, n WHERE n >= 5 UNION ALL SELECT feature, 'ranked_fallback' FROM f, n WHERE n < 5) SELECT feature, {r('lfc', 'lfc')}, CASE WHEN lfc > 0 THEN 'up' ELSE 'down' END AS direction, selection FROM pick JOIN test USING (feature)",
)
def e10(d: Data) -> DataFrame:
    return testing.select_features(test(d), 0.05, LFC, 5, 20).select("feature", "lfc", "direction", "selection")


@query("e11_heatmap_rows", f"WITH s AS (SELECT feature FROM test WHERE adj_p < 0.05 AND abs(lfc) > {LFC} ORDER BY adj_p, p, feature LIMIT 50), f AS (SELECT feature FROM test ORDER BY p, feature LIMIT 20), n AS (SELECT count(*) AS n FROM s) SELECT feature FROM s UNION ALL SELECT feature FROM f, n WHERE n = 0")
def e11(d: Data) -> DataFrame:
    return testing.heatmap_rows(test(d), 0.05, LFC).select("feature")


@query("e12_test_summary", f"SELECT count(*) AS n, count(*) FILTER (adj_p < 0.5 AND lfc > {LFC}) AS n_up, count(*) FILTER (adj_p < 0.5 AND lfc < -{LFC}) AS n_down, {r('min(adj_p)', 'min_adj_p')}, (SELECT string_agg(feature, ',' ORDER BY p, feature) FROM (SELECT feature, p FROM test ORDER BY p, feature LIMIT 10)) AS top FROM test")
def e12(d: Data) -> DataFrame:
    return testing.test_summary(test(d), 0.5, LFC)
