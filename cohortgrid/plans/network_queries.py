"""Networks and modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph, modules, qc
from ..session import materialise
from .bindings import Data
from .registry import bh, query, r, t_p


def nodes(d: Data) -> DataFrame:
    return d.table("supplier").where("s_nationkey < 12").select(F.col("s_suppkey").alias("node"))


_INSIDE = "inside AS (SELECT a, b, score FROM edges SEMI JOIN (SELECT s_suppkey AS a FROM supplier WHERE s_nationkey < 12) USING (a)), sub AS (SELECT a, b, score FROM inside SEMI JOIN (SELECT s_suppkey AS b FROM supplier WHERE s_nationkey < 12) USING (b))"


@query("g1_induced", f"WITH {_INSIDE} SELECT a, b, score FROM sub")
def g1(d: Data) -> DataFrame:
    return graph.induced_edges(d.edges, nodes(d))


@query("g2_relabel", "SELECT least(x.s_name, y.s_name) AS a, greatest(x.s_name, y.s_name) AS b, max(score) AS score FROM edges e JOIN supplier x ON x.s_suppkey = e.a JOIN supplier y ON y.s_suppkey = e.b WHERE x.s_nationkey < 12 AND y.s_nationkey < 12 AND x.s_name <> y.s_name GROUP BY 1, 2")
def g2(d: Data) -> DataFrame:
    names = d.table("supplier").where("s_nationkey < 12").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return graph.relabel_edges(d.edges, names)


_DEG = "deg AS (SELECT node, count(*) AS degree FROM (SELECT a AS node FROM edges UNION ALL SELECT b FROM edges) GROUP BY node)"


@query("g3_degree", f"WITH {_DEG} SELECT node, degree FROM deg")
def g3(d: Data) -> DataFrame:
    return graph.degree(d.edges)


@query("g3_hubs", f"WITH {_DEG} SELECT node, degree FROM deg ORDER BY degree DESC, node LIMIT 10")
def g3_hubs(d: Data) -> DataFrame:
    return graph.hubs(d.edges)


@query("g4_coexpression", f"WITH k AS (SELECT feature, sample, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS value FROM m1), p AS (SELECT x.feature AS a, y.feature AS b, corr(x.value, y.value) AS r FROM k x JOIN k y ON x.sample = y.sample AND x.feature < y.feature GROUP BY 1, 2) SELECT a, b, CAST(round(abs(r) * 1000) AS BIGINT) AS score, {r('r', 'signed_r')} FROM p WHERE abs(r) >= 0.05")
def g4(d: Data) -> DataFrame:
    return graph.coexpression_edges(d.m1, d.m1, 0.05)


_CO = "k AS (SELECT feature, sample, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS value FROM m1), p AS (SELECT x.feature AS a, y.feature AS b, corr(x.value, y.value) AS r FROM k x JOIN k y ON x.sample = y.sample AND x.feature < y.feature GROUP BY 1, 2), e AS (SELECT a, b, r FROM p WHERE abs(r) >= 0.05)"


@query("g5_network_route", f"WITH {_CO} SELECT a, b, CAST(round(abs(r) * 1000) AS DOUBLE) AS score, 'coexpression' AS method FROM e")
def g5(d: Data) -> DataFrame:
    return graph.network_route(d.edges.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), "score"), d.m1, d.m1.select("feature").distinct(), 0.05)


@query("g5_network_status", f"WITH {_CO} SELECT CASE WHEN count(*) = 0 THEN 'skipped' ELSE 'fallback' END AS status, CASE WHEN count(*) > 0 THEN 'coexpression' END AS method, count(*) AS n_edges, (SELECT count(DISTINCT f) FROM (SELECT a AS f FROM e UNION ALL SELECT b FROM e)) AS n_nodes, CASE WHEN count(*) > 0 THEN 'not a network of known links: features whose rank correlation is at least 0.05 in size' END AS caveat, CASE WHEN count(*) = 0 THEN 'no known edge between the selected features, and no rank correlation of at least 0.05 in size' END AS reason FROM e")
def g5_status(d: Data) -> DataFrame:
    return graph.network_status(materialise(g5(d), "routed"), 0.05)


_STRONG = "str AS (SELECT a, b FROM edges WHERE score >= 2), sym AS (SELECT a, b FROM str UNION SELECT b, a FROM str), reach(a, b) AS (SELECT a, a FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a), comp AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a)"


@query("g6_components", f"WITH {_STRONG} SELECT node, component FROM comp", recursive=True)
def g6(d: Data) -> DataFrame:
    return graph.components(d.edges.where("score >= 2"))


@query("g6_largest_component", f"WITH {_STRONG}, top AS (SELECT component FROM comp GROUP BY component ORDER BY count(*) DESC, component LIMIT 1), own AS (SELECT node FROM comp JOIN top USING (component)) SELECT a, b FROM str WHERE a IN (SELECT node FROM own) AND b IN (SELECT node FROM own)", recursive=True)
def g6_largest(d: Data) -> DataFrame:
    return graph.largest_component(d.edges.where("score >= 2").select("a", "b"))


@query("g7_thin", f"WITH {_DEG}, top AS (SELECT node FROM deg ORDER BY degree DESC, node LIMIT 20) SELECT a, b, score FROM edges WHERE a IN (SELECT node FROM top) AND b IN (SELECT node FROM top) ORDER BY score DESC, a, b LIMIT 60")
def g7(d: Data) -> DataFrame:
    return graph.thin(d.edges, 20, 60)


def _labels(rounds: int) -> str:
    """SQL of so many rounds of label propagation, each node with a link of its own largest weight, as tables ``c0, c1, ..``."""
    parts = ["one AS (SELECT a, b, score FROM edges UNION ALL SELECT b, a, score FROM edges)", "links AS MATERIALIZED (SELECT * FROM one UNION ALL SELECT a, a, max(score) FROM one GROUP BY a)", "c0 AS MATERIALIZED (SELECT DISTINCT a AS node, a AS label FROM links)"]
    for i in range(rounds):
        parts.append(f"w{i} AS (SELECT a, label, sum(score) AS w FROM links JOIN c{i} ON b = node GROUP BY 1, 2)")
        parts.append(f"c{i + 1} AS MATERIALIZED (SELECT a AS node, label FROM w{i} QUALIFY row_number() OVER (PARTITION BY a ORDER BY w DESC, label) = 1)")
    sizes = f"lz AS (SELECT label, count(*) AS size FROM c{rounds} GROUP BY label), lk AS (SELECT *, row_number() OVER (ORDER BY size DESC, label) AS k FROM lz)"
    return ", ".join(parts) + f", {sizes}, com AS MATERIALIZED (SELECT node, CASE WHEN k <= 4 THEN CAST(k AS VARCHAR) ELSE 'other' END AS community, size FROM c{rounds} JOIN lk USING (label))"


@query("g8_communities", f"WITH {_labels(10)} SELECT node, community, size FROM com")
def g8(d: Data) -> DataFrame:
    return graph.communities(materialise(d.edges, "edges"))


_DIV = "mm AS (SELECT sum(score) AS m FROM edges), ins AS (SELECT coalesce(sum(score) FILTER (x.community = y.community), 0) AS inside FROM edges JOIN com x ON x.node = a JOIN com y ON y.node = b), kn AS (SELECT community, sum(score) AS k FROM (SELECT a AS node, score FROM edges UNION ALL SELECT b, score FROM edges) JOIN com USING (node) GROUP BY 1), kq AS (SELECT sum(k * 1.0 * k) AS kk FROM kn)"


@query("g8_modularity", f"WITH {_labels(10)}, {_DIV} SELECT {r('inside / m - kk / pow(2 * m, 2)', 'modularity')} FROM mm, ins, kq")
def g8_modularity(d: Data) -> DataFrame:
    edges = materialise(d.edges, "edges")
    return graph.modularity(edges, graph.communities(edges))


_RING = f"{_DEG}, k AS (SELECT node, node % 4 AS community, degree, row_number() OVER (ORDER BY degree DESC, node) AS k, count(*) OVER () AS n, least(3, greatest(1, count(*) OVER () // 12)) AS rings FROM deg), c AS (SELECT *, CASE rings WHEN 1 THEN n WHEN 2 THEN greatest(1, round(n / 2.72)) ELSE greatest(1, round(n / 5.16)) END AS c1, CASE rings WHEN 3 THEN greatest(1, round(n / 5.16)) + greatest(1, round(n * 1.72 / 5.16)) ELSE n END AS c2 FROM k), g AS (SELECT *, CASE WHEN k <= c1 THEN 1 WHEN k <= c2 THEN 2 ELSE 3 END AS ring FROM c), p AS (SELECT node, ring, row_number() OVER (PARTITION BY ring ORDER BY community, degree DESC, node) AS place, count(*) OVER (PARTITION BY ring) AS m FROM g), q AS (SELECT *, 2 * pi() * (place - 1) / m + pi() / 2 AS angle, 1 + 0.72 * (ring - 1) AS radius FROM p)"


@query("g9_rings", f"WITH {_RING} SELECT node, ring, CAST(place AS INT) AS place, {r('angle', 'angle')}, {r('radius * cos(angle)', 'x')}, {r('radius * sin(angle)', 'y')} FROM q")
def g9(d: Data) -> DataFrame:
    return graph.ring_layout(graph.degree(d.edges).withColumn("community", F.col("node") % 4))


_SHIFT = "oth AS (SELECT source, target, CASE WHEN length(target) % 3 = 0 THEN -sign ELSE sign END AS sign FROM signed WHERE length(target) > 3)"


@query("g10_compare", f"WITH {_SHIFT}, j AS (SELECT s.sign AS sa, o.sign AS sb, s.target IS NOT NULL AS ia, o.target IS NOT NULL AS ib FROM signed s FULL JOIN oth o ON s.source = o.source AND s.target = o.target) SELECT count(*) FILTER (ia AND ib) AS shared, count(*) FILTER (NOT ib) AS only_a, count(*) FILTER (NOT ia) AS only_b, count(*) FILTER (ia AND ib AND sa = sb) AS sign_agree, count(*) FILTER (ia AND ib AND sa <> sb) AS sign_conflict, (SELECT count(DISTINCT source) FROM signed SEMI JOIN oth USING (source)) AS shared_sources, {r('count(*) FILTER (ia AND ib) * 1.0 / count(*)', 'jaccard')} FROM j")
def g10(d: Data) -> DataFrame:
    other = d.signed.where("length(target) > 3").withColumn("sign", F.when(F.length("target") % 3 == 0, -F.col("sign")).otherwise(F.col("sign")))
    return graph.compare_signed_sets(d.signed, other)


@query("g10_conflicts", f"WITH {_SHIFT} SELECT DISTINCT s.source, s.target, s.sign AS sign_a, o.sign AS sign_b FROM signed s JOIN oth o ON s.source = o.source AND s.target = o.target WHERE s.sign <> o.sign ORDER BY s.source, s.target LIMIT 20")
def g10_conflicts(d: Data) -> DataFrame:
    other = d.signed.where("length(target) > 3").withColumn("sign", F.when(F.length("target") % 3 == 0, -F.col("sign")).otherwise(F.col("sign")))
    return graph.sign_conflicts(d.signed, other)


def feature_pairs(d: Data) -> DataFrame:
    return qc.pair_correlation(d.m1, "feature")


@query("m1_module_input", f"WITH own AS (SELECT m1.* FROM m1 JOIN s1 USING (sample) WHERE arm = 'a1'), top AS (SELECT feature FROM own GROUP BY feature ORDER BY var_samp(value) DESC, feature LIMIT 40) SELECT feature, sample, {r('value', 'value')} FROM own SEMI JOIN top USING (feature)")
def m1(d: Data) -> DataFrame:
    return modules.module_input(d.m1, d.s1, "a1", 40)


@query("m1_gates", "SELECT count(DISTINCT sample) AS n_samples, count(DISTINCT feature) AS n_features, count(DISTINCT sample) >= 15 AND count(DISTINCT feature) >= 2000 AS ok FROM m1")
def m1_gates(d: Data) -> DataFrame:
    return modules.input_gates(d.m1)


def _good(rounds: int) -> str:
    """SQL of so many rounds of dropping features and samples with gaps in more than half, as tables ``x0, x1, ..``."""
    parts = ["x0 AS MATERIALIZED (SELECT feature, sample, value FROM m2)"]
    for i in range(rounds):
        parts.append(f"f{i} AS MATERIALIZED (SELECT feature FROM x{i} GROUP BY feature HAVING count(*) >= (SELECT count(DISTINCT sample) FROM x{i}) * 0.5 AND var_samp(value) > 0)")
        parts.append(f"y{i} AS MATERIALIZED (SELECT * FROM x{i} SEMI JOIN f{i} USING (feature))")
        parts.append(f"x{i + 1} AS MATERIALIZED (SELECT * FROM y{i} WHERE sample IN (SELECT sample FROM y{i} GROUP BY sample HAVING count(*) >= (SELECT count(*) FROM f{i}) * 0.5))")
    return ", ".join(parts)


@query("m2_good_samples", f"WITH {_good(10)} SELECT feature, sample, {r('value', 'value')} FROM x10")
def m2(d: Data) -> DataFrame:
    return modules.good_samples_features(d.m2)


@query("m3_sample_outliers", f"WITH dd AS (SELECT a AS sample, avg(1 - r) AS distance FROM csym GROUP BY a) SELECT sample, {r('distance', 'distance')}, distance > 1.5 * (SELECT median(distance) FROM dd) AS outlier FROM dd")
def m3(d: Data) -> DataFrame:
    return modules.sample_outliers(d.m1)


_SOFT = "k AS (SELECT a, power, sum(pow((1 + r) / 2, power)) AS k FROM fsym, (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14, 16, 18, 20]) AS power) GROUP BY 1, 2), e AS (SELECT power, min(k) AS lo, max(k) AS hi, avg(k) AS mean_k, median(k) AS median_k, count(*) AS n FROM k GROUP BY power), bins AS (SELECT power, n, mean_k, median_k, avg(k) AS kb, count(*) AS nb FROM k JOIN e USING (power) GROUP BY power, n, mean_k, median_k, least(floor((k - lo) / (hi - lo) * 10), 9)), soft AS (SELECT power, mean_k, median_k, regr_slope(log10(nb * 1.0 / n), log10(kb)) AS slope, regr_r2(log10(nb * 1.0 / n), log10(kb)) AS fit FROM bins GROUP BY power, mean_k, median_k)"


@query("m4_soft_threshold", f"WITH {_SOFT} SELECT power, {r('-sign(slope) * fit', 'r2', 5)}, {r('slope', 'slope', 5)}, {r('mean_k', 'mean_k', 5)}, {r('median_k', 'median_k', 5)} FROM soft")
def m4(d: Data) -> DataFrame:
    t = modules.soft_threshold_table(feature_pairs(d))
    return t.select("power", *(F.round(c, 5).alias(c) for c in ("r2", "slope", "mean_k", "median_k")))


@query("m5_pick_power", f"WITH {_SOFT} SELECT CAST(coalesce(min(power) FILTER (-sign(slope) * fit >= 0.8 AND mean_k >= 1), min(power) FILTER (-sign(slope) * fit >= 0.8), arg_max(power, -sign(slope) * fit)) AS INT) AS power, count(*) FILTER (-sign(slope) * fit >= 0.8) > 0 AS reached FROM soft")
def m5(d: Data) -> DataFrame:
    return modules.pick_power(modules.soft_threshold_table(feature_pairs(d)))


def named(d: Data) -> DataFrame:
    return modules.modules(feature_pairs(d), 4, 3, 0.97)


_TOM = "w AS (SELECT a, b, pow((1 + r) / 2, 4) AS w FROM fsym WHERE pow((1 + r) / 2, 4) >= 0.01), k AS (SELECT a, sum(w) AS k FROM w GROUP BY a), l AS (SELECT x.b AS a, y.b AS b, sum(x.w * y.w) AS l FROM w x JOIN w y ON x.a = y.a AND x.b < y.b GROUP BY 1, 2)"


@query("m6_topological_overlap", f"WITH {_TOM} SELECT w.a, w.b, {r('(coalesce(l, 0.0) + w) / (least(ka.k, kb.k) + 1 - w)', 'tom')} FROM w LEFT JOIN l ON l.a = w.a AND l.b = w.b JOIN k ka ON ka.a = w.a JOIN k kb ON kb.a = w.b WHERE w.a < w.b")
def m6_tom(d: Data) -> DataFrame:
    return modules.topological_overlap(feature_pairs(d), 4)


_OVER = "tom AS MATERIALIZED (SELECT w.a, w.b, (coalesce(l, 0.0) + w) / (least(ka.k, kb.k) + 1 - w) AS tom FROM w LEFT JOIN l ON l.a = w.a AND l.b = w.b JOIN k ka ON ka.a = w.a JOIN k kb ON kb.a = w.b WHERE w.a < w.b), cut AS (SELECT quantile_cont(tom, 0.97) AS cut FROM tom), hi AS MATERIALIZED (SELECT a, b FROM tom, cut WHERE tom >= cut), hs AS MATERIALIZED (SELECT a, b FROM hi UNION SELECT b, a FROM hi), reach(a, b) AS (SELECT a, a FROM hs UNION SELECT reach.a, hs.b FROM reach JOIN hs ON reach.b = hs.a), cp AS (SELECT a AS feature, min(b) AS component FROM reach GROUP BY a), cs AS (SELECT component, row_number() OVER (ORDER BY count(*) DESC, component) AS module FROM cp GROUP BY component HAVING count(*) >= 3)"


@query("m6_modules", f"WITH {_TOM}, {_OVER} SELECT feature, CAST(coalesce(module, 0) AS INT) AS module FROM (SELECT DISTINCT feature FROM m1) LEFT JOIN cp USING (feature) LEFT JOIN cs USING (component)", recursive=True)
def m6(d: Data) -> DataFrame:
    return named(d)


#: Modules with a SQL form, for what is computed from given modules.
_MODS = "mods AS (SELECT feature, CAST(substr(feature, 2) AS INT) % 5 AS module FROM (SELECT DISTINCT feature FROM m1))"


def given(d: Data) -> DataFrame:
    return d.m1.select("feature").distinct().withColumn("module", F.substring("feature", 2, 9).cast("int") % 5)


@query("m7_merge_modules")
def m7(d: Data) -> DataFrame:
    return modules.merge_modules(d.m1, given(d), 0.9)


@query("m8_module_sizes", f"WITH {_MODS} SELECT module, count(*) AS size FROM mods GROUP BY module")
def m8(d: Data) -> DataFrame:
    return modules.module_sizes(given(d))


def _power(rounds: int) -> str:
    """SQL of so many power iterations for the first component of each module, and the signed profiles as table ``eig``."""
    z = "z AS MATERIALIZED (SELECT module, feature, sample, CASE WHEN stddev_samp(value) OVER w > 0 THEN (value - avg(value) OVER w) / stddev_samp(value) OVER w ELSE 0.0 END AS value FROM m1 JOIN mods USING (feature) WHERE module > 0 WINDOW w AS (PARTITION BY feature))"
    norm = lambda v: f"SELECT module, sample, v / l AS v FROM (SELECT module, sample, v, sqrt(sum(v * v) OVER (PARTITION BY module)) AS l FROM ({v})) WHERE l > 0"
    parts = [_MODS, z, "mean0 AS MATERIALIZED (SELECT module, sample, avg(value) AS v FROM z GROUP BY 1, 2)", f"v0 AS MATERIALIZED ({norm('FROM mean0')})"]
    for i in range(rounds):
        parts.append(f"u{i} AS MATERIALIZED (SELECT module, feature, sum(value * v) AS u FROM z JOIN v{i} USING (module, sample) GROUP BY 1, 2)")
        new = f"SELECT module, sample, sum(value * u) AS v FROM z JOIN u{i} USING (module, feature) GROUP BY 1, 2"
        parts.append(f"v{i + 1} AS MATERIALIZED ({norm(new)})")
    return ", ".join(parts) + f", sg AS (SELECT module, CASE WHEN sum(p.v * mean0.v) < 0 THEN -1.0 ELSE 1.0 END AS s FROM v{rounds} p JOIN mean0 USING (module, sample) GROUP BY 1), eig AS MATERIALIZED (SELECT module, sample, v * s AS value FROM v{rounds} JOIN sg USING (module))"


@query("m9_eigen_profiles", f"WITH {_power(30)} SELECT module, sample, {r('value', 'value')} FROM eig")
def m9(d: Data) -> DataFrame:
    return modules.eigen_profiles(d.m1, given(d))


@query("m10_membership", f"WITH {_power(30)}, kms AS (SELECT module, feature, corr(m1.value, eig.value) AS kme FROM m1 JOIN mods USING (feature) JOIN eig USING (module, sample) GROUP BY 1, 2) SELECT module, feature, {r('kme', 'kme')}, CAST(row_number() OVER (PARTITION BY module ORDER BY kme DESC, feature) AS INT) AS place FROM kms")
def m10(d: Data) -> DataFrame:
    x = d.m1
    return modules.membership(x, modules.eigen_profiles(x, given(d)), given(d))


def profile(d: Data) -> DataFrame:
    """Module means as profiles, which SQL can express."""
    return d.m1.join(given(d).where("module > 0"), "feature").groupBy("module", "sample").agg(F.avg("value").alias("value"))


def traits(d: Data) -> DataFrame:
    return d.table("embeddings").select(F.col("vec_id").cast("string").alias("sample"), F.lit("label").alias("trait"), F.col("label").cast("double").alias("x"))


_PROF = f"{_MODS}, prof AS (SELECT module, sample, avg(value) AS value FROM m1 JOIN mods USING (feature) WHERE module > 0 GROUP BY 1, 2), tr AS (SELECT CAST(vec_id AS VARCHAR) AS sample, 'label' AS trait, CAST(label AS DOUBLE) AS x FROM embeddings), mt AS (SELECT module, trait, count(*) AS n, corr(value, x) AS r FROM prof JOIN tr USING (sample) WHERE x IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 3)"


@query("m11_module_trait", f"WITH {_PROF} SELECT module, trait, n, {r('r', 'r')}, {r('r * sqrt((n - 2) / (1 - r * r))', 't')} FROM mt")
def m11(d: Data) -> DataFrame:
    return modules.module_trait(profile(d), traits(d))


_MT = f"{_PROF}, tt AS (SELECT module, trait, n, r * sqrt((n - 2) / (1 - r * r)) AS t FROM mt), pv AS (SELECT module, trait, {t_p('t', '(n - 2)')} AS p FROM tt)"


@query("m11_module_trait_p", f"WITH {_MT} SELECT module, trait, {r('p', 'p')}, {r('adj_p', 'adj_p')} FROM ({bh('pv')})")
def m11_p(d: Data) -> DataFrame:
    return modules.with_p(modules.module_trait(profile(d), traits(d))).select("module", "trait", "p", "adj_p")


@query("m12_eigen_correlation", f"WITH {_PROF} SELECT x.module AS a, y.module AS b, {r('corr(x.value, y.value)', 'r')} FROM prof x JOIN prof y ON x.sample = y.sample AND x.module < y.module GROUP BY 1, 2")
def m12(d: Data) -> DataFrame:
    return modules.eigen_correlation(profile(d))


_KME = f"{_PROF}, kme AS (SELECT module, feature, corr(m1.value, prof.value) AS kme FROM m1 JOIN mods USING (feature) JOIN prof USING (module, sample) GROUP BY 1, 2), gs AS (SELECT trait, feature, abs(corr(value, x)) AS gs FROM m1 JOIN tr USING (sample) WHERE x IS NOT NULL GROUP BY 1, 2), rel AS (SELECT trait, module, feature, gs, abs(kme) AS kme FROM gs JOIN kme USING (feature))"


def relevance(d: Data) -> DataFrame:
    return modules.relevance_vs_membership(d.m1, traits(d), modules.membership(d.m1, profile(d), given(d)), 0.3, 0.05)


@query("m13_relevance", f"WITH {_KME} SELECT trait, module, feature, {r('gs', 'gs')}, {r('kme', 'kme')}, CASE WHEN kme >= 0.3 AND gs >= 0.05 THEN 'hub_relevant' WHEN kme >= 0.3 THEN 'hub' WHEN gs >= 0.05 THEN 'relevant' ELSE 'background' END AS zone FROM rel")
def m13(d: Data) -> DataFrame:
    return relevance(d)


@query(
    "m13_relevance_summary",
    f"WITH {_KME}, best AS (SELECT trait, arg_max(module, abs(r)) AS module FROM (SELECT * FROM mt ORDER BY module) GROUP BY trait), x AS (SELECT rel.* FROM rel JOIN best USING (trait, module)), k AS (SELECT *, rank() OVER (PARTITION BY trait ORDER BY gs) + (count(*) OVER (PARTITION BY trait, gs) - 1) / 2.0 AS rg, rank() OVER (PARTITION BY trait ORDER BY kme) + (count(*) OVER (PARTITION BY trait, kme) - 1) / 2.0 AS rk FROM x), c AS (SELECT trait, quantile_cont(gs, 0.6) AS cg, quantile_cont(kme, 0.6) AS ck FROM x GROUP BY trait), h AS (SELECT trait, feature, row_number() OVER (PARTITION BY trait ORDER BY kme DESC, feature) AS place FROM x JOIN c USING (trait) WHERE gs > cg AND kme > ck), l AS (SELECT trait, string_agg(feature, ',' ORDER BY place) AS labels FROM h WHERE place <= 5 GROUP BY trait), o AS (SELECT trait, module, count(*) AS n, corr(rg, rk) AS rho FROM k GROUP BY 1, 2) SELECT trait, module, n, {r('rho', 'rho')}, labels FROM o LEFT JOIN l USING (trait)",
)
def m13_summary(d: Data) -> DataFrame:
    # Modules have a dozen features, so the labels are those beyond the 60 % quantiles.
    return modules.relevance_summary(relevance(d), modules.module_trait(profile(d), traits(d)), 0.6)


@query("m14_significance", f"WITH {_KME} SELECT trait, module, {r('avg(gs)', 'significance')}, count(*) AS n FROM rel GROUP BY 1, 2 HAVING count(*) >= 3")
def m14(d: Data) -> DataFrame:
    return modules.module_significance(relevance(d))


@query("m15_strongest", f"WITH {_KME}, best AS (SELECT module FROM mt ORDER BY abs(r) DESC, module LIMIT 1), own AS (SELECT module, feature, CAST(row_number() OVER (PARTITION BY module ORDER BY kme.kme DESC, feature) AS INT) AS place FROM kme JOIN best USING (module)), z AS (SELECT feature, sample, CASE WHEN stddev_samp(value) OVER w > 0 THEN (value - avg(value) OVER w) / stddev_samp(value) OVER w ELSE 0.0 END AS value FROM m1 WINDOW w AS (PARTITION BY feature)) SELECT module, feature, place, sample, {r('value', 'value')} FROM z JOIN own USING (feature) WHERE place <= 5")
def m15(d: Data) -> DataFrame:
    table = modules.module_trait(profile(d), traits(d))
    return modules.strongest_module(table, modules.membership(d.m1, profile(d), given(d)), d.m1, 5)
