"""Literal cases and properties."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortgrid.functions import stats
from cohortgrid.operators import graph, handoff, matrix, modules, qc, samples, sets, signed, survival, testing
from cohortgrid.sources import readers


def cells(spark, table):
    return spark.createDataFrame([(f, s, float(v) if v is not None else None) for s, values in table.items() for f, v in enumerate(values)], "feature int, sample string, value double").withColumn("feature", F.col("feature").cast("string"))


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_quantile_normalise(spark):
    x = cells(spark, {"a": (1, 2, 3), "b": (4, 6, 8)})
    assert values(matrix.quantile_normalise(x), "sample", "feature", "value") == [(s, str(i), v) for s in "ab" for i, v in enumerate((2.5, 4.0, 5.5))]
    tied = cells(spark, {"a": (1, 1, 3), "b": (4, 6, 8)})
    assert [v for *_, v in values(matrix.quantile_normalise(tied), "sample", "feature", "value")][:3] == [3.0, 3.0, 5.5]
    assert [v for *_, v in values(matrix.quantile_normalise(tied, "first"), "sample", "feature", "value")][:3] == [2.5, 3.5, 5.5]


def test_bh(spark):
    df = spark.createDataFrame([(0.01,), (0.02,), (0.03,), (0.04,), (None,)], "p double")
    got = [r.adj_p for r in stats.bh_adjust(df, "p").orderBy("p").collect()]
    assert got[0] is None and np.allclose(got[1:], 0.04)


def surv(spark, rows):
    return spark.createDataFrame([(i, float(t), e) for i, (t, e) in enumerate(rows)], "subject int, time double, event int")


def risks(spark, r):
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(r)], "subject int, risk double")


@pytest.mark.parametrize("r,c", [((3, 2, 1), 1.0), ((1, 2, 3), 0.0), ((1, 1, 1), 0.5)])
def test_concordance(spark, r, c):
    assert survival.concordance(surv(spark, [(1, 1), (2, 1), (3, 0)]), risks(spark, r)).first()["c"] == c


def test_concordance_equals_pairs(spark):
    rng = np.random.default_rng(3)
    t, e, r = rng.integers(1, 30, 300), rng.integers(0, 2, 300), rng.integers(0, 20, 300)
    pairs = [(r[i] > r[j]) + 0.5 * (r[i] == r[j]) for i in range(300) for j in range(300) if e[i] and t[i] < t[j]]
    got = survival.concordance(surv(spark, [(int(a), int(b)) for a, b in zip(t, e)]), risks(spark, r)).first()
    assert got["pairs"] == len(pairs) and math.isclose(got["c"], float(np.mean(pairs)))


def test_kaplan_meier(spark):
    x = surv(spark, [(1, 1), (2, 0), (3, 1), (4, 1)]).withColumn("stratum", F.lit("s"))
    assert [round(v, 6) for _, v in values(survival.kaplan_meier(x), "time", "survival")] == [1.0, 0.75, 0.75, 0.375, 0.0]


@pytest.mark.parametrize("rows,v,verdict", [([(a, b) for a in "xy" for b in "pq"], 0.0, "partially_crossed"), ([("x", "p"), ("y", "q")], 1.0, "fully_confounded")])
def test_cramers_v(spark, rows, v, verdict):
    got = samples.confounding(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    assert math.isclose(got["cramers_v"], v, abs_tol=1e-12) and got["verdict"] == verdict


def test_fold_redundant(spark):
    m = spark.createDataFrame([(s, x) for s, xs in {"1": "abc", "2": "abd", "3": "xy"}.items() for x in xs], "set_id string, feature string")
    terms = spark.createDataFrame([("1", 0.2), ("2", 0.1), ("3", 0.3)], "set_id string, adj_p double")
    assert values(sets.fold_redundant(terms, m), "set_id", "cluster", "representative") == [("1", "1", False), ("2", "1", True), ("3", "3", True)]


@pytest.mark.parametrize("rank,es", [(1, 1.0), (4, -1.0)])
def test_running_sum(spark, rank, es):
    ranked = spark.createDataFrame([(str(i), 1.0, i) for i in range(1, 5)], "feature string, stat double, rank int")
    one = spark.createDataFrame([("s", str(rank))], "set_id string, feature string")
    assert sets.running_sum(ranked, one).first()["es"] == es


def test_hypergeometric(spark):
    df = spark.createDataFrame([(2, 10, 5, 2)], "k int, n int, m int, d int").select(stats.hyper_sf("k", "n", "m", "d").alias("p"))
    assert math.isclose(df.first()[0], 2 / 9)


def test_distributions(spark):
    df = spark.createDataFrame([(2.2281388519649385, 10.0, 3.841458820694124, 1.959963984540054)], "t double, df double, x double, z double")
    got = df.select(stats.t_sf2("t", "df").alias("a"), stats.chi2_sf("x", F.lit(1.0)).alias("b"), stats.norm_sf2("z").alias("c"), stats.digamma(F.lit(1.0)).alias("g"), stats.trigamma(F.lit(1.0)).alias("h")).first()
    assert np.allclose(got[:3], 0.05) and np.allclose(got[3:], (-0.5772156649, math.pi**2 / 6))
    assert math.isclose(stats.trigamma_inverse(math.pi**2 / 6), 1.0, rel_tol=1e-6)


@pytest.mark.parametrize("n,a,small,cohort", [(9, 4, True, False), (10, 5, False, False), (20, 10, False, True)])
def test_gates(spark, n, a, small, cohort):
    x = spark.createDataFrame([("n" if i < a else "d",) for i in range(n)], "arm string")
    got = samples.arm_gates(x, "n", "d").first()
    assert (got["small_design"], got["cohort"]) == (small, cohort)


def test_ring_sizes(spark):
    nodes = spark.range(146).select(F.col("id").cast("string").alias("node"), F.lit(1).alias("degree"), F.lit(0).alias("community"))
    got = dict(values(graph.ring_layout(nodes).groupBy("ring").count(), "ring", "count"))
    assert got == {1: 28, 2: 49, 3: 69}


def test_components(spark):
    path = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).where("a % 50 <> 49")
    got = graph.components(path.unionByName(path)).toPandas().set_index("node").component
    assert len(got) == 200 and all(c == n // 50 * 50 for n, c in got.items())
    assert graph.components(path.where("a < 0")).count() == 0


def test_components_of_hubs(spark):
    """A star of a million leaves, whose rows no task holds, with chains on some of its leaves and a component apart."""
    star = spark.range(1, 1_000_001).select(F.lit(500_000_000).cast("long").alias("a"), F.col("id").alias("b"))
    chains = spark.range(1, 1001).select(F.col("id").alias("a"), (F.col("id") + 2_000_000).alias("b"))
    apart = spark.range(3_000_000, 3_000_100).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = star.unionByName(chains).unionByName(apart)
    got = graph.components(edges).groupBy("component").agg(F.count("*").alias("n"))
    assert values(got, "component", "n") == [(1, 1_001_001), (3_000_000, 101)]

    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    joined = graph._with_least(both, least, 2_002_200)
    assert joined.exceptAll(both.join(least.select("a", "m"), "a").select("a", "b", "m")).count() == 0 and joined.count() == both.count()
    rows = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert max(rows) < 3 * sorted(rows)[len(rows) // 2]


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_search_with_hubs(spark, monkeypatch, seed):
    """Random links, of which nodes above a low limit count as hubs, against a search by hand."""
    monkeypatch.setattr(graph, "HUB_ROWS", 20)
    rng = random.Random(seed)
    links = [(rng.choice((3, 77, rng.randrange(400))), rng.randrange(400)) for _ in range(260)]
    links += [(a, b) for a, b in ((None, 5), (6, None), (900, 900))]
    parent = {n: n for a, b in links if a is not None and b is not None for n in (a, b)}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = graph.components(spark.createDataFrame(links, "a long, b long"))
    assert values(got, "node", "component") == sorted((n, find(n)) for n in parent)


def test_two_group_and_moderated(spark):
    rng = np.random.default_rng(0)
    table = {f"s{i}": rng.normal(i % 2 * 2 * (np.arange(40) < 5), 1) for i in range(12)}
    arms = spark.createDataFrame([(f"s{i}", "x" if i % 2 else "y") for i in range(12)], "sample string, arm string")
    got = testing.moderate(testing.two_group_fit(cells(spark, table), arms, "x", "y")).toPandas().set_index("feature")
    m = np.array([table[f"s{i}"] for i in range(12)])
    assert np.allclose(got.loc[[str(i) for i in range(40)], "lfc"], m[1::2].mean(0) - m[::2].mean(0))
    assert got.adj_p.between(0, 1).all() and (got.adj_p >= got.p - 1e-12).all()
    assert testing.moderate(testing.two_group_fit(cells(spark, table), arms, "x", "y"), trend=True, robust=True).count() == 40


def test_cox_univariate(spark):
    """Against a direct Newton fit with Efron's ties."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=60)
    t, e = np.ceil(rng.exponential(np.exp(-x)) * 8), (rng.random(60) < 0.7).astype(int)
    beta = 0.0
    for _ in range(30):
        u = v = 0.0
        for s in np.unique(t[e == 1]):
            risk, dead = t >= s, (t == s) & (e == 1)
            w = np.exp(beta * x)
            d = dead.sum()
            u += x[dead].sum()
            for k in range(d):
                a = [(w * x**j)[risk].sum() - k / d * (w * x**j)[dead].sum() for j in range(3)]
                u -= a[1] / a[0]
                v += a[2] / a[0] - (a[1] / a[0]) ** 2
        beta += u / v
    cov = spark.createDataFrame([(i, "f", float(a)) for i, a in enumerate(x)], "subject int, feature string, value double")
    got = survival.cox_univariate(cov, surv(spark, [(float(a), int(b)) for a, b in zip(t, e)])).first()
    assert math.isclose(got["beta"], beta, rel_tol=1e-5) and math.isclose(got["se"], 1 / math.sqrt(v), rel_tol=1e-4)


def l1_case(rng, n, p, ties=True):
    x = np.round(rng.normal(size=(n, p)), 3)
    t = rng.exponential(np.exp(-1.2 * x[:, 0] + 0.8 * x[:, 1])) * 4 + 0.1
    t, e = np.ceil(t) if ties else t, (rng.random(n) < 0.75).astype(int)
    return x, t, e, np.argsort(rng.random(n)) % 3 + 1


def l1_gradient(x, t, e, beta):
    """The mean gradient of the Breslow log-likelihood, sum by sum."""
    w, g = np.exp(x @ beta), np.zeros(x.shape[1])
    for s in np.unique(t[e == 1]):
        risk, dead = t >= s, (t == s) & (e == 1)
        g += x[dead].sum(0) - dead.sum() * (w[risk] @ x[risk]) / w[risk].sum()
    return g / e.sum()


def l1_tables(spark, x, t, e, fold):
    n, p = x.shape
    cov = spark.createDataFrame([(i, f"f{j:04d}", float(x[i, j])) for i in range(n) for j in range(p)], "subject int, feature string, value double")
    s = spark.createDataFrame([(i, float(t[i]), int(e[i])) for i in range(n)], "subject int, time double, event int")
    return cov, s, spark.createDataFrame([(i, 1, int(fold[i])) for i in range(n)], "subject int, repeat int, fold int")


def l1_check(found, x, t, e, fold, folds, lambdas):
    p = x.shape[1]
    found = found.toPandas()
    assert len(found) == len(folds) * len(lambdas) * p
    for (f, lam), own in found.groupby(["fold", "lam"]):
        beta = own.sort_values("feature").coef.to_numpy()
        train = fold != f
        g = l1_gradient(x[train], t[train], e[train], beta)
        assert np.abs(g[beta != 0] - lam * np.sign(beta[beta != 0])).max(initial=0) < 1e-6
        assert np.abs(g[beta == 0]).max(initial=0) < lam + 1e-6
    return found


def test_cox_l1_path_meets_its_conditions(spark, monkeypatch):
    from cohortgrid.operators import cox_path

    monkeypatch.setattr(cox_path, "FEATURES", 4)
    x, t, e, fold = l1_case(np.random.default_rng(6), 80, 9)
    cov, s, folds = l1_tables(spark, x, t, e, fold)
    found = l1_check(survival.cox_l1_path(cov, s, folds, [0.2, 5.0]), x, t, e, fold, (0, 1, 2, 3), (0.2, 5.0))
    # Sums along the times as tables, in windows of a few times.
    monkeypatch.setattr(cox_path, "TIMES", 5)
    monkeypatch.setattr(cox_path, "MOST_SUMS", 0)
    l1_check(survival.cox_l1_path(cov, s, folds.where("fold = 1"), [0.5]), x, t, e, fold, (0, 1), (0.5,))
    assert (found[found.lam == 5.0].coef == 0).all() and (found[(found.lam == 0.2) & (found.feature == "f0000")].coef != 0).all()
    assert survival.cox_l1_path(cov.limit(0), s, folds, [0.1]).count() == survival.cox_l1_path(cov, s.limit(0), folds, [0.1]).count() == 0


def test_cox_l1_path_of_many_features(spark):
    x, t, e, fold = l1_case(np.random.default_rng(7), 100, 2000, ties=False)
    cov, s, folds = l1_tables(spark, x, t, e, fold)
    found = l1_check(survival.cox_l1_path(cov, s, folds.limit(0), [0.4]), x, t, e, np.full(100, -1), (0,), (0.4,))
    assert 0 < (found.coef != 0).sum() < 200


def test_eigen_profiles(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=20)
    table = {f"s{i}": [base[i] + 0.3 * z for z in rng.normal(size=6)] for i in range(20)}
    named = spark.createDataFrame([(str(i), 1) for i in range(6)], "feature string, module int")
    got = modules.eigen_profiles(cells(spark, table), named, 15).toPandas().set_index("sample").value
    m = np.array([table[f"s{i}"] for i in range(20)])
    z = (m - m.mean(0)) / m.std(0, ddof=1)
    first = np.linalg.svd(z, full_matrices=False)[0][:, 0]
    first *= np.sign(first @ z.mean(1))
    assert np.allclose(got[[f"s{i}" for i in range(20)]], first, atol=1e-5)


def test_pca_sign_and_scores(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(15, 4)) * [5, 2, 1, 0.5]
    got = qc.pca(cells(spark, {f"s{i}": m[i] for i in range(15)}), 2).toPandas()
    u, s, vt = np.linalg.svd(m - m.mean(0), full_matrices=False)
    for j in (0, 1):
        want = u[:, j] * s[j] * np.sign(vt[j][np.abs(vt[j]).argmax()])
        assert np.allclose(got[got.component == j + 1].set_index("sample").score[[f"s{i}" for i in range(15)]], want, atol=1e-8)


def test_pca_with_both_sides_large(spark, monkeypatch):
    """Components of 3,000 features equal those of the SVD, also where the spectrum is flat after the leading ones, and nothing covers a covariance."""
    rng = np.random.default_rng(5)
    m = rng.normal(size=(60, 6)) @ np.diag([9, 7, 5, 3, 2, 1.5]) @ rng.normal(size=(6, 3000)) / 10 + rng.normal(size=(60, 3000)) * 0.3 + 4
    monkeypatch.setattr(qc, "PCA", None)
    wide = spark.createDataFrame([(f"s{i:02d}", [float(x) for x in m[i]]) for i in range(60)], "sample string, v array<double>")
    long = wide.select("sample", F.posexplode("v").alias("feature", "value")).withColumn("feature", F.format_string("f%04d", "feature"))
    got = qc.pca(long, 3, top_n=0).toPandas()
    u, s, vt = np.linalg.svd(m - m.mean(0), full_matrices=False)
    for j in range(3):
        one = got[got.component == j + 1].set_index("sample").sort_index()
        assert np.allclose(one.score, u[:, j] * s[j] * np.sign(vt[j][np.abs(vt[j]).argmax()]), atol=1e-6)
        assert np.allclose(one.share, s[j] ** 2 / (s**2).sum(), atol=1e-9)


def test_pca_of_small_rank_and_without_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    m = np.outer(rng.normal(size=12), rng.normal(size=30)) + np.outer(rng.normal(size=12), rng.normal(size=30))
    x = cells(spark, {f"s{i:02d}": m[i] for i in range(12)})
    monkeypatch.setattr(qc, "MOST_COLUMNS", 0)
    got = qc.pca(x, 4).toPandas()
    u, s, vt = np.linalg.svd(m - m.mean(0), full_matrices=False)
    assert set(got.component) == {1, 2}
    for j in range(2):
        one = got[got.component == j + 1].set_index("sample").sort_index()
        assert np.allclose(one.score, u[:, j] * s[j] * np.sign(vt[j][np.abs(vt[j]).argmax()]), atol=1e-8)
    assert qc.pca(x.where("feature is null"), 2).count() == 0
    assert qc.pca(cells(spark, {"a": (1, None), "b": (None, 2)}), 2).count() == 0
    assert qc.pca(cells(spark, {"a": (1, 1), "b": (1, 1)}), 2).count() == 0


def test_endpoints_have_event_values_only(spark):
    rows = [(s, k, v) for s, (dead, odd) in enumerate([("Yes", "yes"), ("no", "no"), ("YES", "unknown"), (None, None)]) for k, v in (("overall death", dead), ("other death", odd), ("overall days", str(s)))]
    attrs = spark.createDataFrame(rows, "sample int, key string, value string").withColumn("sample", F.col("sample").cast("string"))
    profile = spark.createDataFrame([("overall death", 3, 1, False), ("other death", 3, 1, False), ("overall days", 4, 0, True)], "key string, present long, missing long, is_numeric boolean")
    got = samples.find_endpoints(profile, ["yes", "no"], attrs)
    assert values(got, "event", "time", "shared_words", "events") == [("overall death", "overall days", 1, 2)]


def test_nothing_to_stack_or_route(spark):
    with pytest.raises(ValueError, match="no tables"):
        sets.stack_common([])
    features = spark.createDataFrame([("a",)], "feature string")
    none = matrix.route_coverage(features, {})
    one = matrix.route_coverage(features, {"own": (F.col("feature"), spark.createDataFrame([("a", "x")], "key string, target string"))})
    assert none.count() == 0 and {(f.name, f.dataType) for f in none.schema} == {(f.name, f.dataType) for f in one.schema}


def test_conditional_odds(spark):
    over = spark.createDataFrame([("a", 3, 20, 6, 5), ("b", 0, 20, 6, 5)], "source string, overlap int, n_detected int, n_targets int, n_selected int")
    got = {r.source: r.odds for r in signed.conditional_odds(over).collect()}
    assert got["b"] == 0 and 4 < got["a"] < 6.5


def test_set_null_is_repeatable(spark):
    ranked = spark.createDataFrame([(str(i), float(50 - i), i) for i in range(1, 100)], "feature string, stat double, rank int")
    m = spark.createDataFrame([("top", str(i)) for i in range(1, 8)] + [("mid", str(i)) for i in range(10, 90, 11)], "set_id string, feature string")
    a, b = (values(sets.set_null(ranked, m, 20), "set_id", "es", "p") for _ in range(2))
    assert a == b and all(-1 <= es <= 1 and 0 < p <= 1 for _, es, p in a)


def test_block_tables_of_many_splits(spark, tmp_path):
    """Blocks that begin and end in different splits, with end lines before and after them, blank and short lines, and files without a whole block."""
    rng, want = random.Random(4), set()
    for name, (top, size) in {"a": (700, 3000), "b": (0, 40), "c": (2500, 1)}.items():
        lines = [f"!end of nothing {i}" if i % 100 == 0 else f"!note {i} {'x' * rng.randrange(60)}" for i in range(top)] + ["!begin of table", "id\t name\tnote"]
        for i in range(1, size + 1):
            cells = [f"{name}{i}", f" n{i} ", "t" * rng.randrange(40)][: rng.choice((1, 2, 3, 3))]
            lines.append("\t".join(cells + ["surplus"]) if len(cells) == 3 else "\t".join(cells))
            if i % 50 == 7:
                lines[-1] = ""
                continue
            padded = [c.strip() for c in cells] + [None] * (3 - len(cells))
            want.add((name, i, *padded))
        lines += ["!end", "!begin", "id\tother", "1\t2", "!end"] + [f"after {i}" for i in range(900)]
        (tmp_path / f"{name}.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "open.txt").write_text("!end\n!begin\nid\n1\n")
    (tmp_path / "none.txt").write_text("id\n1\n")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "bare.txt").write_text("!begin\n!end\n")
    asked = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in asked]
    try:
        for k, v in zip(asked, ("16384", "1024")):
            spark.conf.set(k, v)
        assert spark.read.text(str(tmp_path / "a.txt")).rdd.getNumPartitions() > 4
        got = readers.read_block_table(spark, str(tmp_path), "!begin", "!end").collect()
    finally:
        for k, v in zip(asked, old):
            spark.conf.set(k, v)
    found = [(r.file.rsplit("/", 1)[1][:-4], r.row, r.fields["id"], r.fields["name"], r.fields["note"]) for r in got]
    assert len(found) == len(set(found)) and set(found) == want


def test_edge_copy_is_pruned_by_score(spark, tmp_path):
    """Of a sorted copy only the rows of few row groups are read for a high score; lower scores than the copy holds come from the source."""
    source, copy = str(tmp_path / "source"), str(tmp_path / "copy")
    edges = spark.range(200_000).select(F.concat(F.lit("n"), F.col("id")).alias("a"), F.concat(F.lit("m"), F.col("id") * 7).alias("b"), (F.abs(F.xxhash64("id")) % 1000).cast("int").alias("score"))
    edges.write.option("sep", " ").option("header", True).option("compression", "gzip").csv(source)
    high = readers.stored_edges(spark, source, copy, 950)
    rows = high.collect()
    assert len(rows) == edges.where("score >= 950").count() and min(r.score for r in rows) == 950
    read = high._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()
    stored = spark.read.parquet(copy)
    assert stored.agg(F.min("score")).first()[0] == 400 and len(rows) <= read < stored.count() / 3
    assert readers.stored_edges(spark, source, copy, 100).count() == edges.where("score >= 100").count()
    # The copy starts from 400, whatever a later call says.
    assert readers.stored_edges(spark, source, copy, 200, least=200).count() == edges.where("score >= 200").count()
    readers.write_edges(edges.where("score is null"), str(tmp_path / "no"), 400)
    assert readers.stored_edges(spark, source, str(tmp_path / "no"), 500).count() == 0


def test_readers(spark, tmp_path):
    (tmp_path / "soft").mkdir()
    (tmp_path / "soft/a.txt").write_text("^SAMPLE = S1\n!age = 3\n!note = a = b\n^SAMPLE = S2\n!age = 4\n")
    assert values(readers.read_tagged_records(spark, str(tmp_path / "soft"), "SAMPLE"), "record_id", "key", "value") == [("S1", "age", "3"), ("S1", "note", "a = b"), ("S2", "age", "4")]
    (tmp_path / "b.txt").write_text("x\n!begin\nID\tSYM\n1\t a \n2\n!end\n")
    assert [r.fields for r in readers.read_block_table(spark, str(tmp_path / "b.txt"), "!begin", "!end").orderBy("row").collect()] == [{"ID": "1", "SYM": "a"}, {"ID": "2", "SYM": None}]
    (tmp_path / "m.tsv").write_text("id\ts1\ts2\ng\t1.5\tNA\n")
    assert {(r.feature, r.sample, r.value) for r in readers.read_wide_matrix(spark, str(tmp_path / "m.tsv"), "id").collect()} == {("g", "s1", 1.5), ("g", "s2", None)}
    (tmp_path / "e.txt").write_text("protein1 protein2 score\na b 500\na c 100\n")
    assert values(readers.read_edges(spark, str(tmp_path / "e.txt")), "a", "b", "score") == [("a", "b", 500)]
    (tmp_path / "r.tsv").write_text("# note\nsource\ttarget\tmor\tconfidence\nt\tg\t-1\tA\n")
    assert values(readers.read_signed_sets(spark, str(tmp_path / "r.tsv"), ["A"]), "source", "sign", "coverage") == [("t", -1, "declared")]
    assert values(readers.read_signed_sets(spark, str(tmp_path / "r.tsv"), ["Z"], str(tmp_path / "r.tsv")), "source") == []
    (tmp_path / "v.tsv").write_text("t\tg\tBoost\t1\n")
    with pytest.raises(Exception, match="unknown mode"):
        readers.read_signed_sets_vocab(spark, str(tmp_path / "v.tsv"), {"Activation": 1}).collect()
    out = str(tmp_path / "out")
    readers.write_results(spark.range(3), out, "d1")
    readers.write_results(spark.range(2), out, "d2")
    readers.write_results(spark.range(5), out, "d1")
    assert dict(values(spark.read.parquet(out).groupBy("dataset").count(), "dataset", "count")) == {"d1": 5, "d2": 2}


def test_small_helpers(spark):
    assert samples.pick_col(spark.createDataFrame([(1,)], "Gene int"), ["symbol", "gene"]) == "Gene"
    with pytest.raises(ValueError):
        matrix.align_samples(cells(spark, {"a": (1,)}), spark.createDataFrame([("a",), ("b",)], "sample string"))
    x = matrix.row_zscore(cells(spark, {"a": (1, 5), "b": (1, 9)}), 0.5)
    assert values(x, "feature", "sample", "value") == [("0", "a", 0.0), ("0", "b", 0.0), ("1", "a", -0.5), ("1", "b", 0.5)]
    sig = survival.capped_signature(spark.createDataFrame([(0.1, "a", 1.0), (0.1, "b", 1.0), (0.2, "a", 1.0), (0.2, "b", 0.0), (0.3, "a", 0.0), (0.3, "b", 0.0)], "lam double, feature string, coef double"), 1)
    assert values(sig, "lam", "feature") == [(0.2, "a")]
    short = handoff.shortlist(spark.createDataFrame([("a", -3.0), ("b", 2.0), ("a", 1.0), (None, 9.0)], "g string, k double"), "s", "g", "k")
    assert values(short, "source_rank", "feature", "key") == [(1, "a", 3.0), (2, "b", 2.0)]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "feature string, sample string, value double")
    arms = spark.createDataFrame([], "sample string, arm string")
    assert testing.two_group_fit(none, arms, "a", "b").count() == 0
    assert qc.pair_correlation(none).count() == 0
    assert matrix.quantile_normalise(none).count() == 0
    assert qc.box_summary(none).count() == 0


def test_concordance_counts_by_group(spark):
    rng = random.Random(31)
    rows = [(g, float(rng.randint(1, 9)), rng.randint(0, 1), float(rng.randint(0, 5)), rng.randint(1, 3)) for g in "ab" for _ in range(60)] + [("c", 1.0, 1, 2.0, 1), ("a", None, 1, 1.0, 1)]
    df = spark.createDataFrame(rows, "g string, time double, event int, risk double, w int")
    got = {r.g: (r.pairs, r.concordant, r.tied) for r in survival.concordance_counts(df, ["g"]).collect()}
    for g in "ab":
        own = [r for r in rows if r[0] == g and r[1] is not None]
        pairs = [(x[3], y[3], x[4] * y[4]) for x in own for y in own if x[2] == 1 and x[1] < y[1]]
        assert got[g] == (sum(w for *_, w in pairs), sum(w for a, b, w in pairs if a > b), sum(w for a, b, w in pairs if a == b))
    assert survival.concordance_counts(df.limit(0)).collect()[0].pairs == 0


def test_optimism_equals_refits(spark):
    """Each replicate refitted by hand: Dxy, slope and R2 of its model on its draw and on the original cohort."""
    rng = random.Random(32)
    people = [(i, float(rng.randint(1, 12)), rng.randint(0, 1), rng.gauss(0, 1)) for i in range(50)]
    people = [(i, t + (3 if z < 0 else 0), e, round(z, 3)) for i, t, e, z in people]
    df = spark.createDataFrame(people, "subject long, time double, event int, risk double")
    reps = 6
    u = F.pmod(F.xxhash64("subject", "rep", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    draws = df.select("subject", F.explode(F.sequence(F.lit(0), F.lit(reps))).alias("rep")).select("subject", "rep", u.alias("u")).collect()
    cdf = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(8)])
    weight = {(r.rep, r.subject): 1 if r.rep == 0 else int((r.u > cdf).sum()) for r in draws}

    def terms(rows, beta):
        ll = score = info = 0.0
        for time in {t for _, t, e, _ in rows if e}:
            risk = np.array([z for _, t, _, z in rows if t >= time])
            dead = np.array([z for _, t, e, z in rows if t == time and e])
            ll, score = ll + beta * dead.sum(), score + dead.sum()
            for k in range(len(dead)):
                s = [(np.exp(beta * risk) * risk**p).sum() - k / len(dead) * (np.exp(beta * dead) * dead**p).sum() for p in range(3)]
                ll, score, info = ll - math.log(s[0]), score - s[1] / s[0], info + s[2] / s[0] - (s[1] / s[0]) ** 2
        return ll, score, info

    def fit(rows):
        beta = 0.0
        for _ in range(20):
            _, score, info = terms(rows, beta)
            beta += score / info
        return beta

    def dxy(rows, sign):
        pairs = [(sign * x[3], sign * y[3]) for x in rows for y in rows if x[2] and x[1] < y[1]]
        return 2 * sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs) - 1

    def r2(rows, beta):
        ll, null = terms(rows, beta)[0], terms(rows, 0.0)[0]
        return (1 - math.exp(-2 * (ll - null) / len(rows))) / (1 - math.exp(2 * null / len(rows)))

    beta0 = fit(people)
    parts = []
    for rep in range(1, reps + 1):
        rows = [p for p in people for _ in range(weight[rep, p[0]])]
        beta = fit(rows)
        sign = np.sign(beta)
        parts.append([(dxy(rows, sign), dxy(people, sign)), (1.0, beta0 / beta), (r2(rows, beta), r2(people, beta))])
    training, test = np.mean(parts, 0)[:, 0], np.mean(parts, 0)[:, 1]
    apparent = [dxy(people, np.sign(beta0)), 1.0, r2(people, beta0)]
    got = {r.measure: r for r in survival.optimism(df, df.select("subject", "risk"), reps).collect()}
    for k, name in enumerate(("dxy", "slope", "r2")):
        r = got[name]
        assert np.allclose([r.apparent, r.training, r.test, r.corrected], [apparent[k], training[k], test[k], apparent[k] - training[k] + test[k]], atol=1e-6), name


def test_running_over_ranges(spark):
    rng = random.Random(33)
    values = [rng.choice([None, *range(20)]) for _ in range(300)]
    df = spark.createDataFrame([(i, v, rng.random()) for i, v in enumerate(values)], "i int, v int, x double")
    got = stats.global_running(df, F.col("v").asc_nulls_last(), sums={"s": F.lit(1)}, mins={"m": "x"}, partitions=7).collect()
    rows = [(r.i, r.v, r.x) for r in got]
    for r in got:
        upto = [x for _, v, x in rows if v is not None and (r.v is None or v <= r.v) or r.v is None]
        assert r.s == len(upto) and r.m == min(upto)
    assert stats.bh_adjust(df.limit(0), "x").count() == 0


def test_pair_correlation_in_blocks(spark, monkeypatch):
    from cohortgrid.operators import qc

    monkeypatch.setattr(qc, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(qc, "BLOCK_CELLS", 5)
    rng = np.random.default_rng(34)
    cells = {(f"s{i}", f"f{j:02d}"): 1e3 * i + rng.normal() for i in range(9) for j in range(17) if rng.random() < 0.8} | {("flat", f"f{j:02d}"): 0.1 for j in range(17)} | {("one", "f00"): 2.0}
    df = spark.createDataFrame([(f, s, float(v)) for (s, f), v in cells.items()], "feature string, sample string, value double")
    got = {(r.a, r.b): (r.n, r.r) for r in qc.pair_correlation(df).collect()}
    names = sorted({s for s, _ in cells})
    for a in names:
        for b in names:
            both = [f for f in (f"f{j:02d}" for j in range(17)) if (a, f) in cells and (b, f) in cells]
            if a >= b or not both:
                assert (a, b) not in got
                continue
            n, r = got[a, b]
            x, y = ([cells[s, f] for f in both] for s in (a, b))
            assert n == len(both)
            assert r is None if n < 2 or "flat" in (a, b) else abs(r - np.corrcoef(x, y)[0, 1]) < 1e-9


def test_joint_proportional_hazards_by_brute_force(spark):
    rng = np.random.default_rng(3)
    n, p = 90, 3
    x = np.round(rng.normal(size=(n, p)), 3)
    time = np.ceil(rng.exponential(1 / np.exp(0.5 * x[:, 0])) * 6)
    event = (rng.random(n) < 0.7).astype(int)
    cells = spark.createDataFrame([(i, f"f{j}", float(x[i, j])) for i in range(n) for j in range(p)], "subject int, feature string, value double")
    surv = spark.createDataFrame([(i, float(time[i]), int(event[i])) for i in range(n)], "subject int, time double, event int")

    def terms(beta):
        for t in sorted(set(time[event == 1])):
            risk, dead = time >= t, (time == t) & (event == 1)
            e, d = np.exp(x @ beta), int(dead.sum())
            u, v = x[dead].sum(axis=0), np.zeros((p, p))
            for k in range(d):
                w = e * risk - k / d * e * dead
                mean = w @ x / w.sum()
                u, v = u - mean, v + (x.T * w) @ x / w.sum() - np.outer(mean, mean)
            yield t, u, v

    beta = np.zeros(p)
    for _ in range(15):
        every = list(terms(beta))
        beta = beta + np.linalg.solve(sum(v for _, _, v in every), sum(u for _, u, _ in every))
    gone, s = {}, 1.0
    for t in sorted(set(time)):
        gone[t] = 1 - s
        s *= 1 - ((time == t) & (event == 1)).sum() / (time >= t).sum()
    every = list(terms(beta))
    i11, i12, i22 = (sum(v * gone[t] ** k for t, _, v in every) for k in range(3))
    u = sum(w * gone[t] for t, w, _ in every)
    left = i22 - i12 @ np.linalg.inv(i11) @ i12
    wanted = {f"f{j}": u[j] ** 2 / left[j, j] for j in range(p)} | {"GLOBAL": u @ np.linalg.inv(left) @ u}

    found = {r["term"]: r for r in survival.proportional_hazards_joint(cells, surv).collect()}
    assert set(found) == set(wanted)
    for term, chi2 in wanted.items():
        assert found[term]["chi2"] == pytest.approx(chi2, rel=1e-6)
    assert [found[f"f{j}"]["beta"] for j in range(p)] == pytest.approx(list(beta), rel=1e-6)
    assert found["GLOBAL"]["df"] == p
    assert survival.proportional_hazards_joint(cells.limit(0), surv).count() == 0


def test_paired_fit_falls_back_with_a_reason(spark):
    cells = spark.createDataFrame([("g", s, float(v)) for s, v in zip("abcdef", (1, 2, 4, 3, 5, 9))], "feature string, sample string, value double")

    def fit(pairs):
        rows = [(s, "t" if s in "abc" else "c", q) for s, q in zip("abcdef", pairs)]
        one = testing.paired_or_plain_fit(cells, spark.createDataFrame(rows, "sample string, arm string, pair_id string"), "t", "c").first()
        return one["design"], one["reason"], one["df"]

    assert fit(["1", "2", "3", "1", "2", "3"]) == ("paired", None, 2.0)
    assert fit(["1", "2", None, "1", "2", "3"]) == ("two_group", "samples without a pair", 4.0)
    assert fit(["1"] * 6) == ("two_group", "fewer than two pairs", 4.0)
    assert fit(["1", "2", "3", "4", "5", "6"]) == ("two_group", "no pair has both arms", 4.0)


def test_expectations_without_tables_or_rules(spark):
    assert readers.expectations({}, []).count() == 0
    assert [tuple(r) for r in readers.expectations({}, [("a", "t", "count(*) > 0", True)]).collect()] == [("a", False, True)]


def test_log_odds_by_brute_force(spark):
    rng = np.random.default_rng(5)
    n, se = 700, 0.5
    t = np.round(rng.standard_t(9, n) * np.where(np.arange(n) < 20, 4, 1), 4)
    df = np.where(np.arange(n) % 7 == 0, 7.0, 9.0)
    rows = spark.createDataFrame([(f"g{i:03d}", float(t[i]), float(df[i]), se, 0.8) for i in range(n)], "feature string, t double, df_total double, se_unscaled double, s2_prior double")
    got = testing.log_odds(rows.withColumn("p", stats.t_sf2("t", "df_total"))).toPandas().set_index("feature")["b"]

    grid = np.linspace(0, 400, 2_000_001)

    def tail(d):
        """Two-sided tail on the grid, by adding up the density."""
        density = (1 + grid**2 / d) ** (-(d + 1) / 2)
        upto = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2)])
        far = density[-1] * grid[-1] / d / (grid[1] - grid[0])
        return (upto[-1] + far - upto) / (upto[-1] + far)

    tails = {d: tail(d) for d in (7.0, 9.0)}
    p_of = lambda x, d: np.interp(x, grid, tails[d])
    t_of = lambda p, d: np.interp(-p, -tails[d], grid)
    size = np.array([abs(x) if d == 9 else t_of(p_of(abs(x), d), 9.0) for x, d in zip(t, df)])
    top = math.ceil(0.005 * n)
    share = max(top / n, 0.01)
    found = []
    for place, x in enumerate(sorted(size)[::-1][:top]):
        p0 = p_of(x, 9.0)
        wanted = ((place + 0.5) / n - (1 - share) * p0) / share
        v = se**2 * ((x / t_of(wanted, 9.0)) ** 2 - 1) if wanted > p0 else 0.0
        found.append(min(16 / 0.8, max(0.01 / 0.8, v)))
    ratio = 1 + np.mean(found) / se**2
    b = math.log(0.01 / 0.99) - math.log(ratio) / 2 + (1 + df) / 2 * np.log((t**2 + df) / (t**2 / ratio + df))
    assert np.allclose(got.loc[[f"g{i:03d}" for i in range(n)]], b, rtol=1e-3, atol=1e-3)
    assert testing.log_odds(rows.limit(0).withColumn("p", F.lit(1.0))).count() == 0


def test_exact_quantiles(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.lognormal(size=3000), np.full(1500, 2.5), [1e9, -1e9]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (math.nan,)], "v double")
    shares = [0.0, 0.01, 0.25, 0.5, 0.7, 0.99, 1.0]
    for few in (10_000, 20):
        assert np.allclose(stats.exact_quantiles(df, "v", shares, few=few, bins=16), np.quantile(x, shares), rtol=1e-12)
        assert stats.exact_quantiles(df, F.col("v"), shares, kind=1, few=few) == np.quantile(x, shares, method="inverted_cdf").tolist()
    assert stats.exact_quantiles(df.limit(0), "v", [0.5]) == [None]


def test_hypergeometric_tails_by_summing(spark):
    rng = random.Random(9)
    cases = [(0, 5, 0, 3), (3, 10, 5, 2), (60, 20000, 900, 700), (1, 1, 1, 1), (None, 5, 1, 1)]
    for _ in range(60):
        n = rng.randint(1, 400)
        cases.append((rng.randint(0, 40), n, rng.randint(0, n), rng.randint(0, n)))
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, k int, n int, m int, d int")
    got = {r.i: r.p for r in df.select("i", stats.hyper_sf("k", "n", "m", "d").alias("p")).collect()}
    for i, (k, n, m, d) in enumerate(cases):
        if k is None:
            assert got[i] is None
            continue
        p = sum(math.comb(m, j) * math.comb(n - m, d - j) for j in range(k, min(m, d) + 1)) / math.comb(n, d)
        assert math.isclose(got[i], p, rel_tol=1e-9, abs_tol=1e-300)


def test_bh_with_many_equal_p(spark):
    rng = random.Random(10)
    p = [rng.choice([None, 1.0, 1.0, round(rng.random(), 2)]) for _ in range(400)]
    got = {r.i: r.adj_p for r in stats.bh_adjust(spark.createDataFrame(list(enumerate(p)), "i int, p double"), "p").collect()}
    known = sorted((x, i) for i, x in enumerate(p) if x is not None)
    least = 1.0
    for place in range(len(known), 0, -1):
        x, i = known[place - 1]
        least = min(least, x * len(known) / place)
        assert math.isclose(got[i], least)
    assert all(got[i] is None for i, x in enumerate(p) if x is None)


@pytest.mark.parametrize("threshold", [0.16, 0.5, 0.8])
def test_jaccard_pairs_equal_all_pairs(spark, monkeypatch, threshold):
    """One feature is in every set and some sets are near copies; short and long lists."""
    rng = random.Random(11)
    base = [rng.sample(range(60), 12) for _ in range(6)]
    table = {f"s{i:02d}": {0, *(x for x in rng.choice(base) if rng.random() < 0.9)} for i in range(40)} | {"alone": {0}, "alike": {0}}
    df = spark.createDataFrame([(s, str(x)) for s, xs in table.items() for x in xs] + [("s00", None), (None, "1")], "set_id string, feature string")
    wanted = {(a, b): len(table[a] & table[b]) / len(table[a] | table[b]) for a in table for b in table if a < b}
    wanted = {k: v for k, v in wanted.items() if v >= threshold}
    for short, block in ((64, 512), (3, 4)):
        monkeypatch.setattr(sets, "SHORT", short)
        monkeypatch.setattr(sets, "BLOCK", block)
        got = {(r.a, r.b): r.jaccard for r in sets.jaccard_pairs(df, threshold).collect()}
        assert got.keys() == wanted.keys() and all(math.isclose(got[k], v) for k, v in wanted.items())
    terms = spark.createDataFrame([(s, 0.1) for s in table], "set_id string, adj_p double")
    low = {s: s for s in table}
    for _ in table:
        for a, b in wanted:
            low[a] = low[b] = min(low[a], low[b])
    assert dict(values(sets.fold_redundant(terms, df, threshold), "set_id", "cluster")) == low


def test_topological_overlap_and_modules_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(qc, "BLOCK_ITEMS", 4)
    monkeypatch.setattr(qc, "BLOCK_CELLS", 6)
    rng = np.random.default_rng(12)
    n = 16
    m = rng.normal(size=(n, 8)) + np.repeat(rng.normal(size=(4, 8)), 4, 0) * 2
    r = np.corrcoef(m)
    pairs = spark.createDataFrame([(f"f{i:02d}", f"f{j:02d}", float(r[i, j])) for i in range(n) for j in range(i + 1, n)], "a string, b string, r double")
    w = ((1 + r) / 2) ** 4
    w[w < 0.05] = 0
    np.fill_diagonal(w, 0)
    k = w.sum(1)
    tom = (w @ w + w) / (np.minimum(k[:, None], k) + 1 - w)
    got = {(x.a, x.b): x.tom for x in modules.topological_overlap(pairs, 4, 0.05).collect()}
    wanted = {(f"f{i:02d}", f"f{j:02d}"): tom[i, j] for i in range(n) for j in range(i + 1, n) if w[i, j] > 0}
    assert got.keys() == wanted.keys() and all(math.isclose(got[x], v, rel_tol=1e-9) for x, v in wanted.items())

    t = {(x.a, x.b): x.tom for x in modules.topological_overlap(pairs, 4).collect()}
    limit = np.quantile(list(t.values()), 0.8)
    low = {f"f{i:02d}": f"f{i:02d}" for i in range(n)}
    for _ in range(n):
        for (a, b), v in t.items():
            if v >= limit:
                low[a] = low[b] = min(low[a], low[b])
    groups = {}
    for f, c in low.items():
        groups.setdefault(c, []).append(f)
    large = sorted((c for c in groups if len(groups[c]) >= 2), key=lambda c: (-len(groups[c]), c))
    assert dict(values(modules.modules(pairs, 4, 2, 0.8), "feature", "module")) == {f: large.index(c) + 1 if c in large else 0 for f, c in low.items()}


def test_neighbours_by_brute_force(spark):
    rng = np.random.default_rng(13)
    table = {(f"g{i}", f"s{j}"): 1e4 + float(rng.normal() + i // 3) for i in range(9) for j in range(12) if rng.random() < 0.85}
    names, sample_names = sorted({f for f, _ in table}), sorted({s for _, s in table})
    df = spark.createDataFrame([(f, s, v) for (f, s), v in table.items()] + [("g0", "s0", None)] * (("g0", "s0") not in table), "feature string, sample string, value double")
    got = {(r.feature, r.sample): r.value for r in matrix.knn_impute(df, df.select("sample").distinct(), 3).collect()}
    for f in names:
        for s in sample_names:
            if (f, s) in table:
                assert got[f, s] == table[f, s]
                continue
            near = []
            for g in names:
                both = [t for t in sample_names if (f, t) in table and (g, t) in table]
                if g != f and both and (g, s) in table:
                    near.append((np.mean([(table[f, t] - table[g, t]) ** 2 for t in both]), g))
            assert math.isclose(got[f, s], np.mean([table[g, s] for _, g in sorted(near)[:3]]), rel_tol=1e-12)


def test_draws_are_the_first_of_each_order(spark):
    features = spark.createDataFrame([(f"f{i}",) for i in range(500)], "feature string")
    for size in (1, 7, 499, 600):
        keyed = features.withColumn("perm", F.explode(F.sequence(F.lit(1), F.lit(5)))).withColumn("key", F.xxhash64("feature", "perm", F.lit(3))).collect()
        wanted = sorted((p, place, f) for p in range(1, 6) for place, (_, f) in enumerate(sorted((r.key, r.feature) for r in keyed if r.perm == p)[:size], 1))
        assert values(sets._draws(features, 5, size, 3), "perm", "place", "feature") == wanted
    fold = survival.folds(spark.range(95).select(F.col("id").alias("subject")), 10, 3)
    assert sorted({r["count"] for r in fold.groupBy("repeat", "fold").count().collect()}) == [9, 10]


def test_guards_of_cleaning(spark):
    x = cells(spark, {"a": (1, 2, 900), "b": (3, 2, 800)})
    assert matrix.filter_low_information(x, 2, 2).select("feature").distinct().count() == 2
    with pytest.raises(ValueError, match="only 2 features"):
        matrix.filter_low_information(x, 2, 100)
    with pytest.raises(ValueError, match="negative"):
        matrix.to_log2(cells(spark, {"a": (-1, 2, 900)}), "always")
    assert matrix.to_log2(cells(spark, {"a": (60, 61, 62)}), early=50).first()["value"] == math.log2(61)
    assert matrix.detect_scale(x.limit(0)).first()["q50"] is None
    test = spark.createDataFrame([("a", 2.0, 0.01, 0.02), ("b", 3.0, 0.5, 0.9)], "feature string, lfc double, p double, adj_p double")
    assert values(testing.select_features(test), "feature", "reason") == [("a", "only 1 significant features, of at least 5"), ("b", "only 1 significant features, of at least 5")]


def test_survival_at_many_horizons(spark):
    rng = np.random.default_rng(14)
    steps = {g: np.unique(np.round(rng.exponential(5, 400), 3)) for g in ("a", "b", None)}
    curve = spark.createDataFrame([(g, float(t), 1.0 - i / 1000) for g, ts in steps.items() for i, t in enumerate(ts)], "stratum string, time double, survival double")
    horizons = spark.range(100_000).select((F.col("id") / 4000.0).alias("horizon"))
    got = survival.survival_at(curve, horizons).toPandas()
    at = np.arange(100_000) / 4000.0
    for g, ts in steps.items():
        own = got[got.stratum.isna() if g is None else got.stratum == g].sort_values("horizon")
        place = np.searchsorted(ts, at, "right") - 1
        assert np.array_equal(own.horizon, at[place >= 0]) and np.allclose(own.survival, 1 - place[place >= 0] / 1000)


def test_modelling_input_and_summaries(spark):
    x = spark.createDataFrame([(i, f"f{j}", float(i + j)) for i in range(25) for j in range(8)], "subject int, feature string, value double")
    s = spark.createDataFrame([(i, 1.0 + i, i % 2) for i in range(24)] + [(24, None, 1)], "subject int, time double, event int")
    test = spark.createDataFrame([(f"f{j}", 2.0, 0.001 * j, 0.01 if j < 6 else 0.9) for j in range(9)], "feature string, lfc double, p double, adj_p double")
    cells_, status = survival.modelling_input(x, s, test)
    assert tuple(status.first()) == ("ok", None, 24, 12, "fdr", 6) and cells_.count() == 24 * 6
    assert survival.modelling_input(x, s, test.withColumn("adj_p", F.lit(1.0)), fallback_n=3)[1].first()["n_candidates"] == 3
    cells_, status = survival.modelling_input(x, s.where("subject < 5"), test)
    assert status.first()["status"] == "too_few_subjects" and "only 5" in status.first()["reason"] and cells_.count() == 0
    one = survival.selection_summary(spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, None)], "repeat int, feature string")).first()
    assert tuple(one) == (3, 1.0, 0, 2, False)
    none = spark.createDataFrame([], "a string, b string, score double, method string")
    assert graph.network_status(none).first()["status"] == "skipped" and "0.9" in graph.network_status(none).first()["reason"]



@pytest.mark.parametrize("down", [False, True])
def test_group_running_over_ranges(spark, down):
    """One group holds most rows and spans ranges; null is a group, and sums of nulls alone stay null."""
    rng = random.Random(35)
    rows = [(rng.choice([None, "a", *["hot"] * 6, "z"]), rng.randrange(40), rng.choice([None, 1, 2, 5])) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, o int, v int").groupBy("g", "o").agg(F.sum("v").alias("v"))
    dealt = stats.deal_groups(df, ["g"], "o", 9)
    assert dealt.where("g = 'hot'").select("_range").distinct().count() > 2
    got = stats.group_running(dealt, ["g"], "o", {"s": "v", "n": F.lit(1)}, down).collect()
    assert len(got) == df.count()
    for x in got:
        upto = [r.v for r in got if r.g == x.g and (r.o >= x.o if down else r.o <= x.o)]
        known = [v for v in upto if v is not None]
        assert x.n == len(upto) and x.s == (sum(known) if known else None)
    assert stats.group_running(stats.deal_groups(df.limit(0), ["g"], "o"), ["g"], "o", {"s": "v"}).count() == 0


def test_kaplan_meier_of_strata_by_brute_force(spark):
    rng = np.random.default_rng(36)
    rows = [("ab"[int(rng.random() < 0.1)], float(t), int(e)) for t, e in zip(rng.integers(1, 60, 500), rng.random(500) < 0.6)]
    got = survival.kaplan_meier(spark.createDataFrame(rows, "stratum string, time double, event int")).collect()
    for s in "ab":
        own = [(t, e) for g, t, e in rows if g == s]
        left, want = 1.0, [(0.0, len(own), 0, 0, 1.0)]
        for t in sorted({t for t, _ in own}):
            n, d, c = sum(u >= t for u, _ in own), sum(u == t and e for u, e in own), sum(u == t and not e for u, e in own)
            left *= 1 - d / n
            want.append((t, n, d, c, left))
        found = sorted((r.time, r.n_risk, r.events, r.censored, r.survival) for r in got if r.stratum == s)
        assert np.allclose(np.array(found, float), np.array(want, float))
    assert survival.kaplan_meier(spark.createDataFrame([], "stratum string, time double, event int")).count() == 0


def test_schoenfeld_residuals_by_brute_force(spark):
    rng = np.random.default_rng(37)
    x, t, e = rng.normal(size=(2, 80)), rng.integers(1, 25, 80).astype(float), (rng.random(80) < 0.7).astype(int)
    cells_ = spark.createDataFrame([(i, f"f{j}", float(x[j, i])) for i in range(80) for j in range(2)], "subject int, feature string, value double")
    table = spark.createDataFrame([(i, float(t[i]), int(e[i])) for i in range(80)], "subject int, time double, event int")
    betas = spark.createDataFrame([("f0", 0.3), ("f1", -0.4)], "feature string, beta double")
    got = {(r.feature, r.subject): r for r in survival.schoenfeld(cells_, table, betas).collect()}
    assert len(got) == 2 * e.sum()
    for j, beta in enumerate((0.3, -0.4)):
        w = np.exp(beta * x[j])
        for i in np.flatnonzero(e):
            risk = t >= t[i]
            r = got[f"f{j}", int(i)]
            assert math.isclose(r.residual, x[j, i] - (w * x[j])[risk].sum() / w[risk].sum(), abs_tol=1e-9)
            assert r.rank == 1 + ((t < t[i]) & (e == 1)).sum()


def test_merge_modules_by_brute_force(spark):
    """Modules 1 and 3 follow one factor and become 1; 2 stays, and so do the unassigned."""
    rng = np.random.default_rng(38)
    a, b = rng.normal(size=(2, 20))
    base = {1: a, 2: b, 3: a}
    x = {f"m{m}g{i}": (m, base.get(m, rng.normal(size=20)) + 0.2 * rng.normal(size=20)) for m in range(4) for i in range(4)}

    def profile(names):
        z = np.array([(x[f][1] - x[f][1].mean()) / x[f][1].std(ddof=1) for f in names])
        v = np.linalg.svd(z, full_matrices=False)[2][0]
        return v * (-1 if v @ z.mean(0) < 0 else 1)

    of = {m: [f for f in x if x[f][0] == m] for m in (1, 2, 3)}
    r = {(p, q): np.corrcoef(profile(of[p]), profile(of[q]))[0, 1] for p in of for q in of if p < q}
    assert [k for k, v in r.items() if v > 0.75] == [(1, 3)]
    long = spark.createDataFrame([(f, f"s{i:02d}", float(v)) for f, (_, vs) in x.items() for i, v in enumerate(vs)], "feature string, sample string, value double")
    named = spark.createDataFrame([(f, m) for f, (m, _) in x.items()], "feature string, module int")
    got = dict(values(modules.merge_modules(long, named, 0.25), "feature", "module"))
    assert got == {f: {3: 1}.get(m, m) for f, (m, _) in x.items()}
