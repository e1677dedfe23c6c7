"""Small cases of what failed on large tables, or differed from its SQL."""

import math

import numpy as np
from pyspark.sql import functions as F

from cohortgrid.functions import stats
from cohortgrid.operators import graph, matrix, samples, sets, signed, survival


def test_scores_without_spread(spark):
    rows = [("same", s, 1.0) for s in "abcd"] + [("apart", s, 1.0 if s in "ab" else 3.0) for s in "abcd"] + [("usual", s, float(i)) for i, s in enumerate("abcd")]
    arms = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "y")], "sample string, arm string")
    got = {r.source: r for r in signed.two_arm_scores(spark.createDataFrame(rows, "source string, sample string, activity double"), arms).collect()}
    assert math.isnan(got["same"].cohens_d) and got["apart"].cohens_d == math.inf and math.isclose(got["usual"].cohens_d, 2 / math.sqrt(0.5))
    assert got["same"].z == 0.0 and got["same"].p == 1.0


def test_quartiles_without_a_buffer(spark):
    x = np.random.default_rng(1).integers(0, 50, 400).astype(float)
    rows = [(str(i), "t" if i % 3 else "u", float(v)) for i, v in enumerate(x)] + [("n", "t", None), ("o", "one", 2.5)]
    df = spark.createDataFrame(rows, "sample string, trait string, x double")
    got = {r.trait: r.q for r in stats.group_quantiles(df, "trait", "x", [0.25, 0.5, 0.75]).collect()}
    for trait in "tu":
        assert np.allclose(got[trait], np.quantile([v for _, t, v in rows if t == trait and v is not None], [0.25, 0.5, 0.75]))
    assert got["one"] == [2.5, 2.5, 2.5]
    out = samples.quartile_bins(df)
    # No percentile of a whole trait in one buffer, and the traits' rows are not shuffled.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "SortMergeJoin" not in plan and out.count() == len(rows)


def test_equal_values_are_no_information(spark):
    # The standard deviation of equal values, added up in parts, need not be 0.
    df = spark.createDataFrame([("flat", str(i), math.log2(3)) for i in range(30)] + [("live", str(i), float(i % 2)) for i in range(30)], "feature string, sample string, value double")
    assert {r.feature for r in matrix.filter_low_information(df, 20).select("feature").distinct().collect()} == {"live"}
    assert "stddev" not in matrix.filter_low_information(df, 20)._jdf.queryExecution().optimizedPlan().toString()


def counting(spark, df):
    """``df`` and a counter of how often its rows are made."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(len(b))
            yield b

    return df.mapInPandas(count, df.schema), made


def test_scale_reads_its_input_once(spark):
    cells = spark.range(3000).select(F.lit("f").alias("feature"), F.col("id").cast("string").alias("sample"), F.col("id").cast("double").alias("value"))
    df, made = counting(spark, cells)
    one = matrix.detect_scale(df).first()
    assert made.value == 3000 and (one.q50, one.scale) == (1499.5, "linear")
    df, made = counting(spark, cells)
    assert matrix.to_log2(df, early=50.0).count() == 3000 and made.value == 3000


def test_moderated_reads_its_fit_once(spark):
    from cohortgrid.operators import testing

    rng = np.random.default_rng(2)
    fit = spark.createDataFrame([(f"f{i}", float(rng.normal()), float(rng.normal()), 5, 5, float(rng.gamma(2)), 8.0, 0.6) for i in range(200)], "feature string, lfc double, ave double, n1 long, n0 long, s2 double, df double, se_unscaled double")
    df, made = counting(spark, fit)
    assert testing.moderate(df, trend=True, robust=True).count() == 200 and made.value == 200


def test_external_risks_tie_to_six_digits(spark):
    scaler = spark.createDataFrame([(f, 0.0, 1.0) for f in "abc"], "feature string, centre double, scale double")
    coefs = spark.createDataFrame([("a", 0.1), ("b", 0.1), ("c", 0.1)], "feature string, coef double")
    x2 = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (1, "c", 0.0), (2, "a", 3.0), (2, "b", 0.0), (2, "c", 0.0)], "subject int, feature string, value double")
    surv = spark.createDataFrame([(1, 1.0, 1), (2, 2.0, 0)], "subject int, time double, event int")
    risk = spark.createDataFrame([(1, 0.0)], "subject int, risk double")
    _, one = survival.external_validation(coefs, scaler, risk, x2, surv)
    one = one.first()
    assert (one.pairs, one.concordant, one.tied, one.c) == (1, 0, 1, 0.5)


def test_no_edge_is_skipped_in_sql_too(spark):
    import duckdb

    from cohortgrid.plans.registry import ORACLE_SQL

    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings AS SELECT CAST(i AS INT) AS vec_id, CAST(i % 2 AS INT) AS label, [CAST(i AS FLOAT), CAST((i * 37 + 11) % 101 AS FLOAT)] AS embedding FROM range(101) t(i)")
    con.execute("UPDATE embeddings SET embedding = [CAST((vec_id - 50) * (vec_id - 50) AS FLOAT), CAST(vec_id AS FLOAT)]")
    status, method, n_edges, n_nodes, caveat, reason = con.execute(ORACLE_SQL["g5_network_status"]).fetchone()
    none = spark.createDataFrame([], "a string, b string, score double, method string")
    row = graph.network_status(none, 0.05).first()
    assert (status, method, n_edges, n_nodes, caveat, reason) == tuple(row)


def test_profiles_equal_principal_components(spark):
    from cohortgrid.operators import modules

    rng = np.random.default_rng(4)
    x = rng.normal(size=(6, 1)) @ rng.normal(size=(1, 40)) + 0.2 * rng.normal(size=(6, 40))
    x[5] = 3.0
    df = spark.createDataFrame([(f"f{i}", f"s{j:02}", float(v)) for i, row in enumerate(x) for j, v in enumerate(row) if (i, j) != (1, 7)], "feature string, sample string, value double")
    named = spark.createDataFrame([(f"f{i}", 1) for i in range(5)] + [("f5", 2)], "feature string, module int")
    out = modules.eigen_profiles(df, named)
    got = {(r.module, r["sample"]): r.value for r in out.collect()}
    x[1, 7] = np.nan
    z = np.nan_to_num((x[:5] - np.nanmean(x[:5], 1, keepdims=True)) / np.nanstd(x[:5], 1, ddof=1, keepdims=True))
    v = np.linalg.svd(z)[2][0]
    v *= np.sign(v @ z.mean(0))
    assert {m for m, _ in got} == {1} and np.allclose([got[1, f"s{j:02}"] for j in range(40)], v, atol=1e-6)
    # The cells are not shuffled to meet the weights.
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_similar_sets_make_no_row_for_a_pair_before_it_is_counted(spark, monkeypatch):
    """Sets of many members that meet in short lists: pairs are counted in place, and only those that may reach the threshold are looked at again."""
    rng = np.random.default_rng(5)
    table = {f"s{i:02d}": {int(x) for x in rng.choice(400, 40 + i, False)} for i in range(20)}
    table |= {f"t{i:02d}": (set(list(table[f"s{i:02d}"])[:-9]) if i % 2 else set(list(table[f"s{i:02d}"])[:20])) for i in range(10)}
    df = spark.createDataFrame([(s, str(x)) for s, xs in table.items() for x in xs], "set_id string, feature string")
    counted = []
    real = sets.shared_edges
    monkeypatch.setattr(sets, "shared_edges", lambda *a: counted.append(a[0]) or real(*a))
    for threshold in (0.16, 0.3, 0.55):
        wanted = {(a, b): len(table[a] & table[b]) / len(table[a] | table[b]) for a in table for b in table if a < b}
        wanted = {k: v for k, v in wanted.items() if v >= threshold}
        for most in (20_000, 0):
            monkeypatch.setattr(sets, "MOST_COUNTED", most)
            got = sets.jaccard_pairs(df, threshold)
            found = {(r.a, r.b): r.jaccard for r in got.collect()}
            assert found.keys() == wanted.keys() and all(math.isclose(found[k], v) for k, v in wanted.items())
    assert len(counted) == 6


def test_sums_along_times_are_sent_by_block(spark, monkeypatch):
    """Equal times over several blocks: log-likelihood and gradient by hand, and nothing for each time on the driver."""
    from cohortgrid.operators import cox_path

    rng = np.random.default_rng(8)
    n, p = 90, 2
    x, t, e, fold = rng.normal(size=(n, p)), np.minimum(rng.integers(0, 40, n), 25).astype(float), rng.integers(0, 2, n), rng.integers(1, 3, n)
    cov = spark.createDataFrame([(i, f"f{j}", float(x[i, j])) for i in range(n) for j in range(p)], "subject int, feature string, value double")
    surv = spark.createDataFrame([(i, float(t[i]), int(e[i])) for i in range(n)], "subject int, time double, event int")
    folds = spark.createDataFrame([(i, 1, int(fold[i])) for i in range(n)], "subject int, repeat int, fold int")
    beta = np.array([[0.5, -0.3], [0.1, 0.2], [-0.4, 0.0]])
    for size in (7, 1000):
        monkeypatch.setattr(cox_path, "TIMES", size)
        cohort = cox_path._Cohort(cov, surv, folds)
        cohort.admit([0, 1])
        value, sums = cohort.hazards(beta)
        assert all(s.shape == (-(-n // size), 3) for s in sums)
        gradient, whole = cohort.gradient(beta, sums)[0], cohort.whole_gradient(beta, sums)
        for m in range(3):
            at = fold != m
            w, wanted, slope = np.exp(x @ beta[m]), 0.0, np.zeros(p)
            for i in np.flatnonzero(at & (e == 1)):
                risk = at & (t >= t[i])
                wanted += x[i] @ beta[m] - math.log(w[risk].sum())
                slope += x[i] - w[risk] @ x[risk] / w[risk].sum()
            events = e[at].sum()
            assert math.isclose(value[m], wanted / events) and np.allclose(gradient[m], slope / events) and np.allclose(whole[m], slope / events)


def test_concordance_over_many_blocks(spark, monkeypatch):
    """Times and risks cut into blocks, one of them of many equal values, with several weights."""
    from cohortgrid.operators import concordance

    rng = np.random.default_rng(4)
    n = 150
    t, r = np.where(rng.random(n) < 0.3, 20.0, rng.integers(0, 40, n)), np.where(rng.random(n) < 0.3, 5.0, rng.integers(0, 12, n))
    e, w, g = rng.integers(0, 2, n), rng.integers(0, 4, (n, 3)), rng.integers(0, 2, n)
    df = spark.createDataFrame([(int(g[i]), float(t[i]), int(e[i]), float(r[i]), [int(x) for x in w[i]]) for i in range(n)], "g int, time double, event int, risk double, w array<byte>")
    monkeypatch.setattr(concordance, "AT_ONCE", 2)
    for rows in (10, 1000):
        monkeypatch.setattr(concordance, "ROWS", rows)
        got = {x.g: (x.pairs, x.concordant, x.tied) for x in concordance.weighted_concordance(df, ["g"]).collect()}
        got |= {None: tuple(concordance.weighted_concordance(df.drop("g")).first())}
        for group in (0, 1, None):
            own = np.flatnonzero((g == group) | (group is None))
            pairs = [(i, j) for i in own for j in own if e[i] and t[i] < t[j]]
            of = lambda keep: [sum(int(w[i, m] * w[j, m]) for i, j in pairs if keep(r[i], r[j])) for m in range(3)]
            assert got[group] == (of(lambda a, b: True), of(lambda a, b: a > b), of(lambda a, b: a == b))


def test_optimism_of_times_over_several_blocks(spark, monkeypatch):
    """Blocks of three rows, with times that fill several of them, give what one block gives; a row is sent once for all replicates."""
    from cohortgrid.operators import cox_replicates

    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, float(t), int(rng.integers(0, 2)), float(round(rng.normal() - t / 9, 2))) for i, t in enumerate(rng.choice([1, 2, 2, 2, 3, 4, 5, 5], 60))], "subject long, time double, event int, risk double")
    made = []
    real = cox_replicates.time_blocks
    monkeypatch.setattr(cox_replicates, "time_blocks", lambda rows, size: made.append((rows.count(), size)) or real(rows, size))
    results = []
    for values in (1 << 20, 15):
        monkeypatch.setattr(cox_replicates, "VALUES", values)
        got = survival.optimism(df.select("subject", "time", "event"), df.select("subject", "risk"), 4).collect()
        results.append({r.measure: list(r)[1:] for r in got})
    assert made == [(60, (1 << 20) // 5), (60, 3)]
    assert all(np.allclose(results[0][k], results[1][k]) for k in ("dxy", "slope", "r2"))
    assert survival.optimism(df.limit(0).select("subject", "time", "event"), df.select("subject", "risk"), 4).count() == 0


def test_conditional_odds_of_large_tables(spark):
    """The mean overlap at the odds is the overlap, also with a hundred thousand terms."""
    for k, n, m, d in ((3, 20, 6, 5), (70, 1000, 200, 300), (30_000, 1_000_000, 100_000, 120_000), (1, 1_000_000, 100_000, 120_000), (99_999, 1_000_000, 100_000, 120_000)):
        odds = signed._conditional_odds(k, n, m, d)
        i = np.arange(max(0, d + m - n), min(m, d) + 1)
        logs = np.array([-math.lgamma(v + 1) - math.lgamma(m - v + 1) - math.lgamma(d - v + 1) - math.lgamma(n - m - d + v + 1) for v in i.tolist()]) + math.log(odds) * i
        w = np.exp(logs - logs.max())
        assert math.isclose(w @ i / w.sum(), k, rel_tol=1e-6)
    assert signed._conditional_odds(0, 20, 6, 5) == 0.0 and signed._conditional_odds(5, 20, 6, 5) == math.inf


def test_overlap_reads_texts_once(spark, monkeypatch):
    from cohortgrid.plans import bindings, set_queries

    read = []
    docs = spark.createDataFrame([(i, f"ab{i % 3} abc abd abe abf abg ac{'x' * (i % 7)}") for i in range(30)], "doc_id long, text string")
    monkeypatch.setattr(bindings.Data, "table", lambda self, name: read.append(name) or docs)
    rows = set_queries.overlap(bindings.Data(spark, "")).collect()
    assert read == ["documents"] and {r.source for r in rows} == {"ab", "ac"}
