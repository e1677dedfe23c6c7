"""Small cases of what failed on large tables in round 4."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortgrid.operators import cox_replicates, graph, pairs, qc


def propagated(edges, rounds):
    links = defaultdict(list)
    for a, b, s in edges:
        links[a].append((b, s))
        links[b].append((a, s))
    label = {v: v for v in links}
    for _ in range(rounds):
        new = {}
        for v, own in links.items():
            w = defaultdict(float)
            w[label[v]] += max(s for _, s in own)
            for o, s in own:
                w[label[o]] += s
            new[v] = min(w, key=lambda x: (-w[x], x))
        if new == label:
            break
        label = new
    return label


@pytest.mark.parametrize("path", ["tables", "sorted", "joins"])
@pytest.mark.parametrize("positive", [True, False])
def test_labels_by_hand(spark, monkeypatch, path, positive):
    """Ties, components, names as text, scores that are not positive; by tables of weights, by sorting and by joins."""
    rng = np.random.default_rng(3)
    edges = {}
    for _ in range(150):
        a, b = sorted(f"n{x:02d}" for x in rng.choice(30, 2, False) + 30 * rng.integers(0, 2))
        edges[a, b] = int(rng.integers(1, 4) if positive else rng.integers(-3, 3))
    rows = [(a, b, s) for (a, b), s in edges.items()]
    monkeypatch.setattr(graph, "MOST_NODES", 0 if path == "joins" else 1000)
    monkeypatch.setattr(graph, "CELLS", 100)
    if path == "tables":
        rows += [(f"n{x:02d}", f"n{y:02d}", 1) for x in range(30) for y in range(x + 1, 30) if (f"n{x:02d}", f"n{y:02d}") not in edges]
    df = spark.createDataFrame(rows, "a string, b string, score long")
    written = []
    real = graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df, name="table": written.append(name) or real(df, name))
    for rounds in (1, 10):
        written.clear()
        named = graph.communities(df, 3, rounds)
        # Links are written once, and no table for a round.
        assert path == "joins" or (written.count("blocks") == 1 and written.count("labels") == 1)
        want = propagated(rows, rounds)
        sizes = defaultdict(int)
        for v in want.values():
            sizes[v] += 1
        order = sorted(sizes, key=lambda x: (-sizes[x], x))
        got = {r.node: (r.community, r["size"]) for r in named.collect()}
        assert got == {v: (str(order.index(x) + 1) if order.index(x) < 3 else "other", sizes[x]) for v, x in want.items()}
        m, k = sum(s for *_, s in rows), defaultdict(float)
        inside = sum(s for a, b, s in rows if got[a][0] == got[b][0])
        for a, b, s in rows:
            k[got[a][0]] += s
            k[got[b][0]] += s
        if m:
            assert math.isclose(graph.modularity(df, named).first()[0], inside / m - sum(v * v for v in k.values()) / (2 * m) ** 2, abs_tol=1e-12)


def test_no_edge_has_no_community(spark):
    assert graph.communities(spark.createDataFrame([], "a int, b int, score long")).count() == 0


@pytest.mark.parametrize("values", [1 << 20, 21])
def test_replicates_run_all_tasks_at_once(spark, monkeypatch, values):
    """Log-likelihood, score and information by hand, with few and very many ties, and one job for a pass over any number of files."""
    rng = np.random.default_rng(6)
    n, m = 40, 3
    t, e, x = rng.integers(0, 25, n).astype(float), rng.integers(0, 2, n), rng.normal(size=n)
    w = np.stack([rng.integers(0, 3, n), np.ones(n, int), rng.integers(0, 90, n)], 1)
    df = spark.createDataFrame([(float(t[i]), int(e[i]), float(x[i]), [int(v) for v in w[i]]) for i in range(n)], "time double, event int, risk double, w array<tinyint>")
    monkeypatch.setattr(cox_replicates, "VALUES", values)
    monkeypatch.setattr(cox_replicates, "MODELS", 2)
    fits = cox_replicates.Replicates(df, m)
    assert fits.scan.n == (1 if values > n * m else 6) and list(fits.sizes) == list(w.sum(0))
    beta = np.array([0.3, -0.5, 1.0])
    spark.sparkContext.setJobGroup(f"pass{values}", "")
    found = fits.terms(beta)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"pass{values}")) == 2
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for k in range(m):
        want, own = np.zeros(3), np.exp(beta[k] * x) * w[:, k]
        for time in np.unique(t):
            risk, dead = t >= time, (t == time) & (e == 1)
            d = int(w[dead, k].sum())
            want[:2] += np.array([beta[k], 1.0]) * (w[dead, k] * x[dead]).sum()
            for tie in range(d):
                a = [(own[risk] * x[risk] ** q).sum() - tie / d * (own[dead] * x[dead] ** q).sum() for q in range(3)]
                want += [-math.log(a[0]), -a[1] / a[0], a[2] / a[0] - (a[1] / a[0]) ** 2]
        assert np.allclose(found[:, k], want)


def test_draws_are_those_of_the_hash(spark, monkeypatch):
    """Multiplicities are the number of steps of the Poisson distribution below a hash of subject, replicate and seed."""
    from cohortgrid.operators import survival

    df = spark.createDataFrame([(i, float(i % 7) + 1, i % 2, i / 50) for i in range(50)], "subject long, time double, event int, risk double")
    kept = []
    real = survival.materialise
    monkeypatch.setattr(survival, "materialise", lambda df, name="table": kept.append(real(df, name)) or kept[-1])
    survival.optimism(df.select("subject", "time", "event"), df.select("subject", "risk"), 30).collect()
    draws = {r.risk: list(r.w) for r in kept[0].collect()}
    u = df.select("risk", *((F.pmod(F.xxhash64("subject", F.lit(i), F.lit(1)), F.lit(1 << 30)) / float(1 << 30)).alias(str(i)) for i in range(31))).collect()
    steps = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(8)]
    assert len(draws) == 50 and all(draws[r.risk] == [1, *(sum(v > s for s in steps) for v in list(r)[2:])] for r in u)


def test_sums_over_whole_samples_look_at_no_pair(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(40, 6)) + 100
    x[3] = 5.0
    x[4] = x[5]
    rows = [(f"f{j}", f"s{i:02d}", float(v)) for i, row in enumerate(x) for j, v in enumerate(row)]
    schema, label = "feature string, sample string, value double", {f"s{i:02d}": i % 3 if i else 9 for i in range(38)}
    labels = spark.createDataFrame(list(label.items()), "item string, label int")
    by_pairs = qc.visit_pairs
    monkeypatch.setattr(qc, "visit_pairs", None)
    got = {r[0]: list(r)[1:] for r in qc.correlation_sums(spark.createDataFrame(rows, schema), labels).collect()}
    r = np.corrcoef(np.delete(x, 3, 0))
    r = np.insert(np.insert(r, 3, np.nan, 0), 3, np.nan, 1)
    for i, (item, own) in enumerate(label.items()):
        same = [r[i, j] for j, o in enumerate(label.values()) if i != j and o == own and not np.isnan(r[i, j])]
        other = [r[i, j] for j, o in enumerate(label.values()) if o != own and not np.isnan(r[i, j])]
        assert got[item][0] == own and got[item][2::2] == [len(same), len(other)] and np.allclose(got[item][1::2], [sum(same), sum(other)])
    assert len(got) == 38
    # With a gap pairs are looked at, and one sample alone is in no pair.
    assert qc.correlation_sums(spark.createDataFrame(rows, schema), labels.limit(1)).count() == 0
    monkeypatch.setattr(qc, "visit_pairs", by_pairs)
    assert qc.correlation_sums(spark.createDataFrame(rows[1:], schema), labels).count() == 38
    assert not pairs.every_cell(qc._cells(spark.createDataFrame(rows[1:], schema), "sample"))


def test_close_pairs_near_the_threshold(monkeypatch):
    """Single precision only leaves out pairs: those within its error of the threshold are decided in double."""
    import pyarrow as pa

    monkeypatch.setattr(pairs, "TILE", 16)
    rng = np.random.default_rng(8)
    u = rng.normal(size=(60, 64))
    u -= u.mean(1, keepdims=True)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = u[1::2] - (u[1::2] * u[::2]).sum(1, keepdims=True) * u[::2]
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    r = 0.9 + np.repeat([1e-9, -1e-9], 15)[:, None]
    u[1::2] = r * u[::2] + np.sqrt(1 - r * r) * w
    table = pa.table({"item": pa.array(range(60)), "label": pa.array([0] * 60), "h": pa.array([list(range(64))] * 60), "v": pa.array(u.tolist())})
    side = lambda rows: pairs.Side(rows, np.tile(np.arange(64), len(rows)), 64)
    both = side(table)
    found = {(i, j) for batch in pairs._near(both, both, 0.9) for i, j in zip(*map(np.ndarray.tolist, batch))}
    assert found == {(i, i + 1) for i in range(0, 30, 2)}
    even, odd = side(table.take(list(range(0, 60, 2)))), side(table.take(list(range(1, 60, 2))))
    assert {(i, j) for batch in pairs._near(even, odd, 0.9) for i, j in zip(*map(np.ndarray.tolist, batch))} == {(i, i) for i in range(15)}


def test_clusters_look_at_pairs_once(spark, monkeypatch):
    made = []
    real = qc.visit_pairs
    df = spark.createDataFrame([(f"f{j}", f"s{i}", float((i * j) % 7)) for i in range(12) for j in range(5)], "feature string, sample string, value double")
    count = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            count.add(b.num_rows)
            yield b

    monkeypatch.setattr(qc, "visit_pairs", lambda *a: made.append(real(*a)) or made[-1].mapInArrow(counted, made[-1].schema))
    assert qc.correlation_clusters(df).count() == 12
    assert count.value == made[0].count()


def test_a_group_of_copies_is_a_row_for_each_sample(spark):
    """Not one for each two of them: two blocks give one row for each of their samples, with gaps and without."""
    rng = np.random.default_rng(10)
    base = rng.normal(size=6)
    rows = [(f"f{j}", f"s{i:03d}", float(v)) for i in range(200) for j, v in enumerate(base * (1 + i % 3) if i % 4 else rng.normal(size=6))]
    schema = "feature string, sample string, value double"
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame(rows[1:], schema)):
        near = pairs.visit_pairs(qc._cells(df, "sample"), pairs.close_pairs(0.999), "a string, b string").where("a <> b")
        assert near.count() < 4 * 200
        sizes = [r["count"] for r in qc.correlation_clusters(df, 0.999).groupBy("cluster").count().collect()]
        assert max(sizes) == 150
