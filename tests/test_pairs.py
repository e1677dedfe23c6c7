"""Correlations of all pairs by blocks against pandas, with gaps and constant samples."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortgrid.operators import modules, pairs, qc


@pytest.fixture(params=["whole", "gaps"])
def matrix(request, spark):
    rng = np.random.default_rng(5)
    wide = pd.DataFrame(rng.normal(size=(12, 3)) @ rng.normal(size=(3, 90)) + rng.normal(size=(12, 90)) * 0.3 + 40, index=[f"f{i}" for i in range(12)], columns=[f"s{i:02}" for i in range(90)])
    wide["s07"] = 5.0
    if request.param == "gaps":
        wide = wide.mask(rng.random(wide.shape) < 0.2)
    long = wide.stack().reset_index().set_axis(["feature", "sample", "value"], axis=1)
    r = wide.corr(min_periods=2)
    r.loc["s07"] = r["s07"] = np.nan
    r = r.mask(np.eye(len(r), dtype=bool))
    return spark.createDataFrame(long), r


@pytest.fixture(params=[True, False], ids=["tiles", "slices"])
def size(request, monkeypatch):
    monkeypatch.setattr(pairs, "TILE", 7)
    if not request.param:
        monkeypatch.setattr(pairs, "MOST_CELLS", 1)


def same(a, b):
    return (a is None and np.isnan(b)) or (a is not None and abs(a - b) < 1e-9)


def test_pairs_and_least(matrix, size):
    df, r = matrix
    got = {(x.a, x.b): x.r for x in qc.pair_correlation(df).collect()}
    assert len(got) == 90 * 89 // 2 and all(a < b and same(v, r.loc[a, b]) for (a, b), v in got.items())
    low = {x.sample: x.min_r for x in qc.sample_correlation_outliers(df).collect()}
    assert len(low) == 90 and all(same(v, r.loc[s].min()) for s, v in low.items())


def test_arms_and_distances(spark, matrix, size):
    df, r = matrix
    arm = {s: "x" if i % 3 else "y" for i, s in enumerate(r.index) if i % 5}
    got = {x.sample: (x.arm, x.within, x.between) for x in qc.arm_correlation(df, spark.createDataFrame(list(arm.items()), "sample string, arm string")).collect()}
    mine = r.loc[list(arm), list(arm)]
    is_same = np.equal.outer(list(arm.values()), list(arm.values()))
    assert same(got.pop(None)[1], np.nanmean(mine.values[is_same])) and set(got) == set(arm)
    for s, (a, within, between) in got.items():
        of = np.array([arm[o] == a for o in arm])
        assert a == arm[s] and same(within, mine.loc[s][of].mean()) and same(between, mine.loc[s][~of].mean())
    far = {x.sample: (x.distance, x.outlier) for x in modules.sample_outliers(df, 1.2).collect()}
    want = (1 - r).mean(1)
    assert all(same(v, want[s]) and o == (None if v is None else v > 1.2 * want.median()) for s, (v, o) in far.items()) and len(far) == 90


def test_clusters(matrix, size):
    df, r = matrix
    own = {s: s for s in r.index}
    for _ in own:
        for a in own:
            own[a] = min([own[a], *(own[b] for b in r.index[r.loc[a] >= 0.9])])
    found = qc.correlation_clusters(df)
    assert {x.sample: x.cluster for x in found.collect()} == own
    one = qc.cluster_verdict(df, found).first()
    label = np.array([own[s] for s in r.index])
    is_same = np.equal.outer(label, label)
    assert one["n_clusters"] == len(set(label)) > 1 and same(one["within"], np.nanmean(r.values[is_same])) and same(one["between"], np.nanmean(r.values[~is_same]))


def test_only_close_pairs_become_rows(spark):
    df = spark.range(400).select(F.col("id").cast("string").alias("sample"), F.posexplode(F.array(*(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)).cast("double") for i in range(16)))).alias("f", "value")).selectExpr("cast(f as string) as feature", "sample", "value")
    near = pairs.visit_pairs(qc._cells(df, "sample"), pairs.close_pairs(0.999), "a string, b string")
    assert near.where("a = b").select("a").distinct().count() == 400 and near.where("a <> b").count() == 0


def test_shared_edges_shuffle_lists_not_pairs(spark, monkeypatch):
    from itertools import combinations

    from cohortgrid.operators import graph

    rows = [(int(n), int(g)) for g in range(30) for n in np.random.default_rng(g).integers(0, 40, 25)] + [(None, 1), (1, None)]
    df = spark.createDataFrame(rows, "node int, via int")
    want = {}
    for g in range(30):
        for pair in combinations(sorted({n for n, v in rows if v == g and n is not None}), 2):
            want[pair] = want.get(pair, 0) + 1
    for longest in (4096, 5):
        monkeypatch.setattr(graph, "LONGEST", longest)
        found = graph.shared_edges(df, "node", "via")
        assert {(r.a, r.b): r.score for r in found.collect()} == want
        # Counts of pairs are made where the pairs are: nothing is shuffled between them.
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Generate explode(bs") < plan.index("REPARTITION_BY_NUM")
        assert "Exchange" not in plan[: plan.index("Generate explode(bs")]
