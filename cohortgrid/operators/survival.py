"""Survival: tables ``(subject, time, event)``, risks ``(subject, risk)``, covariates long ``(subject, feature, value)``.

Cumulative sums run over distinct times, which a grouped sum makes first, in ranges of stratum or
feature and time, so that neither few strata nor one feature with very many times is a single task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import deal_groups, exact_quantiles, global_running, group_running
from ..session import materialise

#: The normal quantile of 0.975.
Z975 = 1.959963984540054


def survival_table(rows: DataFrame, time_col: str, event_col: str, event_values: Sequence[str]) -> DataFrame:
    """``rows`` with ``time``, ``event`` (1 for a declared value, null for blank, else 0) and ``reason`` (null where usable)."""
    text = F.trim(F.col(event_col).cast("string"))
    event = F.when(text.isNull() | (text == ""), None).when(text.isin(list(event_values)), 1).otherwise(0)
    x = rows.withColumn("time", F.expr(f"try_cast(`{time_col}` AS double)")).withColumn("event", event)
    bad_time = F.col("time").isNull() | F.isnan("time") | (F.abs("time") == float("inf"))
    return x.withColumn("reason", F.when(bad_time, "no_time").when(F.col("time") <= 0, "time_not_positive").when(F.col("event").isNull(), "no_event"))


def survival_counts(table: DataFrame) -> DataFrame:
    """``(reason, n, events)`` of a survival table; the usable rows have the reason ``ok``."""
    return table.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"), F.coalesce(F.sum("event"), F.lit(0)).cast("long").alias("events"))


def epv_cap(surv: DataFrame, epv: int = 10, min_events: int = 20) -> DataFrame:
    """One row: subjects, events, the most features ``epv`` events each allow, and whether there are enough events."""
    return surv.agg(F.count("*").alias("n"), F.sum("event").alias("events")).select("n", "events", F.floor(F.col("events") / epv).alias("cap"), (F.col("events") >= min_events).alias("enough"))


def signature_candidates(measurements: DataFrame, surv: DataFrame, features: DataFrame) -> DataFrame:
    """Cells of candidate features of subjects with a usable time."""
    return measurements.join(features.select("feature").distinct(), "feature", "left_semi").join(surv.select("subject").distinct(), "subject", "left_semi")


def modelling_input(measurements: DataFrame, surv: DataFrame, test: DataFrame, adj_p: float = 0.05, lfc: float = 1.0, min_features: int = 5, fallback_n: int = 500, min_subjects: int = 20) -> tuple[DataFrame, DataFrame]:
    """Cells to model, and one row ``(status, reason, n_subjects, n_events, mode, n_candidates)``.

    Candidates are the significant features of the test table that are measured (``fdr``); fewer than ``min_features`` of them give way to the ``fallback_n``
    smallest p-values, whatever the size of the difference (``ranked_fallback``). With fewer than ``min_subjects`` subjects that have both cells and a usable time there are
    no cells, and the status says so.
    """
    from .testing import significant

    spark = measurements.sparkSession
    measured = materialise(measurements.select("feature").distinct(), "measured")
    chosen, mode = materialise(significant(test, adj_p, lfc).select("feature").distinct().join(measured, "feature", "left_semi"), "candidates"), "fdr"
    if chosen.limit(min_features).count() < min_features:
        ranked = test.where("p is not null").orderBy("p", "feature").limit(fallback_n)
        chosen, mode = materialise(ranked.select("feature").distinct().join(measured, "feature", "left_semi"), "candidates"), "ranked_fallback"
    usable = surv.where("time is not null and event is not null").join(measurements.select("subject").distinct(), "subject", "left_semi")
    n, events = usable.agg(F.count_distinct("subject"), F.coalesce(F.sum("event"), F.lit(0))).first()
    enough = n >= min_subjects
    reason = None if enough else f"only {n} subjects have both measurements and a usable time, of at least {min_subjects}"
    row = (("ok" if enough else "too_few_subjects"), reason, n, int(events), mode, chosen.count())
    status = spark.createDataFrame([row], "status string, reason string, n_subjects long, n_events long, mode string, n_candidates long")
    cells = signature_candidates(measurements, usable, chosen)
    return (cells if enough else cells.limit(0)), status


def fit_scaler(x: DataFrame) -> DataFrame:
    """``(feature, centre, scale)``; a zero or undefined scale is 1."""
    s = x.groupBy("feature").agg(F.avg("value").alias("centre"), F.stddev_samp("value").alias("scale"))
    return s.withColumn("scale", F.when(F.col("scale") > 0, F.col("scale")).otherwise(1.0))


def apply_scaler(x: DataFrame, scaler: DataFrame) -> DataFrame:
    """Cells standardised by a stored scaler; non-finite results are 0 and features it lacks are left out."""
    z = (F.col("value") - F.col("centre")) / F.col("scale")
    return x.join(scaler, "feature").select("subject", "feature", F.when(z.isNull() | F.isnan(z), 0.0).otherwise(z).alias("value"))


def folds(ids: DataFrame, k: int = 10, repeats: int = 5, seed: int = 1) -> DataFrame:
    """``(subject, repeat, fold)``: balanced folds by the order of an MD5 hash of seed, repeat and subject, all repeats ranked together over ranges."""
    from ..functions.stats import global_row_number

    x = ids.select("subject").distinct().withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("repeat").cast("string"), F.col("subject").cast("string")))
    ranked = global_row_number(x.withColumn("_h", h), [F.col("repeat"), F.col("_h"), F.col("subject")], "_at")
    ranked = materialise(ranked.select("subject", "repeat", "_at"), "folds")
    first = ranked.groupBy("repeat").agg(F.min("_at").alias("_first"))
    return ranked.join(F.broadcast(first), "repeat").select("subject", "repeat", ((F.col("_at") - F.col("_first")) % k + 1).cast("int").alias("fold"))


def risk_score(x: DataFrame, coefs: DataFrame) -> DataFrame:
    """``(subject, risk)``: the sum of coefficients times standardised values."""
    return x.join(coefs.select("feature", "coef"), "feature").groupBy("subject").agg(F.sum(F.col("coef") * F.col("value")).alias("risk"))


def concordance_counts(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by.., pairs, concordant, tied, c)`` of rows ``(by.., time, event, risk, w)``; ``w`` counts a row so many times.

    A pair is comparable where the shorter time had the event and the times differ. See :mod:`concordance`. ``by`` must not be null.
    """
    from .concordance import weighted_concordance

    by = list(by)
    x = rows.where("time is not null and event is not null and risk is not null").select(*by, F.col("time").cast("double").alias("time"), "event", (F.col("risk").cast("double") + 0.0).alias("risk"), F.col("w").cast("long").alias("w"))
    x = materialise(x.groupBy(*by, "time", "event", "risk").agg(F.array(F.sum("w")).alias("w")), "asked")
    one = weighted_concordance(x, by).groupBy(*by).agg(*(F.coalesce(F.sum(F.element_at(c, 1)), F.lit(0)).alias(c) for c in ("pairs", "concordant", "tied")))
    return one.withColumn("c", F.when(F.col("pairs") > 0, (F.col("concordant") + F.col("tied") * 0.5) / F.col("pairs")))


def concordance(surv: DataFrame, risk: DataFrame) -> DataFrame:
    """One row: comparable pairs (the shorter time had the event, times differ), concordant and tied ones, and C."""
    return concordance_counts(surv.select("subject", "time", "event").join(risk.select("subject", "risk"), "subject").withColumn("w", F.lit(1)))


def external_validation(coefs: DataFrame, scaler: DataFrame, train_risk: DataFrame, x2: DataFrame, surv2: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Risks (to six digits) of a second cohort by the training scale, split at the training median; and one row with C and the features found and missing."""
    # Sums in another order differ in their last digits, which must not part equal risks.
    risk = risk_score(apply_scaler(x2, scaler), coefs).withColumn("risk", F.round("risk", 6) + 0.0)
    cutoff = median_cutoff(train_risk)
    rows = risk_strata(risk, cutoff)
    found = coefs.join(x2.select("feature").distinct().withColumn("hit", F.lit(1)), "feature", "left").agg(F.count("hit").alias("found"), F.count_if(F.col("hit").isNull()).alias("missing"))
    return rows, concordance(surv2, risk).join(found, F.lit(True))


def median_cutoff(risk: DataFrame) -> DataFrame:
    """One row: the median risk as ``cutoff``."""
    return risk.sparkSession.createDataFrame([(exact_quantiles(risk, "risk", [0.5])[0],)], "cutoff double")


def risk_strata(risk: DataFrame, cutoff: DataFrame) -> DataFrame:
    """``risk`` with ``stratum``: ``high`` above the one value in ``cutoff``, else ``low``."""
    return risk.join(F.broadcast(cutoff.select("cutoff")), F.lit(True)).withColumn("stratum", F.when(F.col("risk") > F.col("cutoff"), "high").otherwise("low"))


def kaplan_meier(surv: DataFrame, by: Sequence[str] = ("stratum",)) -> DataFrame:
    """``(by.., time, n_risk, events, censored, survival)``, one row for each distinct time and a start at (0, 1); no subjects give no rows."""
    by = list(by)
    per = surv.where("time is not null and event is not null").groupBy(*by, "time").agg(F.count("*").alias("n"), F.sum("event").cast("long").alias("events"))
    per = group_running(deal_groups(per, by, "time"), by, "time", {"n_risk": "n"}, down=True)
    # A step to zero has no logarithm; from there on survival is zero.
    step = 1 - F.col("events") / F.col("n_risk")
    per = per.withColumns({"log": F.when(step > 0, F.log(step)).otherwise(0.0), "end": (step <= 0).cast("int")})
    per = group_running(per, by, "time", {"logs": "log", "ends": "end"})
    per = per.select(*by, "time", "n_risk", "events", (F.col("n") - F.col("events")).alias("censored"), F.when(F.col("ends") > 0, 0.0).otherwise(F.exp("logs")).alias("survival"))
    zero = F.lit(0).cast("long")
    start = per.groupBy(*by).agg(F.max("n_risk").alias("n_risk")).select(*by, F.lit(0.0).alias("time"), "n_risk", zero.alias("events"), zero.alias("censored"), F.lit(1.0).alias("survival"))
    return start.unionByName(per)


def survival_before(surv: DataFrame, ends: Column) -> DataFrame:
    """``(time, before)``: the Kaplan-Meier survival of ``ends`` (1 or 0 a row) just before each time, in parallel ranges."""
    per = surv.where("time is not null and event is not null").groupBy("time").agg(F.count("*").alias("n"), F.sum(ends).alias("e"))
    per = global_running(per, F.col("time").desc(), sums={"at_risk": "n"})
    step = 1 - F.col("e") / F.col("at_risk")
    per = per.withColumns({"log": F.when(step > 0, F.log(step)).otherwise(0.0), "end": (step <= 0).cast("int")})
    per = global_running(per, F.col("time").asc(), sums={"logs": "log", "ends": "end"})
    return per.select("time", F.when(F.col("ends") - F.col("end") > 0, 0.0).otherwise(F.exp(F.col("logs") - F.col("log"))).alias("before"))


def survival_at(curve: DataFrame, horizons: DataFrame, by: Sequence[str] = ("stratum",)) -> DataFrame:
    """``(by.., horizon, survival)``: the last step at or before each horizon, of every group that has one.

    Steps and horizons are dealt together by range; each range carries its last step on, and the last steps of the ranges before, one
    row for each range and group in it, fill what begins without one. No step meets a horizon in a join.
    """
    by = list(by)
    groups = curve.select(*by).distinct()
    asked = groups.join(F.broadcast(horizons.select("horizon").distinct()), F.lit(True)).select(*by, F.col("horizon").alias("time"), F.lit(None).cast("double").alias("survival"), F.lit(1).alias("asked"))
    rows = curve.select(*by, "time", "survival", F.lit(0).alias("asked")).unionByName(asked)
    n = int(curve.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(rows.repartitionByRange(n, *by, "time", "asked").withColumn("_range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_range", *by).orderBy("time", "asked")
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = dealt.groupBy("_range", *by).agg(F.max_by("survival", F.when(F.col("asked") == 0, F.col("time"))).alias("end"))
    ends = ends.select("_range", *by, F.last("end", ignorenulls=True).over(before).alias("carried"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"e.{c}")) for c in ("_range", *by)]
    told = dealt.withColumn("own", F.last("survival", ignorenulls=True).over(inside)).where("asked = 1")
    out = told.alias("d").join(F.broadcast(ends).alias("e"), same)
    return out.select(*(F.col(f"d.{c}") for c in by), F.col("d.time").alias("horizon"), F.coalesce("own", "carried").alias("survival")).where("survival is not null")


def log_rank(surv: DataFrame) -> DataFrame:
    """One row: observed and expected events of the stratum first by name, variance and chi-square of two strata."""
    x = surv.where("time is not null and event is not null and stratum is not null")
    first = x.agg(F.min("stratum").alias("first"))
    x = x.join(F.broadcast(first), F.lit(True)).withColumn("own", (F.col("stratum") == F.col("first")).cast("int"))
    per = x.groupBy("time").agg(F.count("*").alias("n"), F.sum("own").alias("n1"), F.sum("event").alias("d"), F.sum(F.col("event") * F.col("own")).alias("d1"))
    per = global_running(per, F.col("time").desc(), sums={"at_risk": "n", "own_risk": "n1"}).where("d > 0")
    v = F.when(F.col("at_risk") > 1, F.col("d") * (F.col("own_risk") / F.col("at_risk")) * (1 - F.col("own_risk") / F.col("at_risk")) * (F.col("at_risk") - F.col("d")) / (F.col("at_risk") - 1)).otherwise(0.0)
    one = per.agg(F.sum("d1").cast("long").alias("observed"), F.sum(F.col("d") * F.col("own_risk") / F.col("at_risk")).alias("expected"), F.sum(v).alias("variance"))
    return one.withColumn("chi2", F.when(F.col("variance") > 0, F.pow(F.col("observed") - F.col("expected"), F.lit(2)) / F.col("variance")))


def with_chi2_p(df: DataFrame, df_col: int = 1) -> DataFrame:
    from ..functions.stats import chi2_sf

    return df.withColumn("p", chi2_sf("chi2", F.lit(float(df_col))))


def cox_terms(x: DataFrame, surv: DataFrame, betas: DataFrame) -> DataFrame:
    """``(feature, loglik, score, information)`` of the one-covariate Cox model of each feature at ``betas`` ``(feature, beta)``, with Efron's ties.

    A column ``w`` of ``x`` counts its rows so many times.
    """
    x = x if "w" in x.columns else x.withColumn("w", F.lit(1))
    r = x.join(surv.select("subject", "time", "event").where("time is not null and event is not null"), "subject").join(betas, "feature")
    e = F.col("w") * F.exp(F.col("beta") * F.col("value"))
    dead = F.col("event") == 1
    sums = {"s0": e, "s1": e * F.col("value"), "s2": e * F.col("value") * F.col("value")}
    per = r.groupBy("feature", "time", "beta").agg(*(F.sum(v).alias(k) for k, v in sums.items()), *(F.coalesce(F.sum(F.when(dead, v)), F.lit(0.0)).alias(f"d{k[1]}") for k, v in sums.items()), F.sum(F.col("event") * F.col("w")).cast("int").alias("d"), F.coalesce(F.sum(F.when(dead, F.col("w") * F.col("value"))), F.lit(0.0)).alias("xd"))
    per = per.withColumnsRenamed({k: f"own_{k}" for k in sums})
    per = group_running(deal_groups(per, ["feature"], "time"), ["feature"], "time", {k: f"own_{k}" for k in sums}, down=True).where("d > 0")
    per = per.withColumn("l", F.explode(F.sequence(F.lit(0), F.col("d") - 1)))
    part = F.col("l") / F.col("d")
    a0, a1, a2 = (F.col(f"s{i}") - part * F.col(f"d{i}") for i in range(3))
    per = per.withColumns({"u": a1 / a0, "v": a2 / a0 - F.pow(a1 / a0, F.lit(2)), "ll": F.log(a0)})
    last = F.col("l") == 0
    return per.groupBy("feature").agg(F.sum(F.when(last, F.col("beta") * F.col("xd")).otherwise(0.0) - F.col("ll")).alias("loglik"), F.sum(F.when(last, F.col("xd")).otherwise(0.0) - F.col("u")).alias("score"), F.sum("v").alias("information"))


def cox_univariate(x: DataFrame, surv: DataFrame, rounds: int = 6) -> DataFrame:
    """``(feature, beta, se, hr, lower, upper, z)`` of every feature by Newton steps for all features at once."""

    x = materialise(x, "covariates")
    betas = x.select("feature").distinct().withColumn("beta", F.lit(0.0))
    for _ in range(rounds):
        t = cox_terms(x, surv, betas)
        step = F.when(F.col("information") > 0, F.greatest(F.lit(-2.0), F.least(F.lit(2.0), F.col("score") / F.col("information")))).otherwise(0.0)
        betas = materialise(betas.join(t, "feature").select("feature", (F.col("beta") + step).alias("beta")), "betas")
    out = betas.join(cox_terms(x, surv, betas), "feature").withColumn("se", F.when(F.col("information") > 0, 1 / F.sqrt("information")))
    return out.select("feature", "beta", "se", F.exp("beta").alias("hr"), F.exp(F.col("beta") - Z975 * F.col("se")).alias("lower"), F.exp(F.col("beta") + Z975 * F.col("se")).alias("upper"), (F.col("beta") / F.col("se")).alias("z"))


def schoenfeld(x: DataFrame, surv: DataFrame, betas: DataFrame) -> DataFrame:
    """``(feature, subject, time, residual, rank)`` at each event: the covariate less its mean over the risk set (Breslow), and the rank of the time among the feature's events, equal times at the first place."""
    r = x.join(surv.select("subject", "time", "event").where("time is not null and event is not null"), "subject").join(betas.select("feature", "beta"), "feature").withColumn("e", F.exp(F.col("beta") * F.col("value")))
    per = r.groupBy("feature", "time").agg(F.sum("e").alias("own_s0"), F.sum(F.col("e") * F.col("value")).alias("own_s1"), F.sum("event").cast("long").alias("d"))
    per = group_running(deal_groups(per, ["feature"], "time"), ["feature"], "time", {"s0": "own_s0", "s1": "own_s1"}, down=True)
    per = group_running(per, ["feature"], "time", {"upto": "d"})
    per = per.where("d > 0").select("feature", "time", (F.col("s1") / F.col("s0")).alias("mean"), (F.col("upto") - F.col("d") + 1).cast("double").alias("rank"))
    return r.where("event = 1").join(per, ["feature", "time"]).select("feature", "subject", "time", (F.col("value") - F.col("mean")).alias("residual"), "rank")


def proportional_hazards_test(x: DataFrame, surv: DataFrame, betas: DataFrame) -> DataFrame:
    """``(feature, n_events, rho, chi2, p, verdict)``: correlation of Schoenfeld residuals with the rank of time, each feature in its own model."""
    res = schoenfeld(x, surv, betas)
    one = res.groupBy("feature").agg(F.count("*").alias("n_events"), F.corr("rank", "residual").alias("rho"))
    one = one.withColumn("chi2", F.col("n_events") * F.pow("rho", F.lit(2)))
    return with_chi2_p(one).withColumn("verdict", F.when(F.col("p") < 0.05, "violated").otherwise("holds"))


def joint_rows(x: DataFrame, surv: DataFrame) -> tuple[DataFrame, list[str]]:
    """``(time, event, x)`` of subjects with every feature, ``x`` in the order of the names that come with it. A signature is short, so its names are."""
    names = [r[0] for r in x.select("feature").distinct().orderBy("feature").collect()]
    wide = x.groupBy("subject").agg(F.transform(F.array_sort(F.collect_list(F.struct("feature", "value"))), lambda v: v["value"]).alias("x")).where(F.size("x") == len(names))
    return materialise(wide.join(surv.select("subject", "time", "event").where("time is not null and event is not null"), "subject").select("time", "event", "x"), "joint"), names


def joint_terms(rows: DataFrame, beta: Sequence[float]) -> DataFrame:
    """``(time, u_i.., v_i_j..)`` at each event time: score and information of the Cox model of all features at ``beta``, with Efron's ties."""
    p = len(beta)
    v = [F.col("x")[i] for i in range(p)]
    e = F.exp(sum((float(b) * c for b, c in zip(beta, v)), F.lit(0.0)))
    both = [(i, j) for i in range(p) for j in range(i, p)]
    cells = {"s0": e} | {f"s1_{i}": e * v[i] for i in range(p)} | {f"s2_{i}_{j}": e * v[i] * v[j] for i, j in both}
    dead = F.col("event") == 1
    one = lambda c: F.coalesce(F.sum(F.when(dead, c)), F.lit(0.0))
    per = rows.groupBy("time").agg(*(F.sum(c).alias(f"own_{k}") for k, c in cells.items()), *(one(c).alias(f"dead_{k}") for k, c in cells.items()), *(one(v[i]).alias(f"xd_{i}") for i in range(p)), F.sum("event").cast("int").alias("d"))
    per = global_running(per, F.col("time").desc(), sums={k: f"own_{k}" for k in cells}).where("d > 0").withColumn("l", F.explode(F.sequence(F.lit(0), F.col("d") - 1)))
    a = {k: F.col(k) - F.col("l") / F.col("d") * F.col(f"dead_{k}") for k in cells}
    mean = [a[f"s1_{i}"] / a["s0"] for i in range(p)]
    return per.groupBy("time").agg(*((F.max(f"xd_{i}") - F.sum(mean[i])).alias(f"u_{i}") for i in range(p)), *(F.sum(a[f"s2_{i}_{j}"] / a["s0"] - mean[i] * mean[j]).alias(f"v_{i}_{j}") for i, j in both))


def _sums(terms: DataFrame, p: int, weights: Sequence[Column]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Score vector and information matrix of :func:`joint_terms` summed with each of ``weights``, in one pass."""
    both = [(i, j) for i in range(p) for j in range(i, p)]
    asked = [F.sum(w * F.col(c)) for w in weights for c in [*(f"u_{i}" for i in range(p)), *(f"v_{i}_{j}" for i, j in both)]]
    got = np.array([x or 0.0 for x in terms.agg(*asked).first()], dtype=float).reshape(len(weights), -1)
    out = []
    for row in got:
        m = np.zeros((p, p))
        for (i, j), value in zip(both, row[p:]):
            m[i, j] = m[j, i] = value
        out.append((row[:p], m))
    return out


def cox_joint(rows: DataFrame, p: int, rounds: int = 20, tolerance: float = 1e-8) -> np.ndarray:
    """Coefficients of the Cox model of all features, by Newton steps until none is beyond ``tolerance``."""
    beta = np.zeros(p)
    for _ in range(rounds):
        ((score, information),) = _sums(joint_terms(rows, beta), p, [F.lit(1.0)])
        step = np.clip(np.linalg.pinv(information) @ score, -2, 2)
        beta += step
        if np.abs(step).max(initial=0.0) < tolerance:
            break
    return beta


def proportional_hazards_joint(x: DataFrame, surv: DataFrame) -> DataFrame:
    """``(term, beta, chi2, df, p, verdict)`` of the joint model of a signature: each term and ``GLOBAL``.

    A score test of the interaction of each covariate with one less the survival just before a time, given the fitted model.
    The numbers of a signature of p features are p^2; sums over times and risk sets are Spark's. No subjects or features: no rows.
    """
    rows, names = joint_rows(x, surv)
    p, schema = len(names), "term string, beta double, chi2 double, df int"
    if not p:
        return with_chi2_p(x.sparkSession.createDataFrame([], schema), 1).withColumn("verdict", F.lit(""))
    beta = cox_joint(rows, p)
    terms = joint_terms(rows, beta).join(survival_before(rows, F.col("event")), "time").withColumn("g", 1 - F.col("before"))
    (_, i11), (u, i12), (_, i22) = _sums(terms, p, [F.lit(1.0), F.col("g"), F.col("g") * F.col("g")])
    left = i22 - i12 @ np.linalg.pinv(i11) @ i12
    out = [(n, float(b), float(s * s / m) if m > 0 else None, 1) for n, b, s, m in zip(names, beta, u, np.diag(left))]
    out.append(("GLOBAL", None, float(u @ np.linalg.pinv(left) @ u), p))
    from ..functions.stats import chi2_sf

    table = x.sparkSession.createDataFrame(out, schema).withColumn("p", chi2_sf("chi2", F.col("df").cast("double")))
    return table.withColumn("verdict", F.when(F.col("p") < 0.05, "violated").when(F.col("p").isNotNull(), "not_violated"))


def lambda_path(x: DataFrame, surv: DataFrame, shares: Sequence[float] = (0.95, 0.78, 0.6, 0.3, 0.1)) -> list[float]:
    """Penalties as shares of the least one that leaves no feature: the largest slope of the mean log-likelihood at zero, one number."""
    terms = cox_terms(x, surv, x.select("feature").distinct().withColumn("beta", F.lit(0.0)))
    top = terms.agg(F.max(F.abs("score"))).first()[0] or 0.0
    events = surv.where("time is not null").agg(F.sum("event")).first()[0] or 1
    return [round(top / events * s, 9) for s in shares]


def cox_l1_path(x: DataFrame, surv: DataFrame, fold_table: DataFrame, lambdas: Sequence[float], tolerance: float = 1e-7) -> DataFrame:
    """``(repeat, fold, lam, feature, coef)`` of L1-penalised Cox models (Breslow ties) on all but each fold; fold 0 is the whole cohort. See :mod:`cox_path`."""
    from .cox_path import fit_path

    return fit_path(x, surv, fold_table, lambdas, tolerance)


def cv_concordance(x: DataFrame, surv: DataFrame, fold_table: DataFrame, coefs: DataFrame) -> DataFrame:
    """``(repeat, lam, fold, c)`` of held-out subjects by the models that did not see them."""
    # A subject's cells are sent once, and each of its folds is joined to the models of that fold.
    cells = x.join(F.broadcast(coefs.select("feature").distinct()), "feature", "left_semi").groupBy("subject").agg(F.array_sort(F.collect_list(F.struct("feature", "value"))).alias("x"))
    models = coefs.where("fold > 0").groupBy("repeat", "fold", "lam").agg(F.map_from_entries(F.collect_list(F.struct("feature", "coef"))).alias("coef"))
    held = cells.join(surv.select("subject", "time", "event"), "subject").join(fold_table, "subject").join(F.broadcast(models), ["repeat", "fold"])
    score = F.aggregate("x", F.lit(0.0), lambda total, c: total + F.coalesce(F.try_element_at("coef", c["feature"]), F.lit(0.0)) * c["value"])
    risk = held.select("repeat", "fold", "lam", "time", "event", score.alias("risk"))
    return concordance_counts(risk.withColumn("w", F.lit(1)), ["repeat", "fold", "lam"]).where("c is not null").select("repeat", "fold", "lam", "c")


def lambda_1se(cv: DataFrame) -> DataFrame:
    """``(repeat, lam_best, lam_1se)``: the best mean concordance, and the largest lambda within one standard error of it."""
    m = cv.groupBy("repeat", "lam").agg(F.avg("c").alias("mean"), (F.stddev_samp("c") / F.sqrt(F.count("*"))).alias("se"))
    best = m.groupBy("repeat").agg(F.max_by(F.struct("lam", "mean", "se"), F.struct("mean", "lam")).alias("best"))
    j = m.join(best, "repeat").where(F.col("mean") >= F.col("best.mean") - F.coalesce("best.se", F.lit(0.0)))
    return j.groupBy("repeat").agg(F.max("best.lam").alias("lam_best"), F.max("lam").alias("lam_1se"))


def selection_stability(selected: DataFrame) -> DataFrame:
    """``(feature, times, frequency, stable)`` of the sets ``(repeat, feature)`` chosen in each repeat."""
    n = selected.agg(F.count_distinct("repeat").alias("n"))
    per = selected.groupBy("feature").agg(F.count_distinct("repeat").alias("times"))
    return per.join(F.broadcast(n), F.lit(True)).select("feature", "times", (F.col("times") / F.col("n")).alias("frequency"), (F.col("times") == F.col("n")).alias("stable"))


def selection_summary(selected: DataFrame) -> DataFrame:
    """One row ``(n_repeats, median_size, min_size, max_size, signature_stable)`` of the sets ``(repeat, feature)``: stable where every repeat chose the same features. A null feature stands for a repeat that chose none."""
    per = selected.groupBy("repeat").agg(F.count_distinct("feature").cast("long").alias("size"), F.array_sort(F.collect_set("feature")).alias("chosen"))
    return per.agg(F.count("*").alias("n_repeats"), F.median("size").alias("median_size"), F.min("size").alias("min_size"), F.max("size").alias("max_size"), (F.count_distinct("chosen") == 1).alias("signature_stable"))


def signature(coefs: DataFrame, cap: int) -> DataFrame:
    """Features with a coefficient, by its size, with ``exceeds_epv`` where there are more than ``cap``."""
    x = coefs.where("coef <> 0")
    n = x.agg((F.count("*") > cap).alias("exceeds_epv"))
    return x.join(F.broadcast(n), F.lit(True)).select("feature", "coef", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.abs("coef").desc(), "feature")).alias("place"), "exceeds_epv")


def capped_signature(path: DataFrame, cap: int) -> DataFrame:
    """Coefficients ``(lam, feature, coef)`` at the smallest lambda that has at most ``cap`` features."""
    n = path.groupBy("lam").agg(F.count_if(F.col("coef") != 0).alias("nonzero")).where(F.col("nonzero").between(1, cap))
    return path.join(F.broadcast(n.agg(F.min("lam").alias("lam"))), "lam").where("coef <> 0")


def recommend(signatures: DataFrame, cap: int) -> DataFrame:
    """One row: ``one_se`` if that signature of ``(name, n_features)`` is within ``cap``, else ``epv_compliant`` if there is one, else ``none``."""
    size = lambda name: F.coalesce(F.max(F.when(F.col("name") == name, F.col("n_features"))), F.lit(0))
    one = signatures.agg(size("one_se").alias("one_se"), size("epv_compliant").alias("epv"))
    ok = F.col("one_se").between(1, cap)
    return one.select(F.when(ok, "one_se").when(F.col("epv") > 0, "epv_compliant").otherwise("none").alias("recommended"), F.when(ok, "within the cap").when(F.col("one_se") > cap, "one_se exceeds the cap").otherwise("one_se selects nothing").alias("reason"))


def horizons(surv: DataFrame, q: Sequence[float] = (0.25, 0.5, 0.75), min_events: int = 10) -> DataFrame:
    """``(q, horizon, later)``: quantiles of the event times (inverse distribution function) with at least ``min_events`` events after them."""
    times = surv.where("event = 1").groupBy("time").agg(F.count("*").alias("n"))
    n = surv.agg(F.sum("event").alias("events"))
    rows = surv.sparkSession.createDataFrame(list(zip(q, exact_quantiles(surv.where("event = 1"), "time", list(q), kind=1))), "q double, horizon double")
    after = F.broadcast(rows).join(times, F.col("time") > F.col("horizon")).groupBy("q", "horizon").agg(F.sum("n").alias("later"))
    return after.join(F.broadcast(n), F.lit(True)).where((F.col("later") >= min_events) & (F.col("events") >= min_events)).select("q", "horizon", "later")


def time_auc(surv: DataFrame, risk: DataFrame, horizon_table: DataFrame) -> DataFrame:
    """``(horizon, n_cases, n_controls, n_at_risk, n_events_after, auc, se, lower, upper)``: cases by the horizon against those beyond it, weighted by the inverse probability of censoring.

    Weighted pairs are counted by running sums over the risks of all horizons at once, not by pairs. The standard error is that of a weighted
    two-sample statistic (variance of the shares of cases and of controls); the weights count as known. The interval is of 95 %.
    Without cases or controls these are null.
    """
    x = surv.join(risk.select("subject", "risk"), "subject").select("subject", "time", "event", "risk")
    g = survival_before(x, 1 - F.col("event")).withColumnRenamed("before", "g_before")
    y = x.join(g, "time").join(F.broadcast(horizon_table.select("horizon")), F.lit(True))
    case, control = (F.col("time") <= F.col("horizon")) & (F.col("event") == 1), F.col("time") > F.col("horizon")
    w = F.when(case & (F.col("g_before") > 0), 1 / F.col("g_before")).otherwise(0.0)
    counts = {"cases": case, "c": control, "at_risk": F.col("time") >= F.col("horizon"), "after": control & (F.col("event") == 1)}
    per = y.groupBy("horizon", "risk").agg(F.sum(w).alias("w"), F.sum(w * w).alias("w2"), *(F.count_if(v).alias(k) for k, v in counts.items()))
    per = global_running(per.withColumn("_order", F.struct("horizon", "risk")), F.col("_order"), sums={"upto_w": "w", "upto_c": "c"})
    per = materialise(per.drop("_order"), "auc")
    whole = per.groupBy("horizon").agg(F.sum("w").alias("all_w"), F.sum("c").alias("all_c"), F.max("upto_w").alias("end_w"), F.max("upto_c").alias("end_c"))
    per = per.join(F.broadcast(whole), "horizon")
    # What the running sums had come to before the horizon is taken out.
    below_c, below_w = (F.col(f"upto_{k}") - F.col(k) - (F.col(f"end_{k}") - F.col(f"all_{k}")) for k in ("c", "w"))
    per = per.withColumns({"of_case": (below_c + F.col("c") * 0.5) / F.col("all_c"), "of_control": (F.col("all_w") - below_w - F.col("w") * 0.5) / F.col("all_w")})
    sums = {"hits": F.col("w") * F.col("of_case"), "h1": F.col("w2") * F.col("of_case"), "h2": F.col("w2") * F.col("of_case") * F.col("of_case"), "k2": F.col("c") * F.col("of_control") * F.col("of_control"), "w2": F.col("w2"), **{f"n_{k}": F.col(k) for k in counts}}
    one = per.groupBy("horizon", "all_w", "all_c").agg(*(F.sum(v).alias(k) for k, v in sums.items())).withColumn("auc", F.col("hits") / F.col("all_w"))
    variance = (F.col("h2") - 2 * F.col("auc") * F.col("h1") + F.col("auc") * F.col("auc") * F.col("w2")) / (F.col("all_w") * F.col("all_w")) + (F.col("k2") / F.col("all_c") - F.col("auc") * F.col("auc")) / F.col("all_c")
    one = one.withColumn("se", F.sqrt(F.greatest(F.lit(0.0), variance)))
    return one.select("horizon", "n_cases", F.col("n_c").alias("n_controls"), "n_at_risk", F.col("n_after").alias("n_events_after"), "auc", "se", (F.col("auc") - Z975 * F.col("se")).alias("lower"), (F.col("auc") + Z975 * F.col("se")).alias("upper"))


def calibration(surv: DataFrame, risk: DataFrame, horizon: float, groups: int = 4, beta: float = 1.0) -> DataFrame:
    """``(bin, n, predicted, observed)``: mean Cox-predicted survival at the horizon against Kaplan-Meier, by risk quantile."""
    x = surv.join(risk.select("subject", "risk"), "subject").select("subject", "time", "event", (F.col("risk") * beta).alias("eta"))
    per = x.groupBy("time").agg(F.sum(F.exp("eta")).alias("s0"), F.sum("event").alias("d"))
    hazard = global_running(per.withColumnRenamed("s0", "own"), F.col("time").desc(), sums={"s0": "own"}).where((F.col("time") <= horizon) & (F.col("d") > 0)).agg(F.coalesce(F.sum(F.col("d") / F.col("s0")), F.lit(0.0)).alias("h0"))
    cuts = exact_quantiles(x, "eta", [i / groups for i in range(1, groups)])
    place = F.lit(1)
    for c in cuts:
        place = place + (F.col("eta") > F.lit(c).cast("double")).cast("int")
    x = x.join(F.broadcast(hazard), F.lit(True)).withColumn("bin", place).withColumn("s", F.exp(-F.col("h0") * F.exp("eta")))
    predicted = x.groupBy("bin").agg(F.count("*").alias("n"), F.avg("s").alias("predicted"))
    at = x.sparkSession.createDataFrame([(float(horizon),)], "horizon double")
    observed = survival_at(kaplan_meier(x, ["bin"]), at, ["bin"]).select("bin", F.col("survival").alias("observed"))
    return predicted.join(observed, "bin")


def optimism(surv: DataFrame, risk: DataFrame, replicates: int = 200, seed: int = 1) -> DataFrame:
    """``(measure, apparent, training, test, optimism, corrected)`` of the Cox model on the risk, for ``dxy``, ``slope`` and ``r2``.

    Each replicate draws the cohort with Poisson(1) multiplicities from a hash of subject, replicate and seed, fits the model again and is measured
    on its own draw (``training``) and on the original cohort (``test``). The mean difference is the optimism, which the
    apparent measure is lowered by. All replicates are fitted together. ``r2`` is that of Nagelkerke. Subjects without time, event or risk don't count.
    """
    from .concordance import weighted_concordance
    from .cox_replicates import Replicates

    x = surv.select("subject", F.col("time").cast("double").alias("time"), "event").join(risk.select("subject", F.col("risk").cast("double").alias("risk")), "subject").where("time is not null and event is not null and risk is not null")
    u = F.transform(F.sequence(F.lit(0), F.lit(replicates)), lambda rep: F.pmod(F.xxhash64("subject", rep, F.lit(seed)), F.lit(1 << 30)).cast("int"))
    limits = np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 8)])) * (1 << 30)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = np.searchsorted(limits, batch.column("w").flatten().to_numpy()).astype(np.int8).reshape(-1, replicates + 1)
            w[:, 0] = 1
            own = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * (replicates + 1)), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("time", "event", "risk")), own], ["time", "event", "risk", "w"])

    x = x.select("time", F.col("event").cast("int").alias("event"), (F.col("risk") + 0.0).alias("risk"), u.alias("w")).mapInArrow(draw, "time double, event int, risk double, w array<tinyint>")
    x = materialise(x, "draws")
    if not x.limit(1).count():
        return x.sparkSession.createDataFrame([], "measure string, apparent double, training double, test double, optimism double, corrected double")
    fits = Replicates(x, replicates + 1)
    beta, own0 = fits.fit()
    own, other = fits.loglik(beta), fits.loglik(beta, drawn=False)
    rows = [(i, *map(float, v)) for i, v in enumerate(zip(beta, own, own0, other, fits.sizes))]
    m = x.sparkSession.createDataFrame(rows, "rep int, beta double, own double, own0 double, other double, n double")
    pairs = weighted_concordance(x).select(F.posexplode(F.arrays_zip("pairs", "concordant", "tied")).alias("rep", "p"))
    c = F.when(F.col("p.pairs") > 0, (F.col("p.concordant") + F.col("p.tied") * 0.5) / F.col("p.pairs"))
    m = m.join(pairs.select("rep", (2 * c - 1).alias("d")), "rep")
    base = m.where("rep = 0").select(F.col("beta").alias("beta0"), F.col("own0").alias("ll0"), F.col("n").alias("n0"), F.col("d").alias("d0"))
    m = m.join(F.broadcast(base), F.lit(True))
    r2 = lambda ll, null, n: (1 - F.exp(-2 * (ll - null) / n)) / (1 - F.exp(2 * null / n))
    side = F.signum("beta")
    row = lambda name, training, test: F.struct(F.lit(name).alias("measure"), training.alias("training"), test.alias("test"))
    measures = F.array(
        row("dxy", side * F.col("d"), side * F.col("d0")),
        row("slope", F.lit(1.0), F.col("beta0") / F.col("beta")),
        row("r2", r2(F.col("own"), F.col("own0"), F.col("n")), r2(F.col("other"), F.col("ll0"), F.col("n0"))),
    )
    each = m.select("rep", F.inline(measures))
    one = each.groupBy("measure").agg(F.max(F.when(F.col("rep") == 0, F.col("training"))).alias("apparent"), F.avg(F.when(F.col("rep") > 0, F.col("training"))).alias("training"), F.avg(F.when(F.col("rep") > 0, F.col("test"))).alias("test"))
    gap = F.col("training") - F.col("test")
    return one.select("measure", "apparent", "training", "test", gap.alias("optimism"), (F.col("apparent") - gap).alias("corrected"))


def decision_curve(rows: DataFrame, points: int = 19) -> DataFrame:
    """``(step, threshold, net_benefit, treat_all)`` of ``(outcome, risk)`` where risk is a probability, at quantiles of the risk."""
    at = [(i + 1) / (points + 1) for i in range(points)]
    steps = rows.sparkSession.createDataFrame(list(enumerate(exact_quantiles(rows, "risk", at))), "step int, threshold double").where("threshold < 1")
    cuts = rows.agg(F.count("*").alias("n"), F.sum("outcome").alias("cases")).join(F.broadcast(steps), F.lit(True))
    j = rows.join(F.broadcast(cuts), F.lit(True)).groupBy("step", "threshold", "n", "cases").agg(F.count_if((F.col("risk") >= F.col("threshold")) & (F.col("outcome") == 1)).alias("tp"), F.count_if((F.col("risk") >= F.col("threshold")) & (F.col("outcome") == 0)).alias("fp"))
    odds = F.col("threshold") / (1 - F.col("threshold"))
    return j.select("step", "threshold", (F.col("tp") / F.col("n") - F.col("fp") / F.col("n") * odds).alias("net_benefit"), (F.col("cases") / F.col("n") - (F.col("n") - F.col("cases")) / F.col("n") * odds).alias("treat_all"))


def risk_order(strata: DataFrame) -> DataFrame:
    """Rows ``(subject, risk, stratum)`` with their ``place`` by risk."""
    from ..functions.stats import global_row_number

    return global_row_number(strata.select("subject", "risk", "stratum"), [F.col("risk"), F.col("subject")], "place")
