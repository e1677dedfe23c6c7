"""Survival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import survival as sv
from .bindings import Data
from .registry import chi2_p, query, r


def rows(d: Data) -> DataFrame:
    """Visits with time and event as text, as they come from files."""
    return d.visits.select("subject", F.when(F.col("user_id") % 11 > 0, F.col("time").cast("string")).alias("t"), F.when(F.col("user_id") % 13 > 0, F.when(F.col("event") == 1, "dead").otherwise("alive")).alias("e"))


_S1 = "s AS (SELECT subject, CASE WHEN user_id % 11 > 0 THEN time END AS time, CASE WHEN user_id % 13 > 0 THEN event END AS event FROM visits), t AS (SELECT *, CASE WHEN time IS NULL THEN 'no_time' WHEN event IS NULL THEN 'no_event' END AS reason FROM s)"


@query("s1_survival_table", f"WITH {_S1} SELECT subject, {r('time', 'time')}, event, reason FROM t")
def s1(d: Data) -> DataFrame:
    return sv.survival_table(rows(d), "t", "e", ["dead"]).select("subject", "time", "event", "reason")


@query("s1_counts", f"WITH {_S1} SELECT coalesce(reason, 'ok') AS reason, count(*) AS n, CAST(coalesce(sum(event), 0) AS BIGINT) AS events FROM t GROUP BY 1")
def s1_counts(d: Data) -> DataFrame:
    return sv.survival_counts(sv.survival_table(rows(d), "t", "e", ["dead"]))


@query("s2_epv_cap", "SELECT count(*) AS n, CAST(sum(event) AS BIGINT) AS events, CAST(sum(event) // 10 AS BIGINT) AS cap, sum(event) >= 20 AS enough FROM surv")
def s2(d: Data) -> DataFrame:
    return sv.epv_cap(d.surv)


def chosen(d: Data) -> DataFrame:
    return d.covariates.select("feature").distinct().where("feature <> 'purchase'")


@query("s3_candidates", f"SELECT subject, feature, {r('value', 'value')} FROM covariates SEMI JOIN surv USING (subject) WHERE feature <> 'purchase'")
def s3(d: Data) -> DataFrame:
    return sv.signature_candidates(d.covariates, d.surv, chosen(d))


@query("s3_modelling_status", "SELECT 'ok' AS status, CAST(NULL AS VARCHAR) AS reason, count(*) AS n_subjects, CAST(sum(event) AS BIGINT) AS n_events, 'ranked_fallback' AS mode, 2 AS n_candidates FROM surv SEMI JOIN covariates USING (subject)")
def s3_status(d: Data) -> DataFrame:
    """Without significant features the two of smallest p are the candidates."""
    test = chosen(d).select("feature", F.lit(0.0).alias("lfc"), F.length("feature").cast("double").alias("p"), F.lit(1.0).alias("adj_p"))
    return sv.modelling_input(d.covariates, d.surv, test, fallback_n=2)[1]


def train(d: Data) -> DataFrame:
    return sv.signature_candidates(d.covariates, d.surv, chosen(d))


_SCALER = "tx AS (SELECT subject, feature, value FROM covariates SEMI JOIN surv USING (subject) WHERE feature <> 'purchase'), scaler AS (SELECT feature, avg(value) AS centre, CASE WHEN stddev_samp(value) > 0 THEN stddev_samp(value) ELSE 1.0 END AS scale FROM tx GROUP BY feature), z1 AS (SELECT subject, feature, (value - centre) / scale AS value FROM tx JOIN scaler USING (feature)), x2 AS (SELECT subject, feature, (value - centre) / scale AS value FROM covariates SEMI JOIN surv2 USING (subject) JOIN scaler USING (feature)), co AS (SELECT feature, (row_number() OVER (ORDER BY feature) - 2) * 0.1 AS coef FROM scaler), rk1 AS (SELECT subject, round(sum(coef * value), 6) + 0.0 AS risk FROM z1 JOIN co USING (feature) GROUP BY subject), rk2 AS (SELECT subject, round(sum(coef * value), 6) + 0.0 AS risk FROM x2 JOIN co USING (feature) GROUP BY subject)"


def coefs(d: Data) -> DataFrame:
    from pyspark.sql import Window

    return chosen(d).withColumn("coef", (F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("feature")) - 2) * 0.1)


@query("s4_scaler", f"WITH {_SCALER} SELECT feature, {r('centre', 'centre')}, {r('scale', 'scale')} FROM scaler")
def s4(d: Data) -> DataFrame:
    return sv.fit_scaler(train(d))


@query("s4_apply", f"WITH {_SCALER} SELECT subject, feature, {r('value', 'value')} FROM x2")
def s4_apply(d: Data) -> DataFrame:
    return sv.apply_scaler(d.covariates.join(d.surv2, "subject", "left_semi"), sv.fit_scaler(train(d)))


@query("s5_folds", "SELECT subject, CAST(repeat AS INT) AS repeat, CAST((row_number() OVER (PARTITION BY repeat ORDER BY md5('1:' || repeat || ':' || subject), subject) - 1) % 10 + 1 AS INT) AS fold FROM surv, (SELECT unnest([1, 2, 3, 4, 5]) AS repeat)")
def s5(d: Data) -> DataFrame:
    return sv.folds(d.surv)


def path(d: Data) -> tuple[DataFrame, DataFrame, DataFrame]:
    from ..session import materialise

    x = materialise(sv.apply_scaler(train(d), sv.fit_scaler(train(d))), "x")
    f = materialise(sv.folds(d.surv), "folds")
    return x, f, materialise(sv.cox_l1_path(x, d.surv, f, sv.lambda_path(x, d.surv)), "path")


@query("s6_cox_l1_path")
def s6(d: Data) -> DataFrame:
    return path(d)[2]


@query("s7_lambda_1se")
def s7(d: Data) -> DataFrame:
    x, f, p = path(d)
    return sv.lambda_1se(sv.cv_concordance(x, d.surv, f, p))


@query("s8_stability", f"WITH sel AS (SELECT DISTINCT subject % 4 AS repeat, feature FROM covariates WHERE value > 12), n AS (SELECT count(DISTINCT repeat) AS n FROM sel) SELECT feature, count(DISTINCT repeat) AS times, {r('count(DISTINCT repeat) * 1.0 / max(n)', 'frequency')}, count(DISTINCT repeat) = max(n) AS stable FROM sel, n GROUP BY feature")
def s8(d: Data) -> DataFrame:
    return sv.selection_stability(d.covariates.where("value > 12").select((F.col("subject") % 4).alias("repeat"), "feature").distinct())


@query("s8_summary", "WITH sel AS (SELECT DISTINCT subject % 4 AS repeat, feature FROM covariates WHERE value > 12), per AS (SELECT repeat, count(*) AS size, string_agg(feature, ',' ORDER BY feature) AS chosen FROM sel GROUP BY 1) SELECT count(*) AS n_repeats, median(size) AS median_size, min(size) AS min_size, max(size) AS max_size, count(DISTINCT chosen) = 1 AS signature_stable FROM per")
def s8_summary(d: Data) -> DataFrame:
    return sv.selection_summary(d.covariates.where("value > 12").select((F.col("subject") % 4).alias("repeat"), "feature").distinct())


@query("s9_signature", f"WITH {_SCALER}, n AS (SELECT count(*) > 2 AS exceeds_epv FROM co WHERE coef <> 0) SELECT feature, {r('coef', 'coef')}, CAST(row_number() OVER (ORDER BY abs(coef) DESC, feature) AS INT) AS place, exceeds_epv FROM co, n WHERE coef <> 0")
def s9(d: Data) -> DataFrame:
    return sv.signature(coefs(d), 2)


@query("s10_capped_signature")
def s10(d: Data) -> DataFrame:
    x = sv.apply_scaler(train(d), sv.fit_scaler(train(d)))
    whole = sv.cox_l1_path(x, d.surv, sv.folds(d.surv).limit(0), sv.lambda_path(x, d.surv))
    return sv.capped_signature(whole.select("lam", "feature", "coef"), 2)


def risk1(d: Data) -> DataFrame:
    return sv.risk_score(sv.apply_scaler(train(d), sv.fit_scaler(train(d))), coefs(d)).withColumn("risk", F.round("risk", 6) + 0.0)


@query("s11_risk_score", f"WITH {_SCALER} SELECT subject, risk FROM rk1")
def s11(d: Data) -> DataFrame:
    return risk1(d)


_C = "c AS (SELECT count(*) AS pairs, count(*) FILTER (i.risk > j.risk) AS concordant, count(*) FILTER (i.risk = j.risk) AS tied FROM x i JOIN x j ON i.event = 1 AND i.time < j.time)"


@query("s12_concordance", f"WITH x AS (SELECT subject, time, event, risk FROM surv JOIN risk USING (subject)), {_C} SELECT pairs, concordant, tied, {r('(concordant + tied * 0.5) / pairs', 'c')} FROM c")
def s12(d: Data) -> DataFrame:
    return sv.concordance(d.surv, d.risk)


def external(d: Data) -> tuple[DataFrame, DataFrame]:
    return sv.external_validation(coefs(d), sv.fit_scaler(train(d)), risk1(d), d.covariates.join(d.surv2, "subject", "left_semi"), d.surv2)


@query("s13_external_rows", f"WITH {_SCALER} SELECT subject, risk, CASE WHEN risk > (SELECT median(risk) FROM rk1) THEN 'high' ELSE 'low' END AS stratum FROM rk2")
def s13_rows(d: Data) -> DataFrame:
    x, _ = external(d)
    return x.select("subject", (F.round("risk", 6) + 0.0).alias("risk"), F.when(F.round("risk", 6) > F.col("cutoff"), "high").otherwise("low").alias("stratum"))


@query("s13_external_concordance", f"WITH {_SCALER}, x AS (SELECT subject, time, event, round(sum(coef * value), 6) + 0.0 AS risk FROM x2 JOIN co USING (feature) JOIN surv2 USING (subject) GROUP BY ALL), {_C} SELECT pairs, concordant, tied, {r('(concordant + tied * 0.5) / pairs', 'c')}, (SELECT count(*) FROM co SEMI JOIN x2 USING (feature)) AS found, (SELECT count(*) FROM co ANTI JOIN x2 USING (feature)) AS missing FROM c")
def s13(d: Data) -> DataFrame:
    return external(d)[1]


@query("s14_strata", f"SELECT subject, {r('risk', 'risk')}, {r('(SELECT median(risk) FROM risk SEMI JOIN surv USING (subject))', 'cutoff')}, CASE WHEN risk > (SELECT median(risk) FROM risk SEMI JOIN surv USING (subject)) THEN 'high' ELSE 'low' END AS stratum FROM risk")
def s14(d: Data) -> DataFrame:
    return sv.risk_strata(d.risk, sv.median_cutoff(d.risk.join(d.surv, "subject", "left_semi")))


@query("s15_kaplan_meier", f"SELECT stratum, {r('time', 'time')}, CAST(n_risk AS BIGINT) AS n_risk, CAST(events AS BIGINT) AS events, CAST(censored AS BIGINT) AS censored, {r('survival', 'survival')} FROM km UNION ALL SELECT stratum, 0.0, CAST(max(n_risk) AS BIGINT), 0, 0, 1.0 FROM km GROUP BY stratum")
def s15(d: Data) -> DataFrame:
    return sv.kaplan_meier(d.visits.withColumnRenamed("cohort", "stratum"))


@query("s15_survival_at", f"WITH h AS (SELECT unnest([1.0, 4.0, 12.0]) AS horizon) SELECT stratum, horizon, {r('coalesce(arg_max(survival, time), 1.0)', 'survival')} FROM (SELECT DISTINCT stratum FROM km) CROSS JOIN h LEFT JOIN km USING (stratum) WHERE time <= horizon OR time IS NULL GROUP BY 1, 2")
def s15_at(d: Data) -> DataFrame:
    h = d.spark.createDataFrame([(1.0,), (4.0,), (12.0,)], "horizon double")
    return sv.survival_at(sv.kaplan_meier(d.visits.withColumnRenamed("cohort", "stratum")), h)


_LR = "p AS (SELECT time, count(*) AS n, count(*) FILTER (cohort = 'test') AS n1, sum(event) AS d, sum(event) FILTER (cohort = 'test') AS d1 FROM visits GROUP BY time), q AS (SELECT *, sum(n) OVER w AS nn, sum(n1) OVER w AS nn1 FROM p WINDOW w AS (ORDER BY time DESC)), s AS (SELECT CAST(sum(coalesce(d1, 0)) AS BIGINT) AS observed, sum(d * nn1 * 1.0 / nn) AS expected, sum(CASE WHEN nn > 1 THEN d * (nn1 * 1.0 / nn) * (1 - nn1 * 1.0 / nn) * (nn - d) / (nn - 1) ELSE 0.0 END) AS variance FROM q WHERE d > 0)"


@query("s16_log_rank", f"WITH {_LR} SELECT observed, {r('expected', 'expected')}, {r('variance', 'variance')}, {r('pow(observed - expected, 2) / variance', 'chi2')} FROM s")
def s16(d: Data) -> DataFrame:
    return sv.log_rank(d.visits.withColumnRenamed("cohort", "stratum"))


@query("s16_log_rank_p", f"WITH {_LR}, x AS (SELECT *, pow(observed - expected, 2) / variance AS chi2 FROM s) SELECT observed, {r('expected', 'expected')}, {r('variance', 'variance')}, {r('chi2', 'chi2')}, {r(chi2_p('chi2'), 'p')} FROM x")
def s16_p(d: Data) -> DataFrame:
    return sv.with_chi2_p(sv.log_rank(d.visits.withColumnRenamed("cohort", "stratum")))


_COX = "x AS (SELECT subject, feature, value / 10 AS value, time, event FROM covariates JOIN surv USING (subject) WHERE feature <> 'purchase'), p AS (SELECT feature, time, sum(exp(0.1 * value)) AS s0, sum(exp(0.1 * value) * value) AS s1, sum(exp(0.1 * value) * value * value) AS s2, coalesce(sum(exp(0.1 * value)) FILTER (event = 1), 0) AS d0, coalesce(sum(exp(0.1 * value) * value) FILTER (event = 1), 0) AS d1, coalesce(sum(exp(0.1 * value) * value * value) FILTER (event = 1), 0) AS d2, sum(event) AS d, coalesce(sum(value) FILTER (event = 1), 0) AS xd FROM x GROUP BY 1, 2), q AS (SELECT feature, time, d0, d1, d2, CAST(d AS BIGINT) AS d, xd, sum(s0) OVER w AS s0, sum(s1) OVER w AS s1, sum(s2) OVER w AS s2 FROM p WINDOW w AS (PARTITION BY feature ORDER BY time DESC)), l AS (SELECT *, unnest(generate_series(0, d - 1)) AS l FROM q WHERE d > 0), a AS (SELECT *, s0 - l * 1.0 / d * d0 AS a0, s1 - l * 1.0 / d * d1 AS a1, s2 - l * 1.0 / d * d2 AS a2 FROM l)"


@query("s17_cox_terms", f"WITH {_COX} SELECT feature, {r('sum(CASE WHEN l = 0 THEN 0.1 * xd ELSE 0 END - ln(a0))', 'loglik', 4)}, {r('sum(CASE WHEN l = 0 THEN xd ELSE 0 END - a1 / a0)', 'score', 4)}, {r('sum(a2 / a0 - pow(a1 / a0, 2))', 'information', 4)} FROM a GROUP BY feature")
def s17_terms(d: Data) -> DataFrame:
    x = train(d).withColumn("value", F.col("value") / 10)
    t = sv.cox_terms(x, d.surv, chosen(d).withColumn("beta", F.lit(0.1)))
    return t.select("feature", *(F.round(c, 4).alias(c) for c in ("loglik", "score", "information")))


def newton(rounds: int) -> str:
    """SQL of that many Newton steps from 0 for each feature, and the terms at their end, as tables ``b0, t0, b1, ..``."""
    parts = ["x AS MATERIALIZED (SELECT subject, feature, value / 10 AS value, time, event FROM covariates JOIN surv USING (subject) WHERE feature <> 'purchase')", "b0 AS MATERIALIZED (SELECT DISTINCT feature, 0.0 :: DOUBLE AS beta FROM x)"]
    for i in range(rounds + 1):
        sums = ", ".join(f"sum(e * pow(value, {k})) AS s{k}, coalesce(sum(e * pow(value, {k})) FILTER (event = 1), 0) AS d{k}" for k in range(3))
        parts.append(f"p{i} AS (SELECT feature, time, {sums}, sum(event) AS d, coalesce(sum(value) FILTER (event = 1), 0) AS xd FROM (SELECT x.*, exp(beta * value) AS e FROM x JOIN b{i} USING (feature)) GROUP BY 1, 2)")
        parts.append(f"q{i} AS (SELECT feature, d0, d1, d2, CAST(d AS BIGINT) AS d, xd, sum(s0) OVER w AS s0, sum(s1) OVER w AS s1, sum(s2) OVER w AS s2 FROM p{i} WINDOW w AS (PARTITION BY feature ORDER BY time DESC))")
        parts.append(f"a{i} AS (SELECT feature, l, xd, s0 - l * 1.0 / d * d0 AS a0, s1 - l * 1.0 / d * d1 AS a1, s2 - l * 1.0 / d * d2 AS a2 FROM (SELECT *, unnest(generate_series(0, d - 1)) AS l FROM q{i} WHERE d > 0))")
        parts.append(f"t{i} AS MATERIALIZED (SELECT feature, sum(CASE WHEN l = 0 THEN xd ELSE 0 END - a1 / a0) AS u, sum(a2 / a0 - pow(a1 / a0, 2)) AS v FROM a{i} GROUP BY feature)")
        if i < rounds:
            parts.append(f"b{i + 1} AS MATERIALIZED (SELECT feature, beta + CASE WHEN v > 0 THEN greatest(-2.0, least(2.0, u / v)) ELSE 0.0 END AS beta FROM b{i} JOIN t{i} USING (feature))")
    return ", ".join(parts)


@query("s17_cox_univariate", f"WITH {newton(6)}, z AS (SELECT feature, beta, CASE WHEN v > 0 THEN 1 / sqrt(v) END AS se FROM b6 JOIN t6 USING (feature)) SELECT feature, {r('beta', 'beta')}, {r('se', 'se')}, {r('exp(beta)', 'hr')}, {r('exp(beta - 1.959963984540054 * se)', 'lower')}, {r('exp(beta + 1.959963984540054 * se)', 'upper')}, {r('beta / se', 'z')} FROM z")
def s17(d: Data) -> DataFrame:
    return sv.cox_univariate(train(d).withColumn("value", F.col("value") / 10), d.surv)


_PH = "x AS (SELECT subject, feature, value / 10 AS value, time, event, exp(0.1 * value / 10) AS e FROM covariates JOIN surv USING (subject) WHERE feature <> 'purchase'), p AS (SELECT feature, time, sum(e) AS s0, sum(e * value) AS s1 FROM x GROUP BY 1, 2), mean AS (SELECT feature, time, sum(s1) OVER w / sum(s0) OVER w AS mean FROM p WINDOW w AS (PARTITION BY feature ORDER BY time DESC)), res AS (SELECT feature, value - mean AS residual, rank() OVER (PARTITION BY feature ORDER BY time) AS k FROM x JOIN mean USING (feature, time) WHERE event = 1), ph AS (SELECT feature, count(*) AS n_events, corr(k, residual) AS rho, count(*) * pow(corr(k, residual), 2) AS chi2 FROM res GROUP BY feature)"


@query("s18_proportional_hazards", f"WITH {_PH}, pp AS (SELECT *, {chi2_p('chi2')} AS p FROM ph) SELECT feature, n_events, {r('rho', 'rho')}, {r('chi2', 'chi2')}, {r('p', 'p')}, CASE WHEN p < 0.05 THEN 'violated' ELSE 'holds' END AS verdict FROM pp")
def s18(d: Data) -> DataFrame:
    return sv.proportional_hazards_test(train(d).withColumn("value", F.col("value") / 10), d.surv, chosen(d).withColumn("beta", F.lit(0.1)))


@query("s18_proportional_hazards_joint")
def s18_joint(d: Data) -> DataFrame:
    return sv.proportional_hazards_joint(sv.apply_scaler(train(d), sv.fit_scaler(train(d))), d.surv)


@query("s19_recommend", "SELECT 'epv_compliant' AS recommended, 'one_se exceeds the cap' AS reason FROM (SELECT count(DISTINCT event_type) AS n FROM events) WHERE n > 2")
def s19(d: Data) -> DataFrame:
    n = d.table("events").agg(F.count_distinct("event_type").alias("n_features"))
    return sv.recommend(n.select(F.lit("one_se").alias("name"), "n_features").unionByName(n.select(F.lit("epv_compliant").alias("name"), F.lit(2).cast("long").alias("n_features"))), 2)


_HOR = "q AS (SELECT unnest([0.25, 0.5, 0.75]) AS q), h AS (SELECT q, (SELECT quantile_disc(time, [0.25, 0.5, 0.75]) FROM surv WHERE event = 1)[CAST(q * 4 AS INT)] AS horizon FROM q), hor AS (SELECT q, horizon, (SELECT count(*) FROM surv WHERE event = 1 AND time > horizon) AS later FROM h)"


@query("s20_horizons", f"WITH {_HOR} SELECT CAST(q AS DOUBLE) AS q, {r('horizon', 'horizon')}, later FROM hor WHERE later >= 10")
def s20(d: Data) -> DataFrame:
    return sv.horizons(d.surv)


_AUC = f"{_HOR}, x AS (SELECT time, event, risk FROM surv JOIN risk USING (subject)), cs AS (SELECT time, sum(1 - event) AS c, sum(count(*)) OVER (ORDER BY time DESC) AS n FROM x GROUP BY time), g AS (SELECT time, coalesce(exp(sum(CASE WHEN c < n THEN ln(1 - c / n) ELSE -1e9 END) OVER (ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1.0) AS g FROM cs), k AS (SELECT row_number() OVER () AS i, horizon, i.risk, CASE WHEN g > 0 THEN 1 / g ELSE 0.0 END AS w FROM hor, x i JOIN g USING (time) WHERE event = 1 AND i.time <= horizon AND later >= 10), o AS (SELECT row_number() OVER () AS j, horizon, risk FROM hor, x WHERE time > horizon AND later >= 10)"


_SE = "pr AS (SELECT k.horizon, k.i, o.j, w, CASE WHEN k.risk > o.risk THEN 1.0 WHEN k.risk = o.risk THEN 0.5 ELSE 0.0 END AS h FROM k JOIN o ON k.horizon = o.horizon), au AS (SELECT horizon, sum(w * h) / sum(w) AS auc FROM pr GROUP BY 1), ci AS (SELECT horizon, i, any_value(w) AS w, avg(h) AS h FROM pr GROUP BY 1, 2), cj AS (SELECT horizon, j, sum(w * h) / sum(w) AS h FROM pr GROUP BY 1, 2), v1 AS (SELECT horizon, any_value(auc) AS auc, count(*) AS n_cases, sum(pow(w * (h - auc), 2)) / pow(sum(w), 2) AS v FROM ci JOIN au USING (horizon) GROUP BY 1), v0 AS (SELECT horizon, count(*) AS n_controls, sum(pow(h - auc, 2)) / pow(count(*), 2) AS v FROM cj JOIN au USING (horizon) GROUP BY 1), s AS (SELECT horizon, n_cases, n_controls, auc, sqrt(v1.v + v0.v) AS se FROM v1 JOIN v0 USING (horizon))"


@query("s21_time_auc", f"WITH {_AUC}, {_SE} SELECT {r('horizon', 'horizon')}, n_cases, n_controls, (SELECT count(*) FROM x WHERE time >= s.horizon) AS n_at_risk, (SELECT count(*) FROM x WHERE event = 1 AND time > s.horizon) AS n_events_after, {r('auc', 'auc')}, {r('se', 'se')}, {r('auc - 1.959963984540054 * se', 'lower')}, {r('auc + 1.959963984540054 * se', 'upper')} FROM s")
def s21(d: Data) -> DataFrame:
    return sv.time_auc(d.surv, d.risk, sv.horizons(d.surv))


_CAL = "x AS (SELECT time, event, risk * 0.1 AS eta FROM surv JOIN risk USING (subject)), p AS (SELECT time, sum(exp(eta)) AS own, sum(event) AS d FROM x GROUP BY time), h AS (SELECT *, sum(own) OVER (ORDER BY time DESC) AS s0 FROM p), h0 AS (SELECT coalesce(sum(d / s0), 0.0) AS h0 FROM h WHERE time <= 6 AND d > 0), q AS (SELECT quantile_cont(eta, [0.25, 0.5, 0.75]) AS c FROM x), b AS (SELECT time, event, 1 + CAST(eta > c[1] AS INT) + CAST(eta > c[2] AS INT) + CAST(eta > c[3] AS INT) AS bin, exp(-h0 * exp(eta)) AS s FROM x, q, h0), kp AS (SELECT bin, time, count(*) AS n, sum(event) AS e FROM b GROUP BY 1, 2), kr AS (SELECT *, sum(n) OVER (PARTITION BY bin ORDER BY time DESC) AS nr FROM kp), ks AS (SELECT bin, exp(sum(CASE WHEN e < nr THEN ln(1 - e / nr) ELSE -1e9 END)) AS observed FROM kr WHERE time <= 6 GROUP BY bin), pd AS (SELECT bin, count(*) AS n, avg(s) AS predicted FROM b GROUP BY bin)"


@query("s22_calibration", f"WITH {_CAL} SELECT CAST(bin AS INT) AS bin, n, {r('predicted', 'predicted')}, {r('coalesce(observed, 1.0)', 'observed')} FROM pd LEFT JOIN ks USING (bin)")
def s22(d: Data) -> DataFrame:
    return sv.calibration(d.surv, d.risk, 6.0, beta=0.1)


@query("s23_optimism")
def s23(d: Data) -> DataFrame:
    return sv.optimism(d.surv, d.risk.withColumn("risk", F.col("risk") / 10))


_DC = "x AS (SELECT event AS outcome, risk / 20 AS risk FROM surv JOIN risk USING (subject)), c AS (SELECT quantile_cont(risk, [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]) AS q, count(*) AS n, sum(outcome) AS cases FROM x), t AS (SELECT unnest(range(19)) AS step, unnest(q) AS threshold, n, cases FROM c), k AS (SELECT step, threshold, n, cases, count(*) FILTER (risk >= threshold AND outcome = 1) AS tp, count(*) FILTER (risk >= threshold AND outcome = 0) AS fp FROM t, x WHERE threshold < 1 GROUP BY 1, 2, 3, 4)"


@query("s24_decision_curve", f"WITH {_DC} SELECT CAST(step AS INT) AS step, {r('threshold', 'threshold')}, {r('tp * 1.0 / n - fp * 1.0 / n * (threshold / (1 - threshold))', 'net_benefit', 5)}, {r('cases * 1.0 / n - (n - cases) * 1.0 / n * (threshold / (1 - threshold))', 'treat_all', 5)} FROM k")
def s24(d: Data) -> DataFrame:
    x = d.surv.join(d.risk, "subject").select(F.col("event").alias("outcome"), (F.col("risk") / 20).alias("risk"))
    t = sv.decision_curve(x)
    return t.select("step", "threshold", F.round("net_benefit", 5).alias("net_benefit"), F.round("treat_all", 5).alias("treat_all"))


@query("s25_risk_order", f"SELECT subject, {r('risk', 'risk')}, CASE WHEN risk > (SELECT median(risk) FROM risk) THEN 'high' ELSE 'low' END AS stratum, row_number() OVER (ORDER BY risk, subject) AS place FROM risk")
def s25(d: Data) -> DataFrame:
    return sv.risk_order(sv.risk_strata(d.risk, sv.median_cutoff(d.risk)))
