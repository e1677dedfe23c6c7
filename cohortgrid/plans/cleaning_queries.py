"""Sources, gates, sample metadata, mapping, cleaning and hand-off."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import handoff, matrix, samples
from ..session import materialise, work_path
from ..sources import readers
from .bindings import Data
from .registry import query, r

_TAGGED = "SELECT CAST(event_id AS VARCHAR) AS record_id, unnest(['kind', 'value']) AS key, unnest([event_type, regexp_extract(props, '\"k\": *([0-9]+)', 1)]) AS value, unnest([CAST(1 AS BIGINT), CAST(2 AS BIGINT)]) AS pos FROM events"


@query("a1_tagged_records", _TAGGED)
def a1(d: Data) -> DataFrame:
    text = F.concat(F.col("event_id").cast("string"), F.lit("\n!kind = "), F.col("event_type"), F.lit("\n!value = "), F.regexp_extract("props", '"k": *([0-9]+)', 1))
    return readers.split_tagged(d.table("events").select(text.alias("value")))


@query("a2_block_table", "SELECT CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INT) AS row, CAST(s_suppkey AS VARCHAR) AS id, trim(s_name) AS name, CAST(NULL AS VARCHAR) AS note FROM supplier")
def a2(d: Data) -> DataFrame:
    """One annotation file for each nation, with a column that no row fills."""
    line = F.concat_ws("\t", F.col("s_suppkey").cast("string"), "s_name")
    files = d.table("supplier").groupBy("s_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", line.alias("line")))), lambda v: v["line"]), "\n").alias("lines"))
    path = work_path(d.spark, "blocks")
    text = F.concat(F.lit("!head\n#begin\nid\tname\tnote\n"), "lines", F.lit("\n#end"))
    files.select(text.alias("value"), F.col("s_nationkey").alias("nation")).repartition("nation").write.partitionBy("nation").text(path)
    rows = readers.read_block_table(d.spark, path, "#begin", "#end")
    return rows.select(F.col("row").cast("int").alias("row"), F.col("fields")["id"].alias("id"), F.col("fields")["name"].alias("name"), F.col("fields")["note"].alias("note"))


@query("a3_wide_to_long", "SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS feature, unnest(['l_quantity', 'l_tax']) AS sample, unnest([l_quantity, l_tax]) AS value FROM lineitem")
def a3(d: Data) -> DataFrame:
    wide = d.table("lineitem").select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"), "l_quantity", "l_tax")
    return readers.wide_to_long(wide, "id")


@query("a4_edges", "SELECT CAST(a AS VARCHAR) AS a, CAST(b AS VARCHAR) AS b, CAST(score AS INT) AS score FROM edges WHERE score >= 2")
def a4(d: Data) -> DataFrame:
    path = work_path(d.spark, "edges")
    d.edges.write.option("sep", " ").option("header", True).option("compression", "gzip").csv(path)
    return readers.read_edges(d.spark, path, 2)


@query("a4_edge_copy", "SELECT CAST(a AS VARCHAR) AS a, CAST(b AS VARCHAR) AS b, CAST(score AS INT) AS score FROM edges WHERE score >= 3")
def a4_copy(d: Data) -> DataFrame:
    """The stronger half of a sorted copy that starts from a score of 2."""
    source, copy = work_path(d.spark, "edges"), work_path(d.spark, "edge_copy")
    d.edges.write.option("sep", " ").option("header", True).option("compression", "gzip").csv(source)
    return readers.stored_edges(d.spark, source, copy, 3, least=2)


@query("a5_signed_sets", "SELECT source, target, sign, confidence, 'declared' AS coverage FROM (SELECT source, target, coalesce(sign, 0) AS sign, chr(65 + CAST(length(target) % 3 AS INT)) AS confidence FROM signed) WHERE confidence IN ('A', 'B')")
def a5(d: Data) -> DataFrame:
    rows = d.signed.select("source", "target", F.coalesce("sign", F.lit(0)).cast("double").alias("mor"), F.char(65 + F.length("target") % 3).alias("confidence"))
    return readers.signed_sets(rows, ["A", "B"])


@query("a6_signed_sets_vocab", "SELECT source, target, sign, CASE sign WHEN 1 THEN 'Activation' WHEN -1 THEN 'Repression' ELSE 'Unknown' END AS mode FROM signed")
def a6(d: Data) -> DataFrame:
    rows = d.signed.select("source", "target", F.when(F.col("sign") == 1, "Activation").when(F.col("sign") == -1, "Repression").otherwise("Unknown").alias("mode"))
    return readers.signed_sets_vocab(rows, {"Activation": 1, "Repression": -1, "Unknown": None})


@query("a7_result_folders", "SELECT c_nationkey, count(*) AS n, 'customers' AS dataset FROM customer GROUP BY 1 UNION ALL SELECT s_nationkey, count(*), 'suppliers' FROM supplier GROUP BY 1")
def a7(d: Data) -> DataFrame:
    """Two datasets in one folder; the second write of the customers replaces the first and leaves the suppliers."""
    path = work_path(d.spark, "results")
    per = lambda table, key: d.table(table).groupBy(F.col(key).alias("c_nationkey")).agg(F.count("*").alias("n"))
    readers.write_results(per("orders", "o_custkey"), path, "customers")
    readers.write_results(per("supplier", "s_nationkey"), path, "suppliers")
    readers.write_results(per("customer", "c_nationkey"), path, "customers")
    return d.spark.read.parquet(path).select("c_nationkey", "n", "dataset")


@query("a8_sort_members", "SELECT o_custkey AS id, string_agg(s, '/' ORDER BY s) AS members FROM (SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS s FROM orders) GROUP BY 1")
def a8(d: Data) -> DataFrame:
    lists = d.table("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.array_join(F.collect_list(F.col("o_orderkey").cast("string")), "/").alias("members"))
    return readers.sort_members(lists, ["members"])


@query("a9_fingerprint", "SELECT 'orders' AS name, count(*) AS n_rows, CAST(sum(CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|' || coalesce(o_orderstatus, '\\N')), 1, 15)) AS HUGEINT)) AS VARCHAR) AS content_hash FROM orders")
def a9(d: Data) -> DataFrame:
    return readers.table_fingerprint(d.table("orders"), "orders", ["o_orderkey", "o_orderstatus"])


@query("a10_expectations", "SELECT * FROM (VALUES ('orders_present', true, true), ('prices_positive', true, true), ('no_such_table', false, false), ('no_such_column', false, false)) t(name, ok, required)")
def a10(d: Data) -> DataFrame:
    rules = [("orders_present", "orders", "count(*) > 0", True), ("prices_positive", "orders", "min(o_totalprice) > 0", True), ("no_such_table", "figures", "count(*) > 0", False), ("no_such_column", "orders", "count(label) > 0", False)]
    return readers.expectations({"orders": d.table("orders")}, rules)


@query("b1_gates", "SELECT 'status_known' AS rule, count(*) AS n_rows, count(*) FILTER (o_orderstatus IN ('F', 'O', 'P')) AS n_pass, count(*) FILTER (o_orderstatus IN ('F', 'O', 'P')) = count(*) AS pass FROM orders UNION ALL SELECT 'price_over_1000', count(*), count(*) FILTER (o_totalprice > 1000), count(*) FILTER (o_totalprice > 1000) = count(*) FROM orders")
def b1(d: Data) -> DataFrame:
    return samples.gates(d.table("orders"), {"status_known": F.col("o_orderstatus").isin("F", "O", "P"), "price_over_1000": F.col("o_totalprice") > 1000})


@query("b2_search_catalogue", "SELECT * FROM (SELECT c_custkey AS dataset, c_mktsegment AS organism, n_name AS platform, o_orderpriority AS type, count(*) AS n_samples FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY ALL) WHERE organism = 'BUILDING' AND regexp_matches(type, '^[12]-') AND NOT regexp_matches(platform, 'CHINA|JAPAN') AND n_samples >= 2 AND n_samples < 50 ORDER BY n_samples DESC, dataset, type LIMIT 20")
def b2(d: Data) -> DataFrame:
    x = d.table("customer").join(d.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(d.table("orders"), F.col("o_custkey") == F.col("c_custkey"))
    x = x.groupBy(F.col("c_custkey").alias("dataset"), F.col("c_mktsegment").alias("organism"), F.col("n_name").alias("platform"), F.col("o_orderpriority").alias("type")).agg(F.count("*").alias("n_samples"))
    return samples.search_catalogue(x, "BUILDING", "^[12]-", "CHINA|JAPAN", 2, 50, 20, tie=("dataset", "type"))


@query("b3_candidate_groups", "SELECT label, count(*) AS n FROM (SELECT sample, string_agg(value, ' | ' ORDER BY key) FILTER (regexp_matches(key, 'status|priority')) AS label FROM attrs GROUP BY sample) GROUP BY label")
def b3(d: Data) -> DataFrame:
    return samples.candidate_groups(d.attrs, "status|priority")


@query("b4_assign_arms", "SELECT sample, n_hits, CASE WHEN n_hits = 1 THEN CASE WHEN a THEN 'case' ELSE 'control' END END AS arm FROM (SELECT sample, a, CAST(a AS INT) + CAST(b AS INT) AS n_hits FROM (SELECT CAST(o_orderkey AS VARCHAR) AS sample, contains(lower(o_orderpriority), 'urgent') OR contains(lower(o_orderpriority), 'high') AS a, contains(lower(o_orderpriority), 'low') AS b FROM orders))")
def b4(d: Data) -> DataFrame:
    x = d.table("orders").select(F.col("o_orderkey").cast("string").alias("sample"), "o_orderpriority")
    return samples.assign_arms(x, "o_orderpriority", {"case": ["Urgent", "High"], "control": ["low"]}).drop("o_orderpriority")


@query("b5_arm_gates", "SELECT *, n_numerator + n_denominator < 10 AND least(n_numerator, n_denominator) >= 3 AS small_design, n_numerator + n_denominator >= 15 AND least(n_numerator, n_denominator) >= 10 AS cohort FROM (SELECT count(*) FILTER (arm = 'a1') AS n_numerator, count(*) FILTER (arm = 'a0') AS n_denominator FROM s1)")
def b5(d: Data) -> DataFrame:
    return samples.arm_gates(d.s1, "a1", "a0")


@query("b6_validate_pairs", "WITH u AS (SELECT l_suppkey % 7 + (l_suppkey // 14) * 7 AS pair_id, CAST(l_suppkey AS VARCHAR) AS sample, CASE WHEN l_suppkey % 2 = 0 THEN 'F' ELSE 'O' END AS arm FROM (SELECT DISTINCT l_suppkey FROM lineitem)) SELECT pair_id, count(*) AS n_members, count(*) AS n_known, count(DISTINCT arm) AS n_arms, CAST(0 AS BIGINT) AS n_reused, count(*) = 2 AND count(DISTINCT arm) = 2 AS ok FROM u GROUP BY pair_id")
def b6(d: Data) -> DataFrame:
    u = d.table("lineitem").select("l_suppkey").distinct().select((F.col("l_suppkey") % 7 + F.floor(F.col("l_suppkey") / 14) * 7).alias("pair_id"), F.col("l_suppkey").cast("string").alias("sample"), F.when(F.col("l_suppkey") % 2 == 0, "F").otherwise("O").alias("arm"))
    return samples.validate_pairs(u.select("sample", "arm"), u.select("pair_id", "sample"))


@query("b7_parse_key_values", "SELECT id, key, string_agg(value, ' | ' ORDER BY pos) AS value FROM (SELECT user_id AS id, CASE WHEN event_type = 'view' THEN 'unnamed' ELSE event_type END AS key, CASE WHEN event_type = 'view' THEN regexp_extract(props, '([0-9]+)', 1) ELSE regexp_extract(props, '([0-9]+)', 1) END AS value, event_id AS pos FROM events) GROUP BY 1, 2")
def b7(d: Data) -> DataFrame:
    n = F.regexp_extract("props", "([0-9]+)", 1)
    return samples.parse_key_values(d.table("events").withColumn("text", F.when(F.col("event_type") == "view", n).otherwise(F.concat("event_type", F.lit(": "), n))), "user_id", "text", "event_id")


@query("b8_attributes_wide", "SELECT sample, min(value) FILTER (key = 'status') AS status, min(value) FILTER (key = 'priority') AS priority FROM attrs GROUP BY sample")
def b8(d: Data) -> DataFrame:
    return samples.attributes_wide(d.attrs, ["status", "priority"])


_PROFILE = f"SELECT key, present, (SELECT count(*) FROM attr_samples) - present AS missing, n_distinct, is_numeric, {r('CASE WHEN is_numeric THEN lo END', 'min')}, {r('CASE WHEN is_numeric THEN hi END', 'max')}, {r('CASE WHEN is_numeric THEN med END', 'median')}, CASE WHEN NOT is_numeric THEN tops END AS top_values FROM profile0 LEFT JOIN (SELECT key, string_agg(value || ' (' || n || ')', '; ' ORDER BY k) AS tops FROM (SELECT key, value, count(*) AS n, row_number() OVER (PARTITION BY key ORDER BY count(*) DESC, value) AS k FROM attrs GROUP BY 1, 2) WHERE k <= 12 GROUP BY key) USING (key)"


@query("b9_field_profile", _PROFILE)
def b9(d: Data) -> DataFrame:
    return samples.field_profile(d.attrs, d.attr_samples)


@query("b10_batch_field", "SELECT min(key) AS batch_field FROM profile0 WHERE regexp_matches(key, '(?i)status|priority') AND n_distinct > 1")
def b10(d: Data) -> DataFrame:
    return samples.detect_batch_field(samples.field_profile(d.attrs, d.attr_samples), "(?i)status|priority")


_CELLS = "cells AS (SELECT source AS a, lang AS b, count(*) AS o FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY 1, 2), every AS (SELECT x.a, y.b, coalesce(o, 0) AS observed, na * nb * 1.0 / (SELECT sum(o) FROM cells) AS expected FROM (SELECT a, sum(o) AS na FROM cells GROUP BY a) x CROSS JOIN (SELECT b, sum(o) AS nb FROM cells GROUP BY b) y LEFT JOIN cells c ON c.a = x.a AND c.b = y.b)"


@query("b11_contingency", f"WITH {_CELLS} SELECT a, b, observed, {r('expected', 'expected')} FROM every")
def b11_cells(d: Data) -> DataFrame:
    return samples.contingency(d.table("documents"), "source", "lang").drop("n")


@query(
    "b11_confounding",
    f"WITH {_CELLS}, one AS (SELECT CAST(sum(observed) AS BIGINT) AS n, count(DISTINCT a) AS n_batches, count(DISTINCT b) AS n_groups, sum((observed - expected) * (observed - expected) / expected) AS chi2, (SELECT max(g) FROM (SELECT count(*) AS g FROM cells GROUP BY a)) AS most FROM every) SELECT n, n_batches, n_groups, {r('chi2', 'chi2')}, {r('sqrt(chi2 / (n * (least(n_batches, n_groups) - 1)))', 'cramers_v')}, CASE WHEN n_batches < 2 THEN 'no_batch_variation' WHEN most = 1 THEN 'fully_confounded' ELSE 'partially_crossed' END AS verdict FROM one",
)
def b11(d: Data) -> DataFrame:
    return samples.confounding(d.table("documents"), "source", "lang")


@query("b12_endpoints", "SELECT 'late event' AS event, 'price (days)' AS time, CAST(0 AS INT) AS shared_words, count(*) AS events, count(*) // 10 AS cap10, count(*) // 5 AS cap5 FROM attrs WHERE key = 'late event' AND value = '1'")
def b12(d: Data) -> DataFrame:
    return samples.find_endpoints(samples.field_profile(d.attrs, d.attr_samples), ["1", "0"], d.attrs, min_cover=0.5)


@query("b13_code_traits", f"SELECT sample, key AS trait, {r('CASE WHEN is_numeric THEN TRY_CAST(value AS DOUBLE) ELSE CAST(value = second AS DOUBLE) END', 'x')} FROM attrs JOIN profile0 USING (key) WHERE present >= 0.8 * (SELECT count(*) FROM attr_samples) AND (is_numeric OR n_distinct = 2)")
def b13(d: Data) -> DataFrame:
    return samples.code_traits(d.attrs, d.attr_samples)


@query("b14_quartile_bins", "WITH t AS (SELECT CAST(o_orderkey AS VARCHAR) AS sample, 'price' AS trait, o_totalprice AS x FROM orders), q AS (SELECT quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM t) SELECT sample, trait, round(x, 6) + 0.0 AS x, CASE WHEN x <= q[1] THEN 1 WHEN x <= q[2] THEN 2 WHEN x <= q[3] THEN 3 ELSE 4 END AS quartile FROM t, q")
def b14(d: Data) -> DataFrame:
    return samples.quartile_bins(d.table("orders").select(F.col("o_orderkey").cast("string").alias("sample"), F.lit("price").alias("trait"), F.col("o_totalprice").alias("x")))


@query("b15_cap_samples", "SELECT CAST(vec_id AS VARCHAR) AS sample FROM embeddings ORDER BY vec_id LIMIT 25")
def b15(d: Data) -> DataFrame:
    return samples.cap_samples(d.table("embeddings").select("vec_id"), 25, "vec_id").select(F.col("vec_id").cast("string").alias("sample"))


@query("b16_unit", "SELECT DISTINCT key, CASE WHEN key = 'price (days)' THEN 'days' END AS unit FROM attrs")
def b16(d: Data) -> DataFrame:
    return d.attrs.select("key").distinct().withColumn("unit", samples.unit_of(F.col("key")))


@query("c1_pick_annotation", "WITH c AS (SELECT count(*) FILTER (trim(p_type) <> '' AND p_size > 25) AS a, count(*) FILTER (trim(p_name) <> '') AS b FROM part) SELECT 'type' AS \"column\", a AS filled, 0 AS priority, a > 100 AS picked FROM c UNION ALL SELECT 'name', b, 1, a <= 100 AND b > 100 FROM c")
def c1(d: Data) -> DataFrame:
    x = d.table("part").select(F.when(F.col("p_size") > 25, F.col("p_type")).alias("type"), F.col("p_name").alias("name"))
    return matrix.pick_annotation(x, ["type", "name"])


@query("c2_normalise_key", "SELECT p_partkey, regexp_replace(regexp_replace(lower(p_type || ' (v1)'), '\\([^)]*\\)', '', 'g'), '[^a-z0-9]', '', 'g') AS key, regexp_replace(trim(p_brand || '.12'), '\\.\\d+$', '') AS accession, false AS refseq FROM part")
def c2(d: Data) -> DataFrame:
    return d.table("part").select("p_partkey", matrix.normalise_key(F.concat("p_type", F.lit(" (v1)"))).alias("key"), matrix.strip_version(F.concat("p_brand", F.lit(".12"))).alias("accession"), matrix.is_refseq(F.col("p_brand")).alias("refseq"))


def _routes(d: Data) -> dict:
    part = d.table("part")
    by_key = part.where("p_size <= 20").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_brand").alias("target"))
    by_name = part.where("p_size <= 40").select(matrix.normalise_key(F.concat("p_name", F.col("p_partkey").cast("string"))).alias("key"), F.col("p_type").alias("target"))
    return {"id": (F.col("feature"), by_key), "name": (matrix.normalise_key(F.col("name")), by_name)}


def _parts(d: Data) -> DataFrame:
    return d.table("part").select(F.col("p_partkey").cast("string").alias("feature"), F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"))


_KEY = "regexp_replace(regexp_replace(lower(p_name || CAST(p_partkey AS VARCHAR)), '\\([^)]*\\)', '', 'g'), '[^a-z0-9]', '', 'g')"
_COVER = f"names AS (SELECT {_KEY} AS key, min(p_type) AS target FROM part WHERE p_size <= 40 GROUP BY 1), j AS (SELECT CAST(p_partkey AS VARCHAR) AS feature, CASE WHEN p_size <= 20 THEN p_brand END AS a, n.target AS b FROM part LEFT JOIN names n ON n.key = {_KEY}), cov AS (SELECT 'id' AS route, 0 AS position, count(*) AS n, count(a) AS covered, count(DISTINCT a) AS n_targets FROM j UNION ALL SELECT 'name', 1, count(*), count(b), count(DISTINCT b) FROM j)"


@query("c3_route_coverage", f"WITH {_COVER} SELECT route, position, n, covered, n_targets, {r('covered * 1.0 / n', 'coverage')} FROM cov")
def c3_cover(d: Data) -> DataFrame:
    return matrix.route_coverage(_parts(d), _routes(d))


@query("c3_map_features", f"WITH {_COVER} SELECT feature, b AS target, 'name' AS route FROM j WHERE b IS NOT NULL")
def c3(d: Data) -> DataFrame:
    return matrix.map_features(_parts(d), _routes(d))


@query("c4_mapping_gate", f"WITH {_COVER} SELECT route, position, n, covered, n_targets, {r('covered * 1.0 / n', 'coverage')}, NOT (covered * 1.0 / n < 0.5 AND n_targets < 5000) AS usable FROM cov")
def c4(d: Data) -> DataFrame:
    return matrix.mapping_gate(matrix.route_coverage(_parts(d), _routes(d)))


@query("c5_first_wins", "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders) WHERE k = 1")
def c5(d: Data) -> DataFrame:
    return matrix.first_wins(d.table("orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("c6_collapse_max_var", f"WITH v AS (SELECT feature, coalesce(var_samp(value), 0) AS v FROM m2 GROUP BY feature), pick AS (SELECT feature, target FROM (SELECT feature, substr(feature, 1, 7) AS target, row_number() OVER (PARTITION BY substr(feature, 1, 7) ORDER BY v DESC, feature) AS k FROM v) WHERE k = 1) SELECT target AS feature, sample, {r('value', 'value')} FROM m2 JOIN pick USING (feature)")
def c6(d: Data) -> DataFrame:
    return matrix.collapse_max_var(d.m2, d.m2.select("feature", F.substring("feature", 1, 7).alias("target")).distinct())


@query("c7_align_samples", f"SELECT feature, sample, {r('value', 'value')} FROM m2 SEMI JOIN (SELECT DISTINCT sample FROM m2 SEMI JOIN s2 USING (sample)) USING (sample)")
def c7(d: Data) -> DataFrame:
    return matrix.align_samples(d.m2, d.s2.join(d.m2.select("sample").distinct(), "sample", "left_semi"))


@query("c7_alignment_report", "SELECT sample, 'missing' AS status FROM s2 ANTI JOIN m2 USING (sample) UNION ALL SELECT DISTINCT sample, 'extra' FROM m2 ANTI JOIN s2 USING (sample)")
def c7_report(d: Data) -> DataFrame:
    return matrix.alignment_report(d.m2, d.s2)


@query("c8_low_information", f"SELECT feature, sample, {r('value', 'value')} FROM m3 SEMI JOIN (SELECT feature FROM m3 GROUP BY feature HAVING count(*) >= 20 AND min(value) < max(value)) USING (feature)")
def c8(d: Data) -> DataFrame:
    return matrix.filter_low_information(d.m3, 20)


@query(
    "c9_knn_impute",
    f"WITH few AS (SELECT DISTINCT sample FROM m2), x AS (SELECT m2.* FROM m2 SEMI JOIN few USING (sample)), gappy AS (SELECT feature FROM x GROUP BY feature HAVING count(*) < (SELECT count(*) FROM few)), near AS (SELECT a.feature AS f, b.feature AS g, avg((a.value - b.value) * (a.value - b.value)) AS dist FROM x a JOIN gappy ON a.feature = gappy.feature JOIN x b ON a.sample = b.sample AND a.feature <> b.feature GROUP BY 1, 2), gaps AS (SELECT g.feature AS f, few.sample FROM gappy g CROSS JOIN few ANTI JOIN x ON x.feature = g.feature AND x.sample = few.sample), opt AS (SELECT gaps.f, gaps.sample, x.value, row_number() OVER (PARTITION BY gaps.f, gaps.sample ORDER BY dist, near.g) AS k FROM gaps JOIN near ON near.f = gaps.f JOIN x ON x.feature = near.g AND x.sample = gaps.sample) SELECT feature, sample, {r('value', 'value', 4)}, false AS imputed FROM x UNION ALL SELECT f, sample, {r('avg(value)', 'value', 4)}, true FROM opt WHERE k <= 5 GROUP BY 1, 2",
)
def c9(d: Data) -> DataFrame:
    out = matrix.knn_impute(d.m2, d.m2.select("sample").distinct(), 5)
    return out.withColumn("value", F.round("value", 4))


_SCALE = f"SELECT {r('q[1]', 'q01')}, {r('q[2]', 'q50')}, {r('q[3]', 'q99')}, {r('neg', 'negative')}, CASE WHEN neg > 0.001 THEN 'log2' WHEN q[3] > 100 THEN 'linear' WHEN q[2] > 50 THEN 'linear' ELSE 'log2' END AS scale FROM (SELECT quantile_cont(value, [0.01, 0.5, 0.99]) AS q, avg(CASE WHEN value < 0 THEN 1.0 ELSE 0.0 END) AS neg FROM m2)"


@query("c10_detect_scale", _SCALE)
def c10(d: Data) -> DataFrame:
    return matrix.detect_scale(d.m2)


@query("c11_to_log2", f"SELECT feature, sample, {r('log2(value + 1)', 'value')} FROM m2")
def c11(d: Data) -> DataFrame:
    return matrix.to_log2(d.m2)


@query("c12_quantile_normalise", f"WITH k AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY value, feature) AS k FROM m1), m AS (SELECT k, avg(value) AS m FROM k GROUP BY k) SELECT feature, sample, {r('avg(m) OVER (PARTITION BY sample, value)', 'value')} FROM k JOIN m USING (k)")
def c12(d: Data) -> DataFrame:
    return matrix.quantile_normalise(d.m1)


@query("c13_stabilise", f"WITH q AS (SELECT sample, quantile_cont(value, [0.25, 0.5, 0.75]) AS q FROM m2 GROUP BY sample) SELECT feature, sample, {r('asinh((value - q[2]) / CASE WHEN q[3] - q[1] > 0 THEN q[3] - q[1] ELSE 1.0 END)', 'value')} FROM m2 JOIN q USING (sample)")
def c13(d: Data) -> DataFrame:
    return matrix.stabilise(d.m2)


@query("c14_row_zscore", f"SELECT feature, sample, {r('CASE WHEN stddev_samp(value) OVER w > 0 THEN greatest(-3, least(3, (value - avg(value) OVER w) / stddev_samp(value) OVER w)) ELSE 0 END', 'value')} FROM m1 WINDOW w AS (PARTITION BY feature)")
def c14(d: Data) -> DataFrame:
    return matrix.row_zscore(d.m1, 3.0)


@query("c15_top_variance", f"SELECT feature, sample, {r('value', 'value')} FROM m1 SEMI JOIN (SELECT feature FROM m1 GROUP BY feature ORDER BY var_samp(value) DESC, feature LIMIT 10) USING (feature)")
def c15(d: Data) -> DataFrame:
    return matrix.top_variance(d.m1, 10)


@query("c16_cleaning_report", "SELECT (SELECT count(DISTINCT feature) FROM m2) AS features_before, (SELECT count(DISTINCT sample) FROM m2) AS samples_before, (SELECT count(*) FROM m2) AS cells_before, count(DISTINCT feature) AS features_after, count(DISTINCT sample) AS samples_after, count(*) AS cells_after, 'linear' AS scale FROM m2 SEMI JOIN s2 USING (sample)")
def c16(d: Data) -> DataFrame:
    raw = materialise(d.m2, "raw")
    return matrix.cleaning_report(raw, raw.join(d.s2, "sample", "left_semi"))


_H1 = "SELECT 'stat' AS source, feature, abs(t) AS key, row_number() OVER (ORDER BY abs(t) DESC, feature) AS source_rank FROM part_stat ORDER BY abs(t) DESC, feature LIMIT 200"


@query("h1_shortlist", f"SELECT source, feature, {r('key', 'key')}, source_rank FROM ({_H1})")
def h1(d: Data) -> DataFrame:
    return handoff.shortlist(d.part_stat, "stat", "feature", "t")


@query(
    "h2_merge_shortlists",
    f"WITH a AS ({_H1}), b AS (SELECT 'size' AS source, CAST(p_partkey AS VARCHAR) AS feature, p_size AS key, row_number() OVER (ORDER BY p_size, CAST(p_partkey AS VARCHAR)) AS source_rank FROM part ORDER BY p_size, CAST(p_partkey AS VARCHAR) LIMIT 200), x AS (SELECT source, feature, source_rank, 0 AS pr FROM a UNION ALL SELECT source, feature, source_rank, 1 FROM b), n AS (SELECT feature, count(DISTINCT source) AS n_sources FROM x GROUP BY feature), best AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY pr, source_rank) AS k FROM x) SELECT feature, source, source_rank, n_sources, {r('t', 'lfc')} FROM best JOIN n USING (feature) LEFT JOIN part_stat USING (feature) WHERE k = 1",
)
def h2(d: Data) -> DataFrame:
    a = handoff.shortlist(d.part_stat, "stat", "feature", "t")
    b = handoff.shortlist(d.table("part").select(F.col("p_partkey").cast("string").alias("feature"), "p_size"), "size", "feature", "p_size", desc=False)
    return handoff.merge_shortlists([a, b], d.part_stat.select("feature", F.col("t").alias("lfc")))
