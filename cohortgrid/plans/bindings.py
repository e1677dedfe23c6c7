"""The library's inputs built from the star-schema tables, as DataFrames and as SQL of the same names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import shared_edges


class Data:
    """Tables below a folder, and the inputs derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def m1(self) -> DataFrame:
        """Dense matrix: vectors as samples, dimensions as features."""
        x = self.table("embeddings").select(F.col("vec_id").cast("string").alias("sample"), F.posexplode("embedding").alias("i", "value"))
        return x.select(F.concat(F.lit("f"), F.lpad(F.col("i").cast("string"), 2, "0")).alias("feature"), "sample", F.col("value").cast("double").alias("value"))

    @property
    def s1(self) -> DataFrame:
        return self.table("embeddings").where("label in (0, 1)").select(F.col("vec_id").cast("string").alias("sample"), F.concat(F.lit("a"), F.col("label").cast("string")).alias("arm"))

    @property
    def m1_arms(self) -> DataFrame:
        return self.m1.join(self.s1.select("sample"), "sample", "left_semi")

    @property
    def m2(self) -> DataFrame:
        """Sparse matrix on a linear scale: customers as samples, brands as features, spend as value."""
        line, orders, part = self.table("lineitem"), self.table("orders"), self.table("part")
        x = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
        return x.groupBy(F.col("p_brand").alias("feature"), F.col("o_custkey").cast("string").alias("sample")).agg(F.round(F.sum("l_extendedprice"), 2).alias("value"))

    @property
    def s2(self) -> DataFrame:
        return self.table("customer").where("c_mktsegment in ('AUTOMOBILE', 'BUILDING')").select(F.col("c_custkey").cast("string").alias("sample"), F.col("c_mktsegment").alias("arm"))

    @property
    def m3(self) -> DataFrame:
        """Many features: documents as samples, words as features."""
        words = self.table("documents").select(F.col("doc_id").cast("string").alias("sample"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1)).alias("feature"))
        return words.groupBy("feature", "sample").agg(F.log2(F.count("*") + 1).alias("value"))

    @property
    def s3(self) -> DataFrame:
        return self.table("labels").select(F.col("doc_id").cast("string").alias("sample"), F.when(F.col("quality") == 1, "good").otherwise("bad").alias("arm"))

    @property
    def pairs(self) -> DataFrame:
        """Paired cells: suppliers as pairs, line status as arm, brands as features."""
        x = self.table("lineitem").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        return x.groupBy(F.col("p_brand").alias("feature"), F.concat(F.col("l_suppkey").cast("string"), "l_linestatus").alias("sample")).agg(F.avg("l_extendedprice").alias("value"))

    @property
    def pair_samples(self) -> DataFrame:
        return self.table("lineitem").select(F.concat(F.col("l_suppkey").cast("string"), "l_linestatus").alias("sample"), F.col("l_linestatus").alias("arm"), F.col("l_suppkey").alias("pair_id")).distinct()

    @property
    def visits(self) -> DataFrame:
        """Survival: user days, hours from the first event to the first purchase."""
        x = self.table("events").select((F.col("user_id") * 100000 + F.datediff(F.to_date("ts"), F.lit("2000-01-01"))).alias("subject"), "user_id", "ts", "event_type", "value")
        hours = lambda c: (F.unix_micros(F.col(c).cast("timestamp")) / 3600000000.0)
        g = x.groupBy("subject", "user_id").agg(F.min(hours("ts")).alias("start"), F.max(hours("ts")).alias("last"), F.min(F.when(F.col("event_type") == "purchase", hours("ts"))).alias("bought"))
        g = g.select("subject", "user_id", F.round(F.coalesce("bought", "last") - F.col("start"), 6).alias("time"), F.col("bought").isNotNull().cast("int").alias("event"))
        return g.where("time > 0").withColumn("cohort", F.when(F.col("user_id") % 2 == 0, "train").otherwise("test"))

    @property
    def surv(self) -> DataFrame:
        return self.visits.where("cohort = 'train'").select("subject", "time", "event")

    @property
    def surv2(self) -> DataFrame:
        return self.visits.where("cohort = 'test'").select("subject", "time", "event")

    @property
    def covariates(self) -> DataFrame:
        """Mean event value of each type; a type without events is 0."""
        x = self.table("events").select((F.col("user_id") * 100000 + F.datediff(F.to_date("ts"), F.lit("2000-01-01"))).alias("subject"), "event_type", "value")
        per = x.groupBy("subject", F.col("event_type").alias("feature")).agg(F.round(F.avg("value"), 6).alias("v"))
        types = x.select(F.col("event_type").alias("feature")).distinct()
        every = self.visits.select("subject").join(F.broadcast(types), F.lit(True))
        return every.join(per, ["subject", "feature"], "left").select("subject", "feature", F.coalesce("v", F.lit(0.0)).alias("value"))

    @property
    def risk(self) -> DataFrame:
        """A risk for every visit: its mean event value, in steps."""
        x = self.table("events").select((F.col("user_id") * 100000 + F.datediff(F.to_date("ts"), F.lit("2000-01-01"))).alias("subject"), "value")
        return x.groupBy("subject").agg((F.floor(F.round(F.avg("value"), 6) * 10 + 0.5) / 100).alias("risk"))

    @property
    def sets(self) -> DataFrame:
        return self.table("part").select(F.col("p_brand").alias("set_id"), F.col("p_partkey").cast("string").alias("feature"))

    @property
    def part_stat(self) -> DataFrame:
        """A statistic per part: mean price of returned less accepted lines over the spread."""
        x = self.table("lineitem").groupBy(F.col("l_partkey").cast("string").alias("feature")).agg(
            F.avg(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("r"), F.avg(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("a"), F.stddev_samp("l_quantity").alias("s")
        )
        return x.where("r is not null and a is not null and s > 0").select("feature", F.round((F.col("r") - F.col("a")) / F.col("s"), 6).alias("t"))

    @property
    def signed(self) -> DataFrame:
        """Signed sets: words by their first two letters."""
        return self.signed_words(self.m3)

    @staticmethod
    def signed_words(words: DataFrame) -> DataFrame:
        w = words.select("feature").distinct().where("length(feature) > 1")
        n = F.length("feature")
        return w.select(F.substring("feature", 1, 2).alias("source"), F.col("feature").alias("target"), F.when(n % 5 == 0, None).when(n % 2 == 0, 1).otherwise(-1).alias("sign"))

    @property
    def edges(self) -> DataFrame:
        """Parts that orders have in common by supplier: suppliers linked by the number of parts they share."""
        return shared_edges(self.table("lineitem"), "l_suppkey", "l_partkey")

    @property
    def attrs(self) -> DataFrame:
        """Sample attributes of orders, as text."""
        o = self.table("orders").withColumn("sample", F.col("o_orderkey").cast("string"))
        rows = F.array(
            F.struct(F.lit("status").alias("key"), F.col("o_orderstatus").alias("value")),
            F.struct(F.lit("priority").alias("key"), F.col("o_orderpriority").alias("value")),
            F.struct(F.lit("price (days)").alias("key"), F.when(F.col("o_orderkey") % 10 > 0, F.round("o_totalprice", 0).cast("long").cast("string")).alias("value")),
            F.struct(F.lit("late event").alias("key"), F.when(F.col("o_totalprice") > 150000, "1").otherwise("0").alias("value")),
        )
        return o.select("sample", F.inline(rows)).where("value is not null")

    @property
    def attr_samples(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").cast("string").alias("sample"))


_VISIT = "user_id * 100000 + date_diff('day', DATE '2000-01-01', CAST(ts AS DATE))"

SQL = {
    "m1": "SELECT 'f' || lpad(CAST(i - 1 AS VARCHAR), 2, '0') AS feature, sample, CAST(v AS DOUBLE) AS value FROM (SELECT CAST(vec_id AS VARCHAR) AS sample, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)",
    "s1": "SELECT CAST(vec_id AS VARCHAR) AS sample, 'a' || CAST(label AS VARCHAR) AS arm FROM embeddings WHERE label IN (0, 1)",
    "m1_arms": "SELECT m1.* FROM m1 SEMI JOIN s1 USING (sample)",
    "m2": "SELECT p_brand AS feature, CAST(o_custkey AS VARCHAR) AS sample, round(sum(l_extendedprice), 2) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2",
    "s2": "SELECT CAST(c_custkey AS VARCHAR) AS sample, c_mktsegment AS arm FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')",
    "m3": "SELECT feature, sample, log2(count(*) + 1) AS value FROM (SELECT CAST(doc_id AS VARCHAR) AS sample, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS feature FROM documents) GROUP BY 1, 2",
    "s3": "SELECT CAST(doc_id AS VARCHAR) AS sample, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS arm FROM labels",
    "pairs": "SELECT p_brand AS feature, CAST(l_suppkey AS VARCHAR) || l_linestatus AS sample, avg(l_extendedprice) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2",
    "pair_samples": "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) || l_linestatus AS sample, l_linestatus AS arm, l_suppkey AS pair_id FROM lineitem",
    "visits": f"SELECT subject, user_id, round(coalesce(bought, last) - start, 6) AS time, CAST(bought IS NOT NULL AS INT) AS event, CASE WHEN user_id % 2 = 0 THEN 'train' ELSE 'test' END AS cohort FROM (SELECT {_VISIT} AS subject, user_id, min(epoch_us(ts) / 3600000000.0) AS start, max(epoch_us(ts) / 3600000000.0) AS last, min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) / 3600000000.0 END) AS bought FROM events GROUP BY 1, 2) WHERE round(coalesce(bought, last) - start, 6) > 0",
    "surv": "SELECT subject, time, event FROM visits WHERE cohort = 'train'",
    "surv2": "SELECT subject, time, event FROM visits WHERE cohort = 'test'",
    "covariates": f"SELECT v.subject, t.feature, coalesce(c.v, 0.0) AS value FROM visits v CROSS JOIN (SELECT DISTINCT event_type AS feature FROM events) t LEFT JOIN (SELECT {_VISIT} AS subject, event_type AS feature, round(avg(value), 6) AS v FROM events GROUP BY 1, 2) c ON c.subject = v.subject AND c.feature = t.feature",
    "risk": f"SELECT {_VISIT} AS subject, floor(round(avg(value), 6) * 10 + 0.5) / 100 AS risk FROM events GROUP BY 1",
    "sets": "SELECT p_brand AS set_id, CAST(p_partkey AS VARCHAR) AS feature FROM part",
    "part_stat": "SELECT feature, round((r - a) / s, 6) AS t FROM (SELECT CAST(l_partkey AS VARCHAR) AS feature, avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS r, avg(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS a, stddev_samp(l_quantity) AS s FROM lineitem GROUP BY 1) WHERE r IS NOT NULL AND a IS NOT NULL AND s > 0",
    "signed": "SELECT substr(feature, 1, 2) AS source, feature AS target, CASE WHEN length(feature) % 5 = 0 THEN NULL WHEN length(feature) % 2 = 0 THEN 1 ELSE -1 END AS sign FROM (SELECT DISTINCT feature FROM m3 WHERE length(feature) > 1)",
    "edges": "SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS score FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) x JOIN (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) y ON x.l_partkey = y.l_partkey AND x.l_suppkey < y.l_suppkey GROUP BY 1, 2",
    "attrs": "SELECT CAST(o_orderkey AS VARCHAR) AS sample, key, value FROM (SELECT o_orderkey, 'status' AS key, o_orderstatus AS value FROM orders UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders UNION ALL SELECT o_orderkey, 'price (days)', CASE WHEN o_orderkey % 10 > 0 THEN CAST(CAST(round(o_totalprice, 0) AS BIGINT) AS VARCHAR) END FROM orders UNION ALL SELECT o_orderkey, 'late event', CASE WHEN o_totalprice > 150000 THEN '1' ELSE '0' END FROM orders) WHERE value IS NOT NULL",
    "attr_samples": "SELECT CAST(o_orderkey AS VARCHAR) AS sample FROM orders",
}

#: Results that several queries build on, as SQL over the inputs above.
SQL |= {
    "fit": "SELECT feature, avg(value) FILTER (arm = 'a1') - avg(value) FILTER (arm = 'a0') AS lfc, avg(value) AS ave, count(*) FILTER (arm = 'a1') AS n1, count(*) FILTER (arm = 'a0') AS n0, (var_samp(value) FILTER (arm = 'a1') * (count(*) FILTER (arm = 'a1') - 1) + var_samp(value) FILTER (arm = 'a0') * (count(*) FILTER (arm = 'a0') - 1)) / (count(*) - 2) AS s2, CAST(count(*) - 2 AS DOUBLE) AS df FROM m1 JOIN s1 USING (sample) GROUP BY feature",
    "tstat": "SELECT feature, lfc, ave, df, lfc / sqrt(s2 * (1.0 / n1 + 1.0 / n0)) AS t FROM fit",
    "pvals": "SELECT feature, lfc, ave, t, least(1.0, exp(-0.717 * abs(t) - 0.416 * t * t)) AS p FROM tstat",
    "test": "SELECT *, least(1.0, min(p * m / k) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS adj_p FROM (SELECT *, count(*) OVER () AS m, count(*) OVER (ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM pvals)",
    "cpairs": "SELECT a, b, count(*) AS n, corr(x, y) AS r FROM (SELECT x.sample AS a, y.sample AS b, x.value AS x, y.value AS y FROM m1 x JOIN m1 y ON x.feature = y.feature AND x.sample < y.sample) GROUP BY a, b",
    "csym": "SELECT a, b, r FROM cpairs UNION ALL SELECT b, a, r FROM cpairs",
    "fpairs": "SELECT a, b, count(*) AS n, corr(x, y) AS r FROM (SELECT x.feature AS a, y.feature AS b, x.value AS x, y.value AS y FROM m1 x JOIN m1 y ON x.sample = y.sample AND x.feature < y.feature) GROUP BY a, b",
    "fsym": "SELECT a, b, r FROM fpairs UNION ALL SELECT b, a, r FROM fpairs",
    "ranked": "SELECT feature, t AS stat, row_number() OVER (ORDER BY t DESC, feature) AS rank FROM part_stat",
    "members": "SELECT set_id, feature FROM sets SEMI JOIN ranked USING (feature)",
    "walk": "SELECT *, cum / tw - miss AS hit_at, (cum - w) / tw - miss AS hit_before FROM (SELECT *, CASE WHEN total_n > m THEN (rank - i) * 1.0 / (total_n - m) ELSE 0.0 END AS miss FROM (SELECT set_id, feature, rank, abs(stat) AS w, row_number() OVER (PARTITION BY set_id ORDER BY rank) AS i, count(*) OVER (PARTITION BY set_id) AS m, sum(abs(stat)) OVER (PARTITION BY set_id) AS tw, sum(abs(stat)) OVER (PARTITION BY set_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, (SELECT count(*) FROM ranked) AS total_n FROM members JOIN ranked USING (feature))) WHERE tw > 0",
    "es": "SELECT set_id, max(m) AS size, CASE WHEN max(hit_at) >= -min(hit_before) THEN max(hit_at) ELSE min(hit_before) END AS es FROM walk GROUP BY set_id",
    "selected": "SELECT feature, CASE WHEN t > 0 THEN 'up' ELSE 'down' END AS direction FROM part_stat WHERE abs(t) > 0.5",
    "km": "SELECT cohort AS stratum, time, n_risk, events, n - events AS censored, CASE WHEN gone THEN 0.0 ELSE exp(logs) END AS survival FROM (SELECT *, sum(CASE WHEN events < n_risk THEN ln(1 - events / n_risk) ELSE 0.0 END) OVER (PARTITION BY cohort ORDER BY time) AS logs, max(CASE WHEN events >= n_risk THEN 1 ELSE 0 END) OVER (PARTITION BY cohort ORDER BY time) = 1 AS gone FROM (SELECT cohort, time, count(*) AS n, sum(event) AS events, sum(count(*)) OVER (PARTITION BY cohort ORDER BY time DESC) AS n_risk FROM visits GROUP BY cohort, time))",
    "activity": "SELECT source, sample, sum(coalesce(sign, 1) * z) / sum(abs(coalesce(sign, 1))) AS activity, count(*) AS n_targets FROM (SELECT source, sample, sign, z FROM (SELECT feature, sample, CASE WHEN stddev_samp(value) OVER w > 0 THEN (value - avg(value) OVER w) / stddev_samp(value) OVER w ELSE 0.0 END AS z FROM m3 WINDOW w AS (PARTITION BY feature)) JOIN signed ON feature = target) GROUP BY 1, 2 HAVING count(*) >= 5",
    "profile0": "SELECT key, count(DISTINCT sample) AS present, count(DISTINCT value) AS n_distinct, count(TRY_CAST(value AS DOUBLE)) = count(*) AS is_numeric, min(TRY_CAST(value AS DOUBLE)) AS lo, max(TRY_CAST(value AS DOUBLE)) AS hi, median(TRY_CAST(value AS DOUBLE)) AS med, max(value) AS second FROM attrs WHERE trim(value) <> '' GROUP BY key",
}

_NEEDS: dict[str, list[str]] = {}


def _needs(text: str) -> list[str]:
    import re

    words = set(re.findall(r"[a-z_0-9]+", text))
    return [k for k in SQL if k in words and re.search(rf"(?:FROM|JOIN|,)\s+\(?{k}\b", text)]


def with_inputs(query: str, recursive: bool = False) -> str:
    """``query`` preceded by the inputs it names, and those they name, in order."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in _needs(text):
            if name not in found:
                visit(SQL[name])
                if name not in found:
                    found.append(name)

    visit(query)
    head = ", ".join(f"{name} AS ({SQL[name]})" for name in found)
    body = query.strip()
    lead = "WITH RECURSIVE " if recursive else "WITH "
    if body.startswith("WITH "):
        return lead + (head + ", " if head else "") + body[5:]
    return (lead + head + " " if head else "") + body
