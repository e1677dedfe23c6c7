"""Gates, grouping and sample metadata (attributes are long: ``sample, key, value``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import group_quantiles
from ..session import materialise


def gates(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, n_rows, n_pass, pass)``: each rule must hold in every row; null counts as a failure and an empty table passes nothing."""
    one = df.agg(F.count("*").alias("n"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(f"r{i}") for i, c in enumerate(rules.values())))
    rows = F.array(*(F.struct(F.lit(name).alias("rule"), F.col("n").alias("n_rows"), F.col(f"r{i}").alias("n_pass")) for i, name in enumerate(rules)))
    return one.select(F.inline(rows)).withColumn("pass", (F.col("n_rows") > 0) & (F.col("n_pass") == F.col("n_rows")))


def search_catalogue(df: DataFrame, organism: str, type_re: str, exclude_re: str, n_min: int, n_max: int, limit: int, tie: Sequence[str] = ("dataset",)) -> DataFrame:
    """Datasets of an organism and type with ``n_min <= n_samples < n_max`` and no excluded platform, the largest first, equal ones by ``tie``."""
    kept = df.where((F.col("organism") == organism) & F.col("type").rlike(type_re) & ~F.coalesce(F.col("platform"), F.lit("")).rlike(exclude_re))
    return kept.where((F.col("n_samples") >= n_min) & (F.col("n_samples") < n_max)).orderBy(F.col("n_samples").desc(), *tie).limit(limit)


def candidate_groups(attrs: DataFrame, key_re: str) -> DataFrame:
    """``(label, n)``: samples by the joined values of the keys that match, of all keys where none does."""
    per = attrs.groupBy("sample").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("key").rlike(key_re), F.struct("key", "value")))), lambda x: x["value"]), " | ").alias("chosen"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", "value"))), lambda x: x["value"]), " | ").alias("every"),
    )
    label = F.when(F.col("chosen") != "", F.col("chosen")).otherwise(F.col("every"))
    return per.groupBy(label.alias("label")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "label")


def assign_arms(samples: DataFrame, field: str, patterns: Mapping[str, Sequence[str]]) -> DataFrame:
    """``samples`` with ``arm`` and ``n_hits``: arms of which a pattern is contained in the lower-cased field; exactly one must match."""
    text = F.lower(F.coalesce(F.col(field), F.lit("")))
    hits = []
    for arm, words in patterns.items():
        fits = F.lit(False)
        for w in words:
            fits = fits | text.contains(w.lower())
        hits.append(F.when(fits, F.lit(arm)))
    found = F.array_compact(F.array(*hits))
    return samples.withColumn("n_hits", F.size(found)).withColumn("arm", F.when(F.col("n_hits") == 1, F.get(found, 0)))


def arm_gates(samples: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """One row: arm sizes and the gates of the small design (fewer than 10 samples, at least 3 an arm) and the cohort one (15, 10)."""
    one = samples.agg(F.count_if(F.col("arm") == numerator).alias("n_numerator"), F.count_if(F.col("arm") == denominator).alias("n_denominator"))
    n, low = F.col("n_numerator") + F.col("n_denominator"), F.least("n_numerator", "n_denominator")
    return one.withColumns({"small_design": (n < 10) & (low >= 3), "cohort": (n >= 15) & (low >= 10)})


def validate_pairs(samples: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(pair_id, n_members, n_known, n_arms, n_reused, ok)`` for pairs ``(pair_id, sample)`` against ``(sample, arm)``; samples in no pair come as a null pair that is not ok."""
    uses = pairs.groupBy("sample").agg(F.count("*").alias("uses"))
    joined = pairs.join(samples.select("sample", "arm"), "sample", "left").join(uses, "sample")
    per = joined.groupBy("pair_id").agg(F.count("*").alias("n_members"), F.count("arm").alias("n_known"), F.count_distinct("arm").alias("n_arms"), F.count_if(F.col("uses") > 1).alias("n_reused"))
    per = per.withColumn("ok", (F.col("n_members") == 2) & (F.col("n_known") == 2) & (F.col("n_arms") == 2) & (F.col("n_reused") == 0))
    left = samples.join(pairs, "sample", "left_anti").agg(F.count("*").alias("n_members")).where("n_members > 0")
    zero = F.lit(0).cast("long")
    return per.unionByName(left.select(F.lit(None).cast(per.schema["pair_id"].dataType).alias("pair_id"), "n_members", F.col("n_members").alias("n_known"), zero.alias("n_arms"), zero.alias("n_reused"), F.lit(False).alias("ok")))


def parse_key_values(df: DataFrame, id_col: str, text_col: str, pos_col: str) -> DataFrame:
    """``(id, key, value)`` of ``key: value`` strings; without a colon the key is ``unnamed``; repeated keys are joined by `` | `` in order."""
    key = F.trim(F.regexp_extract(text_col, r"(?s)^([^:]*):", 1))
    rows = df.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"),
        F.when(key == "", "unnamed").otherwise(key).alias("key"),
        F.trim(F.when(F.col(text_col).contains(":"), F.regexp_extract(text_col, r"(?s)^[^:]*:(.*)$", 1)).otherwise(F.col(text_col))).alias("value"),
        F.col(pos_col).alias("pos"),
    )
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]), " | ")
    return rows.groupBy("id", "key").agg(joined.alias("value"))


def attributes_wide(attrs: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One string column per key; missing values are null. Without ``keys`` the columns are those found."""
    grouped = attrs.groupBy("sample")
    return (grouped.pivot("key", list(keys)) if keys else grouped.pivot("key")).agg(F.min("value"))


def field_profile(attrs: DataFrame, samples: DataFrame, top: int = 12) -> DataFrame:
    """``(key, present, missing, n_distinct, is_numeric, min, max, median, top_values)`` of each key over all samples.

    A field is numeric if every present value parses. ``top_values`` lists up to ``top`` values with counts, for fields that are not.
    """
    total = samples.agg(F.count("*").alias("total"))
    x = attrs.where(F.col("value").isNotNull() & (F.trim("value") != "")).withColumn("x", F.expr("try_cast(value AS double)"))
    stats = x.groupBy("key").agg(
        F.count_distinct("sample").alias("present"), F.count_distinct("value").alias("n_distinct"), (F.count("x") == F.count("*")).alias("is_numeric"), F.min("x").alias("min"), F.max("x").alias("max"), F.median("x").alias("median")
    )
    counts = x.groupBy("key", "value").agg(F.count("*").alias("n"))
    ranked = counts.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.col("n").desc(), "value"))).where(F.col("r") <= top)
    tops = ranked.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "value", "n"))), lambda v: F.concat(v["value"], F.lit(" ("), v["n"], F.lit(")"))), "; ").alias("tops"))
    out = stats.join(tops, "key", "left").join(F.broadcast(total))
    num = lambda c: F.when(F.col("is_numeric"), F.col(c)).alias(c)
    return out.select("key", "present", (F.col("total") - F.col("present")).alias("missing"), "n_distinct", "is_numeric", num("min"), num("max"), num("median"), F.when(~F.col("is_numeric"), F.col("tops")).alias("top_values"))


def detect_batch_field(profile: DataFrame, name_re: str = r"(?i)batch|plate|run|site|scan|source") -> DataFrame:
    """The first field, by name, that is called like a batch and has more than one value; no row where there is none."""
    return profile.where(F.col("key").rlike(name_re) & (F.col("n_distinct") > 1)).agg(F.min("key").alias("batch_field")).where("batch_field is not null")


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """``(a, b, observed, expected)`` for every combination of values, also those never seen together."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("observed"))
    rows, columns = cells.groupBy("a").agg(F.sum("observed").alias("na")), cells.groupBy("b").agg(F.sum("observed").alias("nb"))
    # The result is the product of the two sets of levels; margins are one row a level.
    every = rows.join(F.broadcast(columns), F.lit(True)).join(cells, ["a", "b"], "left").join(F.broadcast(cells.agg(F.sum("observed").alias("n"))), F.lit(True))
    return every.select("a", "b", F.coalesce("observed", F.lit(0)).cast("long").alias("observed"), (F.col("na") * F.col("nb") / F.col("n")).alias("expected"), "n")


def confounding(df: DataFrame, batch: str, group: str) -> DataFrame:
    """One row: chi-square, Cramer's V, and a verdict of ``no_batch_variation``, ``fully_confounded`` or ``partially_crossed``."""
    t = contingency(df, batch, group)
    one = t.agg(F.sum(F.pow(F.col("observed") - F.col("expected"), 2) / F.col("expected")).alias("chi2"), F.max("n").alias("n"), F.count_distinct("a").alias("n_batches"), F.count_distinct("b").alias("n_groups"))
    seen = t.where("observed > 0").groupBy("a").agg(F.count("*").alias("g")).agg(F.max("g").alias("most_groups"))
    k = F.least("n_batches", "n_groups") - 1
    one = one.join(F.broadcast(seen), F.lit(True)).withColumn("cramers_v", F.when(k > 0, F.sqrt(F.col("chi2") / (F.col("n") * k))))
    verdict = F.when(F.col("n_batches") < 2, "no_batch_variation").when(F.col("most_groups") == 1, "fully_confounded").otherwise("partially_crossed")
    return one.select("n", "n_batches", "n_groups", "chi2", "cramers_v", verdict.alias("verdict"))


def find_endpoints(profile: DataFrame, event_values: Sequence[str], attrs: DataFrame, time_re: str = r"(?i)time|days|months|years|hours|survival", min_cover: float = 0.5) -> DataFrame:
    """``(event, time, shared_words, events, cap10, cap5)``: event columns, whose values are all of ``event_values``, paired with the time column that shares most words of more than 3 letters."""
    n = F.col("present") + F.col("missing")
    ok = profile.where(F.col("present") >= n * min_cover)
    is_in = lambda allowed: F.lower("value").isin([v.lower() for v in allowed])
    values = attrs.groupBy("key").agg(F.count_if(~is_in(event_values)).alias("others"), F.count_if(is_in(event_values[:1])).alias("events"))
    events = ok.join(values, "key").where("others = 0").select(F.col("key").alias("event"), "events")
    times = ok.where(F.col("is_numeric") & F.col("key").rlike(time_re)).select(F.col("key").alias("time"))
    words = lambda c: F.filter(F.split(F.lower(c), "[^a-z]+"), lambda w: F.length(w) > 3)
    pairs = events.join(F.broadcast(times), F.col("event") != F.col("time")).withColumn("shared_words", F.size(F.array_intersect(words("event"), words("time"))))
    best = pairs.withColumn("r", F.row_number().over(Window.partitionBy("event").orderBy(F.col("shared_words").desc(), "time"))).where("r = 1")
    return best.select("event", "time", "shared_words", "events", F.floor(F.col("events") / 10).alias("cap10"), F.floor(F.col("events") / 5).alias("cap5"))


def code_traits(attrs: DataFrame, samples: DataFrame, min_cover: float = 0.8) -> DataFrame:
    """``(sample, trait, x)``: numeric fields as they are, two-level ones as 0/1 by sorted level; fields present in fewer than ``min_cover`` of the samples, and others, are left out."""
    total = samples.agg(F.count("*").alias("total"))
    x = attrs.where(F.col("value").isNotNull() & (F.trim("value") != "")).withColumn("num", F.expr("try_cast(value AS double)"))
    stats = x.groupBy("key").agg(F.count_distinct("sample").alias("present"), F.count_distinct("value").alias("levels"), (F.count("num") == F.count("*")).alias("is_numeric"), F.max("value").alias("second"))
    usable = stats.join(F.broadcast(total), F.lit(True)).where((F.col("present") >= F.col("total") * min_cover) & (F.col("is_numeric") | (F.col("levels") == 2)))
    coded = F.when(F.col("is_numeric"), F.col("num")).otherwise((F.col("value") == F.col("second")).cast("double"))
    return x.join(usable, "key").select("sample", F.col("key").alias("trait"), coded.alias("x"))


def quartile_bins(traits: DataFrame) -> DataFrame:
    """``traits`` with ``quartile`` 1-4 of the trait's values; the lowest is closed below."""
    # Written, so that its size is known and the traits' rows stay where they are.
    q = materialise(group_quantiles(traits, "trait", "x", [0.25, 0.5, 0.75]), "quartiles")
    at = lambda i: F.col("q")[i]
    return traits.join(q, "trait").withColumn("quartile", F.when(F.col("x") <= at(0), 1).when(F.col("x") <= at(1), 2).when(F.col("x") <= at(2), 3).otherwise(4)).drop("q")


def cap_samples(samples: DataFrame, k: int, order: str = "sample") -> DataFrame:
    """The first ``k`` samples in order, for quick runs."""
    return samples.orderBy(order).limit(k)


def unit_of(name: Column) -> Column:
    """``days`` of ``time (days)`` or ``time_days``; null without a unit."""
    unit = F.lower(F.regexp_extract(name, r"(?i)(?:\(|_)(days|weeks|months|years|hours)\)?$", 1))
    return F.when(unit != "", unit)


def pick_col(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate that is a column, whatever its case."""
    names = {c.lower(): c for c in df.columns}
    return next((names[c.lower()] for c in candidates if c.lower() in names), None)
