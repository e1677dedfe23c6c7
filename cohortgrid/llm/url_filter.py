"""URL rules and exact block lists by a cascade of Bloom filters, in DataFrame functions only.

Level 0 encodes the listed keys; level 1 those keys of the corpus that are not listed but
pass level 0; level 2 the listed ones that pass level 1; and so on until nothing
passes wrongly. Since the corpus's complete set of keys takes part, the answer is exact for
every row, and rows are judged without a join: the filters are scalar values of the plan.

Keys are dealt to shards by their hash, as many as keep the filters of one shard near
``SHARD_BYTES``. Each shard has a cascade of its own, built by all tasks over its keys and applied to its own part of the
table, so that the memory of a task doesn't grow with the list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from ..session import materialise, work_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: About how many bytes the filters of one shard have in all.
SHARD_BYTES = 8 << 20
MOST_LEVELS = 60
FEW = 1 << 12


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z in lower case; empty where there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest fitting one of ``(verdict, 'host/path')``, else nulls."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: -len(r[1])):
        owner, slash, below = text.partition("/")
        fits = ((host == owner) | host.endswith("." + owner)) & path.startswith(slash + below)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def address_keys(host: Column, path: Column) -> Column:
    """The keys under which an address may be listed: its host, all parent domains, and host with path."""
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(parents, F.array(F.concat(host, path)))))


def _places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    # The seeds come first, so that keys whose hashes meet on one level part on the next.
    return [F.pmod(F.xxhash64(F.lit(level), F.lit(j), key), F.lit(bits)) for j in range(hashes)]


class Cascade:
    """The levels over ``universe`` (``key``, ``listed``), all distinct keys of the corpus or of one shard of it.

    ``holds(key)`` tells whether a key of the universe is listed.
    """

    def __init__(self, universe: DataFrame, rate: float = 0.1):
        self.levels: list[tuple[int, int, DataFrame]] = []
        self.sizes: list[int] = []
        inside, outside = universe.where("listed").select("key"), universe.where("not listed").select("key")
        n, others = inside.count(), outside.count()
        while n:
            level = len(self.levels)
            if level == MOST_LEVELS:
                raise RuntimeError(f"{n} keys still pass wrongly after {level} levels")
            # Deep levels hold few keys: a finer filter for them costs little and ends the cascade.
            p = first_rate(n, others, rate) if not level else 1e-4 if level > 1 and n <= FEW else rate
            hashes, bits = filter_shape(n, p)
            places = inside.select(F.explode(F.array(*_places(F.col("key"), level, bits, hashes))).alias("at"))
            words = places.groupBy((F.col("at") / 64).cast("long").alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("word"))
            every = universe.sparkSession.range(-(-bits // 64)).select("id", F.lit(0).cast("long").alias("word"))
            words = words.unionByName(every).groupBy("id").agg(F.bit_or("word").alias("word"))
            packed = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "word"))), lambda x: x["word"]).alias("filter"))
            self.levels.append((bits, hashes, materialise(packed, "filter")))
            self.sizes.append(n)
            inside, outside = materialise(outside.where(self._passes(F.col("key"), level)), "level"), inside
            n = inside.count()

    def _passes(self, key: Column, level: int) -> Column:
        bits, hashes, stored = self.levels[level]
        tests = [F.getbit(F.get(stored.scalar(), (at / 64).cast("int")), (at % 64).cast("int")) == 1 for at in _places(key, level, bits, hashes)]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out

    def holds(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            out = F.when(self._passes(key, level), out).otherwise(F.lit(level % 2 == 1))
        return out


def first_rate(n: int, others: int, rate: float) -> float:
    """The share of the other keys that may pass level 0: about as many as there are listed ones."""
    return max(1e-9, min(rate, n / max(1, others)))


def filter_shape(n: int, rate: float) -> tuple[int, int]:
    """``(hashes, bits)`` of a filter of ``n`` keys."""
    hashes = max(1, round(-math.log2(rate)))
    return hashes, max(64, math.ceil(n * hashes / math.log(2)))


def membership(asked: DataFrame, listed: DataFrame, rate: float = 0.1, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``asked`` with the column ``listed``: whether its ``key`` is a key of ``listed``. Null keys are not.

    The universe of keys is grouped from both tables. Where the list takes several shards, ``asked`` is written once by shard and the
    pass of a shard reads its own part alone, so that the work grows with the table and not with table times list.
    """
    keys = asked.select("key", F.lit(False).alias("listed"), F.lit(True).alias("known"))
    keys = keys.unionByName(listed.select(F.col("key").cast("string").alias("key"), F.lit(True).alias("listed"), F.lit(False).alias("known"))).where("key is not null")
    universe = keys.groupBy("key").agg(F.max("listed").alias("listed"), F.max("known").alias("known")).where("known").select("key", "listed")
    universe = materialise(universe, "universe")
    n, every = universe.agg(F.count_if("listed"), F.count("*")).first()
    # All levels together have at most about twice the bits of the first.
    shards = max(1, -(-2 * filter_shape(n, first_rate(n, every - n, rate))[1] // 8 // shard_bytes))
    own = F.pmod(F.xxhash64(F.lit("shard"), F.col("key")), F.lit(shards)).cast("int")
    if shards == 1:
        cascade = Cascade(universe, rate)
        return asked.withColumn("listed", F.when(F.col("key").isNotNull(), cascade.holds(F.col("key"))).otherwise(False))
    spark = asked.sparkSession
    universe = materialise(universe.withColumn("shard", own).repartitionByRange("shard", "key"), "shards")
    # Rows are dealt by shard and a salt: one file or a few for each shard and task, however unequal the shards are.
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(8))
    parts, answers = work_path(spark, "asked"), work_path(spark, "answers")
    asked.withColumn("_shard", F.coalesce(own, F.lit(0))).repartition("_shard", salt).write.partitionBy("_shard").option("compression", "zstd").parquet(parts)
    for shard in range(shards):
        cascade = Cascade(universe.where(F.col("shard") == shard), rate)
        part = spark.read.schema(StructType([*asked.schema.fields, StructField("_shard", IntegerType())])).parquet(parts).where(F.col("_shard") == shard).drop("_shard")
        part.withColumn("listed", F.when(F.col("key").isNotNull(), cascade.holds(F.col("key"))).otherwise(False)).write.mode("append").option("compression", "zstd").parquet(answers)
    return spark.read.schema(StructType([*asked.schema.fields, StructField("listed", BooleanType())])).parquet(answers)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], listed: DataFrame, id_col: str = "page_id", url_col: str = "url", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, listed``.

    The longest fitting rule decides; where none fits, an address of which a key
    (``address_keys``) is in ``listed`` (column ``key``) is blocked and any other allowed. Null urls
    and urls without ``://`` have an empty host and path, which no rule or list entry fits.
    Repeated rows and null page ids are judged like others, each row once. Null and repeated keys of the list
    change nothing; an empty list blocks nothing and an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    asked = rows.select("page_id", "host", "path", F.posexplode_outer(address_keys(F.col("host"), F.col("path"))).alias("place", "key"))
    found = membership(asked, listed, shard_bytes=shard_bytes)
    # Pages equal in all three columns have one verdict; it is given as often as there are such pages.
    told = found.groupBy("page_id", "host", "path").agg(F.count_if(F.coalesce("place", F.lit(0)) == 0).alias("copies"), F.max("listed").alias("listed"))
    told = told.select("page_id", "host", "path", "listed", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    return told.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
