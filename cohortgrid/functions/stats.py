"""Probability functions that Spark lacks, as vectorised column functions, and ranks and false discovery rates as windows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_lgamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])


def _floats(*series: pd.Series) -> list[np.ndarray]:
    return [s.to_numpy(dtype=float, na_value=np.nan) for s in series]


def beta_cdf(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by Lentz's continued fraction."""
    x, a, b = np.broadcast_arrays(np.clip(x, 0, 1), a, b)
    swap = x > (a + 1) / (a + b + 2)
    z, p, q = np.where(swap, 1 - x, x), np.where(swap, b, a), np.where(swap, a, b)
    with np.errstate(all="ignore"):
        front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(z) + q * np.log1p(-z)) / p
        tiny = 1e-300
        c, d = np.ones_like(z), 1 - (p + q) * z / (p + 1)
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        f = d.copy()
        for m in range(1, 300):
            for step in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
                d = 1 + step * d
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1 + step / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                f = f * c * d
            if np.nanmax(np.abs(c * d - 1), initial=0) < 1e-14:
                break
        out = np.where(z <= 0, 0.0, front * f)
    return np.where(swap, 1 - out, out)


def gamma_sf(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Upper regularised incomplete gamma function."""
    x, a = np.broadcast_arrays(np.maximum(x, 0), a)
    with np.errstate(all="ignore"):
        front = np.exp(-x + a * np.log(x) - _lgamma(a))
        term = total = 1 / a
        for n in range(1, 1000):
            term = term * x / (a + n)
            total = total + term
            if np.nanmax(np.where(x < a + 1, term / total, 0), initial=0) < 1e-16:
                break
        b = x + 1 - a
        c, d = np.full_like(b, 1e300), 1 / b
        h = d.copy()
        for i in range(1, 1000):
            an = -i * (i - a)
            b = b + 2
            d = 1 / (an * d + b)
            c = b + an / c
            h = h * d * c
            if np.nanmax(np.where(x >= a + 1, np.abs(d * c - 1), 0), initial=0) < 1e-15:
                break
        return np.where(x <= 0, 1.0, np.where(x < a + 1, 1 - front * total, front * h))


@F.pandas_udf(DoubleType())
def t_sf2(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of Student's t."""
    t, df = _floats(t, df)
    return pd.Series(beta_cdf(df / (df + t * t), df / 2, np.full_like(df, 0.5)))


@F.pandas_udf(DoubleType())
def t_size(p: pd.Series, df: pd.Series) -> pd.Series:
    """The size of Student's t that has the two-sided p-value ``p``, by bisection of its logarithm; null outside (0, 1]."""
    p, df = _floats(p, df)
    low, high = np.full_like(p, -40.0), np.full_like(p, 120.0)
    for _ in range(70):
        middle = (low + high) / 2
        t = np.exp(middle)
        above = beta_cdf(df / (df + t * t), df / 2, np.full_like(df, 0.5)) > p
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return pd.Series(np.where((p > 0) & (p <= 1), np.exp((low + high) / 2), np.nan)).where(lambda x: x.notna(), None)


@F.pandas_udf(DoubleType())
def norm_sf2(z: pd.Series) -> pd.Series:
    """Two-sided p-value of a standard normal."""
    return pd.Series(_erfc(np.abs(_floats(z)[0]) / math.sqrt(2)))


@F.pandas_udf(DoubleType())
def chi2_sf(x: pd.Series, df: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution."""
    x, df = _floats(x, df)
    return pd.Series(gamma_sf(x / 2, df / 2))


def _psi(x: np.ndarray, order: int) -> np.ndarray:
    """Digamma (0) or trigamma (1): the argument is raised above 8, then the asymptotic series."""
    out = np.zeros_like(x)
    x = x.copy()
    while (low := x < 8).any():
        out[low] += -1 / x[low] if order == 0 else 1 / x[low] ** 2
        x[low] += 1
    r = 1 / (x * x)
    if order == 0:
        return out + np.log(x) - 0.5 / x - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r / 240)))
    return out + 1 / x + r / 2 + r / x * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r / 30)))


@F.pandas_udf(DoubleType())
def digamma(x: pd.Series) -> pd.Series:
    return pd.Series(_psi(_floats(x)[0], 0))


@F.pandas_udf(DoubleType())
def trigamma(x: pd.Series) -> pd.Series:
    return pd.Series(_psi(_floats(x)[0], 1))


def trigamma_inverse(y: float) -> float:
    """The x with trigamma(x) = y, by Newton steps on a scalar."""
    if y > 1e7:
        return 1 / math.sqrt(y)
    if y < 1e-6:
        return 1 / y
    x = 0.5 + 1 / y
    for _ in range(50):
        t = float(_psi(np.array([x]), 1)[0])
        slope = (float(_psi(np.array([x + 1e-5]), 1)[0]) - float(_psi(np.array([x - 1e-5]), 1)[0])) / 2e-5
        step = t * (1 - t / y) / slope
        x += step
        if -step / x < 1e-8:
            break
    return x


def digamma_at(x: float) -> float:
    return float(_psi(np.array([x]), 0)[0])


def log_factorial(n: Column) -> Column:
    """The logarithm of n! by Stirling's series, raised by eight first."""
    n = n.cast("double")
    z = n + 9
    raised = F.lit(0.0)
    for i in range(1, 9):
        raised = raised + F.log(n + i)
    series = F.lit(0.0)
    for power, c in ((1, 1 / 12), (3, -1 / 360), (5, 1 / 1260), (7, -1 / 1680), (9, 1 / 1188), (11, -691 / 360360)):
        series = series + c / F.pow(z, F.lit(float(power)))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - raised


def hyper_sf(k: Column | str, universe: Column | str, hits: Column | str, drawn: Column | str) -> Column:
    """P(overlap >= k) when ``drawn`` of ``universe`` are taken and ``hits`` of them count; null where one is null.

    The first term comes from logarithms of factorials, each further one from the one before, so that no Python is needed.
    """
    k, n, m, d = (F.col(c).cast("long") if isinstance(c, str) else c.cast("long") for c in (k, universe, hits, drawn))
    low, top = F.greatest(k, d + m - n, F.lit(0)), F.least(m, d)
    choose = lambda a, b: log_factorial(a) - log_factorial(b) - log_factorial(a - b)
    first = F.exp(choose(m, low) + choose(n - m, d - low) - choose(n, d))
    ratio = lambda j: (m - j).cast("double") * (d - j) / ((j + 1).cast("double") * (n - m - d + j + 1))
    one = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] * ratio(j)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    steps = F.when(top > low, F.sequence(low, top - 1)).otherwise(F.array().cast("array<bigint>"))
    tail = F.least(F.lit(1.0), first * F.aggregate(steps, one, add)["total"])
    return F.when(k.isNull() | n.isNull() | m.isNull() | d.isNull(), None).when(low > top, 0.0).otherwise(tail)


def exact_quantiles(df: DataFrame, value: Column | str, shares: list[float], kind: int = 7, bins: int = 512, few: int = 10_000, written: bool = False) -> list[float | None]:
    """Exact quantiles of a whole table without a buffer of it: type 7 (interpolated) or 1 (inverse distribution function).

    Values are counted in ranges, and the range that holds a wanted place is counted in finer ones, until few enough values are left
    to look at or all of them are equal. Nulls and NaN don't count; of no values all quantiles are null.
    The values are written first, since they are read several times, unless ``df`` is a table that is ``written`` already.
    """
    from ..session import materialise

    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    values = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    values = values if written else materialise(values, "values")
    n, lo, hi = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(shares)
    place = (lambda p: p * (n - 1)) if kind == 7 else (lambda p: max(0, math.ceil(p * n - 1e-9) - 1))
    wanted = {f(place(p)) for p in shares for f in (math.floor, math.ceil)}
    found: dict[int, float] = {}
    # Range: (low, high, rows in it, rows before it).
    ranges = {r: (lo, hi, n, 0) for r in wanted}
    while ranges:
        for r in [r for r, (a, b, *_) in ranges.items() if a == b]:
            found[r] = ranges.pop(r)[0]
        small = {x for x in ranges.values() if x[2] <= few}
        if small:
            inside = F.lit(False)
            for a, b, *_ in small:
                inside = inside | F.col("v").between(a, b)
            kept = sorted(r[0] for r in values.where(inside).collect())
            for r in [r for r, x in ranges.items() if x in small]:
                a, b, _, before = ranges.pop(r)
                found[r] = [x for x in kept if a <= x <= b][r - before]
        open_ = sorted({x for x in ranges.values()})
        if not open_:
            continue
        at = F.lit(None).cast("int")
        for i, (a, b, *_) in reversed(list(enumerate(open_))):
            at = F.when(F.col("v").between(a, b), i * bins + F.least(F.lit(bins - 1), F.floor((F.col("v") - a) / (b - a) * bins)).cast("int")).otherwise(at)
        cells = sorted(tuple(r) for r in values.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.min("v"), F.max("v")).where("at is not null").collect())
        for r, x in list(ranges.items()):
            i, before = open_.index(x), x[3]
            for at_, count, a, b in cells:
                if at_ // bins == i:
                    if r < before + count:
                        ranges[r] = (a, b, count, before)
                        break
                    before += count
    out = []
    for p in shares:
        at_ = place(p)
        a, b = found[math.floor(at_)], found[math.ceil(at_)]
        out.append(a + (b - a) * (at_ - math.floor(at_)))
    return out


def group_quantiles(df: DataFrame, by: str, value: str, shares: list[float]) -> DataFrame:
    """``(by, q)``: the exact interpolated quantiles of each group as an array, a group of any size being cut into ranges; nulls don't count."""
    per = df.where(F.col(by).isNotNull() & F.col(value).isNotNull()).groupBy(by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    run = group_running(deal_groups(per, [by], "_v"), [by], "_v", {"_upto": "_n"})
    total = run.groupBy(by).agg(F.sum("_n").alias("_all"))
    run = run.join(F.broadcast(total), by)
    ends = []
    for i, p in enumerate(shares):
        place = F.lit(p) * (F.col("_all") - 1)
        for name, at in ((f"_a{i}", F.floor(place)), (f"_b{i}", F.ceil(place))):
            ends.append(F.max(F.when((at < F.col("_upto")) & (at >= F.col("_upto") - F.col("_n")), F.col("_v"))).alias(name))
    found = run.groupBy(by, "_all").agg(*ends)
    share = lambda p: F.lit(p) * (F.col("_all") - 1) - F.floor(F.lit(p) * (F.col("_all") - 1))
    return found.select(by, F.array(*(F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * share(p) for i, p in enumerate(shares))).alias("q"))


def average_rank(value: Column | str, by: list[str]) -> Column:
    """Rank within ``by`` with ties at their mean."""
    value = F.col(value) if isinstance(value, str) else value
    order = Window.partitionBy(*by).orderBy(value)
    ties = Window.partitionBy(*by, value)
    return F.rank().over(order) + (F.count(F.lit(1)).over(ties) - 1) / 2.0


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``row_number`` over the whole table without a single-task window: ranges are sorted apart and offset by the sizes of those before.

    The dealt rows are written once, since a second sample could cut the ranges elsewhere.
    """
    from ..session import materialise

    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("_place", F.monotonically_increasing_id())
    dealt = dealt.withColumn("_part", F.shiftright("_place", 33)).withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
    dealt = materialise(dealt, "ranges")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition.
    base = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return dealt.join(F.broadcast(base), "_part").withColumn(name, F.col("_base") + F.col("_row") + 1).drop("_place", "_part", "_row", "_base")


def global_running(df: DataFrame, order: Column, sums: dict[str, Column | str] | None = None, mins: dict[str, Column | str] | None = None, partitions: int | None = None) -> DataFrame:
    """Running sums and minima over the whole table in ``order``, rows of equal order at their common end, without a single-task window.

    Ranges of the order are summed apart; what the ranges before a range come to, one row for each range, is added.
    Ties share a range. The dealt rows are written once.
    """
    from ..session import materialise

    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = {k: (F.sum, v) for k, v in (sums or {}).items()} | {k: (F.min, v) for k, v in (mins or {}).items()}
    column = lambda v: F.col(v) if isinstance(v, str) else v
    dealt = materialise(df.repartitionByRange(n, order).withColumn("_range", F.spark_partition_id()), "ranges")
    inside, before = Window.partitionBy("_range").orderBy(order), Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = dealt.groupBy("_range").agg(*(f(column(v)).alias(f"_of_{k}") for k, (f, v) in asked.items()))
    carry = whole.select("_range", *(f(f"_of_{k}").over(before).alias(f"_to_{k}") for k, (f, _) in asked.items()))
    out = dealt.withColumns({k: f(column(v)).over(inside) for k, (f, v) in asked.items()}).join(F.broadcast(carry), "_range")
    joined = {k: F.col(k) + F.coalesce(f"_to_{k}", F.lit(0)) if f is F.sum else F.least(k, f"_to_{k}") for k, (f, _) in asked.items()}
    return out.withColumns(joined).drop("_range", *(f"_to_{k}" for k in asked))


def deal_groups(df: DataFrame, by: list[str], order: str, partitions: int | None = None) -> DataFrame:
    """``df`` dealt by ranges of ``by`` and ``order`` and written, with the range in ``_range``: a group of any size is cut into ranges, equal rows of it share one."""
    from ..session import materialise

    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(df.repartitionByRange(n, *by, order).withColumn("_range", F.spark_partition_id()), "ranges")


def group_running(dealt: DataFrame, by: list[str], order: str, sums: dict[str, Column | str], down: bool = False) -> DataFrame:
    """Running sums in ``order`` (from the end where ``down``) within each group of a table from :func:`deal_groups`, rows of equal order at their common end.

    A group that goes on in a further range finds there what its earlier ranges come to. Only the first group of a range can have begun before it (the
    last one, where ``down``), so at most one row for each range is broadcast.
    """
    column = lambda v: F.col(v) if isinstance(v, str) else v
    way = F.col(order).desc() if down else F.col(order).asc()
    ranges = F.col("_range").desc() if down else F.col("_range").asc()
    inside = Window.partitionBy("_range", *by).orderBy(way)
    earlier = Window.partitionBy(*by).orderBy(ranges).rowsBetween(Window.unboundedPreceding, -1)
    whole = dealt.groupBy("_range", *by).agg(*(F.sum(column(v)).alias(f"_of_{k}") for k, v in sums.items()), F.lit(1).alias("_one"))
    carried = whole.select("_range", *by, F.sum("_one").over(earlier).alias("_before"), *(F.sum(f"_of_{k}").over(earlier).alias(f"_to_{k}") for k in sums)).where("_before > 0").drop("_before")
    out = dealt.withColumns({k: F.sum(column(v)).over(inside) for k, v in sums.items()})
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("_range", *by)]
    joined = out.alias("o").join(F.broadcast(carried).alias("c"), same, "left")
    # A sum of nothing but nulls is null; what was carried to it still counts.
    total = lambda k: F.when(F.col(f"o.{k}").isNull(), F.col(f"c._to_{k}")).otherwise(F.col(f"o.{k}") + F.coalesce(f"c._to_{k}", F.lit(0)))
    return joined.select(*(total(c).alias(c) if c in sums else F.col(f"o.{c}") for c in out.columns))


def adjust_distinct(each: DataFrame) -> DataFrame:
    """``(_p, _low)`` of different p-values ``_p`` that ``_n`` rows have each: dealt by range once, ranks carried upward and minima downward over the ranges."""
    from ..session import materialise

    n = int(each.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(each.repartitionByRange(n, "_p").withColumn("_range", F.spark_partition_id()), "ranges")
    # One row for each range.
    ends = Window.orderBy("_range")
    sizes = dealt.groupBy("_range").agg(F.sum("_n").alias("_own"))
    sizes = F.broadcast(sizes.select("_range", F.coalesce(F.sum("_own").over(ends.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_own").over(Window.partitionBy(F.lit(0))).alias("_m")))
    up = Window.partitionBy("_range").orderBy("_p")
    raw = F.col("_p") * F.col("_m") / (F.col("_before") + F.sum("_n").over(up))
    raw = dealt.join(sizes, "_range").withColumn("_raw", raw)
    least = raw.groupBy("_range").agg(F.min("_raw").alias("_own"))
    least = F.broadcast(least.select("_range", F.min("_own").over(Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)).alias("_after")))
    down = Window.partitionBy("_range").orderBy(F.desc("_p"))
    return raw.withColumn("_min", F.min("_raw").over(down)).join(least, "_range").select("_p", F.least(F.lit(1.0), "_min", "_after").alias("_low"))


def bh_adjust(df: DataFrame, p_col: str, by: list[str] | None = None, out: str = "adj_p") -> DataFrame:
    """Benjamini-Hochberg adjusted p-values, within ``by`` where given; null p-values are not counted and stay null.

    Over the whole table ranges of p are adjusted apart; groups are windows of their own.
    """
    p = F.col(p_col)
    if not by:
        from ..session import materialise

        # Equal p-values share their adjusted value, so that only the different ones are ranked, whatever share of all rows has one of them. The
        # table is written first: sums that run again may differ in their last digit, and the values are joined.
        df = materialise(df, "tested")
        each = df.where(p.isNotNull()).groupBy(p.alias("_p")).agg(F.count("*").alias("_n"))
        adjusted = adjust_distinct(each).select(F.col("_p").alias(p_col), F.col("_low").alias(out))
        return df.join(adjusted, p_col, "left").select(*df.columns, out)
    by_all = Window.partitionBy(*by)
    up = by_all.orderBy(p.asc())
    rank = F.count(p_col).over(up.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = df.withColumn("_raw", F.when(p.isNotNull(), p * F.count(p_col).over(by_all) / rank))
    down = by_all.orderBy(p.desc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranked.withColumn(out, F.when(p.isNotNull(), F.least(F.lit(1.0), F.min("_raw").over(down)))).drop("_raw")
