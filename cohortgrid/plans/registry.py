"""All queries of the library proper, with their SQL.

DuckDB lacks the t, chi-square and normal distributions; their SQL here is a power series. Queries that only
order or adjust p-values take ``rough_p`` of the statistic, which both engines have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bindings import Data, with_inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, and without negative zeros, so that two engines' results compare."""
    return df.select(*((F.round(c, digits) + F.lit(0.0)).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes))


def r(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name}"


def query(name: str, sql: str | None = None, recursive: bool = False):
    """Register a function of :class:`Data` under ``name``, with its SQL where there is one."""

    def add(f: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(Data(spark, sf_dir)))
        if sql:
            ORACLE_SQL[name] = with_inputs(sql, recursive)
        return f

    return add


def chi2_p(x: str, df: int = 1) -> str:
    """SQL of the chi-square tail beyond ``x``: one less the series of the lower incomplete gamma function."""
    h = f"(({x}) / 2)"
    series = f"list_sum([exp(({df} / 2.0 + step_) * ln({h}) - {h} - lgamma({df} / 2.0 + step_ + 1)) FOR step_ IN range(0, CAST({h} * 3 AS BIGINT) + 200)])"
    return f"CASE WHEN ({x}) > 0 THEN greatest(0.0, 1 - {series}) WHEN ({x}) = 0 THEN 1.0 END"


def t_p(t: str, df: str) -> str:
    """SQL of the two-sided tail of Student's t: series of the incomplete beta function of the smaller of both arguments."""
    x, a = f"({df} / ({df} + pow({t}, 2)))", f"({df} / 2.0)"
    y = f"(pow({t}, 2) / ({df} + pow({t}, 2)))"
    steps = f"range(0, CAST({df} AS BIGINT) + 200)"
    far = f"list_sum([exp(({a} + step_) * ln({x}) + 0.5 * ln({y}) + lgamma({a} + 0.5 + step_) - lgamma({a} + 1 + step_) - lgamma(0.5)) FOR step_ IN {steps}])"
    near = f"1 - list_sum([exp((0.5 + step_) * ln({y}) + {a} * ln({x}) + lgamma({a} + 0.5 + step_) - lgamma(1.5 + step_) - lgamma({a})) FOR step_ IN {steps}])"
    return f"CASE WHEN {t} = 0 THEN 1.0 WHEN pow({t}, 2) > {df} THEN {far} ELSE {near} END"


def bh(table: str, p: str = "p") -> str:
    """SQL of ``table`` with ``adj_p``; null p-values are not counted."""
    return f"SELECT * EXCLUDE (m, k), CASE WHEN {p} IS NOT NULL THEN least(1.0, min({p} * m / k) OVER (ORDER BY {p} DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS adj_p FROM (SELECT *, count({p}) OVER () AS m, count({p}) OVER (ORDER BY {p} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM {table})"


def rough_p(t: Column) -> Column:
    """About the two-sided normal tail, in functions that both engines have."""
    return F.least(F.lit(1.0), F.exp(-0.717 * F.abs(t) - 0.416 * t * t))


from . import survival_queries, test_queries, cleaning_queries, network_queries, set_queries  # noqa: E402,F401
