"""Query registry: each query is a Spark callable ``(spark, sf_dir) -> DataFrame``
with an optional DuckDB oracle over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DECIMALS = 6


def round_col(c, decimals: int = DECIMALS):
    """floor(x * 10^d + 0.5) / 10^d on doubles: the same IEEE steps in both
    engines, so equal inputs give bit-equal outputs (ties included)."""
    x = c.cast("double")
    s = float(10 ** decimals)
    return F.when(F.abs(x) < 1e15, F.floor(x * F.lit(s) + F.lit(0.5)).cast("double") / F.lit(s)).otherwise(x)


def rounded(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Round every float/double column (the oracle does the same)."""
    return df.select(*[
        round_col(F.col(f.name), decimals).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def round_sql(sql: str, cols: list[str], decimals: int = DECIMALS) -> str:
    if not cols:
        return sql
    s = f"CAST({10 ** decimals} AS DOUBLE)"
    rep = ", ".join(
        f"CASE WHEN abs(CAST({c} AS DOUBLE)) < 1e15 THEN "
        f"CAST(floor(CAST({c} AS DOUBLE) * {s} + CAST(0.5 AS DOUBLE)) AS DOUBLE) / {s} "
        f"ELSE CAST({c} AS DOUBLE) END AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) __q"


def query(name: str, sql: str | None = None, round_cols: list[str] | None = None):
    """Register a query; ``round_cols`` are rounded on both sides."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir)) if round_cols is not None else fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = round_sql(sql, round_cols or [])
        return fn
    return deco
