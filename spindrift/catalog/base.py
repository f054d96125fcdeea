"""The query register and helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, read on first use: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` as a query."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def doubles(df: DataFrame, *names: str) -> DataFrame:
    """Cast exact results to double for the report."""
    return df.withColumns({n: F.col(f"`{n}`").cast("double") for n in names})


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(f"`{n}`").cast("bigint") for n in names})


def sql_ratio(numerator: str, denominator: str, digits: int) -> str:
    """Half-away-from-zero rounding of a ratio in integer arithmetic; at most 2 decimals above."""
    scale = 10**digits
    return (
        f"(sign({numerator}) * CAST((2 * abs(CAST(({numerator}) * 100 AS HUGEINT)) * {scale}"
        f" + 100 * ({denominator})) // (200 * ({denominator})) AS DOUBLE) / {scale}.0)"
    )
