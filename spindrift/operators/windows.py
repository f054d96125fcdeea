"""Ranks, shares and fills.

Plain window functions appear here only where the caller's groups are bounded by a domain (days
of a calendar, quarters, labels) or where Spark limits each group before the shuffle. For groups
of any size see :mod:`spindrift.operators.slices`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str) -> DataFrame:
    """The first ``n`` rows of each group with their row number.

    Spark keeps ``n`` rows per group and task before the shuffle, so a hot group stays small.
    """
    over = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(over)).where(F.col(name) <= n)


def top_dense(
    df: DataFrame, keys: Sequence[str], value: Column, n: int, name: str, descending: bool = True
) -> DataFrame:
    """Rows whose value is among the ``n`` best distinct values of the group, all ties kept.

    1. The values of a group are dealt by their hash into ``4 n`` parts and the best of each part is
       taken, which combines before the shuffle. These are distinct values of the group, so none
       worse than the ``n``-th best of them counts; a group with fewer is not bounded.
    2. The distinct values that are left, few more than ``n``, are ranked.
    3. The ranks are joined back to the rows, by broadcast where they were counted to be few, else
       with skew handling, so the ties of a value are never in one task for their number.

    The first two read keys and value only.
    """
    best, order = (F.max, F.desc) if descending else (F.min, F.asc)
    group = F.struct(F.lit(0).alias("_"), *[F.col(k) for k in keys])
    known = df.where(value.isNotNull())
    narrow = known.select(group.alias("_group"), value.alias("_value"))
    parts = narrow.groupBy("_group", F.pmod(F.xxhash64("_value"), F.lit(4 * n)).alias("_part")).agg(
        best("_value").alias("_value"))
    place = F.row_number().over(Window.partitionBy("_group").orderBy(order("_value")))
    bounds = broadcast_if_small(parts.withColumn("_place", place).where(F.col("_place") == n).select(
        "_group", F.col("_value").alias("_bound")))
    good = F.col("_value") >= F.col("_bound") if descending else F.col("_value") <= F.col("_bound")
    candidates = narrow.join(bounds, "_group", "left").where(F.col("_bound").isNull() | good)
    rank = F.dense_rank().over(Window.partitionBy("_group").orderBy(order("_value")))
    ranked = candidates.select("_group", "_value").distinct().withColumn(name, rank).where(F.col(name) <= n)
    both = known.withColumns({"_group": group, "_value": value})
    return both.join(broadcast_if_small(ranked), ["_group", "_value"]).select(*df.columns, name)


def small_copy(df: DataFrame, most: int = 10_000) -> DataFrame | None:
    """The rows of a table as a local one, computed here and now, or None beyond ``most`` rows."""
    rows = df.limit(most + 1).collect()
    return df.sparkSession.createDataFrame(rows, df.schema) if len(rows) <= most else None


def broadcast_if_small(df: DataFrame, most: int = 10_000) -> DataFrame:
    """A broadcast copy of a table that has at most ``most`` rows, else the table as it is.

    Joins on few distinct keys should not shuffle the facts, and Spark cannot know the size of
    an aggregate before it runs.
    """
    copy = small_copy(df, most)
    return df if copy is None else F.broadcast(copy)


def bounded_dense_rank(keys: Sequence[str], value: str, *, descending: bool = False) -> Column:
    """Dense rank for bounded groups; NULL values get a NULL rank."""
    c = F.col(value)
    order = c.desc_nulls_last() if descending else c.asc_nulls_last()
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy(order))
    return F.when(c.isNotNull(), rank)


def with_group_values(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, Column], *, measured: bool = False
) -> DataFrame:
    """Group aggregates beside every row.

    An aggregate (combined before its shuffle) joined back, instead of a window that would move
    every row of a hot group to one task; the join is open to broadcast and skew handling.
    ``measured`` computes the aggregate at once and broadcasts it when it is small.
    """
    per_group = df.groupBy(*keys).agg(*[c.alias(n) for n, c in values.items()])
    group = F.struct(*[F.col(k) for k in keys])
    right = per_group.select(group.alias("_group"), *values)
    right = broadcast_if_small(right) if measured else right
    return df.withColumn("_group", group).join(right, "_group").drop("_group")


def with_total(df: DataFrame, total: Column, name: str) -> DataFrame:
    """A whole-table aggregate beside every row, as a scalar subquery."""
    return df.withColumn(name, df.agg(total.alias(name)).scalar())


def counted_share(df: DataFrame, label: str, name: str, digits: int) -> DataFrame:
    """Percent of all rows per label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totalled = with_total(counts, F.sum("_n"), "_all")
    exact = (F.col("_n").cast("decimal(20,0)") * 100) / F.col("_all").cast("decimal(20,0)")
    return totalled.select(label, F.round(exact, digits).cast("double").alias(name))


def fill_forward(value: Column, keys: Sequence[str], order: Sequence[Column]) -> Column:
    """Last known value, for bounded groups."""
    over = Window.partitionBy(*keys).orderBy(*order)
    return F.last(value, ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, 0))


def fill_backward(value: Column, keys: Sequence[str], order: Sequence[Column]) -> Column:
    """Next known value, for bounded groups."""
    over = Window.partitionBy(*keys).orderBy(*order)
    return F.first(value, ignorenulls=True).over(over.rowsBetween(0, Window.unboundedFollowing))


def rolling_mean_bounded(
    value: Column, keys: Sequence[str], order: Sequence[Column], n: int
) -> Column:
    """Mean of the last ``n`` rows, NULL for the first ``n - 1``, for bounded groups."""
    over = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1), 0)
    return F.when(F.count(value).over(over) == n, F.sum(value).over(over) / F.lit(n))
