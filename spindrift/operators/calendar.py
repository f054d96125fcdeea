"""Calendars and scaffolds. A calendar has one row per day or month, so it stays small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from spindrift.functions.dates import iso_weekday, month_label, month_start
from spindrift.operators.windows import fill_backward


def date_table(spark: SparkSession, first: str, last: str, step: str = "1 day", name: str = "date") -> DataFrame:
    """One row per step, both ends included."""
    days = F.sequence(
        F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr(f"interval {step}")
    )
    return spark.range(1).select(F.explode(days).alias(name))


def scaffold(
    facts: DataFrame, keys: Sequence[str], date: str, *, step: str = "1 day"
) -> DataFrame:
    """Every key with every date between the table's first and last, facts left-joined.

    Facts hold at most one row per key and date. The date range is a scalar of the table; each
    key is exploded by itself, there is no product of tables.
    """
    reach = facts.agg(F.struct(F.min(date).alias("first"), F.max(date).alias("last"))).scalar()
    days = F.sequence(reach["first"], reach["last"], F.expr(f"interval {step}"))
    grid = facts.select(*keys).distinct().withColumn(date, F.explode(days))
    return grid.join(facts, [*keys, date], "left")


def reporting_days(days: DataFrame, date: str, closed: Column) -> DataFrame:
    """For each calendar day the reporting day its figures count towards, NULL after the last.

    A day reports when it is neither ``closed`` nor on a weekend. One unpartitioned window, over
    one row per day.
    """
    reports = ~(closed | iso_weekday(F.col(date)).isin(6, 7))
    flagged = days.withColumn("_open", F.when(reports, F.col(date)))
    return flagged.withColumn(
        "reported_day", fill_backward(F.col("_open"), [], [F.col(date)])
    ).drop("_open")


def reporting_months(days: DataFrame, day: str) -> DataFrame:
    """Month label and day number within it: the last reporting day opens the next month."""
    last_day = F.max(day).over(Window.partitionBy(month_start(F.col(day))))
    shifted = F.when(F.col(day) < F.col("_last"), F.col(day)).otherwise(F.add_months(day, 1))
    labelled = days.withColumn("_last", last_day).withColumn("reported_month", month_label(shifted))
    number = F.row_number().over(Window.partitionBy("reported_month").orderBy(day))
    return labelled.withColumn("row_number", number).drop("_last")
