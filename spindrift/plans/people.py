"""Employee records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spindrift.functions import cases, dates, text
from spindrift.operators import joins

# Results carry these words.
NOT_PROVIDED = "Not Provided"
AGE_EDGES = (20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70)


def known_pairs(*frames: DataFrame, first: str = "employee_id", second: str = "guid") -> DataFrame:
    """Distinct complete id pairs of several tables."""
    pairs = [df.select(first, second).na.drop().distinct() for df in frames]
    union = pairs[0]
    for other in pairs[1:]:
        union = union.unionByName(other)
    return union.distinct()


def repair_ids(dimension: DataFrame, monthly: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with their missing employee ids and guids filled from each other."""
    pairs = known_pairs(dimension, monthly)
    return (
        joins.resolve_ids(dimension, pairs, "employee_id", "guid"),
        joins.resolve_ids(monthly, pairs, "employee_id", "guid"),
    )


def age_labels() -> list[str]:
    spans = [f"{low}-{high - 1} years" for low, high in zip(AGE_EDGES, AGE_EDGES[1:])]
    return [f"Under {AGE_EDGES[0]} years", *spans, f"{AGE_EDGES[-1]}+ years"]


def age_band(age: Column) -> Column:
    return cases.bucketize(age, AGE_EDGES, age_labels(), otherwise=NOT_PROVIDED)


def generation_label() -> Column:
    name, low, high = F.col("generation"), F.col("start_year"), F.col("end_year")
    return cases.first_match(
        [
            (low.isNull(), text.joined("", name, F.lit(" (born in or before "), high, F.lit(")"))),
            (high.isNull(), text.joined("", name, F.lit(" (born in or after "), low, F.lit(")"))),
        ],
        text.joined("", name, F.lit(" ("), low, F.lit("-"), high, F.lit(")")),
    )


def generations(dimension: DataFrame, bands: DataFrame, open_ended: bool = False) -> DataFrame:
    """Employees with the label of their generation.

    A band without a start or end year matches nobody unless ``open_ended``.
    """
    dated = dimension.withColumns(
        {c: dates.parse(F.col(c), "d/M/yyyy") for c in ("date_of_birth", "hire_date", "leave_date")}
    ).withColumn("birth_year", F.year("date_of_birth"))
    labelled = bands.select("start_year", "end_year", generation_label().alias("gen_name"))
    found = joins.range_left(
        dated, labelled, "birth_year", "start_year", "end_year", open_ended=open_ended
    )
    return found.select(
        "employee_id", "guid", F.coalesce("gen_name", F.lit(NOT_PROVIDED)).alias("gen_name"),
        "first_name", "last_name", "nationality", "gender", "email", "hire_date", "leave_date",
        "date_of_birth",
    )


def monthly_age_bands(monthly: DataFrame, employees: DataFrame) -> DataFrame:
    """Monthly rows with the age band the employee has at the month's end."""
    age = dates.year_gap(F.col("month_end_date"), F.col("date_of_birth"))
    people = employees.select("employee_id", "guid", "hire_date", "leave_date", "date_of_birth")
    return monthly.select("dc_nbr", "month_end_date", "employee_id").join(people, "employee_id").select(
        "dc_nbr", "month_end_date", "employee_id", "guid", "hire_date", "leave_date",
        age_band(age).alias("age_bucket"),
    )
