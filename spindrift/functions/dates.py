"""Date expressions. Formats are Spark datetime patterns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse(c: Column, pattern: str) -> Column:
    """Strict parse: bad text raises."""
    return F.to_date(c, pattern)


def parse_lenient(c: Column, pattern: str) -> Column:
    """Bad text becomes NULL."""
    return F.try_to_timestamp(c, F.lit(pattern)).cast("date")


def parse_with_weekday(c: Column, pattern: str) -> Column:
    """Parse ``Monday, 5 May, 2008``: the weekday is cut off, Spark does not parse it."""
    return F.to_date(F.regexp_replace(c, r"^\s*[A-Za-z]+,\s*", ""), pattern)


def iso_weekday(c: Column) -> Column:
    """Monday is 1."""
    return F.weekday(c) + 1


def month_name(c: Column) -> Column:
    return F.date_format(c, "MMMM")


def month_label(c: Column) -> Column:
    """``January-2022``"""
    return F.date_format(c, "MMMM-yyyy")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def fiscal_quarter(c: Column, first_month: int = 7) -> Column:
    """Quarter of a fiscal year that starts in ``first_month``."""
    return F.quarter(F.add_months(c, (13 - first_month) % 12))


def year_gap(later: Column, earlier: Column) -> Column:
    """Difference of calendar years, not birthday aware."""
    return F.year(later) - F.year(earlier)


def day_number(c: Column) -> Column:
    return F.unix_date(c.cast("date"))


def wall_micros(c: Column) -> Column:
    """Microseconds of a timestamp without a zone, the same in every session zone."""
    whole = F.unix_date(c.cast("date")).cast("bigint") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60
    return whole * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
