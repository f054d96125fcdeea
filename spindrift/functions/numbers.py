"""Arithmetic expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_MILES = 3963  # fixed value: results depend on it
WALKING_METRES_PER_SECOND = 1.2  # fixed value


_EXACT = "decimal(28,8)"


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator / denominator`` rounded half away from zero; NULL for a zero denominator.

    The division runs in decimal arithmetic with ten digits behind the point, so ties round the
    way they do on paper. Operands keep eight digits behind the point; numerators have up to 20 before
    it, denominators up to 22.
    """
    exact = F.try_divide(numerator.cast(_EXACT), denominator.cast("decimal(30,8)"))
    return F.round(exact, digits).cast("double")


def mean(c: Column, digits: int) -> Column:
    """Group mean rounded half away from zero, NULLs skipped; map-side combinable."""
    return ratio(F.sum(c.cast(_EXACT)), F.count(c), digits)


def mean_over(c: Column, window, digits: int) -> Column:
    """:func:`mean` over a window."""
    exact = c.cast(_EXACT)
    return ratio(F.sum(exact).over(window), F.count(c).over(window), digits)


def half_up(c: Column, digits: int = 0) -> Column:
    """Round half towards positive infinity."""
    scale = 10**digits
    return F.floor(c * scale + F.lit(0.5)) / scale


def signed(value: Column, negative: Column) -> Column:
    return F.when(negative, -value).otherwise(value)


def great_circle_miles(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Distance by the spherical law of cosines from radians; the cosine is clamped to [-1, 1]."""
    cosine = F.sin(lat_a) * F.sin(lat_b) + F.cos(lat_a) * F.cos(lat_b) * F.cos(lon_a - lon_b)
    return F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0))) * EARTH_RADIUS_MILES


def walking_minutes(metres: Column) -> Column:
    return F.ceil(metres / WALKING_METRES_PER_SECOND / 60).cast("double")
