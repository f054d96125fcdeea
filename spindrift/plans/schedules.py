"""Reporting calendars, date tables, distances in time and space."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from spindrift.functions import cases, dates, numbers, text
from spindrift.operators import calendar, joins, reshape, slices, windows
from spindrift.operators.columns import snake, with_headers

# Results carry these words.
ECLIPSE_NOTES = {
    "**": "total lunar eclipse takes place",
    "*": "partial lunar eclipse takes place",
    "+": "blue moon",
    "**+": "total lunar eclipse & blue moon",
}
SIZE_ALIASES = ("Jersey|Guernsey", "Channel Islands")
WORLD = "World"
SUBJECTS = "prep|server|community|desktop"


def bank_holidays(sheet: DataFrame, row: str = "row") -> DataFrame:
    """Dated holidays from a sheet that names the year only once per block.

    ``sheet``: year, date (``dd-MMM``), bank_holiday and the sheet's row number. The fill runs
    over the rows of one sheet.
    """
    year = windows.fill_forward(F.col("year"), [], [F.col(row)])
    full = sheet.withColumn("year", year).select("year", "date", "bank_holiday").na.drop()
    return full.select(
        dates.parse(text.joined("-", "year", "date"), "yyyy-d-MMM").alias("date"), "bank_holiday"
    )


def reporting_alignment(
    holidays: DataFrame, customers: DataFrame, other: DataFrame, last_year: int = 2023
) -> DataFrame:
    """New customers of two offices on the first office's reporting calendar.

    ``holidays``: date, bank_holiday; ``customers``: date, new_customers; ``other``: reported_day,
    roi_reporting_month (``MMM-yy``), roi_new_customers. Everything is summed to one row per day
    before any window runs.
    """
    per_day = customers.groupBy("date").agg(F.sum("new_customers").alias("new_customers"))
    off = holidays.groupBy("date").agg(F.max("bank_holiday").alias("bank_holiday"))
    days = per_day.join(off, "date", "full")
    counted = calendar.reporting_days(days, "date", F.col("bank_holiday").isNotNull())
    home = (
        counted.where(F.col("reported_day").isNotNull())
        .groupBy("reported_day")
        .agg(F.coalesce(F.sum("new_customers"), F.lit(0)).alias("customers"))
    )
    home = calendar.reporting_months(home, "reported_day")
    home = home.where(~F.contains(F.col("reported_month"), F.lit(str(last_year + 1))))
    away = other.groupBy("reported_day").agg(
        F.sum("roi_new_customers").alias("roi_customers"),
        F.max("roi_reporting_month").alias("roi_reporting_month"),
    )
    both = home.join(away, "reported_day", "full")
    # a day only the other office reports on counts towards the next home reporting day
    slot = F.when(
        F.col("row_number").isNotNull(), F.struct("reported_day", "reported_month", "row_number")
    )
    moved = both.withColumn("_slot", windows.fill_backward(slot, [], [F.col("reported_day")]))
    result = moved.groupBy("_slot").agg(
        F.coalesce(F.sum("customers"), F.lit(0)).alias("customers"),
        F.coalesce(F.sum("roi_customers"), F.lit(0)).alias("roi_customers"),
        F.max("roi_reporting_month").alias("roi_reporting_month"),
    )
    same = F.substring("reported_month", 1, 3) == F.substring("roi_reporting_month", 1, 3)
    return result.select(
        "_slot.reported_month", "_slot.reported_day", "_slot.row_number", "customers",
        "roi_customers", "roi_reporting_month",
    ).withColumn("misaligned_flag", F.when(~F.coalesce(same, F.lit(False)), "X"))


def matrix_dates(sheet: DataFrame, last_year: int = 2023) -> DataFrame:
    """Dates from a year matrix whose columns stand for a day and month.

    ``sheet`` is read without a header as ``column_1``...: title rows, rows of years under a
    count in ``column_3``, one row of day numbers and one of month names, each name over the
    first of its columns only.
    """
    cells = [c for c in sheet.columns if int(c.split("_")[1]) > 3]
    # a sheet is a year wide: one array per row, not one projection of the row per column
    pairs = F.array(*[F.struct(F.lit(int(c.split("_")[1])).alias("col"), F.col(c).alias("cell")) for c in cells])
    long = sheet.select("column_2", "column_3", F.inline(pairs))
    long = long.where(F.col("cell").isNotNull()).select(
        "col",
        F.col("column_2").isNotNull().alias("title"),
        F.col("column_3").isNotNull().alias("counted"),
        F.regexp_replace("cell", r"\s", "").alias("cell"),
    )
    is_number = F.col("cell").rlike(r"^\d+$")
    years = long.where(is_number & F.col("counted")).select(
        "col", F.col("cell").cast("int").alias("year")
    )
    below = long.where(~F.col("counted") & ~F.col("title"))
    day, month = F.when(is_number, F.col("cell")), F.when(~is_number, F.col("cell"))
    labels = below.groupBy("col").agg(F.max(day).alias("day"), F.max(month).alias("month"))
    # one row per sheet column, so the unpartitioned fill is bounded by the sheet's width
    labels = labels.withColumn("month", windows.fill_forward(F.col("month"), [], [F.col("col")]))
    date = dates.parse(text.joined("-", "year", "month", "day"), "y-MMMM-d")
    return years.where(F.col("year") <= last_year).join(labels, "col").select(date.alias("date"))


def moon_notes(sheet: DataFrame) -> DataFrame:
    """Full moons with an eclipse note. ``sheet``: day, date (``d MMMM yyyy``), time with marks."""
    marks = F.regexp_replace("time", r"[^*+]", "")
    day = dates.parse(text.strip_ws("date"), "d MMMM yyyy")
    return sheet.select(day.alias("fm_date"), cases.lookup(marks, ECLIPSE_NOTES).alias("note"))


def moon_to_holiday(
    moons: DataFrame, holidays: DataFrame, rows_per_slice: int = slices.ROWS_PER_SLICE
) -> DataFrame:
    """How often a holiday falls how many days after the last full moon.

    ``moons``: fm_date, note; ``holidays``: date.
    """
    ahead = joins.asof_forward(
        moons, holidays.withColumnRenamed("date", "holiday"), [], "fm_date", "holiday",
        rows_per_slice=rows_per_slice,
    ).where(F.col("holiday").isNotNull())
    gaps = ahead.withColumn("days_between", F.datediff("holiday", "fm_date"))
    nearest = windows.with_group_values(gaps, ["holiday"], {"_least": F.min("days_between")})
    return (
        nearest.where(F.col("days_between") == F.col("_least"))
        .groupBy("days_between")
        .agg(
            F.count(F.lit(1)).alias("num_occurrences"),
            F.max("note").alias("full_moon_notes"),
            F.min(F.year("fm_date")).alias("fm_date"),
            F.max(F.year("holiday")).alias("easter_sunday"),
        )
    )


def check_years(first: str, last: str, known: list[int]) -> None:
    if not (first.isdigit() and last.isdigit()):
        raise ValueError("years must be digits only")
    if not (len(first) == 4 and len(last) == 4):
        raise ValueError("years must have four digits")
    if not (int(first) >= min(known) and int(last) <= max(known)):
        raise ValueError(f"years must lie in {min(known)} to {max(known)}")


def land_sizes(sheet: DataFrame) -> DataFrame:
    """Land size per country from ``Country / Dependency`` and ``Total in km2 (mi2)`` texts."""
    name = text.strip_ws(F.regexp_extract(F.col("Country / Dependency"), r"^([^\[(]*)", 1))
    name = text.replace_first(name, *SIZE_ALIASES)
    size = text.strip_ws(text.part("Total in km2 (mi2)", "(", 1))
    sizes = sheet.select(
        name.alias("country_name"), F.replace(size, F.lit(","), F.lit("")).cast("double").alias("size")
    )
    return sizes.where(F.col("country_name") != WORLD).groupBy("country_name").agg(
        F.sum("size").alias("size")
    )


def density_growth(
    population: DataFrame, sizes: DataFrame, first: str, last: str, k: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Countries whose density grew most and densest countries, ``k`` rows each.

    ``population`` is wide with a ``Country Name`` and a column per year; only the two asked
    years are read. ``sizes``: country_name, size.
    """
    check_years(first, last, [int(c) for c in population.columns if c.isdigit()])
    country = text.strip_ws(F.col("Country Name")).alias("country_name")
    asked = population.select(country, F.col(f"`{first}`").alias("_a"), F.col(f"`{last}`").alias("_b"))
    dense = asked.join(sizes, "country_name").groupBy("country_name").agg(
        *[
            F.max(numbers.ratio(F.col(c).cast("bigint"), F.col("size"), 2)).alias(year)
            for c, year in (("_a", first), ("_b", last))
        ]
    )
    growth = F.round(F.try_divide(F.col(f"`{last}`"), F.col(f"`{first}`")) - 1, 2)
    grown = dense.withColumn("population_growth_pct", growth)
    return (
        top_ranked(grown, "population_growth_pct", k, "rank_by_growth_rate"),
        top_ranked(grown, last, k, "rank_by_max_year_pop_density"),
    )


def top_ranked(df: DataFrame, value: str, k: int, name: str, tie: str = "country_name") -> DataFrame:
    """The ``k`` first rows by descending dense rank over the whole table.

    Only the ``k`` largest distinct values are ranked, and only their rows sorted.
    """
    column = F.col(f"`{value}`")
    best = df.where(column.isNotNull()).select(column.alias("_value")).distinct()
    best = best.orderBy(F.col("_value").desc()).limit(k)
    best = best.withColumn(name, F.row_number().over(Window.orderBy(F.col("_value").desc())))
    # k rows at most
    found = df.join(F.broadcast(best), column == F.col("_value")).drop("_value")
    return found.orderBy(name, tie).limit(k)


def session_topics(sessions: DataFrame, word: str = "dedup") -> DataFrame:
    """Speaker and subject of the sessions that mention ``word``."""
    fields = text.two_parts("description", ":", ("speaker", "about"))
    told = sessions.select("session_number", fields.alias("_f")).select("session_number", "_f.*")
    surname = text.extract("speaker", r"\s+(.*)$")
    return told.where(F.contains(F.col("about"), F.lit(word))).select(
        "session_number",
        F.concat(text.piece("speaker", 0, 1), F.substring(surname, 1, 1)).alias("speaker_initials"),
        text.extract(text.strip_ws("about"), f"(?i)({SUBJECTS})").alias("subject"),
    )


def room_sessions(rooms: DataFrame) -> DataFrame:
    """Room number, speaker and subject from a room-by-floor sheet."""
    long = reshape.to_long(rooms, ["room"], name="floor", value="shown")
    fields = text.two_parts("shown", "-", ("title", "talk"))
    talk = text.strip_ws("_f.talk")
    number = F.concat(text.extract("floor", r"_(\d)$"), F.lit("0"), F.col("room").cast("string"))
    return long.where(F.col("shown").isNotNull()).withColumn("_f", fields).select(
        number.cast("int").alias("room_B"), text.piece(talk, 0, 2).alias("speaker_initials"),
        text.piece(talk, 6).alias("subject"),
    )


def matrix_pairs(matrix: DataFrame, row: str, other: str, value: str, symmetric: bool = False) -> DataFrame:
    """Distinct pairs of a labelled matrix; a triangle lists each pair once unless ``symmetric``."""
    pairs = reshape.to_long(matrix, [row], name=other, value=value, cast="int")
    pairs = pairs.where(F.col(value).isNotNull()).withColumns(
        {row: F.col(row).cast("int"), other: F.col(other).cast("int")}
    )
    pairs = pairs.where(F.col(row) != F.col(other))
    if symmetric:
        mirror = pairs.select(F.col(other).alias(row), F.col(row).alias(other), value)
        pairs = pairs.unionByName(mirror).distinct()
    return pairs


def walking_times(
    sessions: DataFrame, rooms: DataFrame, distances: DataFrame, floor: str = "2",
    room: int | None = None, symmetric: bool = False,
) -> DataFrame:
    """Walk from every room (or ``room``) to the chosen sessions on a floor."""
    held = room_sessions(rooms).where(F.col("room_B").cast("string").startswith(floor))
    chosen = held.join(session_topics(sessions), ["subject", "speaker_initials"])
    pairs = matrix_pairs(
        with_headers(distances, snake), "room", "room_B", "distance_in_meters", symmetric
    )
    walks = pairs.withColumnRenamed("room", "room_A").join(chosen, "room_B").select(
        "room_A", "room_B", "distance_in_meters",
        numbers.walking_minutes(F.col("distance_in_meters")).alias("mins_to_walk"),
        "speaker_initials", "subject", "session_number",
    )
    return walks if room is None else walks.where(F.col("room_A") == room)
