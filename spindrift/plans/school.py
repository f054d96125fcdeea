"""Students, marks, admissions, athletics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.functions import cases, dates, numbers, text
from spindrift.operators import reshape, selection, slices, windows
from spindrift.operators.columns import map_columns, quoted, without

# Results carry these words and limits.
GRADES = {1: "A", 2: "B", 3: "C", 4: "D", 5: "E"}
LOWEST_GRADE = "F"
GRADE_POINTS = {"A": 50, "B": 40, "C": 30, "D": 20, "E": 10}
LOW_ATTENDANCE, HIGH_ATTENDANCE = 0.7, 0.9
PLACES = {"east": 15, "west": 5}
QUARTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
LOWEST_RANGE = "25th"
OUTLIER_EVENT, OUTLIER_SECONDS = "200m", 25


def yearly_decline(marks: DataFrame, years: tuple[str, str] = ("2021", "2022")) -> DataFrame:
    """Students whose mean mark fell; mark columns are named ``<year>-<category>``."""
    ids = [c for c in marks.columns if "-" not in c]
    long = reshape.to_long(marks, ids, name="header", value="score")
    long = long.withColumn("_h", text.two_parts("header", "-", ("year", "category")))
    means = reshape.to_wide(
        long.select(*[quoted(c) for c in ids], "_h.year", "score"),
        [f"`{c}`" for c in ids], "year", years, "score", F.avg,
    )
    before, after = f"{years[0]}_avg", f"{years[1]}_avg"
    means = means.withColumnsRenamed({years[0]: before, years[1]: after})
    compared = means.withColumn("diff", F.col(f"`{after}`") - F.col(f"`{before}`"))
    status = cases.first_match(
        [(F.col("diff") > 0, "Improvement"), (F.col("diff") == 0, "No change")], "Cause for concern"
    )
    return compared.withColumn("status", status).where(F.col("status") == "Cause for concern")


def attendance_flag(share: Column) -> Column:
    return cases.first_match(
        [(share < LOW_ATTENDANCE, "Low Attendance"), (share > HIGH_ATTENDANCE, "High Attendance")],
        "Medium Attendance",
    )


def attendance_flags(scores: DataFrame, attendance: DataFrame) -> DataFrame:
    """Test scores beside an attendance band. ``student_name`` is ``first_last``."""
    subject = text.replace_first(text.replace_first("subject", "^Eng.*$", "English"), "^Sci.*$", "Science")
    name = text.two_parts("student_name", "_", ("first_name", "last_name"))
    both = scores.drop("test_date").join(attendance, "student_name").withColumn("_name", name)
    share = F.col("attendance_percentage")
    return both.select(
        "student_id", "test_score", subject.alias("subject"), "_name.*",
        F.round("test_score", 0).alias("test_score_int"),
        attendance_flag(share).alias("attendance_flag"),
        share.cast("decimal(3,2)").alias("attendance_percentage"),
    )


def trimmed(df: DataFrame, *keep: str) -> DataFrame:
    """Strip every column but ``keep``."""
    return map_columns(df, text.strip_ws, [c for c in df.columns if c not in keep])


def lowest_class(
    students: DataFrame, results: DataFrame,
    subjects: Sequence[str] = ("english", "economics", "psychology"),
) -> DataFrame:
    """Class with the lowest mean mark per subject, ties kept."""
    joined = trimmed(students, "student_id").join(results, "student_id")
    means = joined.groupBy("class").agg(*[numbers.mean(quoted(s), 2).alias(s) for s in subjects])
    long = reshape.to_long(means, ["class"], subjects, name="subject", value="grade")
    # one row per class and subject; Spark keeps only the lowest before the shuffle
    rank = F.dense_rank().over(Window.partitionBy("subject").orderBy("grade"))
    lowest = long.where(F.col("grade").isNotNull()).withColumn("_rank", rank).where(F.col("_rank") == 1)
    return lowest.select("subject", "grade", "class")


def quartile_tile(value: Column) -> Column:
    """4 for the lowest quarter to 1 for the highest; a value on a bound is in the lower one."""
    return cases.first_match(
        [(value <= F.col("q1"), 4), (value <= F.col("q2"), 3), (value <= F.col("q3"), 2),
         (value.isNotNull(), 1)]
    )


def low_in_several(
    results: DataFrame, students: DataFrame, tiles: DataFrame,
    classes: Sequence[str] = ("9A", "9B"),
    subjects: Sequence[str] = ("English", "Economics", "Psychology"),
    least: int = 2, rows_per_slice: int = slices.ROWS_PER_SLICE,
) -> DataFrame:
    """Students of some classes in the lowest quarter of at least ``least`` subjects.

    ``results``: student_id and a column per subject; ``tiles``: number, range. The quarters are
    those of all students.
    """
    marks = reshape.to_long(results, ["student_id"], subjects, name="subject", value="score")
    bounds = selection.quantiles(marks, ["subject"], "score", QUARTILES, rows_per_slice=rows_per_slice)
    # one row per subject
    tiled = marks.join(F.broadcast(bounds), "subject").withColumn("number", quartile_tile(F.col("score")))
    ranged = tiled.join(windows.broadcast_if_small(tiles), "number").join(
        trimmed(students, "student_id").where(F.col("class").isin(*classes)), "student_id"
    )
    wide = reshape.to_wide(ranged, ["full_name", "class"], "subject", subjects, "range")
    low = F.filter(F.array(*[quoted(s) for s in subjects]), lambda r: F.contains(r, F.lit(LOWEST_RANGE)))
    return wide.withColumn("flag_how_many_25th", F.size(low)).where(
        F.col("flag_how_many_25th") >= least
    )


def letter(grade: Column) -> Column:
    return cases.lookup(grade.cast("int"), GRADES, LOWEST_GRADE)


def points(grade: Column) -> Column:
    return cases.lookup(grade, GRADE_POINTS, 0)


def full_name() -> Column:
    return text.joined(" ", F.upper("first_name"), F.upper("last_name"))


def east_feed(feed: DataFrame) -> DataFrame:
    """Ids like ``East123``, letter grades, dates like ``Monday, 5 May, 2008``."""
    return feed.select(
        text.extract("student_id", r"^[A-Za-z]+(\d+)$").cast("int").alias("student_id"),
        full_name().alias("full_name"),
        dates.parse_with_weekday(F.col("date_of_birth"), "d MMMM, yyyy").alias("date_of_birth"),
        "subject", "grade",
        text.extract("student_id", r"^([A-Za-z]+)\d+$").alias("region"),
    )


def west_feed(feed: DataFrame) -> DataFrame:
    """Ids like ``123-West``, grades 1 to 6, dates like ``05/05/2008``."""
    return feed.select(
        text.part("student_id", "-", 1).cast("int").alias("student_id"),
        full_name().alias("full_name"),
        dates.parse(F.col("date_of_birth"), "d/M/yyyy").alias("date_of_birth"),
        "subject", letter(F.col("grade")).alias("grade"),
        text.part("student_id", "-", 2).alias("region"),
    )


def combine_feeds(
    east: DataFrame, west: DataFrame, schools: DataFrame, subjects: Sequence[str]
) -> DataFrame:
    """Both feeds, one row per student: total points and the grade of every subject.

    One aggregate per person; an id's total runs over the few persons that share it.
    """
    marks = east_feed(east).unionByName(west_feed(west)).withColumn("_points", points(F.col("grade")))
    person = ["student_id", "full_name", "date_of_birth", "region"]
    grades = [F.min(F.when(F.col("subject") == s, F.col("grade"))).alias(s.lower()) for s in subjects]
    combined = marks.groupBy(*person).agg(*grades, F.sum("_points").alias("_own"))
    score = F.sum("_own").over(Window.partitionBy("student_id"))
    lookup = schools.withColumn("student_id", F.col("student_id").cast("int"))
    return combined.withColumn("score", score).join(lookup, "student_id").select(
        "student_id", "full_name", "date_of_birth", "score", "region",
        *[s.lower() for s in subjects], *[c for c in schools.columns if c != "student_id"],
    )


def grade_lists(marks: DataFrame, key: str) -> DataFrame:
    """Sorted (subject, grade) list per key; one entry per subject keeps the list short."""
    one = marks.groupBy(key, "subject").agg(F.min("grade").alias("grade"))
    return one.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("subject", "grade"))).alias("sub_grade")
    )


def ranked_applicants(applicants: DataFrame, places: Mapping[str, int] = PLACES) -> DataFrame:
    """The best applicants per subject and region, as many as the region has places.

    Ties on the score go to the shorter distance, then the smaller id.
    """
    order = [F.col("grade_score").desc(), F.col("distance").asc(), F.col("student_id")]
    region = F.lower("region")
    offered = applicants.where(region.isin(*places))
    best = windows.top_rows(
        offered, ["subject_selection", "region"], order, max(places.values()), "student_rank"
    )
    return best.where(F.col("student_rank") <= cases.lookup(region, dict(places)))


def with_school_status(accepted: DataFrame) -> DataFrame:
    """High, low or average performing school by its share of the region's accepted.

    A region has no more accepted students than places for each subject, so the windows are small.
    """
    region = Window.partitionBy("region")
    own = F.count("student_id").over(Window.partitionBy("region", "school_name"))
    shares = accepted.withColumn("_own", own).withColumn(
        "_share", numbers.ratio(F.col("_own"), F.count("student_id").over(region), 2)
    )
    ends = shares.withColumns({"_most": F.max("_share").over(region), "_least": F.min("_share").over(region)})
    status = cases.first_match(
        [(F.col("_share") == F.col("_most"), "High Performing"),
         (F.col("_share") == F.col("_least"), "Low Performing")],
        "Average Performing",
    )
    return ends.withColumn("school_status", status).drop("_own", "_share", "_most", "_least")


def admissions(students: DataFrame, extra: DataFrame) -> DataFrame:
    """Accepted students with the status of their school.

    ``extra`` repeats the initials, school, birth date and marks as its key.
    """
    keys = ["initials", "school_name", "date_of_birth", "maths", "english", "science"]
    miles = "distance_from_school_(miles)"
    known = students.withColumn("initials", text.initials("full_name"))
    joined = known.join(extra, keys).withColumn("distance", quoted(miles))
    result = with_school_status(ranked_applicants(joined))
    return without(
        result, "home_address", miles, "distance", "student_rank", "initials", "school_id"
    )


def track_qualifiers(
    students: DataFrame, times: DataFrame, benchmarks: DataFrame,
    rows_per_slice: int = slices.ROWS_PER_SLICE,
) -> DataFrame:
    """Students under the benchmark of their age, gender and event, ranked per event."""
    run = students.join(times, "id")
    limits = windows.broadcast_if_small(benchmarks.withColumnRenamed("event", "track_event"))
    beaten = run.join(limits, ["age", "gender", "track_event"]).where(
        F.col("time") < F.col("benchmark")
    )
    too_fast = (F.col("track_event") == OUTLIER_EVENT) & (F.col("time") < OUTLIER_SECONDS)
    return slices.dense_rank(
        beaten.where(~too_fast), ["track_event"], "time", "rank", rows_per_slice=rows_per_slice
    )
