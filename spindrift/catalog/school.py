"""School jobs over customers and orders."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from spindrift.catalog.base import Tables, doubles, longs, money, query, sql_ratio
from spindrift.operators import reshape, selection, windows
from spindrift.plans import school


def _key() -> Column:
    return F.col("c_custkey")


def _pick(index: Column, *items: str) -> Column:
    return F.element_at(F.array(*[F.lit(i) for i in items]), (index % len(items) + 1).cast("int"))


def _sql_pick(index: str, *items: str) -> str:
    listed = ", ".join(f"'{i}'" for i in items)
    return f"list_extract([{listed}], CAST(({index}) % {len(items)} AS INTEGER) + 1)"


_SQL_BORN = """make_date(CAST(1990 + c_custkey % 20 AS INTEGER), CAST(1 + c_custkey % 12 AS INTEGER),
      CAST(1 + c_custkey % 28 AS INTEGER))"""


def _born() -> Column:
    return F.make_date(*[part.cast("int") for part in (1990 + _key() % 20, 1 + _key() % 12, 1 + _key() % 28)])



@query(
    "yoy_decline",
    """
    WITH cells AS (
      SELECT o_custkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, count(*) AS n
      FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY ALL),
    means AS (
      SELECT o_custkey, avg(n) FILTER (y = 1996) AS a, avg(n) FILTER (y = 1997) AS b FROM cells GROUP BY 1)
    SELECT c_custkey AS student_id, c_name AS first_name, c_mktsegment AS last_name,
      round(a, 6) AS "1996_avg", round(b, 6) AS "1997_avg", round(b - a, 6) AS diff, 'Cause for concern' AS status
    FROM means JOIN customer ON o_custkey = c_custkey WHERE b - a < 0 OR b - a IS NULL""",
)
def yoy_decline(t: Tables) -> DataFrame:
    headers = [f"{y}-Q{q}" for y in (1996, 1997) for q in range(1, 5)]
    counted = t.orders.where(F.year("o_orderdate").isin(1996, 1997)).select(
        "o_custkey",
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-Q"), F.quarter("o_orderdate").cast("string")).alias("h"),
    )
    wide = reshape.to_wide(counted, ["o_custkey"], "h", headers, F.lit(1), F.sum)
    marks = wide.join(t.customer, F.col("o_custkey") == _key()).select(
        _key().alias("student_id"), F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"), *[f"`{h}`" for h in headers],
    )
    result = school.yearly_decline(marks, ("1996", "1997"))
    return result.withColumns({c: F.round(F.col(f"`{c}`"), 6) for c in ("1996_avg", "1997_avg", "diff")})


@query(
    "bucket_flags",
    f"""
    SELECT o_orderkey AS student_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.001 AS DOUBLE) AS test_score,
      {_sql_pick("o_orderkey", "English", "English", "Science", "Math")} AS subject, 'First' AS first_name,
      'Last' || CAST(c_custkey AS VARCHAR) AS last_name,
      CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 0.001, 0) AS DOUBLE) AS test_score_int,
      CASE WHEN c_custkey % 101 < 70 THEN 'Low Attendance' WHEN c_custkey % 101 > 90 THEN 'High Attendance'
           ELSE 'Medium Attendance' END AS attendance_flag,
      CAST(c_custkey % 101 AS DOUBLE) / 100 AS attendance_percentage
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def bucket_flags(t: Tables) -> DataFrame:
    scores = t.orders.select(
        F.col("o_orderkey").alias("student_id"),
        (money("o_totalprice") * Decimal("0.001")).alias("test_score"),
        _pick(F.col("o_orderkey"), "Eng", "Englsh", "Scince", "Math").alias("subject"),
        F.concat(F.lit("First_Last"), F.col("o_custkey").cast("string")).alias("student_name"),
        F.col("o_orderdate").alias("test_date"),
    )
    attendance = t.customer.select(
        F.concat(F.lit("First_Last"), _key().cast("string")).alias("student_name"),
        ((_key() % 101).cast("double") / 100).alias("attendance_percentage"),
    )
    result = school.attendance_flags(scores, attendance)
    return doubles(result, "test_score_int", "attendance_percentage", "test_score")


@query(
    "lowest_group",
    f"""
    WITH means AS (
      SELECT c_mktsegment AS class, {sql_ratio("sum(CAST(c_acctbal AS DECIMAL(18,2)))", "count(*)", 2)} AS english,
        {sql_ratio("sum(c_custkey % 100)", "count(*)", 2)} AS economics,
        {sql_ratio("sum(c_custkey * 7 % 100)", "count(*)", 2)} AS psychology FROM customer GROUP BY 1),
    long AS (UNPIVOT means ON english, economics, psychology INTO NAME subject VALUE grade),
    ranked AS (SELECT *, dense_rank() OVER (PARTITION BY subject ORDER BY grade) AS r FROM long)
    SELECT subject, grade, class FROM ranked WHERE r = 1""",
)
def lowest_group(t: Tables) -> DataFrame:
    students = t.customer.select(
        _key().alias("student_id"), F.concat(F.lit("\t"), "c_name", F.lit("  ")).alias("full_name"),
        F.concat(F.lit("  "), "c_mktsegment", F.lit("\n")).alias("class"),
    )
    results = t.customer.select(
        _key().alias("student_id"), money("c_acctbal").alias("english"),
        (_key() % 100).alias("economics"), (_key() * 7 % 100).alias("psychology"),
    )
    return school.lowest_class(students, results)


_TILES = """
    WITH marks AS (
      SELECT c_custkey, c_acctbal AS "English", CAST(c_custkey * 13 % 101 AS DOUBLE) AS "Economics",
             CAST(c_custkey * 29 % 83 AS DOUBLE) AS "Psychology" FROM customer),
    long AS (UNPIVOT marks ON "English", "Economics", "Psychology" INTO NAME subject VALUE score),
    bounds AS (SELECT subject, quantile_cont(score, [0.25, 0.5, 0.75]) AS q FROM long GROUP BY 1),
    ranged AS (
      SELECT c_custkey, subject, CASE WHEN score <= q[1] THEN '25th percentile' WHEN score <= q[3]
        THEN 'Interquartile range' ELSE '75th percentile' END AS r FROM long JOIN bounds USING (subject)),
    wide AS (
      SELECT c_custkey, min(r) FILTER (subject = 'English') AS "English",
        min(r) FILTER (subject = 'Economics') AS "Economics", min(r) FILTER (subject = 'Psychology') AS "Psychology",
        count(*) FILTER (r LIKE '%25th%') AS n FROM ranged GROUP BY 1)
    SELECT c_name AS full_name, c_mktsegment AS class, "English", "Economics", "Psychology",
      CAST(n AS BIGINT) AS flag_how_many_25th
    FROM wide JOIN customer USING (c_custkey) WHERE n >= 2 AND c_mktsegment IN ('MACHINERY', 'HOUSEHOLD')"""


def _low(t: Tables, **options) -> DataFrame:
    results = t.customer.select(
        _key().alias("student_id"), F.col("c_acctbal").alias("English"),
        (_key() * 13 % 101).cast("double").alias("Economics"), (_key() * 29 % 83).cast("double").alias("Psychology"),
    )
    students = t.customer.select(
        _key().alias("student_id"), F.col("c_name").alias("full_name"),
        F.concat(F.lit(" "), "c_mktsegment").alias("class"),
    )
    ranges = ("75th percentile", "Interquartile range", "Interquartile range", "25th percentile")
    tiles = t.spark.createDataFrame(list(enumerate(ranges, 1)), "number int, range string")
    result = school.low_in_several(
        results, students, tiles, classes=("MACHINERY", "HOUSEHOLD"), **options
    )
    return longs(result, "flag_how_many_25th")


@query("low_quartile_students", _TILES)
def low_quartile_students(t: Tables) -> DataFrame:
    return _low(t)


@query("low_quartile_students_sliced", _TILES)
def low_quartile_students_sliced(t: Tables) -> DataFrame:
    return _low(t, rows_per_slice=60)


_QUARTILES = """
    WITH bounds AS (
      SELECT event_type, quantile_cont(value, [0.25, 0.5, 0.75]) AS q FROM events GROUP BY 1),
    tiled AS (
      SELECT event_type, CASE WHEN value <= q[1] THEN 4 WHEN value <= q[2] THEN 3 WHEN value <= q[3] THEN 2
        ELSE 1 END AS tile, value, q FROM events JOIN bounds USING (event_type))
    SELECT event_type, CAST(tile AS BIGINT) AS tile, count(*) AS rows,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value, round(min(q[1]), 6) AS q1,
      round(min(q[2]), 6) AS q2, round(min(q[3]), 6) AS q3 FROM tiled GROUP BY 1, 2"""


def _quartiles(t: Tables, **options) -> DataFrame:
    bounds = selection.quantiles(t.events, ["event_type"], "value", school.QUARTILES, **options)
    tiled = t.events.join(windows.broadcast_if_small(bounds), "event_type").withColumn("tile", school.quartile_tile(F.col("value")))
    result = tiled.groupBy("event_type", F.col("tile").cast("bigint").alias("tile")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(money("value")).alias("value"),
        *[F.round(F.min(q), 6).alias(q) for q in school.QUARTILES],
    )
    return doubles(result, "value")


@query("quartile_tiles", _QUARTILES)
def quartile_tiles(t: Tables) -> DataFrame:
    return _quartiles(t)


@query("quartile_tiles_sliced", _QUARTILES)
def quartile_tiles_sliced(t: Tables) -> DataFrame:
    return _quartiles(t, rows_per_slice=2000)


_SUBJECTS = ("English", "Maths", "Science")


def _feeds(t: Tables) -> tuple[DataFrame, DataFrame]:
    subject = F.posexplode(F.array(*[F.lit(s) for s in _SUBJECTS]))
    base = t.customer.select(
        "c_custkey", F.col("c_mktsegment").alias("first_name"), F.lower("c_name").alias("last_name"),
        subject.alias("i", "subject"),
    ).withColumn("grade_no", (_key() * 3 + F.col("i") * 5) % 7)
    east = base.where("c_custkey % 2 = 0").select(
        F.concat(F.lit("East"), _key().cast("string")).alias("student_id"), "first_name", "last_name",
        F.date_format(_born(), "EEEE, d MMMM, yyyy").alias("date_of_birth"), "subject",
        _pick(F.col("grade_no"), "A", "B", "C", "D", "E", "F", "U").alias("grade"),
    )
    west = base.where("c_custkey % 2 = 1").select(
        F.concat(_key().cast("string"), F.lit("-West")).alias("student_id"), "first_name", "last_name",
        F.date_format(_born(), "dd/MM/yyyy").alias("date_of_birth"), "subject",
        (F.col("grade_no") + 1).cast("string").alias("grade"),
    )
    return east, west


_SQL_GRADE = """list_extract(CASE WHEN c_custkey % 2 = 0 THEN ['A','B','C','D','E','F','U'] ELSE ['A','B','C','D','E','F','F'] END,
      CAST((c_custkey * 3 + i * 5) % 7 AS INTEGER) + 1)"""
_FEEDS = f"""
    WITH marks AS (
      SELECT *, {_SQL_GRADE} AS g FROM customer, (SELECT unnest([0, 1, 2]) AS i)),
    scored AS (SELECT *, CASE g WHEN 'A' THEN 50 WHEN 'B' THEN 40 WHEN 'C' THEN 30 WHEN 'D' THEN 20
      WHEN 'E' THEN 10 ELSE 0 END AS pts FROM marks)"""


@query(
    "combine_feeds",
    _FEEDS + f"""
    SELECT c_custkey AS student_id, c_mktsegment || ' ' || upper(c_name) AS full_name,
      {_SQL_BORN} AS date_of_birth, CAST(sum(pts) AS BIGINT) AS score,
      CASE WHEN c_custkey % 2 = 0 THEN 'East' ELSE 'West' END AS region, min(g) FILTER (i = 0) AS english,
      min(g) FILTER (i = 1) AS maths, min(g) FILTER (i = 2) AS science, min(n_name) AS school_name
    FROM scored JOIN nation ON c_nationkey = n_nationkey GROUP BY c_custkey, c_mktsegment, c_name""",
)
def combine_feeds(t: Tables) -> DataFrame:
    schools = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        _key().cast("string").alias("student_id"), F.col("n_name").alias("school_name")
    )
    return longs(school.combine_feeds(*_feeds(t), schools, _SUBJECTS), "student_id", "score")


@query(
    "grade_lists",
    _FEEDS + """
    SELECT c_custkey AS student_id, string_agg(list_extract(['English','Maths','Science'], CAST(i AS INTEGER) + 1)
      || '=' || g, ',' ORDER BY i) AS sub_grade FROM scored GROUP BY 1""",
)
def grade_lists(t: Tables) -> DataFrame:
    east, west = _feeds(t)
    marks = school.east_feed(east).unionByName(school.west_feed(west))
    lists = school.grade_lists(marks, "student_id")
    shown = F.transform("sub_grade", lambda p: F.concat_ws("=", p["subject"], p["grade"]))
    return longs(lists.select("student_id", F.array_join(shown, ",").alias("sub_grade")), "student_id")


_ADMIT_KEYS = f"""
    {_sql_pick("c_custkey", "A", "B", "C")} AS maths, {_sql_pick("c_custkey // 3", "A", "B")} AS english,
    {_sql_pick("c_custkey // 5", "A", "B", "D")} AS science"""


@query(
    "region_admission",
    f"""
    WITH applicants AS (
      SELECT c_custkey AS student_id, chr(CAST(65 + c_custkey % 26 AS INTEGER)) || 'nn ' || chr(CAST(65 + c_custkey // 26 % 26 AS INTEGER)) || 'ee ' || CAST(c_custkey AS VARCHAR) AS full_name, n_name AS school_name,
        DATE '1001-01-01' + CAST(c_custkey % 2000000 AS INTEGER) AS date_of_birth, {_ADMIT_KEYS}, CASE WHEN n_regionkey % 2 = 0 THEN 'EAST' ELSE 'West' END AS region,
        CAST(c_custkey * 7 % 16 AS BIGINT) * 10 AS grade_score, c_mktsegment AS subject_selection,
        CAST(c_custkey * 31 % 57 AS DOUBLE) / 2 AS distance
      FROM customer JOIN nation ON c_nationkey = n_nationkey),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY subject_selection, region
        ORDER BY grade_score DESC, distance, student_id) AS r FROM applicants),
    accepted AS (SELECT * FROM ranked WHERE r <= CASE WHEN lower(region) = 'east' THEN 15 ELSE 5 END),
    shares AS (
      SELECT region, school_name, {sql_ratio("count(*)", "sum(count(*)) OVER (PARTITION BY region)", 2)} AS s
      FROM accepted GROUP BY 1, 2),
    status AS (
      SELECT region, school_name, CASE WHEN s = max(s) OVER (PARTITION BY region) THEN 'High Performing'
        WHEN s = min(s) OVER (PARTITION BY region) THEN 'Low Performing' ELSE 'Average Performing' END AS school_status
      FROM shares)
    SELECT student_id, full_name, date_of_birth, region, school_name, english, science, maths, grade_score,
      subject_selection, school_status FROM accepted JOIN status USING (region, school_name)""",
)
def region_admission(t: Tables) -> DataFrame:
    marks = [
        _pick(_key(), "A", "B", "C").alias("maths"), _pick(F.floor(_key() / 3), "A", "B").alias("english"),
        _pick(F.floor(_key() / 5), "A", "B", "D").alias("science"),
    ]
    base = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    first, second = F.char(65 + _key() % 26), F.char(65 + F.floor(_key() / 26) % 26)
    name = F.concat(first, F.lit("nn "), second, F.lit("ee "), _key().cast("string"))
    # the six columns of the key stay unique for many customers
    born = F.date_add(F.lit("1001-01-01").cast("date"), (_key() % 2_000_000).cast("int"))
    students = base.select(
        name.alias("full_name"), F.col("n_name").alias("school_name"), born.alias("date_of_birth"), *marks
    )
    extra = base.select(
        F.concat(first, second).alias("initials"), F.col("n_name").alias("school_name"),
        born.alias("date_of_birth"), *marks, _key().alias("student_id"),
        F.when(F.col("n_regionkey") % 2 == 0, "EAST").otherwise("West").alias("region"),
        (_key() * 7 % 16 * 10).alias("grade_score"), F.col("c_mktsegment").alias("subject_selection"),
        ((_key() * 31 % 57).cast("double") / 2).alias("distance_from_school_(miles)"),
        F.lit("address").alias("home_address"), F.col("n_nationkey").alias("school_id"),
    )
    return longs(school.admissions(students, extra), "grade_score")


_TRACK = """
    WITH runs AS (
      SELECT c_custkey AS id, c_name AS first_name, CAST(8 + c_custkey % 3 AS BIGINT) AS age,
        CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
        list_extract(['100m','200m','800m'], CAST(o_orderkey % 3 AS INTEGER) + 1) AS track_event,
        CAST(20 + (o_orderkey * 37 % 1700) AS DOUBLE) / 100 * (1 + o_orderkey % 3) AS time
      FROM orders JOIN customer ON o_custkey = c_custkey),
    kept AS (
      SELECT *, CAST(15 + (age - 8) + CASE gender WHEN 'F' THEN 1 ELSE 0 END AS DOUBLE) * CAST(right(left(track_event, 1), 1) AS DOUBLE) / 1.5
        AS benchmark FROM runs)
    SELECT id, first_name, age, gender, track_event, time, benchmark,
      CAST(dense_rank() OVER (PARTITION BY track_event ORDER BY time) AS BIGINT) AS rank
    FROM kept WHERE time < benchmark AND NOT (track_event = '200m' AND time < 25)"""


def _track(t: Tables, **options) -> DataFrame:
    age = (8 + _key() % 3).alias("age")
    gender = F.when(_key() % 2 == 0, "F").otherwise("M").alias("gender")
    order = F.col("o_orderkey")
    students = t.customer.select(_key().alias("id"), F.col("c_name").alias("first_name"), age, gender)
    times = t.orders.select(
        F.col("o_custkey").alias("id"), _pick(order, "100m", "200m", "800m").alias("track_event"),
        ((20 + order * 37 % 1700).cast("double") / 100 * (1 + order % 3)).alias("time"),
    )
    groups = t.customer.select(age, gender).distinct()
    events = F.explode(F.array(*[F.lit(e) for e in ("100m", "200m", "800m")]))
    base = (15 + (F.col("age") - 8) + F.when(F.col("gender") == "F", 1).otherwise(0)).cast("double")
    limits = groups.withColumn("event", events).withColumn(
        "benchmark", base * F.substring("event", 1, 1).cast("double") / 1.5
    )
    result = school.track_qualifiers(students, times, limits, **options)
    return longs(result, "rank")


@query("benchmark_filter", _TRACK)
def benchmark_filter(t: Tables) -> DataFrame:
    return _track(t)


@query("benchmark_filter_sliced", _TRACK)
def benchmark_filter_sliced(t: Tables) -> DataFrame:
    return _track(t, rows_per_slice=400)
