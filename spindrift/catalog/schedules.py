"""Calendar, matrix and place jobs."""

from __future__ import annotations

from calendar import month_name

from pyspark.sql import Column, DataFrame, functions as F

from spindrift.catalog.base import Tables, doubles, longs, money, query, sql_ratio
from spindrift.operators import calendar, joins, reshape
from spindrift.plans import schedules


def _day() -> Column:
    return F.col("o_orderdate").cast("date")


@query(
    "reporting_calendar",
    """
    WITH days AS (
      SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n,
             max(CASE WHEN day(o_orderdate) IN (1, 25) THEN 'holiday' END) AS h FROM orders GROUP BY 1),
    shifted AS (
      SELECT *, min(CASE WHEN h IS NULL AND isodow(d) < 6 THEN d END)
        OVER (ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r FROM days),
    home AS (SELECT r, sum(n) AS customers FROM shifted WHERE r IS NOT NULL GROUP BY 1),
    labelled AS (
      SELECT *, strftime(CASE WHEN r < max(r) OVER (PARTITION BY date_trunc('month', r)) THEN r
                         ELSE r + INTERVAL 1 MONTH END, '%B-%Y') AS m FROM home),
    numbered AS (
      SELECT *, row_number() OVER (PARTITION BY m ORDER BY r) AS k FROM labelled WHERE m NOT LIKE '%2002%'),
    away AS (
      SELECT CAST(o_orderdate AS DATE) AS r, count(*) AS roi, strftime(min(o_orderdate), '%b-%y') AS rm
      FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
    joined AS (SELECT coalesce(n.r, a.r) AS r, m, k, customers, roi, rm FROM numbered n FULL JOIN away a ON n.r = a.r),
    moved AS (
      SELECT *, min(CASE WHEN k IS NOT NULL THEN r END)
        OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS slot FROM joined)
    SELECT max(m) AS reported_month, slot AS reported_day, CAST(max(k) AS BIGINT) AS row_number,
      CAST(coalesce(sum(customers), 0) AS BIGINT) AS customers, CAST(coalesce(sum(roi), 0) AS BIGINT) AS roi_customers,
      max(rm) AS roi_reporting_month,
      CASE WHEN max(rm) IS NULL OR max(m) IS NULL OR substr(max(m), 1, 3) <> substr(max(rm), 1, 3)
        THEN 'X' END AS misaligned_flag
    FROM moved GROUP BY slot""",
)
def reporting_calendar(t: Tables) -> DataFrame:
    customers = t.orders.select(_day().alias("date"), F.lit(1).alias("new_customers"))
    holidays = t.orders.select(_day().alias("date"), F.lit("holiday").alias("bank_holiday")).where(
        F.dayofmonth("date").isin(1, 25)
    )
    other = t.orders.where("o_orderstatus = 'P'").select(
        _day().alias("reported_day"), F.date_format("o_orderdate", "MMM-yy").alias("roi_reporting_month"),
        F.lit(1).alias("roi_new_customers"),
    )
    return longs(schedules.reporting_alignment(holidays, customers, other, last_year=2001), "row_number")


@query(
    "holiday_sheet",
    """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, 'Holiday ' || CAST(o_orderstatus AS VARCHAR) AS bank_holiday
    FROM orders WHERE day(o_orderdate) IN (1, 25)""",
)
def holiday_sheet(t: Tables) -> DataFrame:
    listed = t.orders.where(F.dayofmonth("o_orderdate").isin(1, 25)).select(_day().alias("d"), "o_orderstatus").distinct()
    first = listed.groupBy(F.year("d").alias("y")).agg(F.min(F.struct("d", "o_orderstatus")).alias("first"))
    sheet = listed.withColumn("y", F.year("d")).join(first, "y").select(
        (F.unix_date("d") * 1000 + F.ascii("o_orderstatus")).alias("row"),
        F.when(F.struct("d", "o_orderstatus") == F.col("first"), F.col("y").cast("string")).alias("year"),
        F.date_format("d", "dd-MMM").alias("date"),
        F.concat(F.lit("Holiday "), "o_orderstatus").alias("bank_holiday"),
    )
    return schedules.bank_holidays(sheet)


@query(
    "matrix_labels",
    """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE year(o_orderdate) <= 2023""",
)
def matrix_labels(t: Tables) -> DataFrame:
    days = [(month, day) for month in range(1, 13) for day in range(1, 32)]
    cells = [f"column_{4 + i}" for i in range(len(days))]
    slot = (F.month("d") - 1) * 31 + F.dayofmonth("d") + 3
    marked = t.orders.select(_day().alias("d")).distinct().select(
        F.year("d").alias("y"), F.concat(F.lit("column_"), slot.cast("string")).alias("c")
    )
    years = reshape.to_wide(marked, ["y"], "c", cells, F.col("y").cast("string"), coarse=True)
    body = years.select(
        F.lit(None).cast("string").alias("column_2"), F.col("y").cast("string").alias("column_3"), *cells
    )
    names = [" ".join(month_name[month]) if day == 1 else None for month, day in days]
    above = [
        ("E x a m p l e", None, *[None] * len(days)),
        (None, None, *[str(day) for _, day in days]),
        (None, None, *names),
    ]
    labels = t.spark.createDataFrame(above, body.schema)
    return schedules.matrix_dates(body.unionByName(labels))


_ASOF = """
    SELECT v.event_id, v.user_id, CAST(v.ts AS DATE) AS day,
      (SELECT min(CAST(p.ts AS DATE)) FROM events p WHERE p.event_type = 'purchase'
         AND p.user_id = v.user_id AND CAST(p.ts AS DATE) >= CAST(v.ts AS DATE)) AS bought
    FROM events v WHERE v.event_type = 'view'"""


def _asof(t: Tables, **options) -> DataFrame:
    day = F.col("ts").cast("date")
    views = t.events.where("event_type = 'view'").select("event_id", "user_id", day.alias("day"))
    bought = t.events.where("event_type = 'purchase'").select("user_id", day.alias("bought"))
    return joins.asof_forward(views, bought, ["user_id"], "day", "bought", **options)


@query("asof_forward", _ASOF)
def asof_forward(t: Tables) -> DataFrame:
    return _asof(t)


@query("asof_forward_sliced", _ASOF)
def asof_forward_sliced(t: Tables) -> DataFrame:
    return _asof(t, rows_per_slice=25)


@query(
    "moon_to_holiday",
    """
    WITH moons AS (
      SELECT DISTINCT CAST(o_orderdate AS DATE) AS m, CASE o_orderstatus
        WHEN 'F' THEN 'total lunar eclipse takes place' WHEN 'O' THEN 'blue moon' END AS note
      FROM orders),
    holidays AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS h FROM orders WHERE o_orderstatus = 'P'),
    ahead AS (SELECT m, note, (SELECT min(h) FROM holidays WHERE h >= m) AS h FROM moons),
    gaps AS (SELECT *, h - m AS gap, min(h - m) OVER (PARTITION BY h) AS least FROM ahead WHERE h IS NOT NULL)
    SELECT CAST(gap AS BIGINT) AS days_between, count(*) AS num_occurrences, max(note) AS full_moon_notes,
      CAST(min(year(m)) AS BIGINT) AS fm_date, CAST(max(year(h)) AS BIGINT) AS easter_sunday
    FROM gaps WHERE gap = least GROUP BY 1""",
)
def moon_to_holiday(t: Tables) -> DataFrame:
    mark = F.when(F.col("o_orderstatus") == "F", "04:12 **").when(F.col("o_orderstatus") == "O", "23:01+").otherwise("11:00")
    sheet = t.orders.select(
        F.date_format("o_orderdate", "EEEE").alias("day"),
        F.concat(F.lit(" "), F.date_format("o_orderdate", "d MMMM yyyy")).alias("date"), mark.alias("time"),
    )
    holidays = t.orders.where("o_orderstatus = 'P'").select(_day().alias("date")).distinct()
    result = schedules.moon_to_holiday(schedules.moon_notes(sheet).distinct(), holidays)
    return longs(result, "days_between", "fm_date", "easter_sunday")


_GROWTH = f"""
    WITH pop AS (
      SELECT o_custkey, CAST(sum(floor(o_totalprice)) FILTER (year(o_orderdate) = 1996) AS BIGINT) AS a,
             CAST(sum(floor(o_totalprice)) FILTER (year(o_orderdate) = 2000) AS BIGINT) AS b
      FROM orders GROUP BY 1),
    dense AS (
      SELECT 'Country ' || CAST(o_custkey AS VARCHAR) AS country_name,
        {sql_ratio("a", "(1000 + o_custkey % 500)", 2)} AS "1996", {sql_ratio("b", "(1000 + o_custkey % 500)", 2)} AS "2000"
      FROM pop),
    grown AS (SELECT *, round("2000" / "1996" - 1, 2) AS population_growth_pct FROM dense),
    ranked AS (
      SELECT *, CAST(dense_rank() OVER (ORDER BY population_growth_pct DESC NULLS LAST) AS BIGINT) AS rank_by_growth_rate,
        CAST(dense_rank() OVER (ORDER BY "2000" DESC NULLS LAST) AS BIGINT) AS rank_by_max_year_pop_density FROM grown)"""


def _growth(t: Tables) -> tuple[DataFrame, DataFrame]:
    name = F.concat(F.lit("Country "), F.col("o_custkey").cast("string"))
    price = F.floor("o_totalprice")
    population = t.orders.groupBy("o_custkey").agg(
        *[F.sum(F.when(F.year("o_orderdate") == y, price)).alias(str(y)) for y in range(1995, 2002)]
    ).select(F.concat(F.lit(" "), name, F.lit(" ")).alias("Country Name"), *[str(y) for y in range(1995, 2002)])
    area = (1000 + F.col("c_custkey") % 500).cast("int")
    sheet = t.customer.select(
        F.concat(F.lit("Country "), F.col("c_custkey").cast("string"), F.lit(" [note]")).alias("Country / Dependency"),
        F.concat(F.format_number(area, 0), F.lit(" (9,999)")).alias("Total in km2 (mi2)"),
    )
    return schedules.density_growth(population, schedules.land_sizes(sheet), "1996", "2000")


@query(
    "growth_topk",
    _GROWTH + """ SELECT country_name, "1996", "2000", population_growth_pct, rank_by_growth_rate
    FROM ranked ORDER BY rank_by_growth_rate, country_name LIMIT 10""",
)
def growth_topk(t: Tables) -> DataFrame:
    return longs(_growth(t)[0], "rank_by_growth_rate")


@query(
    "density_topk",
    _GROWTH + """ SELECT country_name, "1996", "2000", population_growth_pct, rank_by_max_year_pop_density
    FROM ranked ORDER BY rank_by_max_year_pop_density, country_name LIMIT 10""",
)
def density_topk(t: Tables) -> DataFrame:
    return longs(_growth(t)[1], "rank_by_max_year_pop_density")


_WALKS = """
    WITH rooms AS (
      SELECT n_nationkey AS k, CAST((n_nationkey // 5 + 1) * 100 + n_nationkey % 5 + 1 AS BIGINT) AS room FROM nation),
    talks AS (
      SELECT room AS "room_B", CASE room % 5 WHEN 0 THEN 'AP' WHEN 1 THEN 'JM' ELSE 'TB' END AS speaker_initials,
        CASE room % 3 WHEN 0 THEN 'Prep' WHEN 1 THEN 'Server' ELSE 'Desktop' END AS subject FROM rooms
      WHERE room // 100 = 2),
    sessions AS (
      SELECT s_suppkey AS session_number, CASE s_suppkey % 3 WHEN 0 THEN 'AP' WHEN 1 THEN 'JM' ELSE 'TB' END AS speaker_initials,
        CASE s_suppkey % 4 WHEN 0 THEN 'Prep' WHEN 1 THEN 'Server' WHEN 2 THEN 'Desktop' ELSE 'community' END AS subject
      FROM supplier WHERE s_suppkey % 5 <> 0),
    pairs AS (
      SELECT a.room AS "room_A", b.room AS "room_B", CAST((a.k - b.k) * 37 + 13 * b.k AS BIGINT) AS distance_in_meters
      FROM rooms a JOIN rooms b ON a.k > b.k {mirror})
    SELECT "room_A", "room_B", distance_in_meters, ceil(distance_in_meters / 1.2 / 60) AS mins_to_walk,
      speaker_initials, subject, session_number
    FROM pairs JOIN talks USING ("room_B") JOIN sessions USING (speaker_initials, subject)"""
_MIRROR = """UNION ALL SELECT b.room, a.room, CAST((a.k - b.k) * 37 + 13 * b.k AS BIGINT)
      FROM rooms a JOIN rooms b ON a.k > b.k"""


def _walks(t: Tables, **options) -> DataFrame:
    key = F.col("s_suppkey")
    speakers = F.array(F.lit("Andy Pick"), F.lit("Jenny Martin"), F.lit("Tom Brown"))
    topics = F.array(*[F.lit(x) for x in ("Use Prep", "In Server you", "On Desktop", "For a community")])
    sessions = t.supplier.select(
        key.alias("session_number"),
        F.concat(
            F.element_at(speakers, (key % 3 + 1).cast("int")), F.lit(": "),
            F.element_at(topics, (key % 4 + 1).cast("int")),
            F.when(key % 5 == 0, " learn").otherwise(" dedup things"),
        ).alias("description"),
    )
    small = t.nation.select(
        F.col("n_nationkey").alias("k"),
        (F.floor(F.col("n_nationkey") / 5) * 100 + 100 + F.col("n_nationkey") % 5 + 1).alias("number"),
    )
    who = F.when(F.col("number") % 5 == 0, "AP").when(F.col("number") % 5 == 1, "JM").otherwise("TB")
    what = F.when(F.col("number") % 3 == 0, "Prep").when(F.col("number") % 3 == 1, "Server").otherwise("Desktop")
    rooms = reshape.to_wide(
        small.select(
            (F.col("number") % 100).alias("room"), F.floor(F.col("number") / 100).alias("f"),
            F.concat(F.lit("Some title - "), who, F.lit(" on "), what).alias("shown"),
        ),
        ["room"], "f", [1, 2, 3, 4, 5], "shown",
    ).toDF("room", *[f"floor_{i}" for i in range(1, 6)])
    distances = small.select(
        F.col("number").cast("string").alias("room"),
        *[
            F.when(F.col("k") == j, F.lit(0)).when(F.col("k") > j, (F.col("k") - j) * 37 + 13 * j)
            .cast("string").alias(str((j // 5 + 1) * 100 + j % 5 + 1))
            for j in range(25)
        ],
    )
    walks = schedules.walking_times(sessions, rooms, distances, **options)
    return longs(walks, "room_A", "room_B", "distance_in_meters")


@query("matrix_join", _WALKS.format(mirror=""))
def matrix_join(t: Tables) -> DataFrame:
    return _walks(t)


@query("matrix_join_symmetric", _WALKS.format(mirror=_MIRROR) + ' WHERE "room_A" = 101')
def matrix_join_symmetric(t: Tables) -> DataFrame:
    return _walks(t, room=101, symmetric=True)


@query(
    "order_calendar",
    """
    WITH days AS (
      SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '1996-12-31', INTERVAL 1 DAY)) AS DATE) AS date)
    SELECT date, CAST(count(o_orderkey) AS BIGINT) AS orders,
           CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS value
    FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = date GROUP BY 1""",
)
def order_calendar(t: Tables) -> DataFrame:
    in_range = F.col("o_orderdate").between("1996-01-01", "1996-12-31 23:59:59.999999")
    daily = t.orders.where(in_range).groupBy(_day().alias("date")).agg(
        F.count("o_orderkey").alias("orders"), F.sum(money("o_totalprice")).alias("value")
    )
    days = calendar.date_table(t.spark, "1996-01-01", "1996-12-31")
    return doubles(days.join(daily, "date", "left").na.fill(0, ["orders", "value"]), "value")
