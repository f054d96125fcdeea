"""Employee record jobs over customers and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spindrift.catalog.base import Tables, longs, query
from spindrift.operators import joins
from spindrift.plans import people


def _key() -> Column:
    return F.col("c_custkey")


def _blank(c, when):
    return F.when(~when, c)


def _records(t: Tables) -> tuple[DataFrame, DataFrame]:
    guid = F.concat(F.lit("g-"), _key().cast("string"))
    dimension = t.customer.select(
        _blank(_key(), _key() % 5 == 0).alias("employee_id"), _blank(guid, _key() % 7 == 0).alias("guid"),
        F.col("c_name").alias("name"),
    )
    order, owner = F.col("o_orderkey"), F.col("o_custkey")
    monthly = t.orders.select(
        _blank(owner, order % 3 == 0).alias("employee_id"),
        _blank(F.concat(F.lit("g-"), owner.cast("string")), order % 4 == 1).alias("guid"),
        order.alias("dc_nbr"), F.last_day(F.col("o_orderdate").cast("date")).alias("month_end_date"),
    )
    return dimension, monthly


_PAIRS = """
    WITH dim AS (
      SELECT CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS e,
             CASE WHEN c_custkey % 7 <> 0 THEN 'g-' || CAST(c_custkey AS VARCHAR) END AS g, c_name AS name FROM customer),
    mon AS (
      SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS e,
             CASE WHEN o_orderkey % 4 <> 1 THEN 'g-' || CAST(o_custkey AS VARCHAR) END AS g,
             o_orderkey AS dc_nbr, last_day(CAST(o_orderdate AS DATE)) AS month_end_date FROM orders),
    pairs AS (
      SELECT e, g FROM dim WHERE e IS NOT NULL AND g IS NOT NULL
      UNION SELECT e, g FROM mon WHERE e IS NOT NULL AND g IS NOT NULL)"""


@query(
    "id_repair_dimension",
    _PAIRS + """
    SELECT p.e AS employee_id, coalesce(d.g, p.g) AS guid, name
    FROM dim d LEFT JOIN pairs l ON d.g = l.g JOIN pairs p ON coalesce(l.e, d.e) = p.e""",
)
def id_repair_dimension(t: Tables) -> DataFrame:
    return people.repair_ids(*_records(t))[0]


@query(
    "id_repair_monthly",
    _PAIRS + """
    SELECT p.e AS employee_id, coalesce(d.g, p.g) AS guid, dc_nbr, month_end_date
    FROM mon d LEFT JOIN pairs l ON d.g = l.g JOIN pairs p ON coalesce(l.e, d.e) = p.e""",
)
def id_repair_monthly(t: Tables) -> DataFrame:
    return people.repair_ids(*_records(t))[1]


def _day(span: int, first: int):
    return F.concat_ws("/", 1 + _key() % 28, 1 + _key() % 12, first + _key() % span)


def _employees(t: Tables, **options) -> DataFrame:
    dimension = t.customer.select(
        _key().alias("employee_id"), F.concat(F.lit("g-"), _key().cast("string")).alias("guid"),
        F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"),
        F.col("c_nationkey").alias("nationality"), F.lit("x").alias("gender"), F.lit("a@b").alias("email"),
        F.when(_key() % 50 != 0, _day(80, 1930)).alias("date_of_birth"),
        _day(30, 1990).alias("hire_date"), F.when(_key() % 4 == 0, _day(3, 2021)).alias("leave_date"),
    )
    key = F.col("r_regionkey")
    bands = t.region.select(
        F.col("r_name").alias("generation"),
        F.when(key > 0, 1940 + key * 15).cast("int").alias("start_year"),
        F.when(key < 4, 1954 + key * 15).cast("int").alias("end_year"),
    )
    return people.generations(dimension, bands, **options)


_EMPLOYEES = """
    WITH dim AS (
      SELECT *, CASE WHEN c_custkey % 50 <> 0 THEN make_date(CAST(1930 + c_custkey % 80 AS INTEGER),
          CAST(1 + c_custkey % 12 AS INTEGER), CAST(1 + c_custkey % 28 AS INTEGER)) END AS born,
        make_date(CAST(1990 + c_custkey % 30 AS INTEGER), CAST(1 + c_custkey % 12 AS INTEGER),
          CAST(1 + c_custkey % 28 AS INTEGER)) AS hired,
        CASE WHEN c_custkey % 4 = 0 THEN make_date(CAST(2021 + c_custkey % 3 AS INTEGER),
          CAST(1 + c_custkey % 12 AS INTEGER), CAST(1 + c_custkey % 28 AS INTEGER)) END AS gone FROM customer),
    bands AS (
      SELECT CASE r_regionkey WHEN 0 THEN r_name || ' (born in or before ' || CAST(1954 AS VARCHAR) || ')'
          WHEN 4 THEN r_name || ' (born in or after ' || CAST(2000 AS VARCHAR) || ')'
          ELSE r_name || ' (' || CAST(1940 + r_regionkey * 15 AS VARCHAR) || '-'
            || CAST(1954 + r_regionkey * 15 AS VARCHAR) || ')' END AS gen_name,
        CASE WHEN r_regionkey > 0 THEN 1940 + r_regionkey * 15 {low} END AS lo,
        CASE WHEN r_regionkey < 4 THEN 1954 + r_regionkey * 15 {high} END AS hi FROM region),
    employees AS (
      SELECT c_custkey AS employee_id, 'g-' || CAST(c_custkey AS VARCHAR) AS guid,
        coalesce(gen_name, 'Not Provided') AS gen_name, c_name AS first_name, c_mktsegment AS last_name,
        c_nationkey AS nationality, 'x' AS gender, 'a@b' AS email, hired AS hire_date, gone AS leave_date,
        born AS date_of_birth
      FROM dim LEFT JOIN bands ON year(born) BETWEEN lo AND hi)"""


@query("range_bands", _EMPLOYEES.format(low="", high="") + " SELECT * FROM employees")
def range_bands(t: Tables) -> DataFrame:
    return _employees(t)


@query("range_bands_open", _EMPLOYEES.format(low="ELSE 0", high="ELSE 9999") + " SELECT * FROM employees")
def range_bands_open(t: Tables) -> DataFrame:
    return _employees(t, open_ended=True)


@query(
    "age_bands",
    _EMPLOYEES.format(low="", high="") + """
    SELECT o_orderkey AS dc_nbr, last_day(CAST(o_orderdate AS DATE)) AS month_end_date, employee_id, guid, hire_date,
      leave_date, CASE WHEN a < 20 THEN 'Under 20 years' WHEN a >= 70 THEN '70+ years'
        WHEN a IS NULL THEN 'Not Provided'
        ELSE CAST(a // 5 * 5 AS VARCHAR) || '-' || CAST(a // 5 * 5 + 4 AS VARCHAR) || ' years' END AS age_bucket
    FROM (SELECT *, year(o_orderdate) - year(date_of_birth) AS a FROM orders JOIN employees ON o_custkey = employee_id)""",
)
def age_bands(t: Tables) -> DataFrame:
    monthly = t.orders.select(
        F.col("o_orderkey").alias("dc_nbr"),
        F.last_day(F.col("o_orderdate").cast("date")).alias("month_end_date"),
        F.col("o_custkey").alias("employee_id"),
    )
    return people.monthly_age_bands(monthly, _employees(t))


@query(
    "range_bins",
    """
    WITH bands AS (
      SELECT n_nationkey AS band, n_nationkey * 20000 AS lo, n_nationkey * 20000 + 30000 AS hi FROM nation)
    SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS price, CAST(band AS BIGINT) AS band
    FROM orders LEFT JOIN bands ON CAST(floor(o_totalprice) AS BIGINT) BETWEEN lo AND hi""",
)
def range_bins(t: Tables) -> DataFrame:
    bands = t.nation.select(
        F.col("n_nationkey").cast("bigint").alias("band"), (F.col("n_nationkey") * 20000).alias("lo"),
        (F.col("n_nationkey") * 20000 + 30000).alias("hi"),
    )
    facts = t.orders.select("o_orderkey", F.floor("o_totalprice").alias("price"))
    return joins.range_left(facts, bands, "price", "lo", "hi").drop("lo", "hi")


@query(
    "range_any_width",
    """
    WITH bands AS (
      SELECT 's' || CAST(s_suppkey AS VARCHAR) AS band, CAST(floor(s_acctbal * 100) AS BIGINT) AS lo,
        CAST(floor(s_acctbal * 100) AS BIGINT) + s_suppkey % 7 * 1000 AS hi FROM supplier
      UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), CAST(r_regionkey AS BIGINT) * -1000000000,
        CAST(r_regionkey AS BIGINT) * 1000000000 FROM region)
    SELECT c_custkey, CAST(floor(c_acctbal * 100) AS BIGINT) AS cents, band
    FROM customer LEFT JOIN bands ON CAST(floor(c_acctbal * 100) AS BIGINT) BETWEEN lo AND hi""",
)
def range_any_width(t: Tables) -> DataFrame:
    start = F.floor(F.col("s_acctbal") * 100)
    narrow = t.supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("band"), start.alias("lo"),
                               (start + F.col("s_suppkey") % 7 * 1000).alias("hi"))
    far = F.col("r_regionkey").cast("bigint") * 1_000_000_000
    wide = t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("band"), (-far).alias("lo"), far.alias("hi"))
    facts = t.customer.select("c_custkey", F.floor(F.col("c_acctbal") * 100).alias("cents"))
    return joins.range_left(facts, narrow.unionByName(wide), "cents", "lo", "hi").drop("lo", "hi")
