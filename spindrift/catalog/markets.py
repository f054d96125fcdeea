"""Market, shop and cost jobs over lineitem, orders and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spindrift.catalog.base import Tables, doubles, longs, money, query, sql_ratio
from spindrift.functions.cases import lookup
from spindrift.operators import reshape
from spindrift.plans import markets


@query(
    "topn_bucket",
    """
    WITH priced AS (
      SELECT make_date(2023, CAST(month(l_shipdate) AS INTEGER), 1) AS file_date, l_returnflag AS sector,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS p,
        CAST((l_partkey % 997) + 0.25 AS DECIMAL(18,2))
          * CASE l_suppkey % 3 WHEN 0 THEN 1000000000 WHEN 1 THEN 1000000 ELSE 1 END AS cap
      FROM lineitem WHERE l_linenumber <> 7),
    classed AS (
      SELECT *, CASE WHEN p < 25000 THEN 'Low' WHEN p < 50000 THEN 'Medium' WHEN p < 75000 THEN 'High'
                     ELSE 'Very High' END AS pc,
        CASE WHEN cap < 100000000 THEN 'Small' WHEN cap < 1000000000 THEN 'Medium'
             WHEN cap < 100000000000 THEN 'Large' ELSE 'Huge' END AS cc FROM priced),
    ranked AS (
      SELECT *, dense_rank() OVER (PARTITION BY file_date, cc, pc ORDER BY p DESC) AS r FROM classed)
    SELECT file_date, sector, CAST(p AS DOUBLE) AS purchase_price, CAST(cap AS DOUBLE) AS market_cap,
      pc AS purchase_price_category, cc AS market_cap_category, CAST(r AS BIGINT) AS purchase_price_rank
    FROM ranked WHERE r <= 5""",
)
def topn_bucket(t: Tables) -> DataFrame:
    suffix = F.element_at(F.array(F.lit("B"), F.lit("M"), F.lit("")), (F.col("l_suppkey") % 3 + 1).cast("int"))
    cap = F.concat(F.lit("$"), (F.col("l_partkey") % 997).cast("string"), F.lit(".25"), suffix)
    trades = t.lineitem.select(
        F.col("l_returnflag").alias("sector"),
        F.when(F.col("l_linenumber") == 7, "n/a").otherwise(cap).alias("market_cap"),
        F.concat(F.lit("$"), money("l_extendedprice").cast("string")).alias("purchase_price"),
        F.nullif(F.month("l_shipdate"), F.lit(1)).alias("file_month"),
    )
    return longs(
        doubles(markets.top_purchases(trades), "purchase_price", "market_cap"), "purchase_price_rank"
    )


@query(
    "moving_avg_recent",
    f"""
    WITH trades AS (
      SELECT l_suppkey % 11 AS sector, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS BIGINT) AS m,
             l_orderkey * 8 + l_linenumber AS id, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem),
    ordered AS (
      SELECT *, dense_rank() OVER (PARTITION BY sector ORDER BY m, id) AS o,
        dense_rank() OVER (PARTITION BY sector ORDER BY m DESC, id DESC) AS recent,
        sum(p) OVER w AS s, count(p) OVER w AS n
      FROM trades WINDOW w AS (PARTITION BY sector ORDER BY m, id, p ROWS 9 PRECEDING))
    SELECT sector, CAST(o AS BIGINT) AS trade_order,
      CASE WHEN n = 10 THEN {sql_ratio("s", "10", 2)} END AS "10_prev_moving_avg",
      CAST(101 - recent AS BIGINT) AS prev_trades
    FROM ordered WHERE recent <= 100""",
)
def moving_avg_recent(t: Tables) -> DataFrame:
    trades = t.lineitem.select(
        (F.col("l_suppkey") % 11).alias("sector"),
        (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("month_number"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        money("l_extendedprice").alias("purchase_price"),
    )
    return longs(markets.recent_moving_average(trades, 10), "trade_order", "prev_trades")


@query(
    "country_trade_summary",
    """
    WITH cells AS (
      SELECT rn.n_name AS reporter, rn.n_nationkey AS rk, pn.n_name AS partner, pn.n_nationkey AS pk,
        l_linestatus AS product_categories,
        CASE l_returnflag WHEN 'A' THEN 'Export' WHEN 'N' THEN 'Import' ELSE 'Other' END AS indicator_type,
        make_date(CAST(year(l_shipdate) AS INTEGER), 1, 1) AS year,
        sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation rn ON s_nationkey = rn.n_nationkey
      JOIN nation pn ON pn.n_nationkey = l_partkey % 25
      GROUP BY ALL)
    SELECT partner, 'N' || CAST(rk AS VARCHAR) AS country_code, reporter, product_categories, indicator_type, year,
      CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price,
      CASE WHEN rk <> 3 THEN CAST(rk AS DOUBLE) + 0.5 END AS latitude,
      CASE WHEN rk <> 3 THEN -CAST(rk AS DOUBLE) END AS longitude,
      CASE WHEN pk IN (SELECT s_nationkey FROM supplier) THEN 'N' || CAST(pk AS VARCHAR) END AS code_partner,
      CASE WHEN pk IN (SELECT s_nationkey FROM supplier) AND pk <> 3 THEN CAST(pk AS DOUBLE) + 0.5 END AS latitude_partner,
      CASE WHEN pk IN (SELECT s_nationkey FROM supplier) AND pk <> 3 THEN -CAST(pk AS DOUBLE) END AS longitude_partner
    FROM cells WHERE indicator_type <> 'Other'""",
)
def country_trade_summary(t: Tables) -> DataFrame:
    reporter = t.nation.select(
        F.col("n_name").alias("Reporter"), F.col("n_nationkey").alias("rk"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("country_code"),
    )
    partner = t.nation.select(F.col("n_name").alias("Partner"), F.col("n_nationkey").alias("pk"))
    # a column for each year that occurs
    years = sorted(str(r[0]) for r in t.lineitem.select(F.year("l_shipdate")).distinct().na.drop().collect())
    lines = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(reporter, F.col("s_nationkey") == F.col("rk"))
        .join(partner, F.col("l_partkey") % 25 == F.col("pk"))
        .select(
            "Reporter", "Partner", F.col("l_linestatus").alias("Product categories"),
            lookup(F.col("l_returnflag"), {"A": "Export", "N": "Import"}, "Other").alias("Indicator Type"),
            "country_code", F.year("l_shipdate").cast("string").alias("year"),
            money("l_quantity").alias("Quantity"), money("l_extendedprice").alias("Price"),
        )
    )
    ids = ["Reporter", "Partner", "Product categories", "Indicator Type", "Indicator", "country_code"]
    long = reshape.to_long(
        lines, ["Reporter", "Partner", "Product categories", "Indicator Type", "country_code", "year"],
        ["Quantity", "Price"], name="Indicator", value="amount",
    )
    wide = reshape.to_wide(long, ids, "year", years, "amount", F.sum, coarse=True)
    sheet = wide.select(
        *ids, *[F.concat(F.lit("  "), F.col(f"`{y}`").cast("string"), F.lit(" ")).alias(y) for y in years]
    )
    codes = t.nation.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("ISO3 CODE"),
        F.when(
            F.col("n_nationkey") != 3,
            F.concat(F.col("n_nationkey").cast("string"), F.lit(".5, -"), F.col("n_nationkey").cast("string")),
        ).alias("geo_point_2d"),
    )
    return markets.trade_summary(sheet, codes, ["Quantity", "Price"], years)


@query(
    "dirty_map",
    f"""
    WITH cities AS (
      SELECT CASE WHEN p_partkey % 11 < 4 THEN 'London' WHEN p_partkey % 11 < 8 THEN 'Liverpool'
                  ELSE 'Manchester' END AS location,
             CAST(p_retailprice AS DECIMAL(18,2)) AS price, CAST(p_size AS DECIMAL(18,2)) AS size FROM part)
    SELECT location, {sql_ratio("sum(price)", "count(*)", 2)} AS "Price (£) per pack",
           CAST(sum(price * size) AS DOUBLE) AS revenue FROM cities GROUP BY 1""",
)
def dirty_map(t: Tables) -> DataFrame:
    spellings = [s for variants in markets.CITY_SPELLINGS.values() for s in variants]
    place = F.element_at(F.array(*[F.lit(s) for s in spellings]), (F.col("p_partkey") % 11 + 1).cast("int"))
    facts = t.part.select(
        place.alias("location"), F.col("p_partkey").alias("nut_type"),
        F.explode(
            F.create_map(
                F.lit("Price (£) per pack"), money("p_retailprice"),
                F.lit("Quant per Q"), money("p_size"), F.lit("Weight (kg)"), money(F.lit(1)),
            )
        ).alias("category", "value"),
    )
    return doubles(markets.revenue_by_city(facts), "revenue")


@query(
    "half_up_share",
    f"""
    WITH meals AS (
      SELECT CASE p_size % 5 WHEN 0 THEN 'meat-base' WHEN 1 THEN 'meat-base' WHEN 2 THEN 'vegan'
                  ELSE 'vegetarian' END AS kind, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part)
    SELECT kind AS "Type", {sql_ratio("sum(price)", "count(*)", 2)} AS avg_price,
      CAST(floor({sql_ratio("count(*) * 100", "(SELECT count(*) FROM meals)", 2)} + 0.5) AS BIGINT) AS pct_of_total
    FROM meals GROUP BY 1""",
)
def half_up_share(t: Tables) -> DataFrame:
    texts = ("Meat based", "red MEAT", "Suitable for Vegans", "Veggie", "")
    prices = t.part.select(F.col("p_partkey").alias("Meal Option"), money("p_retailprice").alias("Price"))
    nutrition = t.part.select(
        F.col("p_partkey").alias("Meal Option"),
        F.element_at(F.array(*[F.lit(x) for x in texts]), F.col("p_size") % 5 + 1).alias("Type"),
    )
    return longs(markets.meal_prices(prices, nutrition), "pct_of_total")


@query(
    "row_total",
    """
    WITH cells AS (
      SELECT s_name AS school_name, date_trunc('month', l_shipdate) AS m, l_linenumber % 4 AS c,
             min(CAST(l_quantity AS INTEGER)) AS v
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
    wide AS (
      SELECT school_name, CAST(m AS DATE) AS date, min(v) FILTER (c = 0) AS a, min(v) FILTER (c = 1) AS b,
             min(v) FILTER (c = 2) AS g, min(v) FILTER (c = 3) AS k FROM cells GROUP BY ALL)
    SELECT school_name, a AS "Electricity Cost", b AS "Water Cost", g AS "Gas Cost", k AS "Maintenance Cost",
           CAST(a + b + g + k AS BIGINT) AS total_cost, date FROM wide""",
)
def row_total(t: Tables) -> DataFrame:
    names = F.array(*[F.lit(n) for n in markets.COST_NAMES])
    sheets = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_name").alias("school_name"), F.year("l_shipdate").alias("year"),
        F.date_format("l_shipdate", "MMMM").alias("month"),
        F.element_at(names, F.col("l_linenumber") % 4 + 1).alias("name"),
        F.col("l_quantity").cast("int").alias("value"),
    )
    return longs(markets.overhead_costs(sheets), "total_cost")


@query(
    "month_scaffold_roll",
    """
    WITH monthly AS (
      SELECT l_suppkey AS store, l_returnflag AS bike_type, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
        sum(CAST(l_quantity AS BIGINT)) AS sales, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS profit
      FROM lineitem WHERE l_shipdate < DATE '2001-01-01' GROUP BY ALL),
    grid AS (
      SELECT store, bike_type, CAST(unnest(generate_series((SELECT min(date) FROM monthly),
        (SELECT max(date) FROM monthly), INTERVAL 1 MONTH)) AS DATE) AS date
      FROM (SELECT DISTINCT store, bike_type FROM monthly)),
    filled AS (
      SELECT store, bike_type, date, CAST(coalesce(sales, 0) AS BIGINT) AS sales, coalesce(profit, 0) AS profit
      FROM grid LEFT JOIN monthly USING (store, bike_type, date))
    SELECT store, bike_type, date, sales, CAST(profit AS DOUBLE) AS profit,
      CASE WHEN count(*) OVER w = 3
        THEN round(CAST(sum(profit) OVER w AS DOUBLE) / 3, 4) END AS profit_running_mean_3p
    FROM filled WINDOW w AS (PARTITION BY store, bike_type ORDER BY date ROWS 2 PRECEDING)""",
)
def month_scaffold_roll(t: Tables) -> DataFrame:
    sales = t.lineitem.select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_suppkey").alias("store"),
        F.col("l_returnflag").alias("bike_type"), F.col("l_quantity").cast("bigint").alias("sales"),
        money("l_extendedprice").alias("profit"),
    )
    result = doubles(markets.monthly_sales(sales, before="2001-01-01"), "profit")
    return result.withColumn("profit_running_mean_3p", F.round("profit_running_mean_3p", 4))


@query(
    "fiscal_trend",
    f"""
    WITH totals AS (
      SELECT c_nationkey AS store,
        CAST(quarter(CAST(o_orderdate AS DATE) + INTERVAL 6 MONTH) AS BIGINT) AS q,
        CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS sales
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    lagged AS (SELECT *, lag(sales) OVER (PARTITION BY store ORDER BY q) AS prev FROM totals),
    marked AS (
      SELECT *, CASE sign({sql_ratio("(sales - prev) * 100", "prev", 1)})
        WHEN 1 THEN '+' WHEN -1 THEN '-' WHEN 0 THEN '0' END AS mark FROM lagged),
    runs AS (
      SELECT *, lag(mark, 2) OVER w || lag(mark, 1) OVER w || mark AS marks FROM marked
      WINDOW w AS (PARTITION BY store ORDER BY q)),
    labels(marks, label) AS (VALUES {", ".join(f"('{m}', '{label}')" for m, label in markets.TRENDS.items())}),
    named AS (SELECT store, max(label) AS label FROM runs JOIN labels USING (marks) GROUP BY store)
    SELECT store, q AS fiscal_quarter, sales, prev AS "%_diff_QoQ", label AS store_evaluation
    FROM runs LEFT JOIN named USING (store)""",
)
def fiscal_trend(t: Tables) -> DataFrame:
    sheets = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("store"), F.floor("o_totalprice").alias("sales"),
        F.date_format("o_orderdate", "EEEE, dd , yyyy").alias("order_date"),
        F.date_format("o_orderdate", "MMMM").alias("month"),
    )
    return longs(markets.store_trends(markets.order_days(sheets)), "fiscal_quarter")
