"""Trades, shops, prices and costs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.functions import cases, dates, numbers, text
from spindrift.operators import calendar, reshape, windows
from spindrift.operators.columns import quoted, snake, with_headers, without

# Results carry these words and limits.
CAP_SCALES = {"B": 1_000_000_000, "M": 1_000_000}
PRICE_EDGES = (25_000, 50_000, 75_000)
PRICE_LABELS = ("Low", "Medium", "High", "Very High")
CAP_EDGES = (100_000_000, 1_000_000_000, 100_000_000_000)
CAP_LABELS = ("Small", "Medium", "Large", "Huge")
INDICATOR_TYPES = ("Export", "Import")
SKIPPED_REPORTERS = ("European Union", "Occ.Pal.Terr", "Other Asia, nes", "World")
SKIPPED_PARTNERS = ("...", "Special Categories", "World")
CITY_SPELLINGS = {
    "London": ("L0ndon", "London", "londen", "L0ndOn"),
    "Liverpool": ("Liverpool", "Livrepool", "LIverpool", "Liverp00l"),
    "Manchester": ("MANchester", "Manchester", "Manch3ster"),
}
COST_NAMES = ("Electricity Cost", "Water Cost", "Gas Cost", "Maintenance Cost")
# sign of the last three quarterly changes, oldest first
TRENDS = {
    "+++": "Going from strength to strength",
    "---": "Going from bad to worse",
    "++-": "Good growth, until Q4",
    "+-+": "Some good growth, but concerns in Q3",
    "-++": "Good growth in last half",
    "--+": "Concerning performance, but improving in Q4",
    "-+-": "Concerning performance, excluding Q3",
    "+--": "Concerning performance in last half",
}


def top_purchases(trades: DataFrame, year: int = 2023, best: int = 5) -> DataFrame:
    """Best purchase prices per month, market-cap size and price class, ties kept.

    ``trades`` has text ``market_cap`` and ``purchase_price`` and the file's ``file_month``
    (NULL or empty for the first month).
    """
    number = F.coalesce(F.nullif(F.col("file_month").cast("string"), F.lit("")), F.lit("1"))
    month = F.make_date(F.lit(year), number.cast("int"), F.lit(1))
    priced = (
        trades.where(F.col("market_cap") != "n/a")
        .withColumns(
            {
                "file_date": month,
                "market_cap": text.currency("market_cap", CAP_SCALES),
                "purchase_price": text.currency("purchase_price", {}),
            }
        )
        .withColumns(
            {
                "purchase_price_category": price_class(F.col("purchase_price")),
                "market_cap_category": cap_class(F.col("market_cap")),
            }
        )
        .drop("id", "first_name", "last_name", "file_month")
    )
    group = ["file_date", "market_cap_category", "purchase_price_category"]
    return windows.top_dense(priced, group, F.col("purchase_price"), best, "purchase_price_rank")


def price_class(price: Column) -> Column:
    return cases.bucketize(price, PRICE_EDGES, PRICE_LABELS, otherwise=PRICE_LABELS[-1])


def cap_class(cap: Column) -> Column:
    return cases.bucketize(cap, CAP_EDGES, CAP_LABELS, otherwise=CAP_LABELS[-1])


def recent_moving_average(trades: DataFrame, window: int, recent: int = 100) -> DataFrame:
    """Moving average of the last ``window`` trades for the ``recent`` latest trades per sector.

    ``trades``: sector, month_number, id, purchase_price. Trades are ordered by month and id.
    Only the latest ``recent + window - 1`` trades of a sector can matter; Spark cuts the rest
    before the shuffle, and their number alone gives the trade order.
    """
    if window < 1:
        raise ValueError("the window must hold at least one trade")
    when = F.struct("month_number", "id")
    late = windows.top_dense(trades, ["sector"], when, recent + window - 1, "_recency")
    trades_in_sector = (
        trades.select("sector", "month_number", "id").distinct()
        .groupBy("sector").agg(F.count(F.lit(1)).alias("_trades"))
    )
    order = [F.col("_recency").desc(), F.col("purchase_price")]
    average = windows.rolling_mean_bounded(F.col("purchase_price"), ["sector"], order, window)
    shown = late.withColumn("_average", average).where(F.col("_recency") <= recent)
    return shown.join(trades_in_sector, "sector").select(
        (F.col("_trades") - F.col("_recency") + 1).alias("trade_order"),
        "sector",
        F.round("_average", 2).cast("double").alias(f"{window}_prev_moving_avg"),
        (F.least(F.lit(recent), "_trades") - F.col("_recency") + 1).alias("prev_trades"),
    )


def trade_summary(
    trades: DataFrame, codes: DataFrame, indicators: Sequence[str], years: Sequence[str] | None = None
) -> DataFrame:
    """Country trade figures, one column per indicator, with coordinates of both countries.

    Headers as landed, years as columns, plus ``country_code`` from the file name; ``codes`` has
    ``ISO3 CODE`` and a ``lat,lon`` text in ``geo_point_2d``.
    """
    fixed = ["Reporter", "Partner", "Product categories", "Indicator Type", "Indicator", "country_code"]
    kept = trades.where(
        F.col("Indicator Type").isin(*INDICATOR_TYPES)
        & ~F.col("Reporter").isin(*SKIPPED_REPORTERS)
        & ~F.col("Partner").isin(*SKIPPED_PARTNERS)
    )
    years = years or [c for c in trades.columns if c.isdigit()]
    cells = reshape.to_long(kept, fixed, years, name="year", value="value").select(
        *[quoted(c) for c in fixed],
        F.make_date(F.col("year").cast("int"), F.lit(1), F.lit(1)).alias("year"),
        text.strip_ws("value").try_cast("double").alias("value"),
    )
    ids = [c for c in fixed if c != "Indicator"] + ["year"]
    wide = reshape.to_wide(
        cells.where(F.col("value").isNotNull()), ids, "Indicator", indicators, "value", F.sum,
        coarse=True,
    )
    points = windows.broadcast_if_small(
        codes.select("ISO3 CODE", "geo_point_2d").na.drop().select(
            F.col("ISO3 CODE").alias("iso3"),
            text.strip_ws(text.part("geo_point_2d", ",", 1)).cast("double").alias("latitude"),
            text.strip_ws(text.part("geo_point_2d", ",", -1)).cast("double").alias("longitude"),
        )
    )
    partners = windows.broadcast_if_small(
        kept.select(F.col("country_code").alias("code_partner"), F.col("Reporter").alias("Partner"))
        .dropDuplicates()
    )
    there = points.toDF("code_partner", "latitude_partner", "longitude_partner")
    located = (
        wide.join(points.withColumnRenamed("iso3", "country_code"), "country_code", "left")
        .join(partners, "Partner", "left")
        .join(there, "code_partner", "left")
    )
    return with_headers(located, snake)


def revenue_by_city(facts: DataFrame) -> DataFrame:
    """Mean pack price and revenue per city. ``facts``: category, value, location, nut_type."""
    clean = facts.withColumn("location", cases.canonical(F.col("location"), CITY_SPELLINGS))
    price, quantity = "Price (£) per pack", "Quant per Q"
    wide = reshape.to_wide(
        clean, ["location", "nut_type"], "category", [price, quantity], "value"
    )
    return wide.groupBy("location").agg(
        numbers.mean(quoted(price), 2).alias(price),
        F.sum(quoted(price) * quoted(quantity)).alias("revenue"),
    )


def meal_type(kind: Column) -> Column:
    return cases.first_match(
        [(kind.rlike("(?i)meat"), "meat-base"), (kind.rlike("(?i)vegan"), "vegan")], "vegetarian"
    )


def meal_prices(prices: DataFrame, nutrition: DataFrame) -> DataFrame:
    """Mean price and share of the menu per meal type. Headers as landed."""
    meals = nutrition.withColumn("Type", meal_type(F.col("Type"))).join(prices, "Meal Option")
    per_type = meals.groupBy("Type").agg(
        numbers.mean(F.col("Price"), 2).alias("avg_price"), F.count("Type").alias("_n")
    )
    # three meal types at most
    share = numbers.ratio(F.col("_n") * 100, F.sum("_n").over(Window.partitionBy()), 2)
    return per_type.select("Type", "avg_price", numbers.half_up(share).cast("int").alias("pct_of_total"))


def overhead_costs(sheets: DataFrame, names: Sequence[str] = COST_NAMES) -> DataFrame:
    """Costs of a school and month in columns with their total.

    ``sheets``: school_name, year, month (name), name, value.
    """
    wide = reshape.to_wide(sheets, ["school_name", "year", "month"], "name", names, "value")
    total = sum((quoted(n) for n in names[1:]), quoted(names[0]))
    day = dates.parse(text.joined("", "year", "month", F.lit("01")), "yyyyMMMMdd")
    return without(wide.withColumns({"total_cost": total, "date": day}), "year", "month")


def monthly_sales(sales: DataFrame, before: str = "2023-07-01", window: int = 3) -> DataFrame:
    """Sales and profit per store, bike type and month, gaps as zero, with a rolling mean.

    Every store and bike type gets every month of the table. One group of the rolling mean is
    one store and bike type's months.
    """
    keys = ["store", "bike_type"]
    monthly = (
        sales.where(F.col("date") < F.lit(before).cast("date"))
        .groupBy(*keys, dates.month_start(F.col("date")).alias("date"))
        .agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    )
    grid = calendar.scaffold(monthly, keys, "date", step="1 month").na.fill(0, ["sales", "profit"])
    mean = windows.rolling_mean_bounded(F.col("profit"), keys, [F.col("date")], window)
    return grid.withColumn(f"profit_running_mean_{window}p", mean.cast("double"))


def order_days(sheets: DataFrame) -> DataFrame:
    """Order dates from ``Weekday, dd, yyyy`` text and the sheet's month name."""
    day = text.strip_ws(text.part("order_date", ",", 2))
    year = text.strip_ws(text.part("order_date", ",", -1))
    return sheets.withColumn("order_date", dates.parse(F.concat(day, "month", year), "dMMMMyyyy"))


def store_trends(sales: DataFrame) -> DataFrame:
    """Sales per store and fiscal quarter with the store's trend.

    ``sales``: store, sales, order_date. ``%_diff_QoQ`` holds the previous quarter's sales. The
    windows run on the four quarters of a store.
    """
    quarters = sales.groupBy("store", dates.fiscal_quarter(F.col("order_date")).alias("fiscal_quarter"))
    totals = quarters.agg(F.sum("sales").alias("sales"))
    by_quarter = Window.partitionBy("store").orderBy("fiscal_quarter")
    previous = F.lag("sales").over(by_quarter)
    change = numbers.ratio((F.col("sales") - F.col("_previous")) * 100, F.col("_previous"), 1)
    mark = F.when(F.col("_change") > 0, "+").when(F.col("_change") < 0, "-").when(
        F.col("_change").isNotNull(), "0"
    )
    signs = F.concat(F.lag("_mark", 2).over(by_quarter), F.lag("_mark", 1).over(by_quarter), "_mark")
    trend = F.max(cases.lookup(F.col("_signs"), TRENDS)).over(Window.partitionBy("store"))
    return (
        totals.withColumn("_previous", previous)
        .withColumn("_change", change)
        .withColumn("_mark", mark)
        .withColumn("_signs", signs)
        .select("store", "fiscal_quarter", "sales", F.col("_previous").alias("%_diff_QoQ"),
                trend.alias("store_evaluation"))
    )
