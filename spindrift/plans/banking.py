"""Bank accounts, transactions, statements, branches."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.functions import cases, dates, numbers, text
from spindrift.operators import calendar, joins, reshape, slices, windows
from spindrift.operators.columns import quoted, renamed

# Results carry these words.
COUNTRY = "GB"
BANK_CODE = "DSB"
CHANNELS = {1: "Online"}
OTHER_CHANNEL = "In-Person"
PHONE_PREFIX = "07"
EXCLUDED_ACCOUNT_TYPE = "Platinum"
EXCLUDED_QUESTION = "Overall Rating"
PLATFORMS = ("Mobile App", "Online Interface")


def account_codes(transactions: DataFrame, banks: DataFrame, country: str = COUNTRY) -> DataFrame:
    """International account code of every transaction."""
    joined = transactions.join(windows.broadcast_if_small(banks), "bank")
    sort_code = F.regexp_replace("sort_code", "-", "")
    code = text.joined("", F.lit(country), "check_digits", "swift_code", sort_code, "account_number")
    return joined.select("transaction_id", code.alias("IBAN"))


def quarterly_variance(transactions: DataFrame, targets: DataFrame, code: str = BANK_CODE) -> DataFrame:
    """Quarterly value per channel against its target.

    ``targets`` is wide: ``online_or_in_person`` and one column per quarter, ``q1`` to ``q4``.
    """
    day = dates.parse_lenient(F.col("transaction_date"), "dd/MM/yyyy HH:mm:ss")
    channel = cases.lookup(F.col("online_or_in_person").cast("int"), CHANNELS, OTHER_CHANNEL)
    actual = (
        transactions.where(F.col("transaction_code").rlike(code))
        .groupBy(F.quarter(day).alias("quarter"), channel.alias("channel"))
        .agg(F.sum("value").alias("Value"))
    )
    goal = reshape.to_long(
        targets, ["online_or_in_person"], ["q1", "q2", "q3", "q4"], name="quarter", value="target"
    ).select(
        F.col("online_or_in_person").alias("channel"),
        text.extract("quarter", r"(\d)").cast("int").alias("quarter"),
        F.col("target").cast("int").alias("target"),
    )
    return actual.join(goal, ["quarter", "channel"]).select(
        "quarter", F.col("channel").alias("Online or In-Person"), "Value", "target",
        (F.col("Value") - F.col("target")).alias("variance_to_target"),
    )


def first_joining(sheets: DataFrame, year: int = 2023) -> DataFrame:
    """One row per new customer with the first joining date.

    ``sheets``: id, joining_day, demographic, value and the sheet's ``month`` name.
    """
    joined_on = dates.parse(text.joined("/", "joining_day", "month", F.lit(year)), "d/MMMM/yyyy")
    # one cell per id, date and demographic; min makes a repeated cell well defined
    wide = reshape.to_wide(
        sheets.select("id", joined_on.alias("date"), "demographic", "value"),
        ["id", "date"], "demographic", ["Ethnicity", "Date of Birth", "Account Type"], "value",
    )
    born = dates.parse(F.col("Date of Birth"), "M/d/yyyy")
    return (
        wide.withColumn("Date of Birth", born)
        .groupBy("id", "Ethnicity", "Date of Birth", "Account Type")
        .agg(F.min("date").alias("date"))
    )


def duplicated(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def monthly_bank_rank(transactions: DataFrame) -> DataFrame:
    """Value and rank of each bank per month, with means per bank and per rank.

    The windows run on one row per bank and month.
    """
    day = dates.parse(F.col("transaction_date"), "dd/MM/yyyy HH:mm:ss")
    return rank_by_month(
        transactions.select(
            text.part("transaction_code", "-", 1).alias("bank"), day.alias("day"), "value"
        )
    )


def rank_by_month(facts: DataFrame) -> DataFrame:
    """:func:`monthly_bank_rank` from bank, day and value.

    After the sum a bank has at most twelve rows, and so has a rank unless banks tie.
    """
    totals = facts.groupBy("bank", dates.month_name(F.col("day")).alias("month")).agg(
        F.sum("value").alias("value")
    )
    ranked = totals.withColumn(
        "bank_rank_per_month", windows.bounded_dense_rank(["month"], "value", descending=True)
    )
    ranked = ranked.withColumn(
        "avg_rank_per_bank", numbers.mean_over(F.col("bank_rank_per_month"), Window.partitionBy("bank"), 2)
    )
    by_rank = Window.partitionBy("bank_rank_per_month")
    return ranked.withColumn(
        "avg_transaction_value_per_rank", numbers.mean_over(F.col("value"), by_rank, 2)
    )


def fan_label(difference: Column) -> Column:
    """Fan group by mean score difference; both sides of the neutral range are open."""
    return cases.first_match(
        [
            (difference >= 2, "Mobile App Superfan"),
            (difference >= 1, "Mobile App Fan"),
            (difference <= -2, "Online Interface Superfan"),
            (difference <= -1, "Online Interface Fan"),
            (difference.isNotNull(), "Neutral"),
        ]
    )


def platform_mean(headers: Sequence[str]) -> Column:
    """Mean of the known scores of one row."""
    total = sum((F.coalesce(quoted(h), F.lit(0)) for h in headers), F.lit(0))
    known = sum((quoted(h).isNotNull().cast("int") for h in headers), F.lit(0))
    return F.try_divide(total, known)


def fan_groups(survey: DataFrame, customer: str = "Customer ID") -> DataFrame:
    """Share of customers per fan group; score columns are named ``<platform> - <question>``.

    The headers are known when the plan is built, so a customer's scores stay in one row.
    """
    asked = [h for h in survey.columns if h != customer and h.split(" - ")[-1] != EXCLUDED_QUESTION]
    scores = survey.groupBy(quoted(customer)).agg(*[F.min(quoted(h)).alias(h) for h in asked])
    means = [platform_mean([h for h in asked if h.split(" - ")[0] == p]) for p in PLATFORMS]
    labelled = scores.select(fan_label(means[0] - means[1]).alias("group"))
    return windows.counted_share(labelled, "group", "% total", 1)


def large_transfers(
    paths: DataFrame, holders: DataFrame, details: DataFrame, accounts: DataFrame, least: float = 1000
) -> DataFrame:
    """Uncancelled transfers of at least ``least`` with every holder of the paying account."""
    big = details.where((F.col("value") >= least) & (F.col("cancelled?") == "N")).drop("cancelled?")
    owners = reshape.split_rows(
        accounts.where(F.col("account_type") != EXCLUDED_ACCOUNT_TYPE), "account_holder_id", ",", "bigint"
    )
    people = holders.withColumns(
        {
            "contact_number": F.concat(F.lit(PHONE_PREFIX), "contact_number"),
            "date_of_birth": dates.parse(F.col("date_of_birth"), "d/M/yyyy"),
        }
    )
    paid = paths.join(big, "transaction_id").withColumnRenamed("account_from", "account_number")
    return paid.join(owners, "account_number").join(people, "account_holder_id").drop("account_holder_id")


def transfer_legs(details: DataFrame, paths: DataFrame) -> DataFrame:
    """Two signed rows per uncancelled transaction: out of one account, into the other."""
    kept = details.where(F.col("cancelled?") == "N").join(paths, "transaction_id")
    legs = reshape.to_long(
        kept, ["transaction_id", "transaction_date", "value"], ["account_to", "account_from"],
        name="side", value="account_number",
    )
    amount = numbers.signed(F.col("value"), F.col("side") == "account_from")
    return legs.select("account_number", "transaction_date", amount.alias("value"), "transaction_id")


def running_statement(
    details: DataFrame, paths: DataFrame, accounts: DataFrame,
    rows_per_slice: int = slices.ROWS_PER_SLICE,
) -> DataFrame:
    """Statement per account from its opening balance.

    ``transaction_value`` is the previous row's value, ``balance`` includes the row's own. Rows
    of a day run from the highest value to the lowest.
    """
    legs = transfer_legs(details, paths)
    opening = accounts.select(
        "account_number", F.col("balance_date").alias("transaction_date"),
        F.col("balance").alias("value"), F.lit(None).cast("bigint").alias("transaction_id"),
    )
    entries = legs.unionByName(opening)
    # highest value first within a day
    order = [F.col("transaction_date"), -F.col("value"), F.col("transaction_id")]
    run = slices.running(
        entries, ["account_number"], order,
        sums={"balance": "value"}, lags={"transaction_value": "value"}, rows_per_slice=rows_per_slice,
    )
    return run.select("account_number", "transaction_date", "transaction_value", "balance")


def daily_sums(statements: DataFrame) -> DataFrame:
    return statements.groupBy("account_number", "balance_date").agg(
        F.sum("balance").alias("balance"), F.sum("transaction_value").alias("transaction_value")
    )


def daily_balances(statements: DataFrame) -> DataFrame:
    """Balance of every account on every day; days without an entry keep the last balance.

    A group of the fill is one account's days, at most the length of the calendar.
    """
    grid = calendar.scaffold(daily_sums(statements), ["account_number"], "balance_date")
    filled = windows.fill_forward(F.col("balance"), ["account_number"], [F.col("balance_date")])
    return grid.select(
        F.col("balance_date").alias("date"), "account_number", filled.alias("balance"),
        F.coalesce("transaction_value", F.lit(0)).alias("transaction_value"),
    )


def balance_on(statements: DataFrame, day: str) -> DataFrame:
    """One day of :func:`daily_balances`, by one aggregate: no day but the asked one is built."""
    asked = date.fromisoformat(day)
    first, last = statements.agg(F.min("balance_date"), F.max("balance_date")).first()
    if first is None or not first <= asked <= last:
        raise ValueError(f"{day} is outside {first} to {last}")
    upto = daily_sums(statements.where(F.col("balance_date") <= F.lit(asked)))
    known = F.when(F.col("balance").isNotNull(), F.col("balance_date"))
    today = F.sum(F.when(F.col("balance_date") == F.lit(asked), F.col("transaction_value")))
    latest = upto.groupBy("account_number").agg(
        F.max_by("balance", known).alias("balance"), F.coalesce(today, F.lit(0)).alias("transaction_value")
    )
    every = statements.select("account_number").distinct()
    return every.join(latest, "account_number", "left").select(
        F.lit(asked).alias("date"), "account_number", "balance",
        F.coalesce("transaction_value", F.lit(0)).alias("transaction_value"),
    )


def nearest_branch(
    branches: DataFrame, customers: DataFrame, rows_per_slice: int | None = None
) -> DataFrame:
    """Nearest branch of every customer and the customer's priority there, nearest first.

    Headers as landed (``Branch Long`` ...), in degrees; the result is in radians. A branch has at
    most 1.25 million different distances in hundredths of a mile, so ranking them needs no slices
    unless ``rows_per_slice`` asks for them.
    """
    sites = branches.select(
        F.col("Branch").alias("branch"), F.radians("Branch Lat").alias("b_lat"),
        F.radians("Branch Long").alias("b_lon"),
    )
    points = customers.select(
        F.col("Customer").alias("customer"), F.radians("Address Lat").alias("a_lat"),
        F.radians("Address Long").alias("a_lon"),
    )
    near = joins.nearest_sites(
        points, sites, ("a_lat", "a_lon"), "branch", ("b_lat", "b_lon"), "distance_in_miles"
    )
    ranked = slices.dense_rank(
        near, ["branch"], "distance_in_miles", "customer priority",
        rows_per_slice=rows_per_slice or slices.ROWS_PER_SLICE,
        measured=rows_per_slice is not None,
    )
    shown = {
        "branch": "Branch", "b_lon": "Branch Long", "b_lat": "Branch Lat", "customer": "Customer",
        "a_lon": "Address Long", "a_lat": "Address Lat",
    }
    return renamed(ranked, shown).select(*shown.values(), "distance_in_miles", "customer priority")
