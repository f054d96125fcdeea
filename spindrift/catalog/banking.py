"""Bank jobs over orders, customers, suppliers and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spindrift.catalog.base import Tables, doubles, longs, money, query, sql_ratio
from spindrift.plans import banking


@query(
    "monthly_segment_rank",
    f"""
    WITH totals AS (
      SELECT c_mktsegment AS bank, strftime(o_orderdate, '%B') AS month,
             sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    ranked AS (
      SELECT *, dense_rank() OVER (PARTITION BY month ORDER BY v DESC) AS r FROM totals)
    SELECT bank, month, CAST(v AS DOUBLE) AS value, CAST(r AS BIGINT) AS bank_rank_per_month,
      {sql_ratio("sum(r) OVER (PARTITION BY bank)", "count(*) OVER (PARTITION BY bank)", 2)} AS avg_rank_per_bank,
      {sql_ratio("sum(v) OVER (PARTITION BY r)", "count(*) OVER (PARTITION BY r)", 2)} AS avg_transaction_value_per_rank
    FROM ranked""",
)
def monthly_segment_rank(t: Tables) -> DataFrame:
    facts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("bank"), F.col("o_orderdate").cast("date").alias("day"),
        money("o_totalprice").alias("value"),
    )
    return longs(doubles(banking.rank_by_month(facts), "value"), "bank_rank_per_month")


@query(
    "account_codes",
    """
    SELECT c_custkey AS transaction_id,
      'GB' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || upper(substr(n_name, 1, 4))
        || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 97 AS VARCHAR), 2, '0')
        || lpad(CAST(c_custkey % 89 AS VARCHAR), 2, '0') || CAST(10000000 + c_custkey AS VARCHAR) AS "IBAN"
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def account_codes(t: Tables) -> DataFrame:
    def two(n: int):
        return F.lpad((F.col("c_custkey") % n).cast("string"), 2, "0")

    transactions = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("transaction_id"),
        (F.col("c_custkey") + 10000000).alias("account_number"),
        F.concat_ws("-", two(100), two(97), two(89)).alias("sort_code"),
        F.col("n_name").alias("bank"),
    )
    banks = t.nation.select(
        F.col("n_name").alias("bank"),
        F.upper(F.substring("n_name", 1, 4)).alias("swift_code"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("check_digits"),
    )
    return banking.account_codes(transactions, banks)


@query(
    "quarter_vs_target",
    """
    WITH actual AS (
      SELECT CAST(quarter(o_orderdate) AS BIGINT) AS q,
             CASE WHEN o_orderkey % 2 = 0 THEN 'Online' ELSE 'In-Person' END AS ch,
             sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
      FROM orders WHERE o_orderpriority LIKE '%URGENT%' GROUP BY 1, 2),
    goal AS (
      SELECT CASE WHEN r_regionkey = 0 THEN 'Online' ELSE 'In-Person' END AS ch,
             (r_regionkey + 1) * 10000 AS target FROM region WHERE r_regionkey < 2)
    SELECT q AS quarter, ch AS "Online or In-Person", CAST(v AS DOUBLE) AS "Value",
           CAST(target AS BIGINT) AS target, CAST(v - target AS DOUBLE) AS variance_to_target
    FROM actual JOIN goal USING (ch)""",
)
def quarter_vs_target(t: Tables) -> DataFrame:
    transactions = t.orders.select(
        F.col("o_orderpriority").alias("transaction_code"),
        money("o_totalprice").alias("value"),
        (F.col("o_orderkey") % 2 + 1).alias("online_or_in_person"),
        F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss").alias("transaction_date"),
    )
    targets = t.region.where("r_regionkey < 2").select(
        F.when(F.col("r_regionkey") == 0, "Online").otherwise("In-Person").alias("online_or_in_person"),
        *[((F.col("r_regionkey") + 1) * 10000).cast("int").alias(f"q{i}") for i in range(1, 5)],
    )
    result = banking.quarterly_variance(transactions, targets, code="URGENT")
    return longs(doubles(result, "Value", "variance_to_target"), "quarter", "target")


@query(
    "first_joining",
    """
    SELECT o_custkey AS id, c_mktsegment AS "Ethnicity",
           make_date(1950 + CAST(c_custkey % 50 AS INTEGER), 1 + CAST(c_custkey % 12 AS INTEGER),
                     1 + CAST(c_custkey % 28 AS INTEGER)) AS "Date of Birth",
           'Type ' || CAST(c_nationkey AS VARCHAR) AS "Account Type",
           min(CAST(o_orderdate AS DATE)) AS date
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE year(o_orderdate) = 1996 GROUP BY ALL""",
)
def first_joining(t: Tables) -> DataFrame:
    born = F.concat_ws(
        "/", 1 + F.col("c_custkey") % 12, 1 + F.col("c_custkey") % 28, 1950 + F.col("c_custkey") % 50
    )
    answers = F.create_map(
        F.lit("Ethnicity"), F.col("c_mktsegment"),
        F.lit("Date of Birth"), born,
        F.lit("Account Type"), F.concat(F.lit("Type "), F.col("c_nationkey").cast("string")),
    )
    sheets = (
        t.orders.where(F.year("o_orderdate") == 1996)
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_custkey").alias("id"), F.dayofmonth("o_orderdate").alias("joining_day"),
            F.date_format("o_orderdate", "MMMM").alias("month"),
            F.explode(answers).alias("demographic", "value"),
        )
    )
    return banking.first_joining(sheets, year=1996)


@query(
    "duplicate_ids",
    """SELECT o_custkey, count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) > 1""",
)
def duplicate_ids(t: Tables) -> DataFrame:
    return banking.duplicated(t.orders, "o_custkey")


_QUESTIONS = ("Ease of Use", "Ease of Access", "Navigation", "Likelihood to Recommend", "Overall Rating")


@query(
    "survey_groups",
    """
    WITH means AS (
      SELECT o_orderkey,
        (1 + (o_custkey * 2 + o_orderkey * 3) % 5 + 1 + (o_custkey * 3 + o_orderkey * 3) % 5
         + 1 + (o_custkey * 4 + o_orderkey * 3) % 5 + 1 + (o_custkey * 5 + o_orderkey * 3) % 5) / 4.0
        - (1 + (o_custkey * 2 + o_orderkey * 7) % 5 + 1 + (o_custkey * 3 + o_orderkey * 7) % 5
         + 1 + (o_custkey * 4 + o_orderkey * 7) % 5 + 1 + (o_custkey * 5 + o_orderkey * 7) % 5) / 4.0 AS d
      FROM orders),
    groups AS (
      SELECT CASE WHEN d >= 2 THEN 'Mobile App Superfan' WHEN d >= 1 THEN 'Mobile App Fan'
                  WHEN d > -1 THEN 'Neutral' WHEN d <= -2 THEN 'Online Interface Superfan'
                  ELSE 'Online Interface Fan' END AS g FROM means)
    SELECT g AS "group", """
    + sql_ratio("count(*) * 100", "(SELECT count(*) FROM groups)", 1)
    + """ AS "% total" FROM groups GROUP BY g""",
)
def survey_groups(t: Tables) -> DataFrame:
    survey = t.orders.select(
        F.col("o_orderkey").alias("Customer ID"),
        *[
            (1 + (F.col("o_custkey") * (i + 2) + F.col("o_orderkey") * k) % 5).alias(f"{platform} - {q}")
            for platform, k in (("Mobile App", 3), ("Online Interface", 7))
            for i, q in enumerate(_QUESTIONS)
        ],
    )
    return banking.fan_groups(survey)


def _paths(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("account_to"),
        (F.col("o_custkey") + 1 + F.col("o_orderkey") % 7).alias("account_from"),
    )


def _details(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        money("o_totalprice").alias("value"),
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("cancelled?"),
    )


@query(
    "explode_join",
    """
    WITH info AS (
      SELECT c_custkey AS account_number, c_mktsegment AS account_type, CAST(c_acctbal AS DOUBLE) AS balance,
             unnest(CASE WHEN c_custkey % 3 = 0 THEN [c_custkey, c_custkey + 1] ELSE [c_custkey] END) AS h
      FROM customer WHERE c_mktsegment <> 'MACHINERY')
    SELECT i.account_number, o_orderkey AS transaction_id, o_custkey AS account_to,
           CAST(o_orderdate AS DATE) AS transaction_date, o_totalprice AS value, account_type, balance,
           '07' || CAST(900000 + h.c_custkey AS VARCHAR) AS contact_number,
           make_date(1950 + CAST(h.c_custkey % 50 AS INTEGER), 1 + CAST(h.c_custkey % 12 AS INTEGER),
                     1 + CAST(h.c_custkey % 28 AS INTEGER)) AS date_of_birth
    FROM orders JOIN info i ON i.account_number = o_custkey + 1 + o_orderkey % 7
    JOIN customer h ON h.c_custkey = i.h
    WHERE o_totalprice >= 250000 AND o_orderstatus <> 'F'""",
)
def explode_join(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    owners = F.when(key % 3 == 0, F.concat(key.cast("string"), F.lit(" , "), (key + 1).cast("string")))
    accounts = t.customer.select(
        key.alias("account_number"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "Platinum").otherwise(F.col("c_mktsegment"))
        .alias("account_type"),
        F.coalesce(owners, key.cast("string")).alias("account_holder_id"),
        F.col("c_acctbal").alias("balance"),
    )
    holders = t.customer.select(
        key.alias("account_holder_id"), (900000 + key).cast("string").alias("contact_number"),
        F.concat_ws("/", 1 + key % 28, 1 + key % 12, 1950 + key % 50).alias("date_of_birth"),
    )
    result = banking.large_transfers(_paths(t), holders, _details(t), accounts, least=250000)
    return doubles(result, "value")


_STATEMENT = """
    WITH kept AS (
      SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS v, CAST(o_orderdate AS DATE) AS d
      FROM orders WHERE o_orderstatus <> 'F'),
    entries AS (
      SELECT o_custkey AS a, d, v, o_orderkey AS k FROM kept
      UNION ALL SELECT o_custkey + 1 + o_orderkey % 7, d, -v, o_orderkey FROM kept
      UNION ALL SELECT c_custkey, DATE '1994-12-31', CAST(c_acctbal AS DECIMAL(18,2)), NULL FROM customer)
    SELECT a AS account_number, d AS transaction_date,
      CAST(lag(v) OVER w AS DOUBLE) AS transaction_value,
      CAST(sum(v) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance
    FROM entries WINDOW w AS (PARTITION BY a ORDER BY d, v DESC, k NULLS FIRST)"""


def _statement(t: Tables, **options) -> DataFrame:
    accounts = t.customer.select(
        F.col("c_custkey").alias("account_number"), F.lit("1994-12-31").cast("date").alias("balance_date"),
        money("c_acctbal").alias("balance"),
    )
    result = banking.running_statement(_details(t), _paths(t), accounts, **options)
    return doubles(result, "transaction_value", "balance")


@query("two_sided_ledger", _STATEMENT)
def two_sided_ledger(t: Tables) -> DataFrame:
    return _statement(t)


@query("two_sided_ledger_sliced", _STATEMENT)
def two_sided_ledger_sliced(t: Tables) -> DataFrame:
    return _statement(t, rows_per_slice=32)


def _statements(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("account_number"), F.col("ts").cast("date").alias("balance_date"),
        money("value").alias("balance"),
        F.when(F.col("event_type") == "purchase", money("value")).otherwise(money(F.lit(0)))
        .alias("transaction_value"),
    )


_DAILY = """
    WITH sums AS (
      SELECT user_id AS u, CAST(ts AS DATE) AS d, sum(CAST(value AS DECIMAL(18,2))) AS b,
        sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS v
      FROM events GROUP BY 1, 2),
    grid AS (
      SELECT u, CAST(unnest(generate_series((SELECT min(d) FROM sums), (SELECT max(d) FROM sums),
                       INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT DISTINCT u FROM sums)),
    filled AS (
      SELECT d AS date, u AS account_number,
        CAST(last_value(b IGNORE NULLS) OVER (PARTITION BY u ORDER BY d ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance,
        CAST(coalesce(v, 0) AS DOUBLE) AS transaction_value
      FROM grid LEFT JOIN sums USING (u, d))
    SELECT * FROM filled"""


@query("date_scaffold_ffill", _DAILY)
def date_scaffold_ffill(t: Tables) -> DataFrame:
    return doubles(banking.daily_balances(_statements(t)), "balance", "transaction_value")


@query("balance_on_day", _DAILY + " WHERE date = DATE '2024-01-15'")
def balance_on_day(t: Tables) -> DataFrame:
    asked = banking.balance_on(_statements(t), "2024-01-15")
    return doubles(asked, "balance", "transaction_value")


_NEAREST = """
    WITH b AS (
      SELECT s_name AS "Branch", radians(CAST((s_suppkey * 7919) % 1600 AS DOUBLE) / 10 - 80) AS b_lat,
             radians(CAST((s_suppkey * 104729) % 3600 AS DOUBLE) / 10 - 180) AS b_lon FROM supplier),
    c AS (
      SELECT c_custkey, radians(CAST((c_custkey * 6007) % 1600 AS DOUBLE) / 10 - 80) AS a_lat,
             radians(CAST((c_custkey * 3571) % 3600 AS DOUBLE) / 10 - 180) AS a_lon FROM customer),
    pairs AS (
      SELECT "Branch", c_custkey, round(3963 * acos(greatest(least(
          sin(b_lat) * sin(a_lat) + cos(b_lat) * cos(a_lat) * cos(b_lon - a_lon), 1.0), -1.0)), 2) AS dist
      FROM b, c),
    best AS (SELECT *, min(dist) OVER (PARTITION BY c_custkey) AS least FROM pairs)
    SELECT "Branch", c_custkey AS "Customer", dist AS distance_in_miles,
      CAST(dense_rank() OVER (PARTITION BY "Branch" ORDER BY dist) AS BIGINT) AS "customer priority"
    FROM best WHERE dist = least"""


def _nearest(t: Tables, **options) -> DataFrame:
    def spot(key: str, a: int, b: int, who: str):
        return [
            ((F.col(key) * a % 1600).cast("double") / 10 - 80).alias(f"{who} Lat"),
            ((F.col(key) * b % 3600).cast("double") / 10 - 180).alias(f"{who} Long"),
        ]

    branches = t.supplier.select(F.col("s_name").alias("Branch"), *spot("s_suppkey", 7919, 104729, "Branch"))
    customers = t.customer.select(
        F.col("c_custkey").alias("Customer"), *spot("c_custkey", 6007, 3571, "Address")
    )
    result = banking.nearest_branch(branches, customers, **options)
    return longs(
        result.select("Branch", "Customer", "distance_in_miles", "customer priority"), "customer priority"
    )


@query("nearest_neighbour", _NEAREST)
def nearest_neighbour(t: Tables) -> DataFrame:
    return _nearest(t)


@query("nearest_neighbour_sliced", _NEAREST)
def nearest_neighbour_sliced(t: Tables) -> DataFrame:
    return _nearest(t, rows_per_slice=25)
