"""Single operators and functions over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spindrift.catalog.base import Tables, doubles, longs, money, query, sql_ratio
from spindrift.functions import cases, dates, numbers, text
from spindrift.operators import columns, reshape, slices, windows


@query(
    "project_ops",
    """
    SELECT l_orderkey, l_partkey, l_linenumber AS line, l_quantity * 2 AS twice, l_quantity + 1 AS quantity_plus,
      'fixed' AS tag, CAST(l_discount * 100 AS INTEGER) AS pct, l_returnflag AS flag, l_linestatus AS status
    FROM lineitem""",
)
def project_ops(t: Tables) -> DataFrame:
    df = t.lineitem.withColumns(
        {
            "twice": F.col("l_quantity") * 2,
            "quantity_plus": F.col("l_quantity") + 1,
            "tag": F.lit("fixed"),
            "pct": F.round(F.col("l_discount") * 100).cast("int"),
            "kind": F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")),
        }
    )
    df = columns.without(df, "l_suppkey", "l_shipdate", pattern=r"^l_(quantity|ext|dis|tax|ret|linest).*$")
    return columns.unnest(columns.renamed(df, {"l_linenumber": "line"}), "kind")


@query(
    "regex_columns",
    """
    SELECT l_orderkey AS "L orderkey", l_linenumber AS "L linenumber",
      CAST(l_quantity AS DOUBLE) / 10 AS "L quantity", l_tax * 10 AS "L tax", l_discount * 10 AS "L discount"
    FROM lineitem""",
)
def regex_columns(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount")
    df = columns.map_columns(df, lambda c: c * 10, columns.matching(df, r"^l_(tax|discount)$"))
    df = columns.map_columns(df, lambda c: c.cast("double") / 10, ["l_quantity"])
    shown = columns.with_headers(df, lambda h: h.capitalize().replace("_", " "))
    return columns.positional(shown, list(shown.columns))


@query(
    "prefix_between",
    """
    SELECT c_custkey, c_name, c_acctbal, c_acctbal BETWEEN 0 AND 5000 AS closed,
      c_acctbal > 0 AND c_acctbal < 5000 AS open, c_mktsegment IN ('BUILDING', 'MACHINERY') AS listed
    FROM customer WHERE c_mktsegment LIKE 'M%' OR c_mktsegment LIKE 'B%' OR c_custkey = 7""",
)
def prefix_between(t: Tables) -> DataFrame:
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    return t.customer.where(
        segment.startswith("M") | segment.startswith("B") | (F.col("c_custkey") == 7)
    ).select(
        "c_custkey", "c_name", "c_acctbal", balance.between(0, 5000).alias("closed"),
        ((balance > 0) & (balance < 5000)).alias("open"), segment.isin("BUILDING", "MACHINERY").alias("listed"),
    )


@query(
    "business_totals",
    """
    SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
      min(l_extendedprice) AS least, max(l_extendedprice) AS most, max(l_linestatus) AS last_status,
      count(*) AS rows, count(nullif(l_linenumber, 1)) AS not_first,
      arg_max(l_orderkey, l_extendedprice * 1e9 + l_orderkey) AS latest
    FROM lineitem GROUP BY 1, 2""",
)
def business_totals(t: Tables) -> DataFrame:
    result = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(money("l_quantity")).alias("quantity"), F.min("l_extendedprice").alias("least"),
        F.max("l_extendedprice").alias("most"), F.max("l_linestatus").alias("last_status"),
        F.count(F.lit(1)).alias("rows"), F.count(F.nullif("l_linenumber", F.lit(1))).alias("not_first"),
        F.max_by("l_orderkey", F.col("l_extendedprice") * 1e9 + F.col("l_orderkey")).alias("latest"),
    )
    return doubles(result, "quantity")


@query(
    "group_values",
    f"""
    SELECT event_id, user_id, {sql_ratio("sum(CAST(value AS DECIMAL(18,2))) OVER w", "count(*) OVER w", 2)} AS mean_value,
      max(value) OVER w AS most, min(value) OVER w AS least, count(*) OVER w AS rows,
      round(CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) / CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE), 9)
        AS share
    FROM events WINDOW w AS (PARTITION BY user_id)""",
)
def group_values(t: Tables) -> DataFrame:
    values = {
        "mean_value": numbers.mean(money("value"), 2), "most": F.max("value"), "least": F.min("value"),
        "rows": F.count(F.lit(1)), "_sum": F.sum(money("value")),
    }
    joined = windows.with_group_values(t.events, ["user_id"], values, measured=True)
    share = money("value").cast("double") / F.col("_sum").cast("double")
    return joined.select(
        "event_id", "user_id", "mean_value", "most", "least", "rows", F.round(share, 9).alias("share")
    )


@query(
    "unpivot_pivot_sum",
    """
    SELECT l_shipmode AS y, CAST(sum(q) AS DOUBLE) AS l_quantity, CAST(sum(p) AS DOUBLE) AS l_extendedprice,
      CAST(sum(d) AS DOUBLE) AS l_discount, CAST(sum(x) AS DOUBLE) AS l_tax FROM (
      SELECT CAST(year(l_shipdate) AS BIGINT) AS l_shipmode, CAST(l_quantity AS DECIMAL(18,2)) AS q,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS p, CAST(l_discount AS DECIMAL(18,2)) AS d,
        CAST(l_tax AS DECIMAL(18,2)) AS x FROM lineitem) GROUP BY 1""",
)
def unpivot_pivot_sum(t: Tables) -> DataFrame:
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = t.lineitem.select(F.year("l_shipdate").cast("bigint").alias("y"), *measures)
    long = reshape.to_long(lines, ["y"], measures, cast="decimal(18,2)")
    return doubles(reshape.to_wide(long, ["y"], "variable", measures, "value", F.sum, coarse=True), *measures)


@query(
    "anti_missing",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def anti_missing(t: Tables) -> DataFrame:
    large = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(large, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query(
    "set_ops",
    """
    SELECT k, 'both' AS side FROM (
      SELECT o_custkey AS k FROM orders WHERE o_totalprice > 400000
      UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    UNION ALL SELECT l_suppkey, l_returnflag FROM (SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem)""",
)
def set_ops(t: Tables) -> DataFrame:
    rich = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("k"))
    poor = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("k"))
    both = rich.unionByName(poor).distinct().withColumn("side", F.lit("both"))
    pairs = t.lineitem.select("l_suppkey", "l_returnflag").dropDuplicates(["l_suppkey", "l_returnflag"])
    return both.union(pairs)


@query(
    "array_ops",
    r"""
    WITH words AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
    SELECT doc_id, w[1] AS first_word, w[-1] AS last_word, CAST(len(w) AS BIGINT) AS words,
      array_to_string([x[1] FOR x IN w[1:2]], '') AS initials,
      CAST(len([x FOR x IN w if contains(x, 'th')]) AS BIGINT) AS with_th,
      array_to_string([lower(x) FOR x IN w[2:3]], '-') AS second_third
    FROM words""",
)
def array_ops(t: Tables) -> DataFrame:
    words = F.split("text", " ")
    th = F.filter(words, lambda w: F.contains(w, F.lit("th")))
    lowered = F.transform(F.slice(words, 2, 2), lambda w: F.lower(w))
    result = t.documents.select(
        "doc_id", F.get(words, F.lit(0)).alias("first_word"), F.element_at(words, -1).alias("last_word"),
        F.size(words).alias("words"), text.initials("text", 2).alias("initials"),
        F.size(th).alias("with_th"), F.array_join(lowered, "-").alias("second_third"),
    )
    return longs(result, "words", "with_th")


@query(
    "text_ops",
    r"""
    SELECT doc_id, regexp_replace(text, '[aeiou]', '', 'g') AS no_vowels, regexp_replace(text, 'th', 'TH') AS first_th,
      regexp_replace(text, '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') AS stripped,
      CASE WHEN regexp_matches(text, '[0-9]+') THEN regexp_extract(text, '([0-9]+)', 1) END AS digits,
      regexp_matches(lower(text), 'the') AS has_the, contains(text, 'th') AS has_th, substr(text, 4, 5) AS piece,
      upper(lang) || lower(source) AS codes, upper(substr(source, 1, 1)) || lower(substr(source, 2)) AS capital,
      starts_with(text, 'T') AS begins, split_part(source, 'r', 1) AS left_part, split_part(source, 'r', -1) AS right_part,
      lang || '/' || source || '/' || CAST(n_chars AS VARCHAR) AS path, replace(text, 'an', '*') AS literal
    FROM documents""",
)
def text_ops(t: Tables) -> DataFrame:
    body, source = F.col("text"), F.col("source")
    return t.documents.select(
        "doc_id", F.regexp_replace(body, "[aeiou]", "").alias("no_vowels"),
        text.replace_first(body, "th", "TH").alias("first_th"),
        F.regexp_replace(body, r"^[ \t\r\n]+|[ \t\r\n]+\z", "").alias("stripped"),
        text.extract(body, "([0-9]+)").alias("digits"), body.rlike("(?i)the").alias("has_the"),
        F.contains(body, F.lit("th")).alias("has_th"), text.piece(body, 3, 5).alias("piece"),
        F.concat(F.upper("lang"), F.lower("source")).alias("codes"),
        text.capitalise("source").alias("capital"), body.startswith("T").alias("begins"),
        text.part(source, "r", 1).alias("left_part"), text.part(source, "r", -1).alias("right_part"),
        text.joined("/", "lang", "source", "n_chars").alias("path"),
        F.replace(body, F.lit("an"), F.lit("*")).alias("literal"),
    )


@query(
    "math_trig",
    """
    SELECT s_suppkey, round(sin(radians(s_suppkey % 90)) + cos(radians(s_suppkey % 60)), 6) AS waves,
      ceil(s_acctbal / 100) AS hundreds, sign(s_acctbal) AS side, abs(s_acctbal) AS size,
      ceil(abs(s_acctbal) / 1.2 / 60) AS minutes, CASE WHEN s_nationkey % 2 = 0 THEN -s_acctbal ELSE s_acctbal END AS signed,
      CASE WHEN s_nationkey <> 0 THEN s_acctbal / s_nationkey END AS safe, floor(s_acctbal * 10 + 0.5) / 10 AS half
    FROM supplier""",
)
def math_trig(t: Tables) -> DataFrame:
    balance, nation = F.col("s_acctbal"), F.col("s_nationkey")
    waves = F.sin(F.radians(F.col("s_suppkey") % 90)) + F.cos(F.radians(F.col("s_suppkey") % 60))
    return t.supplier.select(
        "s_suppkey", F.round(waves, 6).alias("waves"), F.ceil(balance / 100).cast("double").alias("hundreds"),
        F.signum(balance).cast("tinyint").alias("side"), F.abs(balance).alias("size"),
        numbers.walking_minutes(F.abs(balance)).alias("minutes"),
        numbers.signed(balance, nation % 2 == 0).alias("signed"), F.try_divide(balance, nation).alias("safe"),
        numbers.half_up(balance, 1).alias("half"),
    )


@query(
    "date_parse",
    """
    WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT o_orderkey, d AS slashed, d AS named, d AS compact, d AS weekday_text,
      CASE WHEN o_orderkey % 3 <> 0 THEN d END AS lenient, CAST(isodow(d) AS BIGINT) AS iso,
      CAST(CASE WHEN month(d) >= 7 THEN (month(d) - 7) // 3 + 1 ELSE (month(d) + 5) // 3 + 1 END AS BIGINT) AS fiscal,
      CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(d + INTERVAL 1 MONTH AS DATE) AS next_month,
      strftime(d, '%B-%Y') AS label, strftime(d, '%a') AS short, CAST(d - DATE '1995-01-01' AS BIGINT) AS days,
      CAST(year(d) - 1990 AS BIGINT) AS age, d < DATE '1998-01-01' AS early FROM d""",
)
def date_parse(t: Tables) -> DataFrame:
    day = F.col("d")
    texts = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    spoilt = F.when(F.col("o_orderkey") % 3 == 0, "not a date").otherwise(F.date_format(day, "dd/MM/yyyy HH:mm:ss"))
    result = texts.select(
        "o_orderkey",
        dates.parse(F.date_format(day, "d/M/yyyy"), "d/M/yyyy").alias("slashed"),
        dates.parse(F.date_format(day, "yyyy-MMMM-d"), "y-MMMM-d").alias("named"),
        dates.parse(F.date_format(day, "yyyyMMMMdd"), "yyyyMMMMdd").alias("compact"),
        dates.parse_with_weekday(F.date_format(day, "EEEE, d MMMM, yyyy"), "d MMMM, yyyy").alias("weekday_text"),
        dates.parse_lenient(spoilt, "dd/MM/yyyy HH:mm:ss").alias("lenient"),
        dates.iso_weekday(day).alias("iso"), dates.fiscal_quarter(day).alias("fiscal"),
        dates.month_start(day).alias("month_start"), F.add_months(day, 1).alias("next_month"),
        dates.month_label(day).alias("label"), F.date_format(day, "E").alias("short"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("days"),
        dates.year_gap(day, F.lit("1990-06-01").cast("date")).alias("age"),
        (day < F.lit("1998-01-01").cast("date")).alias("early"),
    )
    return longs(result, "iso", "fiscal", "days", "age")


@query(
    "currency_scale",
    """
    SELECT c_custkey, CAST(CAST(abs(c_acctbal) AS DECIMAL(18,2))
      * CASE c_custkey % 3 WHEN 0 THEN 1000000000 WHEN 1 THEN 1000000 ELSE 1 END AS DOUBLE) AS amount FROM customer""",
)
def currency_scale(t: Tables) -> DataFrame:
    suffix = F.element_at(F.array(F.lit("B"), F.lit("M"), F.lit("")), (F.col("c_custkey") % 3 + 1).cast("int"))
    shown = F.concat(F.lit(" $"), money(F.abs("c_acctbal")).cast("string"), suffix)
    scales = {"B": 1_000_000_000, "M": 1_000_000}
    return doubles(t.customer.select("c_custkey", text.currency(shown, scales).alias("amount")), "amount")


@query(
    "case_ops",
    """
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 25 THEN 'middle' ELSE 'large' END AS size_class,
      CASE WHEN p_retailprice < 1000 THEN CASE WHEN p_size < 25 THEN 'cheap small' ELSE 'cheap large' END END AS nested,
      CASE p_type WHEN 'SMALL' THEN 'S' WHEN 'LARGE' THEN 'L' ELSE '?' END AS code,
      coalesce(nullif(p_brand, 'Brand#1'), p_type) AS filled FROM part""",
)
def case_ops(t: Tables) -> DataFrame:
    size = F.col("p_size")
    inner = cases.first_match([(size < 25, "cheap small")], "cheap large")
    return t.part.select(
        "p_partkey", cases.bucketize(size, (10, 25), ("small", "middle", "large")).alias("size_class"),
        cases.first_match([(F.col("p_retailprice") < 1000, inner)]).alias("nested"),
        cases.lookup(F.col("p_type"), {"SMALL": "S", "LARGE": "L"}, "?").alias("code"),
        F.coalesce(F.nullif(F.col("p_brand"), F.lit("Brand#1")), F.col("p_type")).alias("filled"),
    )


@query(
    "top_rows",
    """
    SELECT event_id, event_type, value, CAST(r AS BIGINT) AS place FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS r FROM events)
    WHERE r <= 10""",
)
def top_rows(t: Tables) -> DataFrame:
    order = [F.col("value").desc(), F.col("event_id")]
    best = windows.top_rows(t.events, ["event_type"], order, 10, "place")
    return longs(best.select("event_id", "event_type", "value", "place"), "place")


_RANKED = """
    SELECT o_orderkey, status, CASE WHEN price IS NOT NULL THEN
        CAST(dense_rank() OVER (PARTITION BY status ORDER BY price DESC NULLS LAST) AS BIGINT) END AS place
    FROM (SELECT o_orderkey, {status} AS status, nullif(floor(o_totalprice / 10), 20000) AS price FROM orders)"""


def _ranked(t: Tables, keys: list[str], **options) -> DataFrame:
    status = F.col("o_orderstatus") if keys else F.lit("all")
    price = F.nullif(F.floor(F.col("o_totalprice") / 10), F.lit(20000))
    facts = t.orders.select("o_orderkey", status.alias("status"), price.alias("price"))
    ranked = slices.dense_rank(facts, keys, "price", "place", descending=True, **options)
    return longs(ranked.select("o_orderkey", "status", "place"), "place")


@query("dense_rank_groups", _RANKED.format(status="o_orderstatus"))
def dense_rank_groups(t: Tables) -> DataFrame:
    return _ranked(t, ["status"])


@query("dense_rank_global", _RANKED.format(status="'all'"))
def dense_rank_global(t: Tables) -> DataFrame:
    return _ranked(t, [])


@query("dense_rank_global_sliced", _RANKED.format(status="'all'"))
def dense_rank_global_sliced(t: Tables) -> DataFrame:
    return _ranked(t, [], rows_per_slice=2000)


_RUNNING = """
    SELECT event_id, CAST(row_number() OVER w AS BIGINT) AS place,
      CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total,
      lag(value) OVER w AS previous,
      last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
        OVER (w ROWS UNBOUNDED PRECEDING) AS last_purchase
    FROM events WINDOW w AS (PARTITION BY event_type = 'view' ORDER BY ts, event_id)"""


def _running(t: Tables, **options) -> DataFrame:
    facts = t.events.select(
        "event_id", "ts", "value", (F.col("event_type") == "view").alias("side"), money("value").alias("amount"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase"),
    )
    result = slices.running(
        facts, ["side"], [F.col("ts"), F.col("event_id")], row_number="place",
        sums={"total": "amount"}, lags={"previous": "value"}, fills={"last_purchase": "purchase"}, **options,
    )
    return doubles(result.select("event_id", "place", "total", "previous", "last_purchase"), "total")


@query("running_values", _RUNNING)
def running_values(t: Tables) -> DataFrame:
    return _running(t)


@query("running_values_sliced", _RUNNING)
def running_values_sliced(t: Tables) -> DataFrame:
    return _running(t, rows_per_slice=1000)


_ROLLING = f"""
    SELECT event_id, CASE WHEN count(*) OVER w = 7
      THEN {sql_ratio("sum(CAST(value AS DECIMAL(18,2))) OVER w", "7", 2)} END AS mean_7
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 6 PRECEDING)"""


def _rolling(t: Tables, **options) -> DataFrame:
    facts = t.events.select("event_id", "ts", "event_type", money("value").alias("amount"))
    result = slices.rolling_mean(
        facts, ["event_type"], [F.col("ts"), F.col("event_id")], "amount", 7, "mean_7", 2, **options
    )
    return result.select("event_id", "mean_7")


@query("rolling_mean", _ROLLING)
def rolling_mean(t: Tables) -> DataFrame:
    return _rolling(t)


@query("rolling_mean_sliced", _ROLLING)
def rolling_mean_sliced(t: Tables) -> DataFrame:
    return _rolling(t, rows_per_slice=1000)
