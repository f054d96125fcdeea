import datetime as dt

import pytest
from pyspark.sql import functions as F

from spindrift.functions import cases, dates, numbers, text
from spindrift.operators import columns, reshape


def one(spark, column, value="x", kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "column, value, expected",
    [
        (text.strip_ws, " \t a b \n", "a b"),
        (lambda c: text.replace_first(c, "a", "X"), "banana", "bXnana"),
        (lambda c: text.replace_first_literal(c, "$", ""), "$1$", "1$"),
        (lambda c: text.replace_first(c, r"\[|\(", "***"), "a(b[c", "a***b[c"),
        (lambda c: text.part(c, "***", 1), "a***b", "a"),
        (lambda c: text.part(c, ",", -1), "a,b,c", "c"),
        (lambda c: text.extract(c, r"(\d+)"), "ab12", "12"),
        (lambda c: text.extract(c, r"(\d+)"), "ab", None),
        (lambda c: text.piece(c, 6), "AP on Server", "Server"),
        (lambda c: text.joined("-", c, F.lit(None).cast("string")), "a", None),
        (lambda c: text.joined("-", c, F.lit(5)), "a", "a-5"),
        (text.capitalise, "hELLO wORLD", "Hello world"),
        (text.initials, "Mary Ann Lee", "MA"),
        (text.initials, "Mary", "M"),
    ],
)
def test_text(spark, column, value, expected):
    assert one(spark, column, value) == expected


def test_two_parts(spark):
    both = lambda c: text.two_parts(c, ":", ("a", "b"))
    assert tuple(one(spark, both, "x: y: z")) == ("x", " y")
    assert tuple(one(spark, both, "x")) == ("x", None)


@pytest.mark.parametrize(
    "value, expected", [("$1.50B", 1_500_000_000), (" $2M", 2_000_000), ("$123.45", 123.45), ("1,250", 1250)]
)
def test_currency(spark, value, expected):
    found = one(spark, lambda c: text.currency(c, {"B": 10**9, "M": 10**6}), value)
    assert float(found) == expected


@pytest.mark.parametrize(
    "column, value, expected",
    [
        (lambda c: dates.parse(c, "d/M/yyyy"), "03/4/2021", dt.date(2021, 4, 3)),
        (lambda c: dates.parse_lenient(c, "dd/MM/yyyy"), "nope", None),
        (lambda c: dates.parse_with_weekday(c, "d MMMM, yyyy"), "Monday, 5 May, 2008", dt.date(2008, 5, 5)),
        (lambda c: dates.iso_weekday(F.to_date(c)), "2024-01-07", 7),
        (lambda c: dates.fiscal_quarter(F.to_date(c)), "2024-07-01", 1),
        (lambda c: dates.fiscal_quarter(F.to_date(c)), "2024-06-30", 4),
        (lambda c: dates.fiscal_quarter(F.to_date(c), 1), "2024-06-30", 2),
        (lambda c: dates.month_label(F.to_date(c)), "2024-06-30", "June-2024"),
    ],
)
def test_dates(spark, column, value, expected):
    assert one(spark, column, value) == expected


def test_strict_parse_raises(spark):
    with pytest.raises(Exception, match="(?i)parse"):
        one(spark, lambda c: dates.parse(c, "dd/MM/yyyy"), "not a date")


def test_numbers(spark):
    df = spark.createDataFrame([(0.5,), (2.5,), (-2.5,), (None,)], "x double")
    assert [r[0] for r in df.select(numbers.half_up(F.col("x"))).collect()] == [1.0, 3.0, -2.0, None]
    means = spark.createDataFrame([(2.33,), (2.34,)], "x double").agg(numbers.mean(F.col("x"), 2)).first()[0]
    assert means == 2.34  # 2.335 rounds up
    zero = df.select(numbers.ratio(F.lit(1), F.lit(0), 2)).first()[0]
    assert zero is None
    same = df.select(
        numbers.great_circle_miles(F.lit(0.9), F.lit(0.1), F.lit(0.9), F.lit(0.1)).alias("m")
    ).first()[0]
    assert same == pytest.approx(0, abs=1e-3)


def test_cases(spark):
    df = spark.createDataFrame([(1, "a"), (10, "b"), (25, "q"), (None, None)], "x int, k string")
    out = df.select(
        cases.bucketize(F.col("x"), (10, 25), ("s", "m", "l"), "none").alias("b"),
        cases.first_match([(F.col("x") < 5, "few"), (F.col("x") < 20, "some")]).alias("f"),
        cases.lookup(F.col("k"), {"a": 1, "b": 2}, 0).alias("l"),
        cases.canonical(F.col("k"), {"A": ["a", "q"]}, strict=False).alias("c"),
    ).collect()
    assert [tuple(r) for r in out] == [
        ("s", "few", 1, "A"), ("m", "some", 2, None), ("l", None, 0, "A"), ("none", None, 0, None),
    ]
    with pytest.raises(Exception, match="no mapping"):
        df.select(cases.canonical(F.col("k"), {"A": ["a"]})).collect()
    with pytest.raises(ValueError):
        cases.bucketize(F.col("x"), (1,), ("a",))


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, (3, 4))], "`A B` int, `c.d` int, s struct<x:int,y:int>")
    assert columns.with_headers(df).columns == ["a_b", "c.d", "s"]
    assert columns.unnest(df, "s").columns == ["A B", "c.d", "x", "y"]
    assert columns.without(df, "s", pattern=r"^c\.").columns == ["A B"]
    assert columns.map_columns(df, lambda c: c * 10, ["c.d"]).first()["c.d"] == 20
    assert columns.matching(df, " ") == ["A B"]
    assert columns.positional(df, ["p", "q", "r"]).columns == ["p", "q", "r"]
    with pytest.raises(ValueError):
        columns.positional(df, ["p"])


def test_long_then_wide_is_identity(spark):
    rows = [(i, i * 2, i * 3, None if i == 2 else i) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, a int, `b c` int, d int")
    long = reshape.to_long(df, ["id"])
    assert long.count() == 15
    for coarse in (False, True):
        wide = reshape.to_wide(long, ["id"], "variable", ["a", "b c", "d"], "value", coarse=coarse)
        assert wide.columns == df.columns and sorted(map(tuple, wide.collect())) == rows


def test_split_rows(spark):
    df = spark.createDataFrame([(1, "4, 5"), (2, "6"), (3, None)], "id int, h string")
    out = reshape.split_rows(df, "h", ",", "bigint").collect()
    assert sorted(map(tuple, out)) == [(1, 4), (1, 5), (2, 6)]


def test_ratio_of_large_denominators(spark):
    rows = [(5, 2 * 10**14), (10**15, 2 * 10**14), (-(10**17), 8 * 10**17), (3, 0)]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    got = [r[0] for r in df.select(numbers.ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [0.0, 5.0, -0.13, None]
