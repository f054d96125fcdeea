"""Jobs on small hand-made tables, with the rows that tend to go wrong."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spindrift.plans import banking, markets, people, schedules, school


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def d(text):
    return dt.date.fromisoformat(text)


def test_first_joining_keeps_the_earliest_date(spark):
    cells = []
    for joined, month in ((3, "May"), (1, "May"), (9, "April")):
        for what, value in (("Ethnicity", "E"), ("Date of Birth", "7/5/1990"), ("Account Type", "Basic")):
            cells.append((1, joined, what, value, month))
    df = spark.createDataFrame(cells, "id int, joining_day int, demographic string, value string, month string")
    assert rows(banking.first_joining(df)) == [(1, "E", d("1990-07-05"), "Basic", d("2023-04-09"))]
    assert rows(banking.duplicated(df, "id")) == [(1, 9)]


@pytest.mark.parametrize(
    "difference, label",
    [(2, "Mobile App Superfan"), (1, "Mobile App Fan"), (0.99, "Neutral"), (-0.99, "Neutral"),
     (-1, "Online Interface Fan"), (-2, "Online Interface Superfan"), (None, None)],
)
def test_fan_label_edges(spark, difference, label):
    df = spark.createDataFrame([(None if difference is None else float(difference),)], "x double")
    assert df.select(banking.fan_label(F.col("x"))).first()[0] == label


def test_large_transfers_lists_every_holder(spark):
    paths = spark.createDataFrame([(1, 20, 10), (2, 20, 10), (3, 20, 11)], "transaction_id int, account_to int, account_from int")
    details = spark.createDataFrame(
        [(1, d("2023-01-01"), 1000.0, "N"), (2, d("2023-01-01"), 999.0, "N"), (3, d("2023-01-01"), 5000.0, "N")],
        "transaction_id int, transaction_date date, value double, `cancelled?` string",
    )
    accounts = spark.createDataFrame(
        [(10, "Basic", "7, 8"), (11, "Platinum", "7")],
        "account_number int, account_type string, account_holder_id string",
    )
    holders = spark.createDataFrame(
        [(7, "111", "01/02/1990"), (8, "222", "3/4/1991")],
        "account_holder_id bigint, contact_number string, date_of_birth string",
    )
    out = banking.large_transfers(paths, holders, details, accounts)
    assert rows(out.select("transaction_id", "contact_number", "date_of_birth")) == [
        (1, "07111", d("1990-02-01")), (1, "07222", d("1991-04-03")),
    ]


@pytest.mark.parametrize("limit", [2, 1000])
def test_running_statement(spark, limit):
    paths = spark.createDataFrame([(1, 1, 2), (2, 1, 2), (3, 2, 1)], "transaction_id bigint, account_to int, account_from int")
    details = spark.createDataFrame(
        [(1, d("2023-02-01"), 5.0, "N"), (2, d("2023-02-01"), 7.0, "N"), (3, d("2023-02-01"), 9.0, "Y")],
        "transaction_id bigint, transaction_date date, value double, `cancelled?` string",
    )
    accounts = spark.createDataFrame(
        [(1, d("2023-01-31"), 100.0), (2, d("2023-01-31"), 50.0)],
        "account_number int, balance_date date, balance double",
    )
    out = banking.running_statement(details, paths, accounts, rows_per_slice=limit)
    assert rows(out) == rows(spark.createDataFrame([
        (1, d("2023-01-31"), None, 100.0), (1, d("2023-02-01"), 100.0, 107.0), (1, d("2023-02-01"), 7.0, 112.0),
        (2, d("2023-01-31"), None, 50.0), (2, d("2023-02-01"), 50.0, 45.0), (2, d("2023-02-01"), -5.0, 38.0),
    ], out.schema))


def test_balance_on_agrees_with_every_day(spark):
    data = [(1, d("2023-01-02"), 10.0, 1.0), (1, d("2023-01-04"), 20.0, None), (2, d("2023-01-05"), 7.0, 3.0),
            (1, d("2023-01-04"), 5.0, 2.0), (3, d("2023-01-01"), None, 4.0)]
    df = spark.createDataFrame(data, "account_number int, balance_date date, balance double, transaction_value double")
    every = banking.daily_balances(df)
    assert every.count() == 15
    for day in ("2023-01-01", "2023-01-03", "2023-01-05"):
        assert rows(banking.balance_on(df, day)) == rows(every.where(F.col("date") == F.lit(d(day))))
    # account 2 starts on its own first day, it does not inherit another account's balance
    assert every.where("account_number = 2 and balance is not null").count() == 1
    for bad in ("2023-01-06", "2022-12-31", "soon"):
        with pytest.raises(ValueError):
            banking.balance_on(df, bad)


def test_top_purchases(spark):
    data = [("n/a", "$1", None)] + [(f"${c}", f"${p}", m) for c, p, m in
            [("1.5B", 100, None), ("1.5B", 100, None), ("2.5B", 90, None), ("3B", 80, None), ("3B", 70, None),
             ("3B", 60, None), ("3B", 50, None), ("5", 26000, 2), ("200000M", 80000, 2)]]
    df = spark.createDataFrame(data, "market_cap string, purchase_price string, file_month int")
    out = markets.top_purchases(df)
    got = [(float(r["purchase_price"]), r["purchase_price_rank"]) for r in out.where("market_cap_category = 'Large'").collect()]
    assert sorted(got, reverse=True) == [(100, 1), (100, 1), (90, 2), (80, 3), (70, 4), (60, 5)]
    small = out.where("market_cap_category = 'Small'").first()
    assert (small["file_date"], small["purchase_price_category"]) == (d("2023-02-01"), "Medium")
    assert out.where("market_cap_category = 'Huge'").first()["purchase_price_category"] == "Very High"


def test_recent_moving_average(spark):
    data = [("s", 1 + i // 50, i, float(i)) for i in range(130)] + [("t", 1, 1, 4.0), ("t", 1, 2, 8.0)]
    df = spark.createDataFrame(data, "sector string, month_number int, id int, purchase_price double")
    got = {(r["sector"], r["trade_order"]): tuple(r)[2:] for r in markets.recent_moving_average(df, 3).collect()}
    assert len(got) == 102
    assert got["s", 31] == (29.0, 1) and got["s", 130] == (128.0, 100)
    assert got["t", 1] == (None, 1) and got["t", 2] == (None, 2)
    with pytest.raises(ValueError):
        markets.recent_moving_average(df, 0)


def test_trade_summary_reads_signed_padded_cells(spark):
    names = ["Reporter", "Partner", "Product categories", "Indicator Type", "Indicator", "2019", "2018", "country_code"]
    data = [
        ("A", "B", "all", "Export", "Growth", "  -12.5 ", None, "AAA"), ("A", "B", "all", "Export", "Growth", "2", "", "AAA"),
        ("B", "A", "all", "Import", "Value", "7", None, "BBB"), ("World", "A", "all", "Import", "Value", "7", None, "WLD"),
        ("A", "...", "all", "Import", "Value", "7", None, "AAA"), ("A", "B", "all", "Other", "Value", "7", None, "AAA"),
    ]
    sheet = spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))
    codes = spark.createDataFrame([("AAA", "1.5, 2.5"), ("BBB", None)], "`ISO3 CODE` string, geo_point_2d string")
    out = markets.trade_summary(sheet, codes, ["Growth", "Value"])
    got = rows(out.select("reporter", "growth", "value", "latitude", "longitude", "code_partner", "latitude_partner"))
    assert got == [("A", -10.5, None, 1.5, 2.5, "BBB", None), ("B", None, 7.0, None, None, "AAA", 1.5)]


def test_monthly_sales_fill_gaps(spark):
    data = [(d("2023-01-05"), "s", "b", 1, 3.0), (d("2023-01-20"), "s", "b", 1, 3.0), (d("2023-04-01"), "s", "b", 2, 9.0),
            (d("2023-07-01"), "s", "b", 2, 9.0), (d("2023-03-01"), "t", "b", 5, 1.0)]
    df = spark.createDataFrame(data, "date date, store string, bike_type string, sales int, profit double")
    got = rows(markets.monthly_sales(df).where("store = 's'").drop("store", "bike_type"))
    assert got == [(d("2023-01-01"), 2, 6.0, None), (d("2023-02-01"), 0, 0.0, None),
                   (d("2023-03-01"), 0, 0.0, 2.0), (d("2023-04-01"), 2, 9.0, 3.0)]


@pytest.mark.parametrize(
    "sales, trend",
    [((1, 2, 3, 4), "Going from strength to strength"), ((4, 3, 2, 1), "Going from bad to worse"),
     ((1, 2, 3, 2), "Good growth, until Q4"), ((1, 3, 2, 4), "Some good growth, but concerns in Q3"),
     ((3, 2, 3, 4), "Good growth in last half"), ((4, 3, 2, 3), "Concerning performance, but improving in Q4"),
     ((4, 3, 4, 3), "Concerning performance, excluding Q3"), ((3, 4, 3, 2), "Concerning performance in last half"),
     ((1, 1, 2, 3), None), ((0, 1, 2, 3), None)],
)
def test_store_trends(spark, sales, trend):
    data = [("s", "X", "Monday, 15 , 2022", m, v) for v, m in zip(sales, ("July", "October", "January", "April"))]
    df = spark.createDataFrame(data, "store string, model string, order_date string, month string, sales bigint")
    out = markets.store_trends(markets.order_days(df)).orderBy("fiscal_quarter").collect()
    assert [(r["sales"], r["%_diff_QoQ"], r["store_evaluation"]) for r in out] == [
        (v, sales[i - 1] if i else None, trend) for i, v in enumerate(sales)
    ]


def test_reporting_alignment(spark):
    days = [d("2023-03-29") + dt.timedelta(days=i) for i in range(9)]  # Wednesday to Thursday week
    customers = spark.createDataFrame([(x, 1) for x in days], "date date, new_customers int")
    sheet = spark.createDataFrame(
        [(1, "2023", "30-Mar", "off"), (2, None, "03-Apr", "off"), (3, None, None, None)],
        "row int, year string, date string, bank_holiday string",
    )
    holidays = schedules.bank_holidays(sheet)
    assert rows(holidays) == [(d("2023-03-30"), "off"), (d("2023-04-03"), "off")]
    other = spark.createDataFrame(
        [(d("2023-03-30"), "Mar-23", 5), (d("2023-04-05"), "Apr-23", 6)],
        "reported_day date, roi_reporting_month string, roi_new_customers int",
    )
    out = rows(schedules.reporting_alignment(holidays, customers, other))
    assert out == [
        ("April-2023", d("2023-03-31"), 1, 2, 5, "Mar-23", "X"),
        ("April-2023", d("2023-04-04"), 2, 4, 0, None, "X"),
        ("April-2023", d("2023-04-05"), 3, 1, 6, "Apr-23", None),
        ("March-2023", d("2023-03-29"), 1, 1, 0, None, "X"),
        ("May-2023", d("2023-04-06"), 1, 1, 0, None, "X"),
    ]


def test_density_growth(spark):
    population = spark.createDataFrame(
        [(" A ", 100, 400), ("B", 100, 300), ("C", 100, 300), ("D", None, 900), ("World", 1, 1)],
        "`Country Name` string, `2000` bigint, `2001` bigint",
    )
    sheet = spark.createDataFrame(
        [("A [x]", "1,0 (4)"), ("B(y)", "10"), ("C", "4 (1)"), ("C", "6"), ("D", "10"), ("World", "5")],
        "`Country / Dependency` string, `Total in km2 (mi2)` string",
    )
    grown, dense = schedules.density_growth(population, schedules.land_sizes(sheet), "2000", "2001", k=2)
    assert rows(grown) == [("A", 10.0, 40.0, 3.0, 1), ("B", 10.0, 30.0, 2.0, 2)]
    assert rows(dense) == [("A", 10.0, 40.0, 3.0, 2), ("D", None, 90.0, None, 1)]
    for first, last in (("20x0", "2001"), ("200", "2001"), ("1999", "2001"), ("2000", "2002")):
        with pytest.raises(ValueError):
            schedules.check_years(first, last, [2000, 2001])


def test_land_size_aliases(spark):
    sheet = spark.createDataFrame(
        [("Jersey (UK)", "1,118 (45)"), ("Guernsey [a]", "2")],
        "`Country / Dependency` string, `Total in km2 (mi2)` string",
    )
    assert rows(schedules.land_sizes(sheet)) == [("Channel Islands", 1120.0)]


def test_attendance_edges(spark):
    scores = spark.createDataFrame(
        [(i, 86.5, s, f"A_B{i}", "x") for i, s in enumerate(("Engish", "Scince", "Math"))],
        "student_id int, test_score double, subject string, student_name string, test_date string",
    )
    attendance = spark.createDataFrame(
        [("A_B0", 0.7), ("A_B1", 0.9), ("A_B2", 0.95)], "student_name string, attendance_percentage double"
    )
    out = school.attendance_flags(scores, attendance)
    assert rows(out.select("subject", "last_name", "test_score_int", "attendance_flag", "attendance_percentage")) == [
        ("English", "B0", 87.0, "Medium Attendance", Decimal("0.70")),
        ("Math", "B2", 87.0, "High Attendance", Decimal("0.95")),
        ("Science", "B1", 87.0, "Medium Attendance", Decimal("0.90")),
    ]


def test_unknown_grades_are_lowest(spark):
    df = spark.createDataFrame([("1", "A"), ("6", "F"), ("9", "Z"), (None, None)], "n string, g string")
    got = df.select(school.letter(F.col("n")), school.points(F.col("g"))).collect()
    assert [tuple(r) for r in got] == [("A", 50), ("F", 0), ("F", 0), ("F", 0)]


def test_ranked_applicants_cut_per_region(spark):
    data = [(i, "Art", region, i // 3, float(i % 3)) for region in ("EAST", "West", "north") for i in range(20)]
    df = spark.createDataFrame(data, "student_id int, subject_selection string, region string, grade_score int, distance double")
    out = school.ranked_applicants(df)
    assert rows(out.groupBy("region").count()) == [("EAST", 15), ("West", 5)]
    assert [r["student_id"] for r in out.where("region = 'West'").orderBy("student_rank").collect()] == [18, 19, 15, 16, 17]


def test_generations_and_age_bands(spark):
    born = ["01/01/1930", "1/1/1955", "31/12/1969", None]
    dim = spark.createDataFrame(
        [(i, "g", "f", "l", "n", "x", "e", b, "1/2/2010", None) for i, b in enumerate(born)],
        "employee_id int, guid string, first_name string, last_name string, nationality string, gender string,"
        " email string, date_of_birth string, hire_date string, leave_date string",
    )
    bands = spark.createDataFrame(
        [("Old", None, 1940), ("Mid", 1950, 1969), ("New", 1970, None)], "generation string, start_year int, end_year int"
    )
    closed = people.generations(dim, bands)
    names = {r["employee_id"]: r["gen_name"] for r in closed.collect()}
    assert names == {0: "Not Provided", 1: "Mid (1950-1969)", 2: "Mid (1950-1969)", 3: "Not Provided"}
    opened = {r["employee_id"]: r["gen_name"] for r in people.generations(dim, bands, open_ended=True).collect()}
    assert opened == {**names, 0: "Old (born in or before 1940)"}
    monthly = spark.createDataFrame(
        [(1, d("2023-01-31"), i) for i in range(5)], "dc_nbr int, month_end_date date, employee_id int"
    )
    ages = {r["employee_id"]: r["age_bucket"] for r in people.monthly_age_bands(monthly, closed).collect()}
    assert ages == {0: "70+ years", 1: "65-69 years", 2: "50-54 years", 3: "Not Provided"}


def test_age_labels():
    assert people.age_labels()[:2] == ["Under 20 years", "20-24 years"]
    assert people.age_labels()[-2:] == ["65-69 years", "70+ years"]


def test_repair_ids_of_two_tables(spark):
    dim = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "employee_id int, guid string")
    monthly = spark.createDataFrame([(2, "b", 5), (None, "a", 6), (3, None, 7)], "employee_id int, guid string, n int")
    one, two = people.repair_ids(dim, monthly)
    assert rows(one) == [(1, "a"), (2, "b")]
    assert rows(two) == [(1, "a", 6), (2, "b", 5)]
