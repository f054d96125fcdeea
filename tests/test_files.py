import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spindrift.operators import staging
from spindrift.operators.columns import snake
from spindrift.sources import files, sinks


def write(path, content, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode(encoding))
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_mark_at_start_separator_null_and_headers(spark, tmp_path):
    path = write(tmp_path / "a.csv", "﻿Account Number;Balance Date\n1;1900-01-00\n2;03/02/2023\n")
    df = files.read_csv(spark, path, separator=";", null_value="1900-01-00", headers=snake)
    assert df.columns == ["account_number", "balance_date"]
    assert rows(df) == [("1", None), ("2", "03/02/2023")]


def test_schema_and_column_subset(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b,c\n1,2.5,x\n")
    df = files.read_csv(spark, path, "a int, b double, c string", columns=["c", "a"])
    assert df.dtypes == [("c", "string"), ("a", "int")] and rows(df) == [("x", 1)]


def test_bad_bytes_are_replaced(spark, tmp_path):
    path = write(tmp_path / "a.csv", b"n\ncaf\xe9\n")
    assert rows(files.read_csv(spark, path)) == [("caf�",)]


def test_many_files_take_a_column_from_the_name(spark, tmp_path):
    write(tmp_path / "in put/DATA.csv", "id,v\n1,a\n")
    write(tmp_path / "in put/DATA-12.csv", "id,v\n2,b\n")
    df = files.read_many(spark, f"{tmp_path}/in put/*.csv", "id int, v string", {"month": r"DATA-?(\d*)\.csv$"})
    assert rows(df) == [(1, "a", ""), (2, "b", "12")]


def test_sheets_with_other_spellings_and_an_extra_column(spark, tmp_path):
    write(tmp_path / "book/January.csv", "id,demographic\n1,x\n")
    write(tmp_path / "book/May 2.csv", "id,Demagraphic,Comments\n2,y,hello\n")
    df = files.read_sheets(spark, f"{tmp_path}/book", "id int, demographic string", "month",
                            spellings={"Demagraphic": "demographic"})
    assert rows(df) == [(1, "x", "January"), (2, "y", "May 2")]


def test_files_are_matched_by_header_name(spark, tmp_path):
    write(tmp_path / "a/1.csv", "id,v\n1,a\n")
    write(tmp_path / "a/2.csv", "v,id\nb,2\n")
    write(tmp_path / "a/3.csv", "w,id,v\n9,3,c\n")
    read = lambda **o: files.read_many(spark, f"{tmp_path}/a/*.csv", "id int, v string", {"n": r"(\d)\.csv$"}, **o)
    assert rows(read(spellings={})) == [(1, "a", "1"), (2, "b", "2"), (3, "c", "3")]
    with pytest.raises(Exception, match="(?i)header"):
        read().collect()
    write(tmp_path / "a/4.csv", "id\n4\n")
    with pytest.raises(ValueError, match="4.csv has no single column"):
        read(spellings={})


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()

    def jobs(n):
        folder = tmp_path / f"{n} files"
        for i in range(n):
            head, row = [("id,v", f"{i},a"), ("v,id", f"a,{i}"), ('"id","other, one",v', f'{i},"x,y",a')][i % 3]
            write(folder / f"{i}.csv", f"{head}\n{row}\n")
        spark.sparkContext.setJobGroup(f"headers {n}", "")
        df = files.read_many(spark, f"{folder}/*.csv", "id int, v string", {"n": r"(\d+)\.csv$"}, spellings={})
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert sorted((r["id"], r["v"], r["n"]) for r in df.collect()) == sorted((i, "a", str(i)) for i in range(n))
        return len(tracker.getJobIdsForGroup(f"headers {n}"))

    few = jobs(3)
    assert jobs(30) == few
    assert jobs(90) <= few + 1  # Spark lists more than 32 paths by a job of its own


def test_header_catalogue(spark, tmp_path):
    write(tmp_path / "h/1.csv", b"\xef\xbb\xbfid,v\r\n1,a\r\n")
    write(tmp_path / "h/a b%20c.csv", "id,v\n" + "2,b\n" * 5000)
    write(tmp_path / "h/3.csv", "id;v")
    write(tmp_path / "h/4.csv", "")
    found = files.header_catalogue(spark, f"{tmp_path}/h/*.csv")
    assert {h: [f.rsplit("/", 1)[1] for f in group] for h, group in found.items()} == {
        ("id", "v"): ["1.csv", "a b%20c.csv"], ("id;v",): ["3.csv"], (): ["4.csv"]}
    write(tmp_path / "l/1.csv", b"caf\xe9;v\n1;a\n")
    assert list(files.header_catalogue(spark, f"{tmp_path}/l", separator=";", encoding="ISO-8859-1")) == [("caf\xe9", "v")]
    with pytest.raises(ValueError, match="4.csv has no single column"):
        files.read_many(spark, [f"{tmp_path}/h/1.csv", f"{tmp_path}/h/4.csv"], "id int, v string", {}, spellings={})


def test_bad_cells_are_errors_unless_asked(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,v\nx,a\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, path, "id int, v string").collect()
    assert rows(files.read_csv(spark, path, "id int, v string", bad_cells="PERMISSIVE")) == [(None, "a")]


def test_landed_headers_fit_the_jobs(spark, tmp_path):
    from spindrift.plans import banking

    write(tmp_path / "t.csv", "Transaction Code,Value,Customer Ref,Online or In-Person,Transaction Date\n"
          f"{banking.BANK_CODE.strip('^$')}-1,5,1,1,20/03/2023 00:00:00\n")
    write(tmp_path / "g.csv", "Online or In-Person,Q1,Q2,Q3,Q4\nOnline,3,3,3,3\nIn-Person,2,2,2,2\n")
    t = files.read_snake(spark, f"{tmp_path}/t.csv").withColumn("value", F.col("value").cast("int"))
    got = rows(banking.quarterly_variance(t, files.read_snake(spark, f"{tmp_path}/g.csv")))
    assert got == [(1, "Online", 5, 3, 2)]


def test_ordered_output_and_shared_parent(spark, tmp_path):
    df = spark.range(100).withColumn("k", F.col("id") * 37 % 100)
    sinks.write_outputs({"o": lambda d: d, "p": lambda d: d.select("k")}, str(tmp_path), shared=[df], order_by=["k"])
    parts = sorted((tmp_path / "o").glob("part-*"))
    lines = [line.split(",")[1] for p in parts for line in p.read_text().splitlines()[1:]]
    assert lines == [str(i) for i in range(100)]


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_ordered_files_of_other_formats(spark, tmp_path, kind):
    df = spark.range(500).withColumn("k", F.col("id") * 37 % 500).repartition(7)
    write_kind = {"parquet": sinks.write_parquet, "json": sinks.write_json}[kind]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_kind(df, f"{tmp_path}/o", order_by=[F.col("k").desc()])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "o").glob("part-*"))) > 1
    read = sinks.read_in_order(spark, f"{tmp_path}/o", kind, "place")
    assert sorted((r["place"], r["k"]) for r in read.collect()) == [(i + 1, 499 - i) for i in range(500)]


def test_a_shared_parent_is_made_once_and_outlives_its_blocks(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    parent = spark.range(100).mapInArrow(count, "id long")

    def second(d):
        spark.catalog.clearCache()  # what a lost executor takes with it
        assert "MapInArrow" not in d._jdf.queryExecution().executedPlan().toString()
        return d.select((F.col("id") * 2).alias("x"))

    before = set(Path(staging.folder(spark)).glob("shared-*"))
    sinks.write_outputs({"a": lambda d: d, "b": second}, str(tmp_path), shared=[parent])
    assert made.value == 100
    assert sum(int(r["x"]) for r in files.read_csv(spark, f"{tmp_path}/b").collect()) == 9900
    assert set(Path(staging.folder(spark)).glob("shared-*")) == before


def test_headerless_with_title_rows(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Title,,\n,,\n1,2,x\n")
    df = files.read_headerless(spark, path, 3, keep=F.col("column_2").isNotNull())
    assert rows(df) == [("1", "2", "x")]


def result(spark):
    return spark.createDataFrame([(1, 2.345, dt.date(2023, 4, 5)), (2, None, None)], "id int, `v £` double, d date")


def test_csv_formats(spark, tmp_path):
    sinks.write_csv(result(spark), f"{tmp_path}/o", date_format="dd/MM/yyyy", float_digits=2)
    df = files.read_csv(spark, f"{tmp_path}/o")
    assert df.columns == ["id", "v £", "d"]
    assert rows(df) == [("1", "2.35", "05/04/2023"), ("2", None, None)]


def test_formats_and_several_outputs(spark, tmp_path):
    df = result(spark)
    sinks.write_formats(df, {k: f"{tmp_path}/{k}" for k in ("csv", "parquet", "json")})
    assert rows(spark.read.parquet(f"{tmp_path}/parquet")) == rows(df)
    assert any(p.name.endswith(".zstd.parquet") for p in (tmp_path / "parquet").iterdir())
    assert spark.read.json(f"{tmp_path}/json").count() == 2
    sinks.write_outputs({"one": df, "two": df.limit(1)}, str(tmp_path))
    assert files.read_csv(spark, f"{tmp_path}/two").count() == 1
    with pytest.raises(KeyError):
        sinks.write_formats(df, {"xlsx": f"{tmp_path}/x"})
