"""Sliced operators against plain Python on skewed groups."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spindrift.operators import selection, slices


def facts(seed, rows=600):
    """One group holds most rows; values have NULLs and ties, order keys have ties."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        group = None if rng.random() < 0.05 else ("hot" if rng.random() < 0.7 else rng.choice("abc"))
        value = None if rng.random() < 0.2 else rng.randrange(40)
        out.append((i, group, rng.randrange(30), value))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, g string, t int, v int").repartition(5)


def by_group(rows):
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        groups[row[1]].append(row)
    return groups


@pytest.mark.parametrize("limit", [7, 50, 10_000])
@pytest.mark.parametrize("keys", [["g"], []])
def test_running(spark, limit, keys):
    rows = facts(1)
    expected = {}
    groups = by_group(rows) if keys else {0: sorted(rows, key=lambda r: (r[2], r[0]))}
    for members in groups.values():
        total, last = None, None
        for n, (i, _, _, v) in enumerate(members):
            total = v if total is None else total + (v or 0)
            last = v if v is not None else last
            expected[i] = (n + 1, total, members[n - 1][3] if n else None, last)
    df = slices.running(
        frame(spark, rows), keys, [F.col("t"), F.col("id")], row_number="n",
        sums={"total": "v"}, lags={"before": "v"}, fills={"known": "v"}, rows_per_slice=limit,
    )
    got = {r["id"]: (r["n"], r["total"], r["before"], r["known"]) for r in df.collect()}
    assert got == expected


def test_running_with_every_group_hot(spark, monkeypatch):
    monkeypatch.setattr(slices, "MAX_HOT_GROUPS", 1)
    test_running(spark, 7, ["g"])


def test_only_hot_groups_are_cut(spark):
    rows = facts(2)
    sizes = {g: len(m) for g, m in by_group(rows).items()}
    hot = slices.measure(frame(spark, rows), ["g"], 100)
    assert len(hot.groups) == sum(1 for n in sizes.values() if n > 100) == 1
    assert hot.slices == -(-max(sizes.values()) // 100)
    assert slices.measure(frame(spark, rows), ["g"], 1000) == slices.Hot()


def test_the_plan_does_not_grow_with_the_rows(spark):
    def plan(rows):
        df = spark.range(rows).select((F.col("id") % 2).alias("g"), "id", F.lit(1).alias("v"))
        found = slices.running(df, ["g"], [F.col("id")], sums={"s": "v"}, lags={"l": "id"}, rows_per_slice=10)
        assert found.where(F.col("s") != F.floor(F.col("id") / 2) + 1).isEmpty()
        return found._jdf.queryExecution().optimizedPlan().toString()

    small, large = plan(100), plan(4000)
    assert abs(len(large) - len(small)) < 20


def test_a_lost_slice_is_made_again_alike(spark):
    """The slices are files, so a second evaluation of either side of the join reads the same ones."""
    df = spark.range(3000).select(F.lit("g").alias("g"), F.xxhash64("id").alias("t"))
    found = slices.running(df, ["g"], [F.col("t")], row_number="n", rows_per_slice=100)
    assert "Range" not in found._jdf.queryExecution().optimizedPlan().toString()
    numbers = [sorted(r["n"] for r in found.collect()) for _ in range(2)]
    assert numbers == [list(range(1, 3001))] * 2


def test_ties_of_one_position_are_parted(spark):
    df = spark.range(1000).select(F.lit(None).cast("string").alias("g"), F.lit(7).alias("t"), "id")
    found = slices.running(df, ["g"], [F.col("t"), F.col("id")], row_number="n", rows_per_slice=50)
    assert found.where(F.col("n") != F.col("id") + 1).isEmpty() and found.count() == 1000


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("limit", [5, 10_000])
def test_dense_rank(spark, descending, limit):
    rows = facts(3)
    df = slices.dense_rank(frame(spark, rows), ["g"], "v", "r", descending=descending, rows_per_slice=limit)
    got = {r["id"]: r["r"] for r in df.collect()}
    for members in by_group(rows).values():
        values = sorted({r[3] for r in members if r[3] is not None}, reverse=descending)
        for i, _, _, v in members:
            assert got[i] == (None if v is None else values.index(v) + 1)


@pytest.mark.parametrize("limit", [10, 10_000])
def test_rolling_mean(spark, limit):
    rows = [(i, g, t, 5 if v is None else v) for i, g, t, v in facts(4)]
    df = slices.rolling_mean(
        frame(spark, rows), ["g"], [F.col("t"), F.col("id")], "v", 4, "m", rows_per_slice=limit
    )
    got = {r["id"]: r["m"] for r in df.collect()}
    assert len(got) == len(rows)
    for members in by_group(rows).values():
        for n, row in enumerate(members):
            window = [r[3] for r in members[max(0, n - 3) : n + 1]]
            expected = sum(window) / 4 if len(window) == 4 else None
            assert got[row[0]] == pytest.approx(expected) if expected is not None else got[row[0]] is None


@pytest.mark.parametrize("limit", [5, 10_000])
def test_quantiles(spark, limit):
    rows = facts(5)
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    df = selection.quantiles(frame(spark, rows), ["g"], "v", shares, rows_per_slice=limit)
    got = {r["g"]: r for r in df.collect()}
    for group, members in by_group(rows).items():
        values = sorted(r[3] for r in members if r[3] is not None)
        for name, share in shares.items():
            at = (len(values) - 1) * share
            low = values[int(at)]
            high = values[min(int(at) + 1, len(values) - 1)]
            assert got[group][name] == pytest.approx(low + (high - low) * (at - int(at)))


@pytest.mark.parametrize("limit", [8, 200])
def test_quantiles_narrow_large_groups_by_counts(spark, limit):
    rng = random.Random(11)
    rows = [("wide", rng.uniform(-1, 1) * 10 ** rng.randrange(-9, 9)) for _ in range(3000)]
    rows += [("tied", 5.0 if rng.random() < 0.9 else rng.random() * 10) for _ in range(2000)]
    rows += [("one", 1.0)] * 700 + [(None, float(i)) for i in range(500)] + [("few", 2.0), ("few", 4.0)]
    rows += [("none", None)] * 300
    shares = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.999, "e": 1.0}
    df = selection.quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", shares, rows_per_slice=limit)
    got = {r["g"]: r for r in df.collect()}
    assert set(got) == {"wide", "tied", "one", None, "few"}
    for group in got:
        values = sorted(v for g, v in rows if g == group and v is not None)
        for name, share in shares.items():
            at = (len(values) - 1) * share
            low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            assert got[group][name] == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-12)


def test_quantiles_order_no_values(spark):
    df = selection.quantiles(frame(spark, facts(3)), ["g"], "v", {"a": 0.5}, rows_per_slice=50)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_small_slices_are_written_together(spark, monkeypatch):
    kept = []
    stage = slices.staged
    monkeypatch.setattr(slices, "staged", lambda df, name: kept.append(stage(df, name)) or kept[-1])
    df = spark.range(4000).select((F.col("id") % 3).cast("string").alias("g"), F.col("id").alias("t"), F.lit(1).alias("v"))
    got = slices.running(df, ["g"], [F.col("t")], sums={"total": "v"}, rows_per_slice=20)
    assert got.where("total <> t div 3 + 1").count() == 0 and got.count() == 4000
    (written,) = kept
    assert written.select("_slice").distinct().count() > 150
    assert len(written.inputFiles()) == 1
