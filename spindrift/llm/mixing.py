"""Mixing sources to target weights by entropy balancing.

A document's rate is its expected number of copies. Of all rates whose expected words meet every
source's target, with no rate above a cap, the balanced ones stay closest to one in relative
entropy: ``min(cap, exp(tilt * size / mean size))`` with one tilt per source. The tilts solve the
convex dual, whose gradient is a source's expected words less its target. Newton steps, kept
inside a bracket, run over the table of counted sizes per source: every step is an aggregate of
that table that all executors share, and only how many sources are left to solve, and by how much
the worst one is off, comes to the driver.

Rates become copies by systematic rounding: documents of a source in order of size, the running sum
of their rates, and a copy whenever it passes a whole number. Of several starting points the one
whose words come nearest the target is taken. Running sums cut large sources into slices.

Only DataFrame operations are used. Rates are fixed-point numbers and sums are exact, so reruns
agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.llm.shared import written
from spindrift.operators import slices

WEIGHTS = (5, 2, 1)
CAP = 3
WORD = r"[^\x20\x09-\x0D]+"
_UNIT = 1 << 20
_EXACT = "decimal(38,12)"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place ``sid`` from 0 in code point order, null last.

    Rows are sorted by range; a row's place is its place in its partition and the rows of the
    partitions before, of which there are as many as shuffle partitions.
    """
    at = F.monotonically_increasing_id()
    placed = written(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("_at", at), "sources")
    part = F.shiftright("_at", 33).alias("_part")
    over = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_before"))
    return placed.withColumn("_part", part).join(before, "_part").withColumn(
        "sid", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    ).drop("_part", "_at", "_before")


def _targets(sources: DataFrame, cap: float) -> DataFrame:
    """Targets in proportion to ``weight`` that sum to all words; none is above ``cap`` sizes.

    The level per unit of weight rises until no target is above its bound; every round is one
    aggregate of the sources.
    """
    bound = F.col("source_size") * F.lit(float(cap))
    total = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    words, weight = float(total[0] or 0), float(total[1] or 0)
    level = words / weight if weight else 0.0
    while True:
        above = bound < F.col("weight") * F.lit(level)
        held = sources.agg(
            F.sum(F.when(above, F.col("source_size"))).alias("full"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight")).first()
        if not held["weight"]:
            break
        higher = (words - cap * float(held["full"] or 0)) / float(held["weight"])
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(bound, F.col("weight") * F.lit(level)))


def _rate(tilt: Column, size: Column, mean: Column, cap: float) -> Column:
    """``min(cap, exp(tilt * size / mean))``, never overflowing."""
    top = F.log(F.lit(float(cap)))
    return F.when(tilt * size / mean >= top, F.lit(float(cap))).otherwise(F.exp(F.least(tilt * size / mean, top)))


def _tilts(sizes: DataFrame, sources: DataFrame, cap: float, tolerance: float, most_steps: int) -> DataFrame:
    """``(sid, tilt)`` by Newton steps on the dual over ``sizes (sid, size, n)``."""
    share = F.col("size") / F.col("mean")
    rate = _rate(F.col("tilt"), F.col("size"), F.col("mean"), cap)
    free = rate < F.lit(float(cap))
    nothing = F.lit(None).cast("double")
    state = written(sources.where("source_size > 0").select(
        "sid", (F.col("source_size") / F.col("n_docs")).alias("mean"), "target",
        (F.col("target") >= F.col("source_size") * F.lit(cap * (1 - 1e-12))).alias("full"),
    ).select(
        "sid", "mean", (F.col("target") / F.col("mean")).alias("goal"),
        F.when(F.col("full"), F.lit(float("inf"))).otherwise(F.lit(0.0)).alias("tilt"),
        nothing.alias("low"), nothing.alias("high"), F.col("full").alias("done")), "tilts")
    for _ in range(most_steps):
        left = state.where("not done")
        slopes = sizes.join(left, "sid").groupBy("sid").agg(
            F.sum((F.col("n") * share * rate).cast(_EXACT)).cast("double").alias("value"),
            F.sum(F.when(free, F.col("n") * share * share * rate).otherwise(0.0).cast(_EXACT))
            .cast("double").alias("slope"))
        gap = F.col("value") - F.col("goal")
        stepped = left.join(slopes, "sid").withColumns({
            "gap": gap,
            "low": F.when(gap < 0, F.col("tilt")).otherwise(F.col("low")),
            "high": F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high")),
        }).withColumn("newton", F.when(F.col("slope") > 0, F.col("tilt") - F.col("gap") / F.col("slope")))
        inside = (F.col("newton").isNotNull()
                  & (F.col("low").isNull() | (F.col("newton") > F.col("low")))
                  & (F.col("high").isNull() | (F.col("newton") < F.col("high"))))
        # outside the bracket: halve it, or double the way to its open end
        other = (F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2)
                 .when(F.col("high").isNull(), F.col("tilt") * 2 + 1).otherwise(F.col("tilt") * 2 - 1))
        done = F.abs("gap") <= F.col("goal") * F.lit(tolerance)
        moved = stepped.select(
            "sid", "mean", "goal",
            F.when(done, F.col("tilt")).when(inside, F.col("newton")).otherwise(other).alias("tilt"),
            "low", "high", done.alias("done"))
        state = written(moved.unionByName(state.where("done")), "tilts")
        if state.where("not done").isEmpty():
            break
    return state.select("sid", "tilt", "mean")


def mix(df: DataFrame, *, weights: Sequence[float] = WEIGHTS, cap: int = CAP, starts: int = 64,
        tolerance: float = 1e-9, most_steps: int = 80, rows_per_slice: int = 200_000,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(doc_id, source, size, source_size, target, rate, copies, taken)`` of every row.

    Sources in code point order, null last, weigh ``weights`` in turn and share all words; a
    target above ``cap`` times its source is cut to that and the excess is shared anew. ``copies``
    is 0 to ``cap`` and ``taken`` is copies times size. A null or empty text has size 0 and rate 1;
    a null id comes first among equal sizes; repeated rows are documents of their own; an empty
    table gives no rows; other columns are ignored.
    """
    docs = written(df.select(F.col(doc_id).cast("long").alias("doc_id"),
                             F.col(source).cast("string").alias("source"),
                             word_count(text).alias("size")), "sizes")
    counted = written(docs.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    totals = counted.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n_docs"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = written(_ranked(totals).withColumn(
        "weight", F.element_at(cycle, (F.col("sid") % len(weights) + 1).cast("int"))), "ranks")
    sources = written(_targets(ranked, float(cap)), "targets")
    known = F.col("of").eqNullSafe(F.col("source"))
    sizes = written(counted.join(
        sources.select("sid", F.col("source").alias("of")), known).select("sid", "size", "n"), "counts")
    tilts = _tilts(sizes.where("size > 0"), sources, float(cap), tolerance, most_steps)
    solved = written(sources.join(tilts, "sid", "left").select(
        "sid", F.col("source").alias("of"), "source_size", "target", "tilt", "mean"), "solved")

    rate = F.when((F.col("size") > 0) & F.col("tilt").isNotNull(),
                  _rate(F.col("tilt"), F.col("size"), F.col("mean"), float(cap))).otherwise(1.0)
    rated = docs.join(solved, known).select(
        "doc_id", "source", "size", "sid", "source_size", "target",
        F.round(rate * _UNIT).cast("long").alias("units"))
    run = written(slices.running(
        rated, ["sid"], [-F.col("size"), F.col("doc_id")], sums={"upto": "units"},
        rows_per_slice=rows_per_slice), "running")

    def copies(start: Column) -> Column:
        whole = lambda c: F.floor((c + start) / _UNIT)
        return whole(F.col("upto")) - whole(F.col("upto") - F.col("units"))

    offsets = [F.lit(i * _UNIT // starts) for i in range(starts)]
    words = run.groupBy("sid").agg(
        F.first("target").alias("goal"),
        *[F.sum(F.col("size") * copies(o)).alias(f"w{i}") for i, o in enumerate(offsets)])
    best = words.select("sid", F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"w{i}") - F.col("goal")).alias("off"), o.cast("long").alias("start"))
        for i, o in enumerate(offsets)]))["start"].alias("start"))
    return run.join(best, "sid").withColumn("copies", copies(F.col("start"))).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("units") / _UNIT).alias("rate"), "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed(df: DataFrame, *, rows_per_slice: int = 200_000, **parameters) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it.

    Copies come by id: the rows that share an id share the copies of all of them, the first ones in
    the order of a hash taking one more where they do not divide, so an id is taken as often in total
    as :func:`mix` says. Rows without an id are taken once.
    """
    key = parameters.get("doc_id", "doc_id")
    taken = mix(df, rows_per_slice=rows_per_slice, **parameters).where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    times = taken.select(F.col("doc_id").alias("of"), F.col("_copies").cast("int").alias("n"), F.col("_rows").alias("m"))
    rows = df.select(F.struct(*df.columns).alias("row"), F.col(key).cast("long").alias("id"))
    joined = rows.join(times, F.col("id") == F.col("of"), "left")
    shared = joined.where(F.col("m") > 1)
    single = joined.where(F.coalesce(F.col("m"), F.lit(1)) <= 1).select(
        "row", F.coalesce("n", F.when(F.col("id").isNull(), 1), F.lit(0)).alias("n"))
    counted = [single]
    if not times.where(F.col("m") > 1).isEmpty():
        place = F.xxhash64("row")
        ranked = slices.running(shared.withColumn("_p", place), ["id"], [F.col("_p")], row_number="_place",
                                rows_per_slice=rows_per_slice)
        more = (F.col("_place") <= F.col("n") % F.col("m")).cast("int")
        counted.append(ranked.select("row", (F.floor(F.col("n") / F.col("m")) + more).cast("int").alias("n")))
    return reduce(DataFrame.unionByName, counted).select(
        "row", F.explode(F.array_repeat(F.lit(1), F.col("n")))).select("row.*")
