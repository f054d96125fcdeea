"""Exact quantiles of groups of any size, without ordering their values.

Groups of at most ``rows_per_slice`` values gather them in one combined array. Larger groups are
narrowed first: a combinable sketch proposes two values that close in on each wanted position, one
aggregate counts what lies below, at, between and above them, and the part that holds the position
is kept. The counts decide, so the result is exact whatever the sketch says; a poor proposal costs a
further pass. A value with many ties becomes a bound itself and is settled by its count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spindrift.operators.slices import ROWS_PER_SLICE
from spindrift.operators.staging import staged
from spindrift.operators.windows import broadcast_if_small

_STEPS = 256
_ACCURACY = 4096
#: Passes that did not narrow enough end here; what is left is gathered as it is.
_MOST_PASSES = 20


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    shares: Mapping[str, float],
    *,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Exact interpolated quantiles per group, one column per entry of ``shares``.

    NULL values take no part, and a group without values has no row. Counts the groups when called.
    """
    group = F.struct(F.lit(0).alias("_"), *[F.col(k) for k in keys])
    facts = df.where(F.col(value).isNotNull()).select(group.alias("_group"), F.col(value).alias("_v"))
    sizes = facts.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.agg(F.max("_n")).first()[0] or 0
    places = {name: (F.col("_n") - 1) * F.lit(float(share)) for name, share in shares.items()}
    if largest <= rows_per_slice:
        found = _gathered(facts, places)
    else:
        is_hot = broadcast_if_small(sizes.where(F.col("_n") > rows_per_slice))
        cold = facts.join(is_hot.select("_group"), "_group", "left_anti")
        found = _gathered(cold, places).unionByName(_narrowed(facts, is_hot, places, rows_per_slice))
    interpolated = {
        name: F.col(f"_low_{i}") + (F.col(f"_high_{i}") - F.col(f"_low_{i}")) * (at - F.floor(at))
        for i, (name, at) in enumerate(places.items())
    }
    return found.select(
        *[F.col("_group")[k].alias(k) for k in keys], *[c.alias(n) for n, c in interpolated.items()]
    )


def _targets(places: Mapping[str, Column]) -> dict[str, Column]:
    """Zero-based positions of the two values that a quantile lies between."""
    found = {}
    for i, at in enumerate(places.values()):
        found[f"_low_{i}"], found[f"_high_{i}"] = F.floor(at), F.ceil(at)
    return found


def _gathered(facts: DataFrame, places: Mapping[str, Column]) -> DataFrame:
    """The wanted values of groups that are small enough to be gathered."""
    values = facts.groupBy("_group").agg(F.sort_array(F.collect_list("_v")).alias("_values"))
    values = values.withColumn("_n", F.size("_values").cast("long"))
    picked = {t: F.get("_values", at.cast("int")) for t, at in _targets(places).items()}
    return values.select("_group", "_n", *[c.alias(t) for t, c in picked.items()])


def _narrowed(
    facts: DataFrame, sizes: DataFrame, places: Mapping[str, Column], limit: int
) -> DataFrame:
    """The wanted values of large groups.

    Per position a state is kept: the open range ``(low, high)`` that holds it, the number of
    values in it, the place among them, and the value once it is known.
    """
    kind = facts.schema["_v"].dataType
    unknown = F.lit(None).cast(kind)
    targets = _targets(places)
    state = sizes.select("_group", "_n", *[
        F.struct(unknown.alias("low"), unknown.alias("high"), F.col("_n").alias("n"), at.alias("at"),
                 unknown.alias("value")).alias(t) for t, at in targets.items()])
    room = max(limit // len(targets), 1)

    def inside(t: str) -> Column:
        low, high = F.col(t)["low"], F.col(t)["high"]
        in_range = (low.isNull() | (F.col("_v") > low)) & (high.isNull() | (F.col("_v") < high))
        return F.col(t)["value"].isNull() & in_range

    def left(state: DataFrame) -> int:
        open_ = [F.when(F.col(t)["value"].isNull(), F.col(t)["n"]).otherwise(0) for t in targets]
        return state.agg(F.max(F.greatest(F.lit(0), *open_))).first()[0] or 0

    steps = F.array(*[F.lit(i / _STEPS) for i in range(_STEPS + 1)])
    for _ in range(_MOST_PASSES):
        if left(state) <= room:
            break
        beside = facts.join(broadcast_if_small(state), "_group")
        marks = beside.groupBy("_group").agg(*[
            F.percentile_approx(F.when(inside(t), F.col("_v")), steps, F.lit(_ACCURACY)).alias(f"{t}_marks")
            for t in targets])
        proposed = state.join(marks, "_group")
        for t in targets:
            step = F.col(t)["at"] * _STEPS / F.greatest(F.col(t)["n"] - 1, F.lit(1))
            below, above = F.floor(step).cast("int") - 2, F.ceil(step).cast("int") + 2
            mark = F.col(f"{t}_marks")
            proposed = proposed.withColumns({
                f"{t}_from": F.get(mark, F.greatest(below, F.lit(0))),
                f"{t}_to": F.get(mark, F.least(above, F.lit(_STEPS)))})
        proposed = staged(proposed.drop(*[f"{t}_marks" for t in targets]), "proposed")
        beside = facts.join(broadcast_if_small(proposed), "_group")
        counted = beside.groupBy("_group").agg(*[
            F.count(F.when(inside(t) & where, 1)).alias(f"{t}_{name}")
            for t in targets
            for name, where in (
                ("under", F.col("_v") < F.col(f"{t}_from")),
                ("first", F.col("_v") == F.col(f"{t}_from")),
                ("between", (F.col("_v") > F.col(f"{t}_from")) & (F.col("_v") < F.col(f"{t}_to"))),
                ("last", (F.col("_v") == F.col(f"{t}_to")) & (F.col("_v") > F.col(f"{t}_from"))))])
        state = staged(proposed.join(counted, "_group").select(
            "_group", "_n", *[_kept_part(t, unknown).alias(t) for t in targets]), "narrowed")
    beside = facts.join(broadcast_if_small(state), "_group")
    rest = beside.groupBy("_group").agg(*[
        F.sort_array(F.collect_list(F.when(inside(t), F.col("_v")))).alias(f"{t}_values") for t in targets])
    return state.join(rest, "_group").select("_group", "_n", *[
        F.coalesce(F.col(t)["value"], F.get(f"{t}_values", F.col(t)["at"].cast("int"))).alias(t)
        for t in targets])


def _kept_part(t: str, unknown: Column) -> Column:
    """The state of a position after its range was cut at two values."""
    old, cut, end = F.col(t), F.col(f"{t}_from"), F.col(f"{t}_to")
    upto = F.lit(0)
    parts = []
    for name, low, high, value in (
        ("under", old["low"], cut, unknown), ("first", unknown, unknown, cut),
        ("between", cut, end, unknown), ("last", unknown, unknown, end),
    ):
        n = F.col(f"{t}_{name}")
        parts.append((old["at"] < upto + n, F.struct(
            low.alias("low"), high.alias("high"), n.alias("n"), (old["at"] - upto).alias("at"),
            value.alias("value"))))
        upto = upto + n
    over = F.struct(end.alias("low"), old["high"].alias("high"), (old["n"] - upto).alias("n"),
                    (old["at"] - upto).alias("at"), unknown.alias("value"))
    kept = F.when(old["value"].isNotNull() | cut.isNull(), old)
    for here, part in parts:
        kept = kept.when(here, part)
    return kept.otherwise(over)
