"""Joins that a plain equi-join does not express, each without a product of the two sides."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import pi, sqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.functions.dates import wall_micros
from spindrift.functions.numbers import EARTH_RADIUS_MILES, great_circle_miles
from spindrift.operators import slices
from spindrift.operators.windows import broadcast_if_small, small_copy

MILES_PER_DEGREE = EARTH_RADIUS_MILES * pi / 180


def asof_forward(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    *,
    rows_per_slice: int = slices.ROWS_PER_SLICE,
) -> DataFrame:
    """Left rows with the earliest right time at or after their own, NULL when there is none.

    All left rows of one key and time share the answer, so only the distinct ones take part: both
    sides' become one stream, and read from the latest time down, the last right time seen is the
    answer, which joins back to the rows. Equal times match because right times come first. A date
    is midnight beside a timestamp.
    """
    ticks = _ticks(left.schema[left_time].dataType.typeName(), right.schema[right_time].dataType.typeName())
    facts = left.select(
        *keys, ticks(F.col(left_time)).alias("_t"), F.lit(1).alias("_side"),
        F.lit(None).cast(right.schema[right_time].dataType).alias("_found"),
    ).where(F.col("_t").isNotNull()).distinct()
    marks = right.where(F.col(right_time).isNotNull()).select(
        *keys, ticks(F.col(right_time)).alias("_t"), F.lit(0).alias("_side"),
        F.col(right_time).alias("_found"),
    ).distinct()
    seen = slices.running(
        facts.unionByName(marks), keys, [-F.col("_t"), F.col("_side")],
        fills={"_next": "_found"}, rows_per_slice=rows_per_slice,
    )
    group = F.struct(F.lit(0).alias("_"), *[F.col(k) for k in keys])
    answers = seen.where((F.col("_side") == 1) & F.col("_next").isNotNull()).select(
        group.alias("_group"), "_t", F.col("_next").alias(right_time))
    timed = left.withColumns({"_group": group, "_t": ticks(F.col(left_time))})
    kept = [F.col(f"l.{quote(c)}") for c in left.columns]
    same = (F.col("l._group") == F.col("r._group")) & (F.col("l._t") == F.col("r._t"))
    return timed.alias("l").join(answers.alias("r"), same, "left").select(
        *kept, F.col(f"r.{quote(right_time)}").alias(right_time))


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _ticks(left: str, right: str) -> Callable[[Column], Column]:
    """A whole number that orders times of both types alike."""
    numbers = {
        "date": lambda c: F.unix_date(c).cast("bigint"),
        "timestamp": lambda c: F.unix_micros(c.cast("timestamp")),
        "timestamp_ntz": lambda c: wall_micros(c.cast("timestamp_ntz")),
    }
    for kind in (left, right):
        if kind not in numbers:
            raise TypeError(f"cannot match times of type {kind}")
    return numbers[max(left, right)] if "timestamp" not in (left, right) else numbers["timestamp"]


#: Values and bounds of a range join lie between minus and plus this.
_REACH = 1 << 62


def range_left(
    facts: DataFrame,
    bands: DataFrame,
    value: str,
    low: str,
    high: str,
    *,
    open_ended: bool = False,
) -> DataFrame:
    """Left join of facts to the bands whose closed ``[low, high]`` holds the whole-numbered value.

    A band of any width is cut into its dyadic nodes, the at most 2 log2(width) blocks of numbers
    that share all but their last bits. A number lies in one block of each size, so the distinct
    values of the facts probe one node for each size that occurs, and what they find is joined back
    to the facts by value: neither a band nor the facts are listed more than logarithmically often,
    and only distinct values are. A band with a NULL bound matches nothing unless ``open_ended``,
    when it has no end on that side. Bounds beyond 2^62 count as that; values beyond match nothing.
    """
    lo, hi = F.col(low).cast("bigint"), F.col(high).cast("bigint")
    if open_ended:
        lo, hi = F.coalesce(lo, F.lit(-_REACH)), F.coalesce(hi, F.lit(_REACH))
    extra = [c for c in bands.columns if c not in facts.columns]
    whole = bands.select(lo.alias("_lo"), hi.alias("_hi"), F.struct(
        F.lit(0).alias("_"), *[F.col(quote(c)).alias(f"b{i}") for i, c in enumerate(extra)]).alias("_band"))
    cut = _dyadic(F.greatest("_lo", F.lit(-_REACH)), F.least("_hi", F.lit(_REACH)))
    nodes = whole.where(F.col("_lo") <= F.col("_hi")).select("_band", F.explode(cut).alias("_node"))
    copy = small_copy(nodes)
    nodes = nodes if copy is None else copy
    levels = sorted(r[0] for r in nodes.select("_node.level").distinct().collect())

    at = F.col(quote(value)).cast("bigint")
    values = facts.select(at.alias("_value")).where(F.abs("_value") <= _REACH).distinct()
    probes = values.select("_value", F.explode(F.array(*[_node(F.lit(k), F.col("_value")) for k in levels or [0]])).alias("_node"))
    found = probes.join(nodes if copy is None else F.broadcast(nodes), "_node").select("_value", "_band")
    salt = F.xxhash64(*[F.col(quote(f.name)) for f in facts.schema if "map<" not in f.dataType.simpleString()])
    joined = sprayed_left(facts.withColumn("_value", at), broadcast_if_small(found), "_value", salt)
    return joined.select(*[F.col(quote(c)) for c in facts.columns],
                         *[F.col("_band")[f"b{i}"].alias(c) for i, c in enumerate(extra)])


def _node(level: Column, value: Column) -> Column:
    """The block of ``2 ** level`` numbers that holds a value."""
    return F.struct(level.cast("int").alias("level"), F.call_function("shiftright", value, level.cast("int")).alias("at"))


def _dyadic(low: Column, high: Column) -> Column:
    """The fewest blocks that make up ``[low, high]``.

    With ``a`` the first block that starts in the range and ``b`` the one that its end falls into, a
    level gives ``a`` where it is the second half of a larger block, and the one before ``b`` where
    that is a first half.
    """
    def blocks(level: Column) -> Column:
        shift = lambda c: F.call_function("shiftright", c, level)
        a, b = -shift(-low), shift(high + 1)
        node = lambda c: F.struct(level.alias("level"), c.alias("at"))
        inside, odd = a < b, lambda c: c.bitwiseAND(F.lit(1)) == 1
        return F.array(F.when(inside & odd(a), node(a)), F.when(inside & odd(b), node(b - 1)))

    levels = F.sequence(F.lit(0), F.lit(_REACH.bit_length()))
    return F.filter(F.flatten(F.transform(levels, blocks)), lambda n: n.isNotNull())


def sprayed_left(left: DataFrame, right: DataFrame, key: str, salt: Column, ways: int = 1024) -> DataFrame:
    """Left join on ``key`` where many left keys may be NULL.

    NULL keys match nothing, but would all hash to one task; they are spread by ``salt``.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(salt), F.lit(ways)) + 1).otherwise(0)
    return (
        left.withColumn("_spray", spread.cast("int"))
        .join(right.where(F.col(key).isNotNull()).withColumn("_spray", F.lit(0)), [key, "_spray"], "left")
        .drop("_spray")
    )


def resolve_ids(df: DataFrame, pairs: DataFrame, first: str, second: str) -> DataFrame:
    """Fill a missing ``first`` id from ``second`` and the other way round.

    ``pairs`` lists known (first, second) pairs. The pair's first id wins over the row's own;
    rows whose first id is unknown after that are dropped.
    """
    own = df.withColumnRenamed(first, "_own_first")
    by_second = sprayed_left(
        own, pairs.select(second, F.col(first).alias("_found_first")), second, F.col("_own_first")
    )
    filled = by_second.withColumn(first, F.coalesce("_found_first", "_own_first"))
    filled = filled.drop("_found_first", "_own_first").withColumnRenamed(second, "_own_second")
    both = filled.join(pairs.select(first, F.col(second).alias("_found_second")), first)
    both = both.withColumn(second, F.coalesce("_own_second", "_found_second"))
    return both.select(*df.columns)


def nearest_sites(
    points: DataFrame,
    sites: DataFrame,
    point_at: tuple[str, str],
    site_id: str,
    site_at: tuple[str, str],
    name: str,
    *,
    digits: int = 2,
) -> DataFrame:
    """Nearest site(s) of every point by great-circle miles rounded to ``digits``, ties kept.

    ``*_at`` name (latitude, longitude) columns in radians; a row without a position on the globe
    takes no part. Points meet the short list of their own cell, from :func:`site_candidates`, and
    the found positions bring back all ids that share them. Up to 100,000 list entries are
    broadcast, so that points need no shuffle.
    """
    chosen, level = site_candidates(points, sites, point_at, site_at, digits=digits)
    copy = small_copy(chosen, 100_000)
    lists = (chosen if copy is None else copy).groupBy("_cell").agg(
        F.collect_list(F.struct("lat", "lon")).alias("_sites")
    )
    lists = lists if copy is None else F.broadcast(lists)

    here = tuple(F.col(c) for c in point_at)
    seen = F.transform(
        "_sites",
        lambda s: F.struct(
            F.round(great_circle_miles(s["lat"], s["lon"], *here), digits).alias("miles"), s.alias("site")
        ),
    )
    nearest = F.array_min(F.transform("_seen", lambda s: s["miles"]))
    # outer explode and null-safe equality keep Spark from adding filters that measure again
    found = (
        points.withColumn("_cell", _cell(here, level))
        .join(lists, "_cell")
        .withColumn("_seen", seen)
        .withColumn("_nearest", nearest)
        .select(*points.columns, "_nearest", F.explode_outer("_seen").alias("_s"))
        .where(F.col("_s.miles").eqNullSafe(F.col("_nearest")))
        .select(*points.columns, F.col("_s.site.lat").alias("_lat"), F.col("_s.site.lon").alias("_lon"),
                F.col("_s.miles").alias("_miles"))
    )
    ids = broadcast_if_small(sites.select(
        F.col(site_id).alias("_id"), *[F.col(c).alias(n) for c, n in zip(site_at, ("_lat", "_lon"))]
    ).na.drop(subset=["_lat", "_lon"]), 100_000)
    return found.join(ids, ["_lat", "_lon"]).select(
        *points.columns, F.col("_id").alias(site_id), F.col("_lat").alias(site_at[0]),
        F.col("_lon").alias(site_at[1]), F.col("_miles").alias(name),
    )


def site_candidates(
    points: DataFrame,
    sites: DataFrame,
    point_at: tuple[str, str],
    site_at: tuple[str, str],
    *,
    digits: int = 2,
    crowd: int = 8,
) -> tuple[DataFrame, int]:
    """``(_cell, lat, lon)``: the site positions that can be nearest to a point of a cell, and the
    level of these cells.

    The globe is a quadtree of cells. Its depth is where no cell holds over ``crowd`` distinct
    positions, however closely the sites are clustered. From a few cells around all sites down,
    occupied cells of points and of sites are both split; a site cell stays beside a point cell
    while its centre is within the nearest site cell's distance and four half diagonals, by the
    triangle inequality. What stays is a ring of a few cells' width at the distance of the nearest
    site: among the sites a list does not grow with them, and far outside a cluster it holds a strip
    along its near edge, about the square root of its sites. A step pairs only the children of what
    stayed. Cells get no smaller than the rounding of distances can tell apart.
    """
    lat, lon = (F.col(c) for c in site_at)
    finest = _cell((lat, lon), _FINEST)
    placed = sites.select(lat.alias("lat"), lon.alias("lon"), finest.alias("_fine")).where(
        F.col("_fine").isNotNull()).distinct()
    top, depth, roots = _levels(placed, crowd)
    cells = points.select(_cell(tuple(F.col(c) for c in point_at), depth).alias("_cell")).where(
        F.col("_cell").isNotNull()).distinct()
    slack = 10.0**-digits + 2e-3

    asked = cells.select(_above("_cell", depth - top).alias("_cell")).distinct().select(
        "_cell", F.explode(F.array(*[F.lit(r) for r in roots])).alias("_node"))
    for level in range(top + _STEP, depth + 1, _STEP):
        below = cells.select(_above("_cell", depth - level).alias("_next")).distinct()
        parts = placed.select(_above("_fine", _FINEST - level).alias("_part")).distinct()
        paired = asked.join(
            parts.withColumn("_node", _above("_part", _STEP)), "_node"
        ).join(below.withColumn("_cell", _above("_next", _STEP)), "_cell").select(
            F.col("_next").alias("_cell"), F.col("_part").alias("_node"))
        apart = great_circle_miles(*_centre("_cell", level), *_centre("_node", level))
        asked = _near(paired, apart, 4 * _half_diagonal(level) + slack).select("_cell", "_node")
    met = asked.join(placed.withColumn("_node", _above("_fine", _FINEST - depth)), "_node")
    apart = great_circle_miles(*_centre("_cell", depth), F.col("lat"), F.col("lon"))
    return _near(met, apart, 2 * _half_diagonal(depth) + slack).select("_cell", "lat", "lon"), depth


#: Level 0 is one cell of 360 degrees; cells of level 22 are about 30 feet wide.
_FINEST = 22
#: Levels a search descends at once.
_STEP = 2


def _levels(placed: DataFrame, crowd: int) -> tuple[int, int, list[int]]:
    """Where a search starts and ends, and the (at most 16) cells around all sites at its start."""
    levels = list(range(0, _FINEST + 1, _STEP))
    every = placed.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("level"), _above("_fine", _FINEST - i).alias("cell")) for i in levels
    ])).alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    row, column = _row("at.cell"), _column("at.cell")
    measured = {r["level"]: r for r in every.groupBy("at.level").agg(
        F.max("n").alias("most"), F.min(row).alias("south"), F.max(row).alias("north"),
        F.min(column).alias("west"), F.max(column).alias("east")).collect()}
    top, depth, roots = 0, 0, [0]
    for level, r in sorted(measured.items()):
        around = (r["north"] - r["south"] + 1) * (r["east"] - r["west"] + 1)
        if around <= 16:
            top = level
            roots = [(a << 32) + b for a in range(r["south"], r["north"] + 1)
                     for b in range(r["west"], r["east"] + 1)]
        depth = level
        if r["most"] <= crowd:
            break
    return top, depth, roots


def _near(pairs: DataFrame, apart: Column, reach: float) -> DataFrame:
    """Pairs of a cell that are at most ``reach`` farther apart than its closest pair.

    The window holds one cell's few candidates.
    """
    measured = pairs.withColumn("_d", apart)
    least = F.min("_d").over(Window.partitionBy("_cell"))
    return measured.withColumn("_least", least).where(F.col("_d") <= F.col("_least") + reach)


def _half_diagonal(level: int) -> float:
    """Miles that no place of a cell is farther than from its centre."""
    return 360 / 2**level / sqrt(2) * MILES_PER_DEGREE


def _cell(at: tuple[Column, Column], level: int) -> Column:
    """Cell of a position as one number, NULL for a position that is not known or not on the globe."""
    side = F.lit(360 / 2**level)
    lat, lon = at
    row = F.floor((F.degrees(lat) + 90) / side)
    column = F.floor(F.pmod(F.degrees(lon) + 180, F.lit(360.0)) / side)
    return F.when((F.abs(lat) <= 4) & (F.abs(lon) <= 8), F.shiftleft(row, 32) + column)


def _row(cell: str) -> Column:
    return F.shiftright(F.col(cell), 32)


def _column(cell: str) -> Column:
    return F.col(cell).bitwiseAND(F.lit((1 << 32) - 1))


def _above(cell: str, levels: int) -> Column:
    """The cell that holds this one so many levels up."""
    return F.shiftleft(F.shiftright(_row(cell), levels), 32) + F.shiftright(_column(cell), levels)


def _centre(cell: str, level: int) -> tuple[Column, Column]:
    """Centre of a cell in radians."""
    side = F.lit(360 / 2**level)
    return F.radians((_row(cell) + 0.5) * side - 90), F.radians((_column(cell) + 0.5) * side - 180)
