"""Ordered calculations over groups of any size.

A window function sorts a whole group in one task, which fails when one group holds a large
share of a big table. The operators here measure which groups are hot, that is larger than
``rows_per_slice``, and run over those as a prefix scan:

1. The hot rows are dealt by ranges of (group, order). A range is a slice; Spark's range sampling
   places the bounds, also within a group, and the order is total, so ties are parted too. The
   numbered slices are written to the shared folder, so what a lost executor recomputes is the same.
2. Each (group, slice) cell is reduced to one row, and these few are summed up or carried on along
   the slices of their group.
3. Each cell is windowed on its own and joined with what its earlier cells carry.

No cut point comes to the driver or into the plan, which is as large for a billion rows as for a
thousand. The other groups take a plain window, and without a hot group nothing is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.operators.staging import staged

ROWS_PER_SLICE = 1_000_000
MAX_HOT_GROUPS = 1000
#: More slices than this are not dealt; they get larger instead, and sorting them spills.
MAX_SLICES = 16_384
#: A task that writes slices writes as many as make up this many rows.
ROWS_PER_FILE = 50_000


@dataclass(frozen=True)
class Hot:
    """How many slices the hot groups need, hashes of these groups, all groups for None, and their rows.

    A group that shares a hash with a hot one is cut too, which does no harm.
    """

    slices: int = 0
    groups: Sequence[int] | None = ()
    rows: int = 0

    @property
    def files(self) -> int:
        """How many tasks write the slices, small ones together."""
        return min(self.slices, ceil(self.rows / ROWS_PER_FILE))


def measure(df: DataFrame, keys: Sequence[str], rows_per_slice: int) -> Hot:
    """Find hot groups.

    At most ``MAX_HOT_GROUPS`` + 1 group sizes come to the driver; when there are more hot groups,
    every group is cut.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    large = sizes.where(F.col("_size") > rows_per_slice).orderBy(F.col("_size").desc())
    found = large.select(_hash(keys).alias("_hash"), "_size").limit(MAX_HOT_GROUPS + 1).collect()
    if not found:
        return Hot()
    groups, rows = None, sum(r["_size"] for r in found)
    if len(found) > MAX_HOT_GROUPS:
        rows = df.count()
    elif keys:
        groups = tuple(r["_hash"] for r in found)
    return Hot(min(ceil(rows / rows_per_slice), MAX_SLICES), groups, rows)


def is_hot(keys: Sequence[str], groups: Sequence[int] | None) -> Column:
    return F.lit(True) if groups is None else _hash(keys).isin(list(groups))


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(F.lit(0), *[F.col(k) for k in keys])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    row_number: str | None = None,
    sums: Mapping[str, str] | None = None,
    lags: Mapping[str, str] | None = None,
    fills: Mapping[str, str] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    measured: bool = True,
) -> DataFrame:
    """Running values per group in one pass.

    ``order`` holds ascending expressions that rank rows uniquely (negate a column to descend); rows
    that it leaves equal get their places in any order and are not parted by slices. ``row_number``
    names a 1-based rank; ``sums``, ``lags`` and ``fills`` map a new column to the column it runs
    over: running sum, previous row's value, last value that is not NULL. A running sum of doubles
    depends on the order of addition in its last digits, so give decimals. Groups that a domain
    bounds need not be ``measured``.
    """
    sums, lags, fills = dict(sums or {}), dict(lags or {}), dict(fills or {})
    hot = measure(df, keys, rows_per_slice) if measured else Hot()
    if not hot.slices:
        return _within(df, list(keys), order, row_number, sums, lags, fills)
    inside = is_hot(keys, hot.groups)
    scanned = _scan(df.where(inside), keys, order, hot, row_number, sums, lags, fills)
    if hot.groups is None:
        return scanned
    return _within(df.where(~inside), list(keys), order, row_number, sums, lags, fills).unionByName(scanned)


def _scan(df, keys, order, hot, row_number, sums, lags, fills) -> DataFrame:
    """The prefix scan of the module text.

    The slice is numbered below the coalesce, where a partition still is one range.
    """
    new = [*sums, *lags, *fills, *([row_number] if row_number is not None else [])]
    along = {f"_o{i}": o for i, o in enumerate(order)}
    dealt = df.withColumns(along).repartitionByRange(hot.slices, *keys, *along).withColumn("_slice", F.spark_partition_id())
    sliced = staged(dealt.coalesce(hot.files), "slices")
    # keys in a struct, whose null fields are equal
    cell = F.struct("_slice", *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    sliced = sliced.withColumn("_cell", cell)
    place = F.struct(F.lit(0).alias("_"), *along)
    last_row = {f"_l{i}": F.max_by(F.col(c), place) for i, c in enumerate(lags.values())}
    last_known = {f"_f{i}": F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)) for i, c in enumerate(fills.values())}
    totals = {f"_s{i}": F.sum(F.col(c)) for i, c in enumerate(sums.values())}
    per_cell = sliced.groupBy("_cell").agg(
        F.count(F.lit(1)).alias("_n"), *[a.alias(n) for n, a in {**totals, **last_row, **last_known}.items()])
    over = Window.partitionBy(*[F.col(f"_cell.k{i}") for i in range(len(keys))]).orderBy("_cell._slice")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    carried = {"_n": F.sum("_n").over(before)}
    carried |= {n: F.sum(n).over(before) for n in totals}
    carried |= {n: F.lag(n).over(over) for n in last_row}
    carried |= {n: F.last(n, ignorenulls=True).over(before) for n in last_known}
    carry = per_cell.select(F.col("_cell"), *[c.alias(n) for n, c in carried.items()])

    local = _within(sliced, ["_cell"], [F.col(c) for c in along], "_rn", sums, lags, fills)
    both = local.join(carry, "_cell", "left")
    # a sum over NULLs only is NULL, on either side of a cut, and the type of a sum is that of the
    # plain window
    result = {n: F.coalesce(F.col(n) + F.col(f"_s{i}"), F.col(n), F.col(f"_s{i}"))
              .cast(local.schema[n].dataType) for i, n in enumerate(sums)}
    result |= {n: F.when(F.col("_rn") == 1, F.col(f"_l{i}")).otherwise(F.col(n)) for i, n in enumerate(lags)}
    result |= {n: F.coalesce(F.col(n), F.col(f"_f{i}")) for i, n in enumerate(fills)}
    if row_number is not None:
        result[row_number] = F.col("_rn") + F.coalesce(F.col("_n"), F.lit(0))
    return both.select(*[c for c in df.columns if c not in new], *[result[n].alias(n) for n in new])


def _within(df, keys, order, row_number, sums, lags, fills) -> DataFrame:
    over = Window.partitionBy(*keys).orderBy(*order)
    upto = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = {n: F.sum(F.col(c)).over(upto) for n, c in sums.items()}
    new |= {n: F.lag(F.col(c)).over(over) for n, c in lags.items()}
    new |= {n: F.last(F.col(c), ignorenulls=True).over(upto) for n, c in fills.items()}
    if row_number is not None:
        new[row_number] = F.row_number().over(over).cast("bigint")
    return df.withColumns(new)


def dense_rank(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    *,
    descending: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
    measured: bool = True,
) -> DataFrame:
    """Dense rank of a numeric column per group; NULL values get a NULL rank.

    Only the distinct (group, value) pairs are ordered. They are combined before the shuffle,
    and the rank comes back by a join on the pair.
    """
    direction = -F.col(value) if descending else F.col(value)
    pairs = df.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    ranked = running(pairs, keys, [direction], row_number=name, rows_per_slice=rows_per_slice, measured=measured)
    pair = F.struct(*[F.col(k) for k in keys], F.col(value))
    right = ranked.select(pair.alias("_pair"), F.col(name).cast("int").alias(name))
    return df.withColumn("_pair", pair).join(right, "_pair", "left").drop("_pair")


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str,
    n: int,
    name: str,
    digits: int | None = None,
    *,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Mean of the last ``n`` rows of the group, NULL for its first ``n - 1`` rows.

    Rows are numbered, then windowed in blocks of ``rows_per_slice`` rows; each block also gets
    the ``n - 1`` rows before it, which are dropped again afterwards.
    """
    if n < 1:
        raise ValueError("the window must hold at least one row")
    block_rows = max(rows_per_slice, n)
    original = df.columns
    numbered = running(df, keys, order, row_number="_rn", rows_per_slice=rows_per_slice)
    block = F.floor((F.col("_rn") - 1) / block_rows)
    is_tail = (F.col("_rn") - 1) % block_rows >= block_rows - (n - 1)
    copies = F.when(is_tail, F.array(block, block + 1)).otherwise(F.array(block))
    spread_out = numbered.withColumn("_own", block).withColumn("_block", F.explode(copies))
    over = (
        Window.partitionBy(*keys, "_block").orderBy("_rn").rowsBetween(-(n - 1), Window.currentRow)
    )
    total = F.sum(F.col(value)).over(over)
    full = (F.count(F.col(value)).over(over) == n)
    mean = total / F.lit(n)
    mean = F.round(mean, digits) if digits is not None else mean
    return (
        spread_out.withColumn("_mean", F.when(full, mean))
        .where(F.col("_block") == F.col("_own"))
        .select(*original, F.col("_mean").cast("double").alias(name))
    )
