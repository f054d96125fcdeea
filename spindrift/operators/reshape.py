"""Long and wide shapes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spindrift.functions.text import strip_ws
from spindrift.operators.columns import quoted


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | None = None,
    *,
    name: str = "variable",
    value: str = "value",
    cast: str | None = None,
) -> DataFrame:
    """One row per id and value column; ``cast`` gives the value columns one type first."""
    chosen = [c for c in df.columns if c not in ids] if values is None else list(values)
    if cast is not None:
        df = df.select(
            *[quoted(c) for c in ids], *[quoted(c).cast(cast).alias(c) for c in chosen]
        )
    return df.unpivot([quoted(c) for c in ids], [quoted(c) for c in chosen], name, value)


def to_wide(
    df: DataFrame,
    ids: Sequence[str],
    names_from: str,
    names: Sequence,
    cell: Column | str,
    how: Callable[[Column], Column] = F.min,
    *,
    coarse: bool = False,
) -> DataFrame:
    """One column per listed name, its cells aggregated with ``how``. The list fixes the schema.

    One conditional aggregate per name needs a single shuffle, which suits ids with few rows
    each; ``how`` must skip NULLs, as cells of other names are NULL. For ``coarse`` ids with many
    rows a pivot is cheaper: it computes one aggregate per row and its second shuffle is small.
    """
    value = F.col(cell) if isinstance(cell, str) else cell
    if coarse:
        marked = df.withColumn("_cell", value)
        return marked.groupBy(*ids).pivot(names_from, list(names)).agg(how(F.col("_cell")))
    return df.groupBy(*ids).agg(
        *[how(F.when(F.col(names_from) == F.lit(n), value)).alias(str(n)) for n in names]
    )


def split_rows(df: DataFrame, column: str, separator: str, cast: str | None = None) -> DataFrame:
    """One row per separated item of a text cell, items stripped. NULL cells give no row."""
    pieces = F.split(F.col(column), r"\Q" + separator + r"\E")
    exploded = df.withColumn(column, F.explode(pieces))
    item = strip_ws(column)
    return exploded.withColumn(column, item.cast(cast) if cast else item)
