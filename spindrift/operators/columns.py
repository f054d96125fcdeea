"""Operators on the column list: headers, projections, struct fields."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def quoted(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def snake(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def with_headers(df: DataFrame, how: Callable[[str], str] = snake) -> DataFrame:
    """Rewrite every header with ``how``."""
    return df.toDF(*[how(c) for c in df.columns])


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace the headers by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def without(df: DataFrame, *names: str, pattern: str | None = None) -> DataFrame:
    """Every column but the named ones and those a regex matches from the start."""
    kept = [
        c
        for c in df.columns
        if c not in names and not (pattern is not None and re.match(pattern, c))
    ]
    return df.select(*[quoted(c) for c in kept])


def matching(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def map_columns(
    df: DataFrame, how: Callable[[Column], Column], names: Iterable[str] | None = None
) -> DataFrame:
    """Apply one function to the named columns (all by default), keeping names and order."""
    chosen = set(df.columns if names is None else names)
    return df.select(
        *[how(quoted(c)).alias(c) if c in chosen else quoted(c) for c in df.columns]
    )


def unnest(df: DataFrame, struct_column: str) -> DataFrame:
    """Replace a struct column by its fields, in place of the struct."""
    columns: list[Column] = []
    for c in df.columns:
        columns.append(F.col(f"{struct_column}.*") if c == struct_column else quoted(c))
    return df.select(*columns)
