"""Searched cases, buckets and code mappings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, functions as F


def bucketize(
    value: Column, edges: Sequence[float], labels: Sequence[str], otherwise: str | None = None
) -> Column:
    """Label ``labels[i]`` for the first edge the value is below, the last label beyond them all.

    NULL values take ``otherwise``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one label more than edges")
    case = F.when(value.isNull(), F.lit(otherwise))
    for edge, label in zip(edges, labels):
        case = case.when(value < edge, label)
    return case.otherwise(labels[-1])


def first_match(rules: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """First true condition wins; NULL (or ``otherwise``) when none is."""
    case = F
    for condition, result in rules:
        case = case.when(condition, result)
    return case if otherwise is None else case.otherwise(otherwise)


def lookup(value: Column, table: Mapping[object, object], otherwise: object = None) -> Column:
    """Dictionary lookup; NULL and unmapped values take ``otherwise``."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    found = F.try_element_at(literal, value)
    return found if otherwise is None else F.coalesce(found, F.lit(otherwise))


def canonical(value: Column, spellings: Mapping[str, Sequence[str]], strict: bool = True) -> Column:
    """Map listed spellings to their canonical form; an unlisted one raises, or is NULL if not strict."""
    flat = {s: name for name, variants in spellings.items() for s in variants}
    found = lookup(value, flat)
    if not strict:
        return found
    complaint = F.raise_error(F.concat(F.lit("no mapping for value: "), value))
    return F.when(value.isNull() | found.isNotNull(), found).otherwise(complaint.cast("string"))
