"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spindrift.llm.shared import written


def _to_least(pairs: DataFrame) -> DataFrame:
    """``(u, v)`` with the least ``v`` (or ``u`` itself) of every ``u`` as ``m``.

    The least value is combined before the shuffle, and the pairs of a hot ``u`` can be split by
    the join, so no node's neighbours meet in one task.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least.select("u", F.least("u", "m").alias("m")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
    near = _to_least(both).where(F.col("v") > F.col("u"))
    return near.select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    near = _to_least(down)
    return near.select(F.explode(F.array(
        F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
        F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; the root is the least node.

    Loops and repeated edges do no harm. Every round is a table in the shared folder; the rounds
    end when a round changes nothing, which two sums tell the driver.
    """
    real = lambda e: e.where(F.col("a") != F.col("b")).distinct()
    at, seen = written(real(edges), "edges"), None
    while True:
        at = written(real(_small_star(_large_star(at))), "edges")
        now = at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return at.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        at.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
