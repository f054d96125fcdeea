"""Writing results. Every output is a directory, replaced as a whole."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from spindrift.operators import staging
from spindrift.operators.columns import quoted


def write_csv(
    df: DataFrame,
    path: str,
    *,
    date_format: str = "yyyy-MM-dd",
    float_digits: int | None = None,
    separator: str = ",",
    order_by: Sequence[str | Column] = (),
) -> None:
    """``order_by`` sorts the rows over the files of the output, by range and not in one task."""
    if order_by:
        df = df.orderBy(*order_by)
    if float_digits is not None:
        fractional = (T.DoubleType, T.FloatType)
        df = df.select(
            *[
                quoted(f.name).cast(f"decimal(38,{float_digits})").alias(f.name)
                if isinstance(f.dataType, fractional)
                else quoted(f.name)
                for f in df.schema.fields
            ]
        )
    writer = df.write.mode("overwrite").option("header", True).option("sep", separator)
    writer.option("dateFormat", date_format).csv(path)


def write_parquet(
    df: DataFrame, path: str, *, compression: str = "zstd", partition_by: Sequence[str] = (),
    order_by: Sequence[str | Column] = (),
) -> None:
    """``order_by`` sorts as in :func:`write_csv`; :func:`read_in_order` gives the rows back in order."""
    df = df.orderBy(*order_by) if order_by else df
    df.write.mode("overwrite").option("compression", compression).partitionBy(*partition_by).parquet(path)


def write_json(df: DataFrame, path: str, *, order_by: Sequence[str | Column] = ()) -> None:
    """One JSON object per row; ``order_by`` sorts as in :func:`write_csv`."""
    df = df.orderBy(*order_by) if order_by else df
    df.write.mode("overwrite").json(path)


def read_in_order(spark: SparkSession, path: str, kind: str, name: str, **options) -> DataFrame:
    """The rows of an ordered output with their place from 1 as ``name``.

    Files are named by the range they hold, and rows lie in them in order. Each file numbers its
    rows by where they lie; the sizes of the files before it are added from a table of one row per
    file.
    """
    lines = spark.read.options(**options).format(kind).load(path)
    seen = lines.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_at"))
    blocks = seen.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    upto = blocks.withColumn("_before", before).select("_file", "_block", "_first", "_before")
    return seen.join(upto, ["_file", "_block"]).select(
        *lines.columns, (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(name))


_WRITERS = {"csv": write_csv, "parquet": write_parquet, "json": write_json}


def write_formats(df: DataFrame, paths: Mapping[str, str], *, order_by: Sequence[str | Column] = ()) -> None:
    """One result in several formats, computed once: into a table that outlives the executors."""
    writers = {kind: _WRITERS[kind] for kind in paths}
    with staging.kept(df) as (copy,):
        for kind, write in writers.items():
            write(copy, paths[kind], order_by=order_by)


def write_outputs(
    frames: Mapping[str, Callable[..., DataFrame] | DataFrame], folder: str, *, shared: Sequence[DataFrame] = (), **options
) -> None:
    """Several results of one job, one directory each.

    ``shared`` are tables that several results are made from. Each is written once to the shared
    folder, where it outlives the executors that made it, and is deleted at the end; a result that
    reads them is given as a function of them, in their order.
    """
    with staging.kept(*shared) as copies:
        for name, made in frames.items():
            write_csv(made if isinstance(made, DataFrame) else made(*copies), f"{folder}/{name}", **options)
