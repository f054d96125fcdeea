"""Reading landed text files.

Every reader takes an explicit schema or reads all text; nothing is inferred, so a read costs one
pass. Headers that differ from the schema and cells that do not fit their type are errors, unless
the caller asks for something else.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from spindrift.functions.text import extract
from spindrift.operators.columns import snake, with_headers


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    *,
    header: bool = True,
    separator: str = ",",
    null_value: str | None = None,
    encoding: str = "UTF-8",
    columns: Sequence[str] | None = None,
    headers: Callable[[str], str] | None = None,
    by_position: bool = False,
    bad_cells: str = "FAILFAST",
) -> DataFrame:
    """CSV at a path, glob or list of paths; all text when no schema is given.

    The header of every file must name the schema's columns in order, unless ``by_position``, when
    the schema replaces it. ``bad_cells="PERMISSIVE"`` makes cells that do not fit NULL. Bytes that
    are not valid in ``encoding`` become U+FFFD.
    """
    reader = (
        spark.read.option("header", header).option("sep", separator).option("encoding", encoding)
    )
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is not None:
        reader = reader.schema(schema).option("mode", bad_cells)
        reader = reader.option("enforceSchema", by_position or not header)
    df = reader.csv(path)
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    return with_headers(df, headers) if headers is not None else df


def read_many(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    from_name: Mapping[str, str],
    spellings: Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """Many files of one schema, with columns cut from the decoded file path.

    ``from_name`` maps a new column to a regex whose first group is taken from the path. All files
    have one header and are one scan, unless ``spellings`` is given: then columns are matched by
    name, whatever their order; ``spellings`` maps a header to the schema's name for it, other
    columns are left out, and a file that lacks a column is an error. One job finds the headers of
    all files, and each distinct header makes a scan.
    """
    if spellings is not None:
        return _by_name(spark, path, schema, from_name, spellings, options)
    return _from_path(read_csv(spark, path, schema, **options), from_name)


def _by_name(spark, path, schema, from_name, spellings, options) -> DataFrame:
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    of = {f.name: f.dataType for f in wanted.fields}
    parts = []
    for header, group in header_catalogue(spark, path, **options).items():
        names = [spellings.get(h, h) for h in header]
        lacking = [f.name for f in wanted.fields if names.count(f.name) != 1]
        if lacking:
            raise ValueError(f"{group[0]} has no single column for {lacking}")
        own = T.StructType([T.StructField(h, of.get(n, T.StringType())) for h, n in zip(header, names)])
        df = _from_path(read_csv(spark, group, own, **options), from_name)
        parts.append(df.select(
            *[F.col(f"`{header[names.index(f.name)]}`").alias(f.name) for f in wanted.fields], *from_name))
    if not parts:
        raise FileNotFoundError(str(path))
    return reduce(DataFrame.unionByName, parts)


def header_catalogue(
    spark: SparkSession, path: str | Sequence[str], *, separator: str = ",", encoding: str = "UTF-8", **_
) -> dict[tuple[str, ...], list[str]]:
    """The headers found at a path, each with its files in order; an empty file has no column.

    One job for all files: every task keeps the first line of the files it opens at their start, and
    lines that are alike are put together, so as many rows as there are headers come to the driver.
    """
    lines = spark.read.text(path)
    starts = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.col("value").cast("binary").alias("line"),
    ).where(F.col("at") == 0)
    # the lines of a file's first block are read by one task and in order
    firsts = starts.groupBy("file").agg(F.first("line").alias("line"))
    found = firsts.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    by_header: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(found, key=lambda r: r["files"]):
        text = bytes(row["line"]).decode(encoding, "replace").removeprefix("\ufeff")
        header = tuple(next(csv.reader([text], delimiter=separator), ()))
        by_header.setdefault(header, []).extend(map(_as_path, row["files"]))
    known = {f for files in by_header.values() for f in files}
    empty = sorted({_as_path(f) for f in lines.inputFiles()} - known)
    if empty:
        by_header.setdefault((), []).extend(empty)
    return {header: sorted(files) for header, files in by_header.items()}


def _as_path(uri: str) -> str:
    """A path that Spark's readers take from the escaped one they report, spelled in one way."""
    return re.sub(r"^(\w+):/(?!/)", r"\1:///", unquote(uri))


def _from_path(df: DataFrame, from_name: Mapping[str, str]) -> DataFrame:
    source = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[extract(source, pattern).alias(name) for name, pattern in from_name.items()],
    )


def read_sheets(
    spark: SparkSession, folder: str, schema: T.StructType | str, sheet: str = "sheet", **options
) -> DataFrame:
    """A workbook landed as one CSV per sheet; the file stem becomes the ``sheet`` column.

    Columns are matched by header name; see ``spellings`` of :func:`read_many`.
    """
    stem = {sheet: r"([^/]+)\.[^./]+$"}
    options = {"spellings": {}, **options}
    return read_many(spark, f"{folder}/*.csv", schema, stem, **options)


def read_headerless(
    spark: SparkSession, path: str, width: int, keep: Column | None = None, **options
) -> DataFrame:
    """All-text read without a header as ``column_1``..``column_n``; ``keep`` drops title rows."""
    names = [f"column_{i}" for i in range(1, width + 1)]
    df = read_csv(spark, path, text_schema(names), header=False, **options)
    return df if keep is None else df.where(keep)


def read_snake(spark: SparkSession, path: str, schema=None, **options) -> DataFrame:
    return read_csv(spark, path, schema, headers=snake, **options)
