"""Tables written on the way, which outlive the executors that made them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in a single local process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "folder" not in _own:
        _own["folder"] = tempfile.mkdtemp(prefix="spindrift-")
    return _own["folder"]


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a Parquet table in the shared folder, where they stay until its owner clears it."""
    return _written(df, name)[0]


@contextmanager
def kept(*tables: DataFrame) -> Iterator[list[DataFrame]]:
    """Staged copies of tables for as long as the block runs; then their files are deleted."""
    paths: list[str] = []
    try:
        copies = []
        for df in tables:
            copy, path = _written(df, "shared")
            paths.append(path)
            copies.append(copy)
        yield copies
    finally:
        for df, path in zip(tables, paths):
            _delete(df.sparkSession, path)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    # columns go by place, as their names may hold what the format does not take
    places = [f"c{i}" for i in range(len(df.columns))]
    df.toDF(*places).write.parquet(path)
    return spark.read.schema(df.toDF(*places).schema).parquet(path).toDF(*df.columns), path


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
