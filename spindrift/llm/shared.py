"""Tables in the shared folder, word splitting and batching used by the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in a single local process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own.setdefault("folder", tempfile.mkdtemp(prefix="spindrift-"))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, *, tidy: bool = False) -> DataFrame:
    """The same rows as a table in the shared folder, which survives lost executors.

    If ``tidy``, Spark deletes the shuffle files behind it at once, not whenever the driver collects garbage.
    """
    path, conf = fresh_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    if tidy:
        conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy and before is None:
            conf.unset(_CLEANUP)
        elif tidy:
            conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_by_hash(df: DataFrame, group: str, key: str, n: int, salts: int = 64) -> DataFrame:
    """At most ``n`` rows of every group, those whose ``key`` has the least hashes.

    Each salted part of a group is limited first, so that a group which holds most rows meets in
    one task as at most ``salts * n`` rows.
    """
    order = (F.xxhash64(key), F.col(key))
    for keys in ((group, "_salt"), (group,)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        df = df.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts))).withColumn("_place", place).where(
            F.col("_place") <= n).drop("_place", "_salt")
    return df


def bounded(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``max_bytes``; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array([0 if v is None else v for v in
                          pa.compute.binary_length(batch[column]).to_pylist()], dtype=np.int64)
        group = np.cumsum(sizes) // max_bytes
        edges = np.flatnonzero(np.diff(group)) + 1
        for start, end in zip([0, *edges], [*edges, batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text, empty for null."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def record_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type, from_pandas=False)
         for c, f in zip(columns, schema)], schema=schema)


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 200_000
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from input sorted by ``keys``, with the bounds of the groups.

    Each table holds about ``rows`` rows, or one group that is larger.
    """
    held: list[pa.RecordBatch] = []
    n = 0

    def bounds(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        new[0] = True
        for key in keys:
            v = table[key].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.append(np.flatnonzero(new), table.num_rows)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held)
        at = bounds(table)
        if len(at) > 2:
            yield table.slice(0, int(at[-2])), at[:-1]
            rest = table.slice(int(at[-2])).combine_chunks()
            held, n = rest.to_batches(), rest.num_rows
        else:
            held, rows_seen = table.combine_chunks().to_batches(), n
            rows = max(rows, 2 * rows_seen)
    if held:
        table = pa.Table.from_batches(held)
        yield table, bounds(table)
