"""Nearest neighbours by inner product along shifted space-filling curves.

Every distinct vector is projected onto several groups of random orthogonal directions; each group,
shifted at random, is laid along a Hilbert curve. Spark orders every curve by range, and a query
meets the vectors in a window around its place on each. Scores are exact; what the windows found is
merged and ranked again.

The window is measured: a fixed number of queries meet all vectors, and the window is what finds the
wanted share of their neighbours on some curve. Vectors without structure, whose neighbours are
spread over a share of the curve, get a window that grows with the rows; on vectors that lie along
few directions it is much smaller than the table. Equal vectors are one point of the curve; the ids that can matter of them, one
more than are asked for, come back at the end, so a vector that a third of the rows hold costs no
more than another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.llm.shared import record_batch, written

NEAREST = 20
CURVES = 16
#: Share of the neighbours of ``PROBES`` queries that the window must find.
RECALL = 0.95
PROBES = 128
BLOCK = 2048
#: Blocks of a curve that one group of a task passes through, merging what queries find in them.
RUN = 16
LEAST_WINDOW = 256
_DIRECTIONS = 8
_BITS = 7
_SEED = 11
_HELD_PAIRS = 1_000_000
_PAIRS = pa.schema([("q", pa.int64()), ("c", pa.int64()), ("score", pa.float64())])


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points whose coordinates are whole numbers below 2^bits.

    The standard two passes: from the highest bit down, undo the reflections and rotations that a
    cell's orientation stands for; then the Gray code of the coordinates, read across, is the key.
    """
    x = points.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        low = np.uint64((1 << bit) - 1)
        for i in range(len(x)):
            high = (x[i] >> np.uint64(bit)) & one
            swap = np.where(high == 1, np.uint64(0), (x[0] ^ x[i]) & low)
            flip = np.where(high == 1, low, np.uint64(0))
            x[0] ^= swap ^ flip
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(bit)) & one == 1, np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for row in x:
            key = (key << one) | ((row >> np.uint64(bit)) & one)
    return key.view(np.int64)


def _curves(n: int, dims: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Directions and shifts of ``n`` curves; directions of one rotation share none."""
    random = np.random.default_rng(_SEED)
    width = min(_DIRECTIONS, dims)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(found) < n:
        turn = np.linalg.qr(random.normal(size=(dims, dims)))[0]
        found += [(turn[:, i:i + width], random.random(width))
                  for i in range(0, dims - width + 1, width)]
    return found[:n]


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``n`` best allowed scores of every row, with all ties of the last."""
    if scores.shape[1] > n:
        last = -np.partition(-scores, n - 1, axis=1)[:, n - 1:n]
        keep = scores >= last - 1e-12 * np.abs(last)
    else:
        keep = np.ones(scores.shape, dtype=bool)
    return np.nonzero(keep & np.isfinite(scores))


def _merged(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, ...]:
    """The ``n`` best pairs of every query among ``(q, c, score)``, ties to the smaller ``c``."""
    q, c, score = (np.concatenate(part) for part in zip(*found))
    order = np.lexsort((c, -score, q))
    q, c, score = q[order], c[order], score[order]
    first = np.append(True, q[1:] != q[:-1])
    start = np.flatnonzero(first)[np.cumsum(first) - 1]
    keep = np.arange(len(q)) - start < n
    return q[keep], c[keep], score[keep]


def window_for(points: DataFrame, ranked: DataFrame, dims: int, *, n: int, recall: float, probes: int,
               least_window: int) -> int:
    """Half of the window that finds a share ``recall`` of the ``n`` nearest of ``probes`` queries.

    ``points``: c, ask, v; ``ranked``: curve, c, place. The queries are those with the least hashes
    of ``c``, or all if there are fewer; each meets every vector, and a neighbour is found if its
    place is near enough on one curve. What comes to the driver and to every task is bounded by
    ``probes`` and ``n``.
    """
    chosen = points.where("ask").orderBy(F.xxhash64("c"), "c").limit(probes).select("c", "v").collect()
    if not chosen:
        return least_window
    names = np.array([r["c"] for r in chosen], dtype=np.int64)
    asked = np.array([r["v"] for r in chosen], dtype=np.float64)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            c, scores = batch["c"].to_numpy(), asked @ _vectors(batch["v"], dims).T
            scores[names[:, None] == c[None, :]] = -np.inf
            q, r = _best(scores, c, n)
            found = [_merged([*found, (names[q], c[r], scores[q, r])], n)]
        if found:
            yield record_batch(_PAIRS, found[0])

    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "c"))
    pairs = points.select("c", "v").mapInArrow(best, "q long, c long, score double").withColumn(
        "rank", place).where(F.col("rank") <= n).select("q", F.col("c").alias("near")).collect()
    wanted = sorted({r["near"] for r in pairs} | set(names.tolist()))
    known = points.sparkSession.createDataFrame([(i,) for i in wanted], "c long")
    places: dict[int, dict[int, int]] = {}
    for r in ranked.join(F.broadcast(known), "c").select("curve", "c", "place").collect():
        places.setdefault(r["c"], {})[r["curve"]] = r["place"]
    gaps = sorted(min(abs(at - places[r["near"]][curve]) for curve, at in places[r["q"]].items()) for r in pairs)
    if not gaps:
        return least_window
    return max(least_window, int(gaps[min(int(np.ceil(recall * len(gaps))), len(gaps)) - 1]))


def nearest(df: DataFrame, is_query: Column, *, n: int = NEAREST, curves: int = CURVES,
            recall: float = RECALL, probes: int = PROBES, block: int = BLOCK,
            least_window: int = LEAST_WINDOW, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``n`` nearest rows found of every query row.

    ``is_query`` is a condition on ``id``. The window is measured on ``probes`` queries so that it
    finds a share ``recall`` of their neighbours (:func:`window_for`). Ties go to the smaller id; fewer candidates give fewer
    rows. Vectors that are null or zero, or hold null or non-finite components, or are not of the
    most frequent length (the longer of two equally frequent), and rows without an id take no
    part; rows that repeat an id are one candidate, with their best score; an empty table gives
    no rows; other columns are ignored.
    """
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    lengths = rows.groupBy(F.size("v").alias("dims")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(squares).alias("square"))
    usual = lengths.orderBy(F.desc("n"), F.desc("dims")).first()
    empty = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if usual is None:
        return empty
    dims, spread = usual["dims"], float(np.sqrt(usual["square"] / usual["dims"])) or 1.0
    rows = rows.where(F.size("v") == dims)

    asks = is_query.alias("ask")
    points = written(rows.withColumn("ask", asks).groupBy("v").agg(
        F.min("id").alias("c"), F.max("ask").alias("ask")), "points")
    ids = written(rows.join(points.select("v", "c"), "v").select("id", "c").distinct(), "ids")
    total = points.count()
    shapes = _curves(curves, dims)
    kinds = {"v": points.schema["v"].dataType.simpleString()}

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch["v"], dims)
            for i, (directions, shift) in enumerate(shapes):
                place = np.clip(x @ directions / (8 * spread) + 0.5, 0, 1) + shift
                cells = np.minimum(place / 2 * (1 << _BITS), (1 << _BITS) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), i, np.int32)), pa.array(hilbert_keys(cells, _BITS)),
                     batch["c"], batch["ask"], batch["v"]], ["curve", "key", "c", "ask", "v"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a block come before the queries whose windows reach into it.

        What a query finds in a run of blocks is merged before it is shuffled.
        """
        at, held, run, found, waiting = None, None, None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            curve, part, asking = (batch[k].to_numpy(zero_copy_only=False) for k in ("curve", "block", "asking"))
            edges = np.flatnonzero((curve[1:] != curve[:-1]) | (part[1:] != part[:-1])
                                   | (asking[1:] != asking[:-1])) + 1
            x, c, place = _vectors(batch["v"], dims), batch["c"].to_numpy(), batch["place"].to_numpy()
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if run != (curve[lo], part[lo] // RUN):
                    if waiting:
                        yield record_batch(_PAIRS, _merged(found, n + 1))
                    run, found, waiting = (curve[lo], part[lo] // RUN), [], 0
                if not asking[lo]:
                    if at != (curve[lo], part[lo]):
                        at, held = (curve[lo], part[lo]), (x[lo:hi], c[lo:hi], place[lo:hi])
                    else:
                        held = tuple(np.concatenate(p) for p in zip(held, (x[lo:hi], c[lo:hi], place[lo:hi])))
                    continue
                for a in range(lo, hi, 512):
                    b = min(a + 512, hi)
                    scores = x[a:b] @ held[0].T
                    scores[np.abs(place[a:b, None] - held[2][None, :]) > half] = -np.inf
                    q, r = _best(scores, held[1], n + 1)
                    exact = np.concatenate([(x[a + q[k:k + 65536]] * held[0][r[k:k + 65536]]).sum(axis=1)
                                            for k in range(0, len(q), 65536)] or [np.zeros(0)])
                    found.append((c[a + q], held[1][r], exact))
                    waiting += len(q)
                    if waiting > _HELD_PAIRS:
                        found = [_merged(found, n + 1)]
                        waiting = len(found[0][0])
                        if waiting > _HELD_PAIRS // 2:
                            yield record_batch(_PAIRS, found[0])
                            found, waiting = [], 0
        if waiting:
            yield record_batch(_PAIRS, _merged(found, n + 1))

    laid = points.mapInArrow(lay, f"curve int, key long, c long, ask boolean, v {kinds['v']}")
    order = laid.repartitionByRange("curve", "key", "c").sortWithinPartitions("curve", "key", "c")
    placed = written(order.withColumn("at", F.monotonically_increasing_id()), "curves")
    part = F.shiftright("at", 33)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(over), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) - F.col("curve") * F.lit(total)
    ranked = placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn("place", place)
    half = window_for(points, ranked, dims, n=n, recall=recall, probes=probes, least_window=least_window)
    reach = F.sequence(F.floor(F.greatest(F.col("place") - half, F.lit(0)) / block),
                       F.floor(F.least(F.col("place") + half, F.lit(total - 1)) / block))
    own = F.struct(F.floor(F.col("place") / block).alias("block"), F.lit(False).alias("asking"))
    visits = F.concat(F.array(own), F.when(F.col("ask"), F.transform(
        reach, lambda b: F.struct(b.alias("block"), F.lit(True).alias("asking")))).otherwise(
        F.array().cast("array<struct<block:bigint,asking:boolean>>")))
    spreadout = ranked.select("curve", "c", "place", "v", F.explode(visits).alias("to")).select(
        "curve", "to.block", "to.asking", "c", "place", "v")
    passing = F.floor(F.col("block") / RUN)
    pairs = spreadout.repartition("curve", passing).sortWithinPartitions("curve", "block", "asking").mapInArrow(
        meet, "q long, c long, score double")

    by_score = lambda key, last: Window.partitionBy(key).orderBy(F.desc("score"), last)
    merged = pairs.groupBy("q", "c").agg(F.max("score").alias("score")).withColumn(
        "at", F.row_number().over(by_score("q", "c"))).where(F.col("at") <= n + 1).drop("at")
    members = ids.withColumn("at", F.row_number().over(Window.partitionBy("c").orderBy("id"))).where(
        F.col("at") <= n + 1).select("c", "id")
    classes = merged.join(members, "c").groupBy("q", "id").agg(F.max("score").alias("score")).withColumn(
        "at", F.row_number().over(by_score("q", "id"))).where(F.col("at") <= n + 1).select("q", "id", "score")
    asked = ids.where(is_query).select(F.col("id").alias("query_id"), F.col("c").alias("q"))
    return classes.join(asked, "q").where(F.col("id") != F.col("query_id")).groupBy("query_id", "id").agg(
        F.max("score").alias("score")).withColumn(
        "rank", F.row_number().over(by_score("query_id", "id"))).where(F.col("rank") <= n).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")
