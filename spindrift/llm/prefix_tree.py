"""The trie of shared conversation beginnings, rolled up by centroids.

A node is a sequence of first turns that some conversation begins with, named by its depth and the
least such conversation. Prefixes are compared by two sums of 64-bit hashes, of every turn's SHA-256
with its place; running sums cut a long conversation into slices, so no task holds a conversation.

Subtree totals come from a centroid decomposition of the parent-edge forest. The weight of a subtree,
every node counted once a member, is known beforehand: it is the number of turns, from the top on, of
the conversations that begin with it. So the centroid of a component is its deepest node whose weight
is over half of the component's. The component's totals at and below the centroid are added to the
nodes on the path from the centroid to the component's top; without the centroid and its weight, what
is left are components of at most half the weight, one for each child and one above. Components are
split by joins, in as many rounds as the logarithm of the weight, until they have at most ``LIMIT``
nodes; those are finished within tasks in the same way. A trie as deep as it has nodes takes no more
rounds than a flat one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spindrift.llm.shared import record_batch, whole_groups, written
from spindrift.operators import joins, slices

BLOCK, SHARED = 100, 6
LIMIT = 50_000
_IDS = 1 << 16
_EMPTY = hashlib.sha256(b"").hexdigest()


def _piece(digest: str, start: int) -> Column:
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("long")


def numbered_turns(df: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text", rows_per_slice: int = slices.ROWS_PER_SLICE) -> DataFrame:
    """``(conv_id, rn, a, b, chars)``: turns in order, with two pieces of a digest of role and text.

    A null turn comes first; turns of one number are ordered by their digest.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    content = F.concat(F.length(said[0]).cast("string"), F.lit(":"), *said)
    turns = df.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                      F.sha2(content, 256).alias("_d"), F.length(said[1]).cast("long").alias("chars"))
    turns = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", _piece("_d", 1).alias("a"), _piece("_d", 16).alias("b"), "chars")
    return slices.running(turns, ["conv_id"], [F.col("turn"), F.col("a"), F.col("b")], row_number="rn",
                          rows_per_slice=rows_per_slice).drop("turn")


def rebuilt(turns: DataFrame, *, block: int = BLOCK, shared: int = SHARED) -> DataFrame:
    """``(conv_id, depth, length, a, b, chars)``: every conversation ``c`` begins with the first ``h``
    turns of ``c - c % block``, ``h`` being ``crc32(c) % shared``, and goes on with its own after its
    first ``h``; a row of depth 0 stands for its empty beginning. ``%`` keeps the sign of ``c``."""
    c, h = F.col("conv_id"), F.col("h")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns({
        "h": F.crc32(c.cast("string")) % shared, "base": c - c % block})
    bases = sizes.where(c == F.col("base")).select("base", F.col("n").alias("_have"))
    taken = F.least(h, F.coalesce("_have", F.lit(0)))
    convs = written(sizes.join(bases, "base", "left").withColumn("k", taken).withColumn(
        "length", F.col("k") + F.greatest(F.col("n") - h, F.lit(0))), "conversations")
    columns = ["conv_id", "depth", "length", "a", "b", "chars"]
    own = turns.join(convs, "conv_id").where(F.col("rn") > h).withColumn("depth", F.col("rn") - h + F.col("k"))
    heads = turns.where((F.col("rn") < shared) & (c % block == 0)).withColumnRenamed("conv_id", "base")
    begun = convs.where(F.col("k") > 0).join(heads, "base").where(F.col("rn") <= F.col("k")).withColumnRenamed("rn", "depth")
    nil = F.lit(0).cast("long")
    empty = convs.select("conv_id", nil.alias("depth"), "length", *[nil.alias(x) for x in ("a", "b", "chars")])
    return own.select(columns).unionByName(begun.select(columns)).unionByName(empty)


def _key(depth: Column, *sums: Column) -> Column:
    return F.concat_ws(":", depth, *sums)


def prefixes(rows: DataFrame, *, rows_per_slice: int = slices.ROWS_PER_SLICE) -> DataFrame:
    """The rows with ``key`` for their beginning and ``before`` for the one a turn shorter."""
    d = F.col("depth")
    salted = [F.xxhash64("a", "b", "depth"), F.xxhash64("b", "depth", "a")]
    rows = rows.withColumns({f"salted{i}": F.when(d > 0, s).otherwise(0).cast("decimal(20,0)") for i, s in enumerate(salted)})
    run = slices.running(rows, ["conv_id"], [d], sums={"upto0": "salted0", "upto1": "salted1"}, rows_per_slice=rows_per_slice)
    before = _key(d - 1, F.col("upto0") - F.col("salted0"), F.col("upto1") - F.col("salted1"))
    return run.select("conv_id", "depth", "length", "chars", _key(d, F.col("upto0"), F.col("upto1")).alias("key"),
                      F.when(d > 0, before).alias("before"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a key joined by commas, at most ``_IDS`` in a row; the rows come sorted."""
    at, ids, out, held = None, [], [], 0

    def row():
        return at, ids[0], ",".join(map(str, ids)).encode()

    for batch in batches:
        for key, i in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist()):
            if ids and (key != at or len(ids) >= _IDS):
                out.append(row())
                held += len(ids)
                ids = []
                if held >= _IDS or len(out) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "first", "ids"])
                    out, held = [], 0
            at = key
            ids.append(i)
    if ids:
        out.append(row())
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined chunks of every key, chunk by chunk."""
    at, digest, out = None, None, []
    for batch in batches:
        for key, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
            if key == at:
                digest.update(b",")
            else:
                if digest:
                    out.append((at, digest.hexdigest()))
                at, digest = key, hashlib.sha256()
            digest.update(ids)
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "ends_sha256"])
                out = []
    if digest:
        out.append((at, digest.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "ends_sha256"])


def ends(rows: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of the conversations that end at a node.

    Ids are dealt by ranges, so those of a common ending are joined into chunks by many tasks; the
    hash, which must run through them in order, is fed with chunks.
    """
    last = rows.where(F.col("depth") == F.col("length")).select("key", "conv_id")
    order = ["key", "conv_id"]
    chunks = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "key string, first long, ids binary")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        _digests, "key string, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """``(key, c, d, up, n, weight, children, saved)`` for each node, ``up`` being its parent's ``c``."""
    grouped = written(rows.groupBy("key").agg(
        F.min("conv_id").alias("c"), F.first("depth").alias("d"), F.count(F.lit(1)).alias("n"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.first("chars").alias("chars"),
        F.first("before").alias("before")), "nodes")
    root = grouped.where(F.col("d") == 0).select(F.col("c").alias("_root"))
    children = grouped.where(F.col("d") > 0).groupBy("before").agg(F.count(F.lit(1)).alias("children"))
    deeper = grouped.withColumn("before", F.when(F.col("d") > 1, F.col("before")))
    parents = grouped.select(F.col("key").alias("before"), F.col("c").alias("_up"))
    joined = joins.sprayed_left(deeper, parents, "before", F.col("key")).join(
        children.withColumnRenamed("before", "key"), "key", "left")
    up = F.when(F.col("d") == 1, root.scalar()).otherwise(F.col("_up"))
    return joined.select("key", "c", "d", up.alias("up"), "n", "weight",
                         F.coalesce("children", F.lit(0)).cast("long").alias("children"),
                         ((F.col("n") - 1) * F.col("chars")).alias("saved"))


def centroid_totals(parents: list[int], weights: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Subtree totals of one component, whose nodes are listed by depth, the top first."""
    weights = list(weights)
    totals = [[0] * len(values[0]) for _ in parents]
    waiting = [list(range(len(parents)))]
    while waiting:
        nodes = waiting.pop()
        top, whole = nodes[0], weights[nodes[0]]
        place = max(i for i, v in enumerate(nodes) if 2 * weights[v] > whole)
        centroid = nodes[place]
        label, parts = {centroid: centroid}, {}
        for v in nodes[place + 1:]:
            above = label.get(parents[v])
            if above is not None:
                label[v] = v if above == centroid else above
                parts.setdefault(label[v], []).append(v)
        sums = [sum(column) for column in zip(*(values[v] for v in label))]
        v, less = centroid, weights[centroid]
        while True:
            totals[v] = [t + s for t, s in zip(totals[v], sums)]
            weights[v] -= less
            if v == top:
                break
            v = parents[v]
        if centroid != top:
            waiting.append([v for v in nodes if v not in label])
        waiting.extend(parts.values())
    return totals


_TOTALS = pa.schema([("c", pa.int64()), ("d", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64())])
_TOTALS_SQL = "c long, d long, leaves long, saved long"


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, bounds in whole_groups(batches, ["top_c", "top_d"], rows=20_000):
        columns = {n: table[n].to_pylist() for n in ("c", "d", "up", "weight", "leaf", "saved")}
        out = []
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            c, d, up, weight, leaf, saved = (v[start:end] for v in columns.values())
            index = {node: i for i, node in enumerate(zip(c, d))}
            parents = [index.get((u, x - 1), -1) for u, x in zip(up, d)]
            totals = centroid_totals(parents, weight, list(zip(leaf, saved)))
            out.extend((i, x, *t) for i, x, t in zip(c, d, totals))
        yield record_batch(_TOTALS, zip(*out))


def subtree_totals(nodes: DataFrame, rows: DataFrame, *, limit: int = LIMIT) -> DataFrame:
    """``(c, d, leaves, saved)`` summed over every node's subtree; see the module text.

    ``nodes`` is the trie, ``rows`` the beginnings it was made from, which tell a node's ancestors.
    """
    root = nodes.where(F.col("d") == 0).select("c")
    state = nodes.select("c", "d", "up", "weight", (F.col("children") == 0).cast("long").alias("leaf"), "saved",
                         root.scalar().alias("top_c"), F.lit(0).cast("long").alias("top_d"))
    top = ["top_c", "top_d"]
    small: list[DataFrame] = []
    found: list[DataFrame] = []
    paths = None
    while True:
        sizes = state.groupBy(*top).agg(F.count(F.lit(1)).alias("_n"), F.max("weight").alias("whole"))
        large = written(sizes.where(F.col("_n") > limit).drop("_n"), "components")
        if large.isEmpty():
            break
        if paths is None:
            paths = written(rows.where(F.col("depth") > 0).select("conv_id", "depth", "key").join(
                nodes.select("key", F.col("c").alias("rep"), F.col("up").alias("rep_up")), "key").drop("key"), "paths")
        small.append(state.join(large, top, "left_anti"))
        heavy = state.join(large, top).where(2 * F.col("weight") > F.col("whole"))
        centroids = heavy.groupBy(*top).agg(F.max_by(F.struct("c", "d", "weight"), "d").alias("x"))
        x_c, x_d, x_w, c, d = (F.col(n) for n in ("x.c", "x.d", "x.weight", "c", "d"))
        deeper = d > x_d
        asked = state.join(centroids, top).withColumns({
            "conv_id": F.when(deeper, c).otherwise(x_c), "depth": F.when(deeper, x_d + 1).otherwise(d)})
        seen = asked.join(paths, ["conv_id", "depth"], "left")
        # a null answer is no: the root has no row in paths, but is above everything
        seen = seen.withColumns({
            "below": F.coalesce(deeper & (F.col("rep_up") == x_c), F.lit(False)),
            "onway": ~deeper & ((d == 0) | F.coalesce(F.col("rep") == c, F.lit(False)))})
        cut = written(seen.withColumn("centre", F.col("onway") & (d == x_d)).drop("conv_id", "depth", "rep_up"), "cut")
        sums = cut.where(F.col("below") | F.col("centre")).groupBy(*top).agg(
            F.sum("leaf").alias("leaves"), F.sum("saved").alias("_saved"))
        found.append(cut.where("onway").join(sums, top).select("c", "d", "leaves", F.col("_saved").alias("saved")))
        state = cut.where(~F.col("centre")).select(
            "c", "d", "up", F.when(F.col("onway"), F.col("weight") - x_w).otherwise(F.col("weight")).alias("weight"),
            "leaf", "saved", F.when(F.col("below"), F.col("rep")).otherwise(F.col("top_c")).alias("top_c"),
            F.when(F.col("below"), x_d + 1).otherwise(F.col("top_d")).alias("top_d"))
    rest = reduce(DataFrame.unionByName, [*small, state])
    done = rest.repartition(*top).sortWithinPartitions(*top, "d").mapInArrow(_finish, _TOTALS_SQL)
    if not found:
        return done
    return reduce(DataFrame.unionByName, [*found, done]).groupBy("c", "d").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def rollup(df: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           block: int = BLOCK, shared: int = SHARED, limit: int = LIMIT,
           rows_per_slice: int = slices.ROWS_PER_SLICE) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    Rows without a conversation id belong to none; null roles and texts are empty; repeated rows are
    turns of their own; turns of one number are ordered by a digest of role and text; an empty table
    has no conversation and so no node, not even the root; other columns are ignored.
    """
    turns = written(numbered_turns(df, conv_id=conv_id, turn=turn, role=role, text=text,
                                   rows_per_slice=rows_per_slice), "turns")
    rows = written(prefixes(rebuilt(turns, block=block, shared=shared), rows_per_slice=rows_per_slice), "prefixes")
    nodes = written(trie(rows), "trie")
    totals = subtree_totals(nodes, rows, limit=limit)
    return nodes.drop("saved").join(totals, ["c", "d"]).join(ends(rows), "key", "left").select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("up").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))


SQL = """
    WITH t AS (
        SELECT conv_id, length(text) AS chars, item,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, item) AS rn
        FROM (SELECT conv_id, turn, coalesce(text, '') AS text,
                     sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS item
              FROM conversations WHERE conv_id IS NOT NULL)),
    ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS name FROM t),
    c AS (
        SELECT conv_id, xor(4294967295, list_reduce(
                   list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(name[i]) AS BIGINT)),
                   lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda r, z:
                       xor(r >> 1, 3988292384 * (r & 1)), xor(crc, byte)), CAST(4294967295 AS BIGINT))) % 6 AS h
        FROM ids),
    r AS (
        SELECT c.conv_id, 0 AS part, rn, item, chars
        FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND rn <= h
        UNION ALL SELECT conv_id, 1, rn, item, chars FROM c JOIN t USING (conv_id) WHERE rn > h),
    s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, rn) AS depth FROM r),
    p AS (
        SELECT conv_id, 0 AS depth, CAST([] AS VARCHAR[]) AS path, 0 AS chars FROM c
        UNION ALL SELECT conv_id, depth, list(item) OVER (PARTITION BY conv_id ORDER BY depth), chars FROM s),
    n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM p GROUP BY ALL),
    e AS (
        SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
        FROM (SELECT conv_id, arg_max(path, depth) AS path FROM p GROUP BY conv_id) GROUP BY path),
    k AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
    m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
    u AS (SELECT path, n_children, (n_convs - 1) * chars AS saved, unnest(range(0, depth + 1)) AS d FROM m),
    w AS (SELECT path[1:d] AS path, sum(CAST(n_children = 0 AS INTEGER)) AS leaves, sum(saved) AS saved
          FROM u GROUP BY 1)
    SELECT m.conv_id, m.depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(leaves AS BIGINT) AS n_leaves,
           CAST(saved AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
    FROM m JOIN w USING (path) LEFT JOIN e USING (path)
    LEFT JOIN n AS up ON m.depth > 0 AND up.path = m.path[1:m.depth - 1]"""
