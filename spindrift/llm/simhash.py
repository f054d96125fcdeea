"""Near-duplicates by SimHash fingerprints and BK-trees.

Distinct fingerprints are laid into shards: the bits are cut into blocks, and two fingerprints
within ``radius`` bits agree on at least ``blocks - radius`` of them, so for every choice of that
many blocks a shard holds the fingerprints that agree there. Each shard builds a BK-tree, whose
children are keyed by their distance to the parent, and every member follows only the edges within
the radius of its own distance. A shard gives one edge per linked member, not all pairs.

A shard beyond ``shard_rows`` members is split; every two of its parts meet as a tree and its
queries in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from spindrift.llm.components import components
from spindrift.llm.shared import bounded, record_batch, texts_as_bytes, whole_groups, written

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("choice", pa.int32()),
                    ("shard", pa.int64()), ("part", pa.int32())])
_FOUND_SQL = "a long, b long, choice int, shard long, part int"
_SMALL = 48


def text_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    """XXH64 of every shingle of the text's words, ASCII letters in lower case."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) < shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED)
            for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())]


def majority(hashes: list[int]) -> int:
    """The fingerprint of the hashes: bits set in over half of them."""
    ones = np.zeros(BITS, dtype=np.int64)
    every = np.array(hashes, dtype="<u8")
    for at in range(0, len(every), 1 << 17):
        part = every[at:at + (1 << 17)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(every), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(df: DataFrame, *, shingle: int = SHINGLE, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every row; the 64 bits are a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "t", 1 << 20):
            found = [majority(text_hashes(t, shingle)) for t in texts_as_bytes(batch["t"])]
            yield record_batch(_FINGERPRINTS, [batch["d"], np.array(found, np.uint64).view(np.int64)])

    return df.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t")).mapInArrow(
        run, "doc_id long, fp long")


class BKTree:
    """Nodes are positions in ``values``; children are keyed by their distance to the parent."""

    def __init__(self, values: list[int]):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        for i in range(1, len(values)):
            self._insert(i)

    def _insert(self, i: int) -> None:
        value, at = self.values[i], 0
        while True:
            d = (value ^ self.values[at]).bit_count()
            below = self.children[at].setdefault(d, i)
            if below == i:
                return
            at = below

    def search(self, queries: np.ndarray, radius: int):
        """Yield (node, numbers of the queries within the radius of it)."""
        if not self.values:
            return
        todo = [(0, np.arange(len(queries)))]
        while todo:
            at, who = todo.pop()
            d = np.bitwise_count(queries[who] ^ np.uint64(self.values[at])).astype(np.int64)
            near = who[d <= radius]
            if len(near):
                yield at, near
            for edge, child in self.children[at].items():
                on = who[np.abs(d - edge) <= radius]
                if len(on):
                    todo.append((child, on))


def _joined(tree: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Members and their roots in the forest of all links between tree and queries."""
    every = np.concatenate((tree, queries))
    label = np.arange(len(every))
    for node, near in BKTree(tree.tolist()).search(queries, radius):
        met = np.unique(np.append(label[near + len(tree)], label[node]))
        if len(met) > 1:
            label[np.isin(label, met[1:])] = met[0]
    moved = np.flatnonzero(label != np.arange(len(every)))
    return every[moved], every[label[moved]]


def _joined_small(values: list[int], radius: int) -> list[tuple[int, int]]:
    """The same within one short list, value by value."""
    links, children = [], [{} for _ in values]
    for i in range(1, len(values)):
        value, todo, place, linked = values[i], [0], None, False
        at = 0
        while place is None:
            d = (value ^ values[at]).bit_count()
            below = children[at].get(d)
            if below is None:
                place = (at, d)
            else:
                at = below
        while todo:
            at = todo.pop()
            d = (value ^ values[at]).bit_count()
            if d <= radius:
                links.append((value, values[at]))
            todo.extend(c for e, c in children[at].items() if abs(d - e) <= radius)
        children[place[0]][place[1]] = i
    return links


def _masks(radius: int, blocks: int) -> list[int]:
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    block = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(c)) for c in combinations(block, blocks - radius)]


def links(fps: DataFrame, *, radius: int = RADIUS, blocks: int = 6,
          shard_rows: int = 8192) -> DataFrame:
    """Edges ``(a, b)`` that join all distinct fingerprints ``fp`` within ``radius`` bits."""
    masks = _masks(radius, blocks)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, ["choice", "shard"]):
            values = table["fp"].to_numpy().view(np.uint64)
            choice, shard = table["choice"].to_numpy(), table["shard"].to_numpy()
            sizes = np.diff(at)
            a, b, large = [], [], []
            for g in np.flatnonzero(sizes > 1).tolist():
                lo, hi = int(at[g]), int(at[g + 1])
                if hi - lo <= _SMALL:
                    found = _joined_small(values[lo:hi].tolist(), radius)
                    a.extend(f[0] for f in found)
                    b.extend(f[1] for f in found)
                elif hi - lo <= shard_rows:
                    member, root = _joined(values[lo:hi], values[lo:hi], radius)
                    a.extend(member.tolist())
                    b.extend(root.tolist())
                else:
                    large.append((lo, hi))
            if a:
                none = np.zeros(len(a), np.int32)
                yield record_batch(_FOUND, [
                    np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64),
                    none - 1, none.astype(np.int64), none])
            for lo, hi in large:
                part = (np.arange(hi - lo) // shard_rows).astype(np.int32)
                signed = values[lo:hi].view(np.int64)
                yield record_batch(_FOUND, [signed, signed, choice[lo:hi], shard[lo:hi], part])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, ["choice", "shard", "i", "j"], 2 * shard_rows):
            values = table["a"].to_numpy().view(np.uint64)
            in_tree = table["in_tree"].to_numpy()
            same = table["i"].to_numpy() == table["j"].to_numpy()
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                v, t = values[lo:hi], in_tree[lo:hi]
                member, root = _joined(v[t], v if same[lo] else v[~t], radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(member.view(np.int64)), pa.array(root.view(np.int64))], ["a", "b"])

    laid = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("shard"))
        for i, m in enumerate(masks)])).alias("s")).select("fp", "s.choice", "s.shard")
    found = written(
        laid.repartition("choice", "shard").sortWithinPartitions("choice", "shard")
        .mapInArrow(search, _FOUND_SQL), "links")
    edges = found.where("choice < 0").select("a", "b")
    large = found.where("choice >= 0")
    parts = large.groupBy("choice", "shard").agg(F.max("part").alias("last"))
    pairs = large.join(parts, ["choice", "shard"]).select(
        "a", "choice", "shard", "part", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    ).select("a", "choice", "shard", F.least("part", "other").alias("i"),
             F.greatest("part", "other").alias("j"), (F.col("part") <= F.col("other")).alias("in_tree"))
    keys = ["choice", "shard", "i", "j"]
    return edges.unionByName(pairs.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(meet, "a long, b long"))


def near_duplicates(df: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row.

    The component is the least id reachable over links of at most ``radius`` differing bits. Null
    and empty texts have fingerprint zero and link like any other; a null id never names a
    component that has an id; repeated rows give repeated rows; an empty table gives none; other
    columns are ignored.
    """
    own = written(fingerprints(df, shingle=shingle, doc_id=doc_id, text=text), "fingerprints")
    fps = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(fps.select("fp"), radius=radius))
    rooted = fps.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return own.join(named.select("fp", "component_id"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, **parameters) -> DataFrame:
    """The rows of ``df`` without those that have a near-duplicate of smaller id.

    Rows that share an id stay or go together; rows without an id stay.
    """
    found = near_duplicates(df, **parameters)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(
        F.col("doc_id").alias("_gone")).distinct()
    key = parameters.get("doc_id", "doc_id")
    return df.join(gone, df[key].cast("long") == gone["_gone"], "left_anti")
