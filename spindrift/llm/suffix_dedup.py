"""Removing repeated byte strings with two-stage suffix sorting.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier: in a document of
smaller id, or before it in the same one. Sorting every suffix of a corpus is not needed for that.

1. Anchors: of every ``length`` bytes, at least one ``ANCHOR``-byte gram is the least by hash of
   the grams in it, and equal strings have it at the same place. An anchor's region is all bytes
   of strings that hold it. One shuffle by the gram's hash finds anchors whose whole region occurs
   earlier, told by a second hash; these are settled without looking at text.
2. Where one gram has several regions, the first of each region is fetched, and the regions of a
   gram are sorted together: suffixes smaller than their successor directly, the others induced
   from them bucket by bucket. Adjacent common prefixes of ``length`` bytes mark repeats.
3. The marked ranges meet the documents again and are cut out.

Copies of an anchor within a batch are settled there, so a line that most documents share does not
fill one task; a gram with very many regions is parted by the bytes beside it before its regions are
sorted.
Hashes have 64 bits; two different regions of one gram would have to collide to go wrong.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.llm.shared import bounded, record_batch, texts_as_bytes, whole_groups, written
from spindrift.llm.words import byte_hasher, minimisers, mix, ragged

LENGTH = 100
ANCHOR = 32
_LAST = (1 << 63) - 1
_ANCHORS = pa.schema([("gram", pa.int64()), ("region", pa.int64()), ("doc", pa.int64()),
                      ("at", pa.int64()), ("settled", pa.bool_())])
_REGIONS = pa.schema([("gram", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()),
                      ("lead", pa.int32()), ("bytes", pa.binary())])
_RANGES = pa.schema([("doc", pa.int64()), ("version", pa.int32()), ("first", pa.int64()),
                     ("last", pa.int64())])
_RANGES_SQL = "doc long, version int, first long, last long"
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Ids with null last, and a hash of the text that tells rows of one id apart."""
    return df.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t")).select(
        "d", "t", F.coalesce("d", F.lit(_LAST)).alias("doc"),
        _version("t"))


def _version(text: str) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("version")


def anchors_of(texts: list[bytes], doc: np.ndarray, version: np.ndarray, length: int, anchor: int):
    """Gram hash, region hash, document, place and whether the batch holds the region before."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    use = np.flatnonzero(sizes >= length)
    if not len(use):
        return [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, bool)]
    buffer = np.frombuffer(b"".join([texts[i] for i in use.tolist()]), dtype=np.uint8)
    ends = np.cumsum(sizes[use])
    begins = ends - sizes[use]
    hasher = byte_hasher(buffer)
    grams = hasher.windows(anchor)
    across = ragged(ends[:-1] - (anchor - 1), np.full(len(ends) - 1, anchor - 1))
    valid = np.ones(len(grams), dtype=bool)
    valid[across] = False
    masked = np.where(valid, np.minimum(grams, np.uint64((1 << 64) - 2)), np.uint64((1 << 64) - 1))
    at = minimisers(masked, length - anchor + 1)
    owner = np.searchsorted(ends, at, side="right")
    margin = length - anchor
    low = np.maximum(at - margin, begins[owner])
    high = np.minimum(at + anchor + margin, ends[owner])
    gram = grams[at].view(np.int64)
    region = (hasher.runs(low, high) ^ mix((at - low).astype(np.uint64))).view(np.int64)
    who, place = doc[use][owner], at - begins[owner]
    packed = (version[use][owner].astype(np.int64) << 32) | place
    order = np.lexsort((packed, who, region, gram))
    g, r, w, p = gram[order], region[order], who[order], packed[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    settled = (w != w[lead]) | (p != p[lead])
    g = np.where(settled, mix(p.view(np.uint64) ^ mix(w.view(np.uint64))).view(np.int64), g)
    return g, np.where(settled, 0, r), w, p, settled


def suffix_order(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two-stage suffix sort of all pieces: suffix starts in order, the text with a 0 behind each
    piece (bytes are 1 to 256), the piece and the remaining bytes of every place of it.

    A suffix ends with its piece and a shorter one precedes what it is a prefix of.
    """
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int16) + 1
    stops = np.cumsum(sizes + 1) - 1
    text[stops] = 0
    n = len(text)
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    left = stops[piece] - np.arange(n)
    # a suffix is smaller than its successor if the next unlike symbol is larger
    step = np.append(np.diff(text), 0)
    unlike = np.where(step != 0, np.arange(n), n - 1)
    ahead = np.minimum.accumulate(unlike[::-1])[::-1]
    real = text > 0
    direct = real & (step[ahead] > 0)
    counts = np.bincount(text[real], minlength=258)
    induced_counts = np.bincount(text[real & ~direct], minlength=258)
    start = np.cumsum(counts) - counts
    rank = np.full(n, -1, dtype=np.int64)

    longest = int(sizes.max()) if len(sizes) else 0
    at = np.flatnonzero(direct)
    if len(at):
        at = at[np.argsort(left[at], kind="stable")]
        padded = np.zeros(n + longest, dtype=np.uint8)
        padded[:n][real] = (text[real] - 1).astype(np.uint8)
        keys = np.lib.stride_tricks.sliding_window_view(padded, longest)[at]
        keys[np.arange(longest) >= left[at][:, None]] = 0
        at = at[np.argsort(keys.view(f"S{longest}").ravel(), kind="stable")]
        first = text[at]
        within = np.arange(len(at)) - np.searchsorted(first, first)
        rank[at] = start[first] + induced_counts[first] + within

    induced = np.flatnonzero(real & ~direct)
    induced = induced[np.argsort(text[induced], kind="stable")]
    edges = np.searchsorted(text[induced], np.arange(259))
    for symbol in np.flatnonzero(induced_counts).tolist():
        bucket = induced[edges[symbol]:edges[symbol + 1]]
        now = bucket[text[bucket + 1] != symbol]
        now = now[np.argsort(rank[now + 1], kind="stable")]
        place = start[symbol]
        while len(now):
            rank[now] = place + np.arange(len(now))
            place += len(now)
            now = now[now > 0] - 1
            now = now[text[now] == symbol]
    order = np.empty(int(real.sum()), dtype=np.int64)
    order[rank[real]] = np.flatnonzero(real)
    return order, text, piece, left


def _repeats(pieces: list[bytes], doc: np.ndarray, packed: np.ndarray, length: int):
    """Piece and offset of strings of ``length`` bytes that come earlier in the pieces too;
    ``packed`` holds version and start of every piece."""
    order, text, piece, left = suffix_order(pieces)
    order = order[left[order] >= length]
    if len(order) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    strings = np.lib.stride_tricks.sliding_window_view(text, length)
    same = np.zeros(len(order), dtype=bool)
    for a in range(1, len(order), 1 << 16):
        b = min(a + (1 << 16), len(order))
        same[a:b] = (strings[order[a:b]] == strings[order[a - 1:b - 1]]).all(axis=1)
    run = np.cumsum(~same)
    shared = same | np.append(same[1:], False)
    order, run = order[shared], run[shared]
    of = piece[order]
    offset = order - np.searchsorted(piece, np.arange(len(pieces)))[of]
    who, start = doc[of], packed[of] + offset
    by = np.lexsort((start, who, run))
    run, who, start = run[by], who[by], start[by]
    new = np.append(True, run[1:] != run[:-1])[:len(run)]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(run)), 0))
    later = by[(who != who[lead]) | (start != start[lead])]
    return of[later], offset[later]


def _merged(who: np.ndarray, start: np.ndarray, length: int):
    """Union of ``[start, start + length)`` per document and version, as columns of ranges."""
    by = np.lexsort((start, who))
    who, start = who[by], start[by]
    new = np.ones(len(who), dtype=bool)
    new[1:] = (who[1:] != who[:-1]) | (start[1:] > start[:-1] + length)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(who))[:len(first)] - 1
    return (who[first], (start[first] >> 32).astype(np.int32), start[first] & 0xFFFFFFFF,
            (start[last] & 0xFFFFFFFF) + length)


def repeated_ranges(df: DataFrame, *, length: int = LENGTH, anchor: int = ANCHOR,
                    doc_id: str = "doc_id", text: str = "text", shard_bytes: int = 700_000,
                    ) -> DataFrame:
    """``(doc, version, first, last)``: byte ranges to remove, overlapping and beyond text ends."""
    if not 0 < anchor <= length:
        raise ValueError("the anchor must fit into the length")
    margin, most_rows = length - anchor, max(2, shard_bytes // (2 * length - anchor))
    docs = _keyed(df, doc_id, text)
    at: Column = F.col("at")
    version = F.shiftright(at, 32).cast("int").alias("version")
    place = at.bitwiseAND(F.lit(0xFFFFFFFF))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "t", 2 << 20):
            found = anchors_of(texts_as_bytes(batch["t"]), batch["doc"].to_numpy(),
                               batch["version"].to_numpy(), length, anchor)
            for lo in range(0, len(found[0]), 50_000):
                yield record_batch(_ANCHORS, [c[lo:lo + 50_000] for c in found])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "t", 2 << 20):
            rows = []
            for body, doc, v, places in zip(texts_as_bytes(batch["t"]), batch["doc"].to_pylist(),
                                            batch["version"].to_pylist(), batch["places"].to_pylist()):
                for p in places:
                    low = max(0, p - margin)
                    rows.append((doc, (v << 32) | p, p - low, body[low:p + length],
                                 body[p:p + anchor]))
            for lo in range(0, len(rows), 20_000):
                doc, packed, lead, region, gram = zip(*rows[lo:lo + 20_000])
                joined = np.frombuffer(b"".join(gram), np.uint8)
                starts = np.arange(len(gram)) * anchor
                yield record_batch(_REGIONS, [
                    byte_hasher(joined).runs(starts, starts + anchor).view(np.int64),
                    doc, packed, lead, region])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = most_rows
        for table, bounds in whole_groups(batches, ["gram"], rows):
            doc, lead = table["doc"].to_numpy(), table["lead"].to_numpy()
            packed = table["at"].to_numpy() - lead
            region = table["bytes"].to_pylist()
            shards: list[list[int]] = [[]]
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if hi - lo > rows:
                    yield from settle_hot(list(range(lo, hi)), 0, 0, region, lead, doc, packed)
                    continue
                if len(shards[-1]) + hi - lo > rows:
                    shards.append([])
                shards[-1].extend(range(lo, hi))
            for shard in filter(None, shards):
                yield from settle([region[i] for i in shard], doc[shard], packed[shard])

    def settle(pieces: list[bytes], doc: np.ndarray, packed: np.ndarray):
        of, offset = _repeats(pieces, doc, packed, length)
        if len(of):
            yield record_batch(_RANGES, _merged(doc[of], packed[of] + offset, length))

    def settle_hot(members: list[int], before: int, behind: int, region, lead, doc, packed):
        """Strings of many regions that agree from ``before`` bytes before their gram to ``behind``
        bytes behind it. Every string reaches further on one of the sides by at least half of the
        bytes that are left, so the regions are parted by those bytes on either side, until a part
        can be sorted or its strings are all one."""
        rest = margin - before - behind
        if not rest:
            start = packed[members] + lead[members] - before
            order = np.lexsort((start, doc[members]))
            who, start = doc[members][order], start[order]
            later = (who != who[0]) | (start != start[0])
            yield record_batch(_RANGES, _merged(who[later], start[later], length))
            return
        for low, high in ((before, behind + (rest + 1) // 2), (before + rest // 2 + 1, behind)):
            parts: dict[bytes, list[int]] = {}
            for i in members:
                at = int(lead[i])
                if at >= low and at + anchor + high <= len(region[i]):
                    parts.setdefault(region[i][at - low:at + anchor + high], []).append(i)
            reach = margin - high
            for part in parts.values():
                if len(part) > most_rows:
                    yield from settle_hot(part, low, high, region, lead, doc, packed)
                elif len(part) > 1:
                    skip = np.maximum(lead[part] - reach, 0)
                    pieces = [region[i][k:int(lead[i]) + length - low] for i, k in zip(part, skip.tolist())]
                    yield from settle(pieces, doc[part], packed[part] + skip)

    found = docs.select("doc", "version", "t").mapInArrow(
        find, "gram long, region long, doc long, at long, settled boolean")
    of_gram = Window.partitionBy("gram")
    marks = written(
        found.repartition("gram").select(
            "gram", "doc", "at",
            (F.col("settled") | (F.rank().over(Window.partitionBy("gram", "region").orderBy("doc", "at")) > 1))
            .alias("settled"),
            (F.min("region").over(of_gram) != F.max("region").over(of_gram)).alias("several"),
        ).where("settled or several").select("doc", "at", "settled"), "marks")

    wanted = marks.where("not settled").groupBy("doc", version).agg(F.collect_list(place).alias("places"))
    regions = docs.join(wanted, ["doc", "version"]).select("doc", "version", "t", "places").mapInArrow(
        fetch, "gram long, doc long, at long, lead int, bytes binary")
    sorted_ranges = written(
        regions.repartition("gram").sortWithinPartitions("gram").mapInArrow(sort, _RANGES_SQL), "ranges")
    whole = marks.where("settled").select(
        "doc", version, F.greatest(place - margin, F.lit(0)).alias("first"), (place + length).alias("last"))
    return whole.unionByName(sorted_ranges)


def _cut(body: bytes, ranges: list) -> tuple[bytes, int, int]:
    """What is left of the bytes, and the number of removed bytes and runs."""
    kept, at, removed, spans, end = [], 0, 0, 0, -1
    for low, high in sorted(ranges):
        high = min(high, len(body))
        if high <= end:
            continue
        if low > end:
            spans += 1
            kept.append(body[at:low])
            removed += high - low
        else:
            removed += high - end
        at = end = high
    kept.append(body[at:])
    return b"".join(kept), removed, spans


def _with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    lists = ranges.groupBy("doc", "version").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    return docs.join(lists, ["doc", "version"], "left")


def remove_repeats(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, SHA-256 of the rest, and the rest.

    A null text is empty; texts shorter than the length lose nothing; a null id comes after all
    others; repeated rows are one document, rows of one id with unlike texts are ordered by a hash
    of the text; an empty table gives no rows; other columns are ignored.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "t", 1 << 20):
            bodies = texts_as_bytes(batch["t"])
            ranges = batch["ranges"].to_pylist()
            done = [_cut(b, [(x["first"], x["last"]) for x in r or ()]) for b, r in zip(bodies, ranges)]
            yield record_batch(_RESULT, [
                batch["d"], [len(b) for b in bodies], [d[1] for d in done], [d[2] for d in done],
                [hashlib.sha256(d[0]).hexdigest() for d in done], [d[0] for d in done]])

    ranges = repeated_ranges(df, doc_id=doc_id, text=text, **parameters)
    return _with_ranges(_keyed(df, doc_id, text), ranges).select("d", "t", "ranges").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def _whole_characters(body: bytes, ranges: list) -> list[tuple[int, int]]:
    """The ranges united, each drawn in to the bounds of characters."""
    out: list[list[int]] = []
    for low, high in sorted(ranges):
        high = min(high, len(body))
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    inner = lambda i: 0 < i < len(body) and body[i] & 0xC0 == 0x80
    drawn = []
    for low, high in out:
        while low < high and inner(low):
            low += 1
        while high > low and inner(high):
            high -= 1
        if low < high:
            drawn.append((low, high))
    return drawn


def without_repeats(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                    n_chars: str = "n_chars", **parameters) -> DataFrame:
    """The rows of ``df`` with repeats cut from the text, which stays valid: a character goes only
    as a whole. A null text stays null; the count of characters, where there is one, follows."""
    others = [c for c in df.columns if c != text]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "t", 1 << 20):
            new = []
            for body, ranges in zip(batch["t"].cast(pa.binary()).to_pylist(), batch["ranges"].to_pylist()):
                if body is not None and ranges:
                    body = _cut(body, _whole_characters(body, [(x["first"], x["last"]) for x in ranges]))[0]
                new.append(body)
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(new, pa.binary()).cast(pa.string())], ["row", "t"])

    ranges = repeated_ranges(df, doc_id=doc_id, text=text, **parameters)
    rows = df.select(F.struct(*others).alias("row"), F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
    keyed = rows.select("row", "t", F.coalesce("d", F.lit(_LAST)).alias("doc"), _version("t"))
    joined = _with_ranges(keyed, ranges).select("row", "t", "ranges")
    done = joined.mapInArrow(cut, joined.select("row", "t").schema)
    follow = lambda c: (F.char_length("t").cast(df.schema[c].dataType) if c == n_chars
                        else F.col("row")[c])
    return done.select(*[F.col("t").alias(text) if c == text else follow(c).alias(c) for c in df.columns])


def digest(df: DataFrame, **parameters) -> DataFrame:
    """The rows of :func:`remove_repeats` without the bytes that are kept."""
    return remove_repeats(df, **parameters).drop("kept")
