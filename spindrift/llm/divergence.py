"""How far the sources of a language are apart in their words, over run-length columns.

1. Terms are counted per language and source; a language keeps the terms that stand in enough of its
   documents.
2. The kept terms of a language are brought into an order in which terms with equal counts stand
   together: by their counts in the sources, the smallest first, as a column store sorts its rows.
   Where a language has more sources than the key has columns, neighbouring ones are added up and a
   hash of all counts ends the key. Any order gives the same results. The order is cut into blocks.
3. Every source is a column of counts over that order, run-length encoded block by block.
4. For each pair of columns the run boundaries are merged, the formula is computed once a merged run
   and multiplied by its length. Columns meet in tiles, so a task holds one block of a few columns
   however many sources there are; the sums of the blocks are added by Spark.

All numbers are whole and exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.llm.shared import bounded, record_batch, texts_as_bytes, whole_groups, written
from spindrift.operators.windows import broadcast_if_small

SCALE = 1_000_000_000
LEAST_DOCUMENTS = 10
TOP_TERMS = 10
#: Terms in a block, columns in a tile, columns of the key that orders the terms.
BLOCK, TILE, KEYS = 16_384, 32, 16

#: Bytes of a term, with A-Z lower-cased; all others part terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()),
                     ("n", pa.int64()), ("docs", pa.int64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of the terms of a batch per language and source.

    An empty term stands for the language and source themselves.
    """
    for batch in bounded(batches, "text", 2 << 20):
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        keys = zip(batch["lang"].to_pylist(), batch["source"].to_pylist())
        for key, text in zip(keys, texts_as_bytes(batch["text"])):
            occurrences, documents = groups.setdefault(key, (Counter(), Counter()))
            words = text.translate(_FOLD).split()
            occurrences.update(words)
            documents.update(set(words))
        for (lang, source), (occurrences, documents) in groups.items():
            terms, n = [b"", *occurrences], len(occurrences) + 1
            yield record_batch(_COUNTS, [[lang] * n, [source] * n, terms, [0, *occurrences.values()],
                                         [0, *map(documents.__getitem__, occurrences)]])


def term_counts(df: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``; a row with an empty term for every language and source."""
    texts = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                        for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = texts.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    return counted.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * terms))``, exact."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(19,0)")
    return F.call_function("div", above, (total + 2 * terms).cast("decimal(19,0)")) + 1


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """:func:`share` of many counts: a long division in three steps of a thousand."""
    below = total + 2 * terms
    if below >= 1 << 53:
        return np.array([SCALE * (int(c) + 2) // below + 1 for c in counts], dtype=np.int64)
    rest, quotient = counts + 2, np.zeros(len(counts), dtype=np.int64)
    for _ in range(3):
        rest = rest * 1000
        quotient = quotient * 1000 + rest // below
        rest = rest % below
    return quotient + 1


def runs(counts: np.ndarray) -> np.ndarray:
    """Where the runs of equal counts start."""
    return np.flatnonzero(np.concatenate((np.ones(min(len(counts), 1), dtype=bool), counts[1:] != counts[:-1])))


def apart(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], size: int) -> int:
    """Sum over ``size`` terms of ``floor((p - q)^2 / (p + q))`` for columns given as run starts and shares.

    Shares are at most about 10^9, so squares and sums fit 64 bits.
    """
    starts = np.sort(np.concatenate((a[0], b[0])), kind="stable")
    starts = starts[runs(starts)]
    lengths = np.diff(starts, append=size)
    p = a[1][np.searchsorted(a[0], starts, "right") - 1]
    q = b[1][np.searchsorted(b[0], starts, "right") - 1]
    return int(((p - q) ** 2 // (p + q) * lengths).sum())


_COLUMN = pa.schema([("lang", pa.string()), ("block", pa.int64()), ("low", pa.int32()), ("high", pa.int32()),
                     ("at", pa.int32()), ("size", pa.int32()), ("starts", pa.binary()), ("shares", pa.binary())])
_COLUMN_SQL = "lang string, block long, low int, high int, at int, size int, starts binary, shares binary"
_PAIR = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])


def _encoder(tile: int):
    """Encode the columns of a block and send each to the tiles where it meets the others."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.zeros(row["size"], dtype=np.int64)
                if row["places"]:
                    counts[np.array(row["places"]) - row["first"]] = row["ns"]
                starts = runs(counts)
                values = shares(counts[starts], row["total"], row["terms"]) if len(starts) else counts
                own, tiles = row["at"] // tile, -(-row["sources"] // tile)
                out = [(row["lang"], row["block"], min(own, t), max(own, t), row["at"], row["size"],
                        starts.astype(np.int32).tobytes(), values.tobytes()) for t in range(tiles)]
                for i in range(0, tiles, 64):
                    yield record_batch(_COLUMN, zip(*out[i:i + 64]))

    return encode


def _meeter(tile: int):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["lang", "block", "low", "high"], rows=4 * tile):
            out = []
            for start, end in zip(bounds[:-1], bounds[1:]):
                rows = table.slice(start, end - start).to_pylist()
                columns = [(np.frombuffer(r["starts"], np.int32), np.frombuffer(r["shares"], np.int64)) for r in rows]
                same = rows[0]["low"] == rows[0]["high"]
                for i, a in enumerate(rows):
                    for j in range(i + 1, len(rows)):
                        b = rows[j]
                        if same or a["at"] // tile != b["at"] // tile:
                            value = apart(columns[i], columns[j], a["size"]) if a["size"] else 0
                            out.append((a["lang"], a["at"], b["at"], value))
            if out:
                yield record_batch(_PAIR, zip(*out))

    return meet


def audit(df: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
          least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS, block: int = BLOCK, tile: int = TILE,
          ) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every language and source of the table.

    Part ``pair`` has the value of each other source of the language, part ``term`` the
    ``top_terms`` terms that the source uses more than its language. Null text, language or source
    counts as empty; every row is a document, also a repeated one; a language without kept terms has
    pairs of value 0; an only source has none; an empty table gives no rows; other columns are
    ignored. Texts and terms may be of any length.
    """
    counts = written(term_counts(df, text=text, lang=lang, source=source), "terms")
    found = counts.where(F.col("term") != "").groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_documents).drop("docs")
    kept = written(counts.drop("docs").join(found, ["lang", "term"]), "terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    by_size = Window.partitionBy("lang").orderBy("total", "source")
    groups = written(
        counts.where(F.col("term") == "").select("lang", "source")
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
        .withColumn("at", (F.row_number().over(by_size) - 1).cast("int"))
        .withColumn("sources", F.count(F.lit(1)).over(Window.partitionBy("lang")).cast("int")), "groups")
    pairs = _pairs(kept, groups, block, tile)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(_terms(kept, groups, top_terms).select(columns))


def _pairs(kept: DataFrame, groups: DataFrame, block: int, tile: int) -> DataFrame:
    small = broadcast_if_small(groups)
    numbered = kept.join(small.select("lang", "source", "at", "sources"), ["lang", "source"])
    key = F.when(F.col("sources") > KEYS, F.floor(F.col("at") * KEYS / F.col("sources"))).otherwise(F.col("at"))
    names = [f"k{i}" for i in range(KEYS)]
    ordered = numbered.groupBy("lang", "term").agg(
        *[F.sum(F.when(key == i, F.col("n")).otherwise(0)).alias(k) for i, k in enumerate(names)],
        F.bit_xor(F.xxhash64("at", "n")).alias("_all"))
    order = ["lang", *names, "_all", "term"]
    numbers = F.monotonically_increasing_id()
    row = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    placed = written(
        ordered.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", numbers)
        .select("lang", "term", (F.shiftright("_row", 33) * (1 << 32) + F.floor(row / block)).alias("block"),
                (row % block).cast("int").alias("place")), "order")
    blocks = placed.groupBy("lang", "block").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).cast("int").alias("size"))
    # an empty block for each language, so that sources without a kept term meet too
    blocks = blocks.unionByName(groups.select(
        "lang", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("first"), F.lit(0).alias("size")).distinct())
    entry = F.array_sort(F.collect_list(F.struct("place", "n")))
    entries = numbered.join(placed, ["lang", "term"]).groupBy("lang", "block", "at").agg(entry.alias("_e"))
    columns = groups.drop("source", "lang_total").join(blocks, "lang").join(entries, ["lang", "block", "at"], "left")
    columns = columns.withColumns({"places": F.col("_e.place"), "ns": F.col("_e.n")}).drop("_e")
    meeting = ["lang", "block", "low", "high"]
    encoded = columns.mapInArrow(_encoder(tile), _COLUMN_SQL)
    met = encoded.repartition(*meeting).sortWithinPartitions(*meeting, "at").mapInArrow(
        _meeter(tile), "lang string, a int, b int, value long")
    values = met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = values.select("lang", "value", F.explode(F.array(
        F.struct(F.col("a").alias("at"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("at"), F.col("a").alias("other")))).alias("e")).select("lang", "value", "e.*")
    named = both.join(small.select("lang", "at", "source"), ["lang", "at"]).join(
        small.select("lang", F.col("at").alias("other"), F.col("source").alias("item")), ["lang", "other"])
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return named.withColumns({"part": F.lit("pair"), "rank": F.row_number().over(best)})


def _terms(kept: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    sized = kept.join(broadcast_if_small(groups.drop("at", "sources")), ["lang", "source"])
    p, q = F.col("_p"), F.col("_q")
    valued = sized.select(
        "lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("terms")).alias("_p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("_q"),
    ).where(p > q).withColumn("value", F.call_function("div", (p - q) * (p - q), p + q))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return valued.withColumns({"part": F.lit("term"), "rank": F.row_number().over(best)}).where(
        F.col("rank") <= most)
