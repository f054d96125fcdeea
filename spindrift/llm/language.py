"""Language identification by prediction by partial matching over bytes.

Every language has a context tree: for the up to three bytes before a byte, the longest context
that the tree holds gives the byte a probability from its counts, or an escape probability
(distinct over total plus distinct) times what the next shorter context gives it, renormalised
over the bytes not seen in the longer one. Statistics are frozen after learning, so the code
length of every byte in every context is known beforehand, and a text's exact code length is a sum
of table entries. The language of the shortest code wins.

The 127 most frequent bytes are symbols of their own; the others share a symbol and are told apart
by a uniform code, which costs every language the same.

Learning takes a bounded sample: of each language ``documents`` documents with the least hash of
their id. Counting runs in Spark; counts of the sample come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spindrift.llm.shared import bounded, first_by_hash, record_batch, texts_as_bytes

ORDER = 3
SYMBOLS = 128
_SHIFT = 7
_PAD = b"\n" * ORDER
_PART = 4 << 20
_TABLE_BYTES = 64 << 20
_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                     ("score", pa.float64())])


@dataclass(frozen=True)
class Model:
    languages: list[str]
    symbol: np.ndarray  # of every byte
    node: np.ndarray  # of every three symbols, the longest context that some tree holds
    bits: np.ndarray  # (node and next symbol, language)


def gram_counts(df: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` of all four-byte grams of texts, each text led by three line ends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "t", 4 << 20):
            langs = np.array(batch["lang"].to_pylist(), dtype=object)
            texts = texts_as_bytes(batch["t"])
            for lang in sorted(set(langs)):
                joined = b"".join(_PAD + texts[i] for i in np.flatnonzero(langs == lang).tolist())
                b = np.frombuffer(joined, np.uint8).astype(np.int64)
                gram, n = np.unique((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:],
                                    return_counts=True)
                yield record_batch(_COUNTS, [pa.array([lang] * len(gram)), gram, n])

    return df.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def _row(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Next-symbol probabilities of a context, given those of the next shorter one."""
    total, distinct = counts.sum(), np.count_nonzero(counts)
    if not distinct:
        return shorter
    rest = shorter[counts == 0].sum()
    if rest <= 0:
        return counts / total
    return np.where(counts > 0, counts / (total + distinct),
                    distinct / (total + distinct) * shorter / rest)


def compile_model(counts: dict[str, tuple[np.ndarray, np.ndarray]], *, least: int = 16,
                  most_nodes: int | None = None) -> Model:
    """Freeze gram counts per language into a table of code lengths.

    A tree holds the contexts seen ``least`` times or more; if the languages' trees hold more than
    ``most_nodes`` contexts together, longest ones go, those first that are rarest by their share in
    the language that uses them most. Without a number, the table of code lengths may take 64 MB,
    but 6000 contexts are held in any case.
    """
    languages = sorted(counts)
    if most_nodes is None:
        most_nodes = max(6000, _TABLE_BYTES // (4 * SYMBOLS * max(len(languages), 1)))
    if not languages:
        return Model([], np.zeros(256, np.int64), np.zeros(1 << _SHIFT * ORDER, np.int32), np.zeros((0, 0)))
    total = np.zeros(256, dtype=np.int64)
    for gram, n in counts.values():
        np.add.at(total, gram & 0xFF, n)
    symbol = np.zeros(256, dtype=np.int64)
    own = np.argsort(-total, kind="stable")[:SYMBOLS - 1]
    symbol[own] = np.arange(1, SYMBOLS)
    rare = 256 - (SYMBOLS - 1)

    held: list[dict[int, dict[int, np.ndarray]]] = []  # language, order: context to counts
    weight: dict[tuple[int, int], float] = {}
    for lang in languages:
        gram, n = counts[lang]
        s = [symbol[(gram >> shift) & 0xFF] for shift in (24, 16, 8, 0)]
        orders = {}
        for order in range(ORDER + 1):
            context = np.zeros(len(gram), dtype=np.int64)
            for k in range(ORDER - order, ORDER):
                context = (context << _SHIFT) | s[k]
            names, which = np.unique(context, return_inverse=True)
            size = np.bincount(which, n)
            keep = np.flatnonzero(size >= (least if order else 0))
            place = np.full(len(names), -1)
            place[keep] = np.arange(len(keep))
            table = np.zeros((len(keep), SYMBOLS))
            chosen = place[which] >= 0
            np.add.at(table, (place[which[chosen]], s[3][chosen]), n[chosen])
            orders[order] = dict(zip(names[keep].tolist(), table))
            share = size[keep] / max(n.sum(), 1)
            for name, part in zip(names[keep].tolist(), share.tolist()):
                weight[order, name] = max(weight.get((order, name), 0.0), part)
        held.append(orders)

    nodes = sorted(weight, key=lambda k: (k[0], -weight[k], k[1]))
    nodes = sorted(nodes[:most_nodes])
    at = {node: i for i, node in enumerate(nodes)}
    chance = np.zeros((len(nodes), SYMBOLS, len(languages)))
    uniform = np.full(SYMBOLS, 1 / SYMBOLS)
    for i, (order, context) in enumerate(nodes):
        up = i
        if order:
            up = at.get((order - 1, context & ((1 << _SHIFT * (order - 1)) - 1)), None)
        for k, orders in enumerate(held):
            shorter = chance[up, :, k] if order else uniform
            chance[i, :, k] = _row(orders[order].get(context, np.zeros(SYMBOLS)), shorter)
    bits = -np.log2(np.maximum(chance, 1e-12))
    bits[:, 0, :] += np.log2(rare)

    node = np.zeros(1 << _SHIFT * ORDER, dtype=np.int32)
    every = np.arange(1 << _SHIFT * ORDER)
    for order in range(1, ORDER + 1):
        names = np.array([c for o, c in nodes if o == order], dtype=np.int64)
        if not len(names):
            continue
        first = at[order, int(names[0])]
        tail = every & ((1 << _SHIFT * order) - 1)
        found = np.minimum(np.searchsorted(names, tail), len(names) - 1)
        node = np.where(names[found] == tail, (first + found).astype(np.int32), node)
    return Model(languages, symbol, node, bits.reshape(-1, len(languages)).astype(np.float32))


def learn(df: DataFrame, *, documents: int = 1500, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang", **parameters) -> Model:
    """Model of rows with a text and a language, from at most ``documents`` of each language."""
    rows = df.select(F.col(doc_id).alias("d"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("t")
                     ).where("lang is not null and t is not null and d is not null")
    chosen = first_by_hash(rows.select("d", "lang"), "lang", "d", documents)
    # at most ``documents`` ids a language
    found = gram_counts(rows.join(F.broadcast(chosen), ["d", "lang"], "left_semi").select("lang", "t")).toPandas()
    counts = {name: (part["gram"].to_numpy(), part["n"].to_numpy())
              for name, part in found.groupby("lang")}
    return compile_model(counts, **parameters)


def code_lengths(texts: list[bytes], model: Model) -> np.ndarray:
    """Bits of every text under every language; a very long text is read in parts."""
    if len(texts) == 1 and len(texts[0]) > _PART:
        led = _PAD + texts[0]
        return sum(_code_lengths([led[at:at + _PART + ORDER]], model, b"")
                   for at in range(0, len(texts[0]), _PART))
    return _code_lengths(texts, model, _PAD)


def _code_lengths(texts: list[bytes], model: Model, lead: bytes) -> np.ndarray:
    if not lead:
        lead, texts = texts[0][:ORDER], [texts[0][ORDER:]]
    joined = b"".join(lead + t for t in texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), len(model.languages)))
    if not sizes.sum():
        return out
    s = model.symbol[np.frombuffer(joined, np.uint8)]
    context = (s[:-3] << 2 * _SHIFT) | (s[1:-2] << _SHIFT) | s[2:-1]
    bits = model.bits[(model.node[context].astype(np.int64) << _SHIFT) | s[3:]]
    starts = np.cumsum(sizes + ORDER) - (sizes + ORDER)
    some = np.flatnonzero(sizes)
    # the pad of the next text lies between two texts' bytes
    edges = np.stack((starts[some], starts[some] + sizes[some]), 1).ravel()
    bits = np.concatenate((bits, np.zeros((1, bits.shape[1]), bits.dtype)))
    out[some] = np.add.reduceat(bits, edges, axis=0, dtype=np.float64)[::2]
    return out


def identify(df: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row.

    The score is the language's probability with equal odds before reading; of equal codes the
    first name wins. A null text and one without a letter are ``und`` with score 0, as all are if
    nothing was learned. A null id is not held out; repeated rows give repeated rows; other
    columns are ignored.
    """
    frozen = df.sparkSession.sparkContext.broadcast(
        (model.languages, model.symbol, model.node, model.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*frozen.value)
        names = np.array([*model.languages, "und"], dtype=object)
        for batch in bounded(batches, "t", 2 << 20):
            texts = texts_as_bytes(batch["t"])
            clear = np.array([bool(model.languages) and any(map(str.isalpha, t.decode())) for t in texts])
            if not model.languages:
                best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            else:
                bits = code_lengths(texts, model)
                best = np.argmin(bits, axis=1)
                gap = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)
                score = np.where(clear, 1 / np.exp2(-gap).sum(axis=1), 0.0)
                best = np.where(clear, best, len(names) - 1)
            yield record_batch(_RESULT, [batch["d"], batch["held_out"],
                                         pa.array(names[best].tolist()), score])

    return df.select(
        F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"),
        F.coalesce(held_out(doc_id), F.lit(False)).alias("held_out"),
    ).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def held_out(doc_id: str):
    """Whether a row is kept from learning."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2
