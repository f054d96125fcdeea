"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded by a small network from the shares of its
pairs of byte classes and of words that repeat a recent one; gated attention weighs the passages,
and a linear layer scores the weighted sum. Only documents have labels, so a spoilt passage that
decides its document's label earns its weight in learning.

Learning takes a bounded sample: of each label ``documents`` documents with the least hash of their
id, and of a document at most ``passages`` passages at even steps. Scoring reads every passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spindrift.llm.language import held_out
from spindrift.llm.shared import bounded, first_by_hash, record_batch, texts_as_bytes
from spindrift.llm.words import Words

PASSAGE = 1024
THRESHOLD = 0.7
_BACK = (1, 2, 3, 4, 8)


def _classes() -> tuple[np.ndarray, int]:
    """Class of every byte: vowels, other letters by case, digits, kinds of punctuation, UTF-8."""
    groups = [b" ", b"\n", b"\t\r\x0b\x0c", b"aeiouy", b"bcdfgjkmpqvwxz", b"hlnrst", b"AEIOUY",
              bytes(set(range(65, 91)) - set(b"AEIOUY")), b"0123456789", b".", b",", b"!", b"?;:",
              b"'\"`", b"-_", b"#*$%&", b"|", b"<>{}[]()/\\=+^~@", bytes(range(0x80, 0xC0)),
              bytes(range(0xC0, 0x100))]
    table = np.full(256, len(groups))
    for i, group in enumerate(groups):
        table[list(group)] = i
    return table, len(groups) + 1


_CLASS, _KINDS = _classes()
FEATURES = _KINDS * _KINDS + len(_BACK) + 2


@dataclass(frozen=True)
class Network:
    """Weights of the encoder, the attention and the score, and what centres the features."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    d: np.ndarray


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of passages of every text (one at least)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(-(-sizes // PASSAGE), 1)
    first = np.cumsum(counts) - counts
    words = Words(texts)
    n = int(counts.sum())
    place = np.arange(len(words.buffer)) - np.repeat(words.text_starts, sizes + 1)
    passage = np.repeat(first, sizes + 1) + np.minimum(place // PASSAGE, np.repeat(counts, sizes + 1) - 1)
    kind = _CLASS[words.buffer]
    pair = (passage[:-1] * _KINDS + kind[:-1]) * _KINDS + kind[1:]
    pairs = np.bincount(pair, minlength=n * _KINDS * _KINDS).reshape(n, -1)
    shares = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))
    hashes, of = words.hashes(), passage[words.starts]
    n_words = np.bincount(of, minlength=n)
    extra = [np.log1p(n_words), np.bincount(of, words.ends - words.starts, n) / np.maximum(n_words, 1)]
    for back in _BACK:
        same = np.zeros(len(hashes))
        same[back:] = (hashes[back:] == hashes[:-back]) & (words.text_of[back:] == words.text_of[:-back])
        extra.append(np.bincount(of, same, n) / np.maximum(n_words, 1))
    return np.concatenate((shares, np.stack(extra, 1)), 1).astype(np.float32), counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _forward(net: dict, x: np.ndarray, counts: np.ndarray):
    """Scores before the sigmoid, and what the gradient needs."""
    starts = np.cumsum(counts) - counts
    h = np.tanh(x @ net["w"] + net["b"])
    t, g = np.tanh(h @ net["v"]), _sigmoid(h @ net["u"])
    e = (t * g) @ net["a"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
    weight = e / np.repeat(np.add.reduceat(e, starts), counts)
    z = np.add.reduceat(h * weight[:, None], starts, axis=0)
    return z @ net["c"] + net["d"], (h, t, g, weight, z)


def _gradients(net: dict, x: np.ndarray, counts: np.ndarray, error: np.ndarray, held) -> dict:
    h, t, g, weight, z = held
    of = np.repeat(np.arange(len(counts)), counts)
    dz = error[:, None] * net["c"]
    dh = weight[:, None] * dz[of]
    de = weight * np.sum(dz[of] * (h - z[of]), axis=1)
    dt = (de[:, None] * net["a"]) * g * (1 - t * t)
    dg = (de[:, None] * net["a"]) * t * g * (1 - g)
    dh += dt @ net["v"].T + dg @ net["u"].T
    dx = dh * (1 - h * h)
    return {"w": x.T @ dx, "b": dx.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ de,
            "c": z.T @ error, "d": error.sum(keepdims=True)}


def train(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, *, hidden: int = 32,
          attention: int = 16, epochs: int = 30, batch: int = 128, rate: float = 3e-3,
          decay: float = 1e-4, seed: int = 7) -> Network:
    """Fit by Adam on the log loss, both labels of equal weight, from a fixed seed.

    The last bias puts the score ``THRESHOLD`` where the sample's labels part best.
    """
    random = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = np.clip((x - mean) / scale, -8, 8)
    n = x.shape[1]
    net = {"w": random.normal(0, n ** -0.5, (n, hidden)), "b": np.zeros(hidden),
           "v": random.normal(0, hidden ** -0.5, (hidden, attention)),
           "u": random.normal(0, hidden ** -0.5, (hidden, attention)),
           "a": random.normal(0, attention ** -0.5, attention),
           "c": random.normal(0, hidden ** -0.5, hidden), "d": np.zeros(1)}
    starts = np.cumsum(counts) - counts
    share = np.array([(labels == k).mean() for k in (0, 1)])
    weight = 0.5 / np.maximum(share, 1e-9)[labels]
    one, two, step = {k: np.zeros_like(v) for k, v in net.items()}, {k: np.zeros_like(v) for k, v in net.items()}, 0
    for _ in range(epochs):
        order = random.permutation(len(counts))
        for at in range(0, len(order), batch):
            bags = order[at:at + batch]
            rows = np.concatenate([np.arange(starts[i], starts[i] + counts[i]) for i in bags.tolist()])
            score, held = _forward(net, x[rows], counts[bags])
            error = weight[bags] * (_sigmoid(score) - labels[bags]) / len(bags)
            step += 1
            for k, grad in _gradients(net, x[rows], counts[bags], error, held).items():
                grad = grad + decay * net[k]
                one[k] = 0.9 * one[k] + 0.1 * grad
                two[k] = 0.999 * two[k] + 0.001 * grad * grad
                net[k] = net[k] - rate * (one[k] / (1 - 0.9 ** step)) / (np.sqrt(two[k] / (1 - 0.999 ** step)) + 1e-8)
    score, _ = _forward(net, x, counts)
    net["d"] = net["d"] + np.log(THRESHOLD / (1 - THRESHOLD)) - _parting(score, labels)
    return Network(mean, scale, **net)


def _parting(score: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the stretch of scores that parts the labels with the best balanced accuracy."""
    order = np.argsort(score)
    s, y = score[order], labels[order]
    zeros, ones = max((y == 0).sum(), 1), max((y == 1).sum(), 1)
    right = np.concatenate(([0], np.cumsum(y == 0) / zeros - np.cumsum(y == 1) / ones))
    best = np.flatnonzero(right >= right.max() - 1e-12)
    edges = np.concatenate(([s[0] - 1], s, [s[-1] + 1]))
    return float((edges[best[0]] + edges[best[-1] + 1]) / 2)


def learn(df: DataFrame, labels: DataFrame, *, documents: int = 2000, passages: int = 48,
          doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Network | None:
    """Fit to ``labels (doc_id, label)``; None if either label has no document.

    Labels other than 0 and 1 are ignored; a document with both counts as 0.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).cast("long").alias("id")).agg(F.min(label).cast("int").alias("y"))
    chosen = first_by_hash(known, "y", "id", documents).select("id", "y")
    rows = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).where(
        "t is not null").join(F.broadcast(chosen), "id")  # at most ``documents`` ids a label

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "t", 1 << 20):
            x, counts = features(texts_as_bytes(batch["t"]))
            kept, at = [], 0
            for n in counts.tolist():
                step = -(-n // passages)
                kept.append(x[at:at + n:step])
                at += n
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["y"], pa.array([k.tobytes() for k in kept], pa.binary())], ["id", "y", "x"])

    sample = rows.select("id", "y", "t").mapInArrow(encode, "id long, y int, x binary").toPandas()
    sample = sample.sort_values("id", kind="stable")
    if sample["y"].nunique() < 2:
        return None
    bags = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in sample["x"]]
    return train(np.concatenate(bags).astype(np.float64), np.array([len(b) for b in bags]),
                 sample["y"].to_numpy(dtype=np.int64))


def score_texts(texts: list[bytes], net: Network) -> np.ndarray:
    x, counts = features(texts)
    x = np.clip((x - net.mean) / net.scale, -8, 8)
    weights = {k: getattr(net, k) for k in ("w", "b", "v", "u", "a", "c", "d")}
    return _sigmoid(_forward(weights, x, counts)[0])


def score(df: DataFrame, net: Network | None, *, doc_id: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row.

    A null or empty text is scored as one empty passage; without a network every score is 0.5.
    A null id is not held out; repeated rows give repeated rows; an empty table gives none; other
    columns are ignored.
    """
    keyed = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"),
                      F.coalesce(held_out(doc_id), F.lit(False)).alias("held_out"))
    return _with_score(keyed, net, ["doc_id", "held_out"], "t").select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(df: DataFrame, net: Network | None, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that score ``threshold`` or more; all of them without a network."""
    if net is None:
        return df
    row = df.select(F.struct(*df.columns).alias("row"), F.col(text).alias("t"))
    return _with_score(row, net, ["row"], "t").where(F.col("score") >= threshold).select("row.*")


def _with_score(df: DataFrame, net: Network | None, kept: list[str], text: str) -> DataFrame:
    frozen = df.sparkSession.sparkContext.broadcast(net and vars(net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = frozen.value and Network(**frozen.value)
        for batch in bounded(batches, text, 1 << 20):
            texts = texts_as_bytes(batch[text])
            found = score_texts(texts, net) if net else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays(
                [*(batch[k] for k in kept), pa.array(found, pa.float64())], [*kept, "score"])

    schema = df.select(*kept).schema.add("score", "double")
    return df.mapInArrow(run, schema)
