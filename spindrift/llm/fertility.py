"""Quality rules from the fertility of a public vocabulary.

Three measures of a text's tokens are held against the band of the text's main script: characters
per token, the share of tokens that stand for single bytes, and the entropy of the tokens. Text
that the vocabulary was not made for, such as encoded data, letter noise or symbol litter, breaks
into short pieces or bytes; text that says little repeats few tokens.

The rules apply beside plain counts of words, symbols and repeats. All is one pass without a
shuffle, over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spindrift.llm.shared import bounded, record_batch, texts_as_bytes
from spindrift.llm.tokens import SentencePieces
from spindrift.llm.words import Hasher, Words, byte_hasher, mix, sums_per_text


@dataclass(frozen=True)
class Band:
    """Limits of accepted text; entropy is judged from ``entropy_tokens`` tokens on.

    ``most_symbol_share`` bounds markup characters, which a vocabulary spells one by one.
    """

    least_chars_per_token: float
    most_chars_per_token: float
    most_byte_share: float
    least_entropy: float
    most_symbol_share: float = 0.05
    entropy_tokens: int = 100


#: Bands by main script. The vocabulary has whole words of Latin script only, few pieces longer
#: than a character for the next ones, and bytes for their rare characters; clean text of these
#: scripts gives 0.7 to 1 characters a token and a byte share of up to 0.15, random characters 0.3 to
#: 0.6 and 0.55 to 0.95. Scripts under ``other`` are spelled in bytes, so that only entropy and
#: symbols tell there.
BANDS: dict[str, Band] = {
    "latin": Band(1.6, 8.0, 0.05, 4.0),
    "greek": Band(0.8, 6.0, 0.3, 3.5),
    "cyrillic": Band(0.9, 6.0, 0.3, 3.5),
    "arabic": Band(0.6, 6.0, 0.3, 3.0),
    "hebrew": Band(0.6, 6.0, 0.3, 3.0),
    "indic": Band(0.6, 6.0, 0.4, 3.0),
    "thai": Band(0.6, 6.0, 0.3, 3.0),
    "cjk": Band(0.5, 6.0, 0.5, 3.0),
    "hangul": Band(0.5, 6.0, 0.5, 3.0),
    "caucasian": Band(0.6, 6.0, 0.4, 3.0),
    "other": Band(0.25, 6.0, 1.0, 3.0),
}
SCRIPTS = tuple(BANDS)

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, script string, n_tokens long, "
          "chars_per_token double, byte_share double, token_entropy double")
_KINDS = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64()}
_ARROW = pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in SCHEMA.split(", ")])

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_CHAR = (np.arange(256) & 0xC0) != 0x80
_WINDOW = 5


def _letters_by_script(words: Words, n_texts: int) -> np.ndarray:
    """Letters of every script (row) and text, told from the leading two bytes of UTF-8."""
    b = words.buffer
    latin = (((b | 32) >= ord("a")) & ((b | 32) <= ord("z")) & (b < 128)) | ((b >= 0xC3) & (b <= 0xC9))
    upto = np.concatenate(([0], np.cumsum(latin)))
    at = np.flatnonzero(b >= 0xCD)  # the other scripts; few bytes of most texts
    pair = (b[at].astype(np.int32) << 8) | np.append(b, 0)[at + 1]
    owner = np.searchsorted(words.text_starts, at, side="right") - 1
    within = lambda low, high: (pair >= low) & (pair <= high)
    marks = {
        "greek": within(0xCDB0, 0xCFFF),
        "cyrillic": within(0xD080, 0xD4AF),
        "arabic": within(0xD880, 0xDBBF),
        "hebrew": within(0xD691, 0xD7BF),
        "indic": within(0xE0A4, 0xE0B7),
        "thai": within(0xE0B8, 0xE0BB),
        "cjk": within(0xE381, 0xE383) | within(0xE390, 0xE9BF),
        "hangul": within(0xEAB0, 0xED9E),
        "caucasian": within(0xD4B0, 0xD68F) | within(0xE182, 0xE183),
    }
    told = np.logical_or.reduce(list(marks.values()))
    symbols = within(0xE200, 0xE2FF) | within(0xE380, 0xE380) | within(0xF09F, 0xF09F)
    marks["other"] = ~told & ~symbols & (pair >= 0xD500)
    counts = {script: np.bincount(owner[mark], minlength=n_texts) for script, mark in marks.items()}
    counts["latin"] = upto[words.text_ends] - upto[words.text_starts]
    return np.stack([counts[script] for script in SCRIPTS])


def _repeated(words: Words) -> np.ndarray:
    """Per text, the words inside five-word windows that occur at least twice in it."""
    n = len(words.starts)
    covered = np.zeros(n + 1, dtype=np.int64)
    if n >= _WINDOW:
        owner = words.text_of[:n - _WINDOW + 1]
        at = np.flatnonzero(owner == words.text_of[_WINDOW - 1:])
        window = Hasher(words.hashes()).windows(_WINDOW)[at] ^ mix(owner[at].astype(np.uint64))
        _, which, count = np.unique(window, return_inverse=True, return_counts=True)
        at = at[count[which] > 1]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + _WINDOW, -1)
    return sums_per_text((np.cumsum(covered[:n]) > 0).astype(np.int64), words.first, words.counts)


def _repeated_lines(words: Words, n_texts: int) -> np.ndarray:
    """Per text, the lines with a word that equal an earlier line."""
    ends = np.flatnonzero(words.buffer == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    owner = np.searchsorted(words.text_starts, starts, side="right") - 1
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, owner = starts[has_word], ends[has_word], owner[has_word]
    line = byte_hasher(words.buffer).runs(starts, ends) ^ mix(owner.astype(np.uint64))
    first = np.zeros(len(line), dtype=bool)
    first[np.unique(line, return_index=True)[1]] = True
    return np.bincount(owner[~first], minlength=n_texts)


def _entropy(ids: list[np.ndarray]) -> np.ndarray:
    """Bits per token of each text's token frequencies."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    if not sizes.sum():
        return np.zeros(len(ids))
    keys = np.repeat(np.arange(len(ids), dtype=np.int64) << 32, sizes) + np.concatenate(ids)
    keys.sort()
    edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(np.append(edge, len(keys)))
    part = np.bincount(keys[edge] >> 32, counts * np.log2(counts), minlength=len(ids))
    n = np.maximum(sizes, 1)
    return np.maximum(np.log2(n) - part / n, 0.0)


def measure_texts(texts: list[bytes], encoder: SentencePieces, bands: Mapping[str, Band]) -> dict:
    """All result columns but the id, as arrays."""
    words = Words(texts)
    buffer = words.buffer
    upto = lambda mask: np.concatenate(([0], np.cumsum(mask)))
    in_text = lambda mask: (c := upto(mask))[words.text_ends] - c[words.text_starts]
    chars = upto(_CHAR[buffer])
    word_chars = sums_per_text(chars[words.ends] - chars[words.starts], words.first, words.counts)
    n_words, n_symbols = words.counts, in_text(_SYMBOL[buffer])
    repeat = _repeated(words)
    failed = (n_words < 10) | (100 * repeat > 20 * n_words)
    script = np.argmax(_letters_by_script(words, len(texts)), axis=0)
    ids = encoder.encode_all(texts)
    n_tokens = np.fromiter(map(len, ids), np.int64, len(ids))
    n_bytes = np.array([np.count_nonzero(encoder.is_byte[i]) for i in ids])
    per_token = word_chars / np.maximum(n_tokens, 1)
    byte_share = n_bytes / np.maximum(n_tokens, 1)
    entropy = _entropy(ids)
    of = [bands[s] for s in SCRIPTS]
    limit = lambda name: np.array([getattr(b, name) for b in of])[script]
    kept = (~failed & (per_token >= limit("least_chars_per_token"))
            & (per_token <= limit("most_chars_per_token")) & (byte_share <= limit("most_byte_share"))
            & ((n_tokens < limit("entropy_tokens")) | (entropy >= limit("least_entropy")))
            & (n_symbols <= limit("most_symbol_share") * word_chars))
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
            "n_dup_lines": _repeated_lines(words, len(texts)), "n_repeat_words": repeat,
            "base_failed": failed, "kept": kept, "script": [SCRIPTS[s] for s in script],
            "n_tokens": n_tokens, "chars_per_token": per_token, "byte_share": byte_share,
            "token_entropy": entropy}


def judge(df: DataFrame, vocabulary: str, *, bands: Mapping[str, Band] = BANDS,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its counts, measures and verdict.

    A null or empty text has no words and fails; a null id stays null; repeated rows give
    repeated rows; an empty table gives none; other columns are ignored.
    """
    bands = dict(bands)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = SentencePieces(vocabulary)
        for batch in bounded(batches, "t", 1 << 20):
            found = measure_texts(texts_as_bytes(batch["t"]), encoder, bands)
            yield record_batch(_ARROW, [batch["d"], *found.values()])

    return df.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t")).mapInArrow(run, SCHEMA)
