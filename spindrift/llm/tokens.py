"""Token ids of whole texts from a public vocabulary, each distinct word encoded once per batch."""

from __future__ import annotations

import numpy as np
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from spindrift.llm.words import Words, byte_hasher, ragged

_MAX_BATCH = 8 << 20
_MAX_TAIL = 8
#: Punctuation that the vocabulary's splitting rule always parts from a run of letters before it.
_TAIL = np.isin(np.arange(256), np.frombuffer(b".,!?;:*#$%&|", np.uint8))
_UPPER = np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1))
_LETTER = _UPPER | np.isin(np.arange(256), np.arange(ord("a"), ord("z") + 1))
#: Second bytes of the letters U+00C0 to U+00FF behind 0xC3, and those of them in upper case.
_LATIN = np.isin(np.arange(256), [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])
_LATIN_UPPER = np.isin(np.arange(256), [b for b in range(0x80, 0x9F) if b != 0x97])
#: Byte-level vocabularies show printable bytes as themselves and the others from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _pieces(words: Words, lower_case: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, with plain words in lower case if asked for, piece bounds in them, and pieces of every word."""
    raw = words.buffer
    letter, upper = _LETTER[raw], _UPPER[raw]
    second = np.flatnonzero(raw[:-1] == 0xC3) + 1
    second = second[_LATIN[raw[second]]]
    letter[second] = letter[second - 1] = True
    upper[second] = _LATIN_UPPER[raw[second]]
    letters = np.concatenate(([0], np.cumsum(letter)))
    starts, ends = words.starts, words.ends
    core = ends.copy()
    for _ in range(_MAX_TAIL):
        more = (core > starts) & _TAIL[raw[core - 1]]
        if not more.any():
            break
        core -= more
    plain = (core > starts) & (letters[core] - letters[starts] == core - starts)
    core = np.where(plain, core, ends)
    lower = raw
    if lower_case:
        lower = raw + np.uint8(32) * upper
        kept = ragged(starts[~plain], (ends - starts)[~plain])
        lower[kept] = raw[kept]
    per_word = 1 + (core < ends)
    bounds = np.stack((np.stack((starts, core), 1), np.stack((core, ends), 1)), 1)
    bounds = bounds.reshape(-1, 2)[np.stack((np.ones(len(starts), bool), core < ends), 1).ravel()]
    return lower, bounds[:, 0], bounds[:, 1], per_word


class PieceEncoder:
    """Encodes texts piece by piece.

    A word of plain Latin letters with plain punctuation behind it is two pieces, any other word
    is one. Pieces are known by a 64-bit hash of their bytes; up to ``max_known`` stay known,
    later ones are encoded anew in each batch that holds them.
    """

    lower_case = False

    def __init__(self, max_known: int = 400_000):
        self._max_known = max_known
        self._hashes = np.zeros(0, dtype=np.uint64)
        self._at = np.zeros(0, dtype=np.int64)
        self._sizes = np.zeros(0, dtype=np.int64)
        self._flat = np.zeros(0, dtype=np.uint32)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        raise NotImplementedError

    def encode_all(self, texts: list[bytes]) -> list[np.ndarray]:
        """One uint32 array per text; a text beyond the batch size is encoded in parts."""
        if sum(map(len, texts)) > _MAX_BATCH and len(texts) > 1:
            half = len(texts) // 2
            return self.encode_all(texts[:half]) + self.encode_all(texts[half:])
        if len(texts) == 1 and len(texts[0]) > _MAX_BATCH:
            parts = self._cut(texts[0])
            if len(parts) > 1:
                return [np.concatenate([self.encode_all([p])[0] for p in parts])]
        words = Words(texts)
        buffer, starts, ends, per_word = _pieces(words, self.lower_case)
        hashes, example, which = np.unique(
            byte_hasher(buffer).runs(starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self._hashes, hashes)
        known = np.zeros(len(hashes), dtype=bool)
        inside = at < len(self._hashes)
        known[inside] = self._hashes[at[inside]] == hashes[inside]
        begins, sizes = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        begins[known], sizes[known] = self._at[at[known]], self._sizes[at[known]]
        raw, new = buffer.tobytes(), np.flatnonzero(~known)
        first, last = starts[example[new]].tolist(), ends[example[new]].tolist()
        ids = self.encode_pieces([raw[a:b] for a, b in zip(first, last)])
        sizes[new] = np.fromiter(map(len, ids), np.int64, len(ids))
        begins[new] = len(self._flat) + np.cumsum(sizes[new]) - sizes[new]
        flat = np.concatenate((self._flat, np.fromiter(
            (i for piece in ids for i in piece), np.uint32, int(sizes[new].sum()))))
        if len(self._hashes) < self._max_known:
            merged = np.concatenate((self._hashes, hashes[new]))
            order = np.argsort(merged)
            self._hashes = merged[order]
            self._at = np.concatenate((self._at, begins[new]))[order]
            self._sizes = np.concatenate((self._sizes, sizes[new]))[order]
            self._flat = flat
        size, begin = sizes[which], begins[which]
        upto = np.concatenate(([0], np.cumsum(size)))
        out = flat[ragged(begin, size)]
        piece_upto = np.concatenate(([0], np.cumsum(per_word)))
        lows = upto[piece_upto[words.first]]
        highs = upto[piece_upto[words.first + words.counts]]
        return [out[a:b] for a, b in zip(lows.tolist(), highs.tolist())]

    @staticmethod
    def _cut(text: bytes) -> list[bytes]:
        """Parts of about the batch size, cut behind a blank or line end."""
        parts, at = [], 0
        while len(text) - at > _MAX_BATCH:
            limit = at + _MAX_BATCH
            cut = max(text.rfind(b" ", at, limit), text.rfind(b"\n", at, limit))
            if cut < 0:
                found = [c for c in (text.find(b" ", limit), text.find(b"\n", limit)) if c >= 0]
                if not found:
                    break
                cut = min(found)
            parts.append(text[at:cut + 1])
            at = cut + 1
        return [*parts, text[at:]]


class WordTokenizer(PieceEncoder):
    """Ids of the lower-casing vocabulary with word ends.

    It drops white space and no token crosses it, so the ids of a text are the ids of its words
    in turn; and it parts a run of letters from the punctuation behind it.
    """

    lower_case = True

    def __init__(self, path: str, max_known: int = 400_000):
        super().__init__(max_known)
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        return [self._encode_piece(p) for p in pieces]

    def _encode_piece(self, piece: bytes) -> list[int]:
        text = piece.decode("utf-8")
        if text.isalpha() and text.islower() and max(text) < "\u0100":
            return [t.id for t in self._model.tokenize(piece.decode("latin-1").translate(_SHOWN))]
        return self._tokenizer.encode(text, add_special_tokens=False).ids


class SentencePieces(PieceEncoder):
    """Ids of a vocabulary with byte fallback, each piece encoded as a word of its own."""

    def __init__(self, path: str, max_known: int = 400_000):
        super().__init__(max_known)
        self._model = SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self._model.is_byte(i) or self._model.is_unknown(i)
                                 for i in range(self._model.get_piece_size())])

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        return self._model.encode([p.decode("utf-8") for p in pieces], num_threads=1) if pieces else []
