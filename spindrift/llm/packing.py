"""Packing token sequences by the online sum-of-squares rule.

An open window is known by its fill level; ``counts[h]`` says how many open windows hold ``h``
tokens. A piece goes to the level (or a new window) for which the sum of the squared counts becomes
least; of equal choices the fullest level wins. A window that becomes full is closed and its rows
leave the task. Documents longer than a window give whole windows first; what is left of them is
placed by the rule.

1. Every task packs the documents of its own partition, without a shuffle, and hands on the pieces
   in the windows that are open at its end.
2. In rounds, a task for every ``_FAN_IN`` tasks of the round before places the pieces handed on by
   the same rule. Tasks of the last round hand nothing on, as there is one.
3. What is open then is topped up: the emptiest windows are cut to fill the fullest, and the last
   remainder is cut into powers of two, which need no padding. Only the pieces that moved are marked
   ``poured``.

A task with more than ``_MOST_OPEN`` open windows tops these up at once, so that a task holds, and
hands on, a bounded number however large its input is.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spindrift.llm.shared import bounded, record_batch, texts_as_bytes, written
from spindrift.llm.tokens import WordTokenizer

CAPACITY = 4096
END_ID = 2
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, poured boolean")
_HANDED = SCHEMA + ", ids binary"
_KINDS = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
_ARROW = pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in _HANDED.split(", ")])
_ROWS = 20_000
_FAN_IN = 8
_MOST_OPEN = 4096
#: Numbers of sequences: round, task of the round, window of the task.
_ROUND_BITS, _TASK_BITS = 55, 30

Piece = tuple  # (doc_id, start, ids as uint32 array, doc_tokens, poured)


class LevelPacker:
    """Open windows by fill level; full windows go to ``close``."""

    def __init__(self, capacity: int, close):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)
        self.close = close

    def best_level(self, size: int) -> int:
        """Fill level that takes the next ``size`` tokens, 0 for a new window."""
        room = self.capacity - size
        if room == 0:
            return 0
        counts = self.counts
        before, after = counts[1:room + 1], counts[1 + size:]
        # moving a window from level h to level g changes the sum by 2 (N[g] - N[h] + 1);
        # a window that becomes full leaves the sum
        change = 2 * (after - before + 1)
        change[-1] = 1 - 2 * before[-1]
        change[before == 0] = np.iinfo(np.int64).max
        fullest = len(change) - 1 - int(np.argmin(change[::-1]))
        fresh = 2 * counts[size] + 1
        return fullest + 1 if change[fullest] <= fresh else 0

    def place(self, piece: Piece) -> None:
        size = len(piece[2])
        level = self.best_level(size)
        window = []
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
        window.append(piece)
        fill = level + size
        if fill == self.capacity:
            self.close(window)
        else:
            self.counts[fill] += 1
            self.open[fill].append(window)

    def n_open(self) -> int:
        return int(self.counts.sum())

    def hand_on(self) -> Iterator[Piece]:
        """The pieces of all open windows, fullest first; no window is open after that."""
        for level in sorted(self.open, reverse=True):
            for window in self.open[level]:
                yield from window
        self.open.clear()
        self.counts[:] = 0

    def top_up(self) -> list[Piece]:
        """Fill the fullest open windows by cutting the emptiest, and return what is left of the last."""
        windows = [(level, window) for level in sorted(self.open, reverse=True) for window in self.open[level]]
        self.open.clear()
        self.counts[:] = 0
        donor, last = [], len(windows)
        for at, (fill, window) in enumerate(windows):
            if at >= last:
                break
            while fill < self.capacity:
                if not donor:
                    last -= 1
                    if last <= at:
                        return window
                    donor = list(windows[last][1])
                doc_id, start, ids, n, *_ = donor.pop()
                taken = min(self.capacity - fill, len(ids))
                window.append((doc_id, start, ids[:taken], n, True))
                if taken < len(ids):
                    donor.append((doc_id, start + taken, ids[taken:], n, True))
                fill += taken
            self.close(window)
        return donor

    def drain(self) -> None:
        """Top up, and close what is left of the last window by powers of two."""
        rest = self.top_up()[::-1]
        total = sum(len(p[2]) for p in rest)
        for bit in range(total.bit_length() - 1, -1, -1):
            need = total & (1 << bit)
            window = []
            while need:
                doc_id, start, ids, n, *_ = rest.pop()
                taken = min(need, len(ids))
                window.append((doc_id, start, ids[:taken], n, True))
                if taken < len(ids):
                    rest.append((doc_id, start + taken, ids[taken:], n, True))
                need -= taken
            if window:
                self.close(window)


def pack(df: DataFrame, vocabulary: str, *, capacity: int = CAPACITY, end_id: int = END_ID,
         doc_id: str = "doc_id", text: str = "text", fan_in: int = _FAN_IN, most_open: int = _MOST_OPEN) -> DataFrame:
    """One row per piece of a document and the sequence that holds it.

    A null or empty text is a document of the end id alone; a null id stays null; repeated rows
    are packed as often as they come; an empty table gives no rows; other columns are ignored.
    Numbers of sequences are unique over all tasks but not gapless. ``poured`` marks the pieces that
    were moved at the end to fill windows. ``capacity`` must be a power of two. Writes the pieces of
    every round into the shared folder when called.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    if fan_in < 2 or most_open < 1:
        raise ValueError("a round needs a fan-in of two or more, and a task an open window")

    def packing(pieces, turn: int, final: bool) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        task = turn << _ROUND_BITS | TaskContext.get().partitionId() << _TASK_BITS
        sequence = task

        def close(window: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for owner, start, ids, n, poured in window:
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                rows.append((owner, start, len(ids), crc, n, sequence, offset, poured, None))
                offset += len(ids)
            sequence += 1

        packer = LevelPacker(capacity, close)
        for piece in pieces:
            packer.place(piece)
            if packer.n_open() > most_open:
                for left in packer.top_up():
                    packer.place(left)
            if len(rows) >= _ROWS:
                yield record_batch(_ARROW, zip(*rows))
                rows.clear()
        if final:
            packer.drain()
        for owner, start, ids, n, poured in packer.hand_on():
            rows.append((owner, start, len(ids), None, n, task, None, poured, ids.astype("<u4").tobytes()))
            if len(rows) >= _ROWS // 10:
                yield record_batch(_ARROW, zip(*rows))
                rows.clear()
        if rows:
            yield record_batch(_ARROW, zip(*rows))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(vocabulary)

        def pieces() -> Iterator[Piece]:
            for batch in bounded(batches, "t", 1 << 20):
                encoded = tokenizer.encode_all(texts_as_bytes(batch["t"]))
                for owner, ids in zip(batch["d"].to_pylist(), encoded):
                    ids = np.append(ids, np.uint32(end_id))
                    for start in range(0, len(ids), capacity):
                        yield owner, start, ids[start:start + capacity].copy(), len(ids), False

        yield from packing(pieces(), 0, False)

    def again(turn: int, final: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            columns = ("doc_id", "start", "ids", "doc_tokens", "poured")
            pieces = ((owner, start, np.frombuffer(ids, "<u4"), n, poured) for batch in bounded(batches, "ids", 4 << 20)
                      for owner, start, ids, n, poured in zip(*(batch[c].to_pylist() for c in columns)))
            yield from packing(pieces, turn, final)
        return run

    docs = df.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    done = []
    made, turn = written(docs.mapInArrow(first, _HANDED), "packed"), 0
    while True:
        done.append(made.where("ids is null").select(*names))
        waiting = made.where("ids is not null")
        last = waiting.agg(F.max("sequence_id")).first()[0]
        if last is None:
            break
        tasks = ((last >> _TASK_BITS) & ((1 << _ROUND_BITS - _TASK_BITS) - 1)) + 1
        left, turn = -(-tasks // fan_in), turn + 1
        made = written(waiting.coalesce(left).mapInArrow(again(turn, left == 1), _HANDED), "packed")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole
