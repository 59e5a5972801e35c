"""Packing token ids into sequences of a fixed length by minimum bin slack."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from plotweave.llm.common import documents, slices
from plotweave.llm.token_ids import default_path, encoder as encoder_of

CAPACITY = 1024
SEPARATOR = 0
# Remainders that wait for a place, per task; a few hundred give an exact fill almost always.
WINDOW = 512
SEQUENCES_PER_TASK = 1 << 33

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def least_slack(counts: np.ndarray, capacity: int) -> list[int]:
    """The lengths, as a multiset out of ``counts[length]``, whose sum is closest to ``capacity``.

    The longest length is always taken; a bitset of reachable sums, one bit per sum, is
    extended length by length from long to short until the capacity itself is reachable. The
    bitsets kept on the way are walked back to find how often each length is used.
    """
    lengths = np.flatnonzero(counts[: capacity + 1])[::-1].tolist()
    lengths = [x for x in lengths if x > 0]
    if not lengths:
        return []
    longest = lengths[0]
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        if length > room:
            continue
        left = int(counts[length]) - (length == longest)
        # Counts in powers of two, so that any number up to ``left`` can be made.
        part = 1
        while left > 0 and part * length <= room:
            use = min(part, left)
            wider = (reach | (reach << (use * length))) & mask
            if wider != reach:
                steps.append((length, use, reach))
                reach = wider
            left -= use
            part *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = [longest]
    for length, use, before in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * use
            total -= use * length
    return chosen


class _Packer:
    """Packs what one task reads; ``rows`` collects the pieces."""

    def __init__(self, capacity: int, window: int, first_sequence: int):
        self.capacity, self.window, self.next_sequence = capacity, window, first_sequence
        self.counts = np.zeros(capacity + 1, "int64")
        self.waiting: dict[int, list[tuple]] = {}
        self.n_waiting = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n, c = len(ids) // 4, self.capacity
        for start in range(0, n - n % c, c):
            self._place([(doc_id, start, c, n, ids[start * 4 : (start + c) * 4])])
        if rest := n % c:
            self._wait((doc_id, n - rest, rest, n, ids[(n - rest) * 4 :]))
            if self.n_waiting >= self.window:
                while self.n_waiting > self.window // 2:
                    self._fill()

    def finish(self) -> None:
        """The last sequences; what stays below the capacity becomes powers of two."""
        while self.n_waiting:
            if int(self.counts @ np.arange(self.capacity + 1)) >= self.capacity:
                self._fill()
                continue
            last = [self._take(x) for x in range(self.capacity, 0, -1) for _ in range(self.counts[x])]
            total = sum(p[2] for p in last)
            for size in [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]:
                self._place(self._cut(last, size))

    def _wait(self, piece: tuple) -> None:
        self.waiting.setdefault(piece[2], []).append(piece)
        self.counts[piece[2]] += 1
        self.n_waiting += 1

    def _take(self, length: int) -> tuple:
        self.counts[length] -= 1
        self.n_waiting -= 1
        return self.waiting[length].pop()

    def _fill(self) -> None:
        """One sequence of the least slack; slack that is left is filled by cutting a remainder."""
        pieces = [self._take(x) for x in least_slack(self.counts, self.capacity)]
        slack = self.capacity - sum(p[2] for p in pieces)
        while slack:
            longer = np.flatnonzero(self.counts)
            piece = [self._take(int(longer[-1]))]
            pieces += self._cut(piece, min(slack, piece[0][2]))
            slack = self.capacity - sum(p[2] for p in pieces)
            if piece:
                self._wait(piece[0])
        self._place(pieces)

    @staticmethod
    def _cut(pieces: list[tuple], size: int) -> list[tuple]:
        """Takes ``size`` ids off the front of ``pieces``."""
        out = []
        while size:
            doc_id, start, length, n, ids = pieces[0]
            use = min(size, length)
            out.append((doc_id, start, use, n, ids[: use * 4]))
            if use == length:
                pieces.pop(0)
            else:
                pieces[0] = (doc_id, start + use, length - use, n, ids[use * 4 :])
            size -= use
        return out

    def _place(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, length, n, ids in pieces:
            self.rows.append((doc_id, start, length, n, self.next_sequence, offset, ids))
            offset += length
        self.next_sequence += 1

    def taken(self) -> pa.RecordBatch:
        columns, self.rows = list(zip(*self.rows)), []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES
        )


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    separator: int = SEPARATOR,
    window: int = WINDOW,
) -> DataFrame:
    """Pieces of documents and their places in sequences of at most ``capacity`` ids.

    Input: ``doc_id, text``; other columns are ignored. A document's ids are followed by
    ``separator``; null and empty texts are just that id. Whole runs of ``capacity`` ids are
    sequences of their own; the remainders wait in a window per task, and each further
    sequence takes the longest one and those that fill it best (``least_slack``). A remainder
    is cut only where nothing fills a sequence exactly. All sequences are full, but for the
    last ids of a task: these make sequences whose lengths are powers of two, so at most
    log2(capacity) short ones per task and no padding at all.

    Rows that repeat an id or have none are documents like any other. An empty table gives no
    rows. Nothing is shuffled, and a task holds ``window`` remainders; sequence ids are unique
    and the same when a task is run again.

    Returns ``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` (little-endian
    unsigned 32-bit).
    """
    path = tokenizer or default_path()
    end = int(separator).to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        packer = _Packer(capacity, window, TaskContext.get().partitionId() * SEQUENCES_PER_TASK)
        for batch in batches:
            for part in slices(batch, "text"):
                encoded = encoder.encode(part.column("text"))
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoded):
                    packer.add(doc_id, ids + end)
                if packer.rows:
                    yield packer.taken()
        packer.finish()
        if packer.rows:
            yield packer.taken()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return rows.mapInArrow(packed, schema)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op1_packing(spark, sf_dir):
    return digest(pack(documents(spark, sf_dir)))


QUERIES = {"op1_packing": op1_packing}
ORACLES: dict[str, str] = {}
