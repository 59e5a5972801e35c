"""Compression of vectors to codes: exact integer codebooks over Hilbert-sorted blocks.

A vector's components become integers, and the vector is cut into ``PARTS`` parts with a codebook
each. Vectors stay with the task that reads them, in slices. Within a slice the parts of one
position are sorted along a Hilbert curve and cut into flat blocks, which hold the least and
largest values (the box) and the sum of their parts. This is stored once and read by each round.

A round compares boxes with the codebook's entries first. An entry whose least distance to the box
is above another's largest one is nearest to no part of the block; what is left is the block's
shortlist. A block with one entry on its shortlist adds its stored sum to it without a look at its
parts; the others are evaluated against their shortlists in integers. Every task returns one sum
per entry, so what is shuffled and collected does not depend on the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plotweave.plans.lookup import join_lookup
from plotweave.session import drop_stage, stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK = 64
# Values in a slice of vectors, and in the arrays of one step of the integer kernels.
SLICE_VALUES = 1 << 20
STEP_VALUES = 1 << 20
# Components and lengths up to which all sums of squares fit 64 bits.
MOST_VALUE, MOST_LENGTH = 1 << 24, 1 << 12


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The places on a Hilbert curve of ``cells``, rows of coordinates of ``bits`` bits.

    From the top bit on, a coordinate's bit turns the lower bits of the first coordinate over or
    swaps them with its own, which undoes the turns of the curve; the rest is a Gray code.
    """
    x = cells.astype("uint64").T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(n):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], "uint64")
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & np.uint64(1 << b), np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    keys = np.zeros(x.shape[1], "uint64")
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            keys = (keys << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return keys


def _curve_order(part: np.ndarray) -> np.ndarray:
    """Rows of one part's vectors in the order of the curve through their common box."""
    axes = part[:, :63]
    if not axes.shape[1]:
        return np.arange(len(part))
    bits = min(16, 63 // axes.shape[1])
    low = axes.min(0)
    width = np.maximum(axes.max(0) - low + 1, 1)
    return np.argsort(hilbert_keys(((axes - low) << bits) // width, bits), kind="stable")


class Blocks:
    """A slice's parts in flat blocks: ``order`` per part position, and each block's rows, box and sum."""

    def __init__(self, values: np.ndarray, parts: int = PARTS, order: np.ndarray | None = None):
        rows, dims = values.shape
        self.values = values.reshape(rows, parts, dims // parts).transpose(1, 0, 2).astype("int64")
        self.order = np.stack([_curve_order(p) for p in self.values]) if order is None else order
        self.sorted = np.take_along_axis(self.values, self.order[:, :, None], 1)
        self.begins = np.arange(0, rows, BLOCK)
        self.sizes = np.diff(np.append(self.begins, rows))

    def boxes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least values, largest values and sums, by part position and block."""
        return tuple(f.reduceat(self.sorted, self.begins, axis=1) for f in (np.minimum, np.maximum, np.add))


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Per block whether each entry of ``book`` may be nearest to a part in the block's box."""
    e = book[None]
    under, over = low[:, None] - e, e - high[:, None]
    least = (np.maximum(np.maximum(under, over), 0) ** 2).sum(2)
    most = (np.maximum(np.abs(under), np.abs(over)) ** 2).sum(2)
    return least <= most.min(1)[:, None]


def _steps(listed: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The blocks ``listed`` in runs of shortlists of about the same length."""
    lengths = listed.sum(1)
    order = np.argsort(lengths, kind="stable")
    start = 0
    while start < len(order):
        end = start + 1
        while end < len(order) and (end + 1 - start) * BLOCK * lengths[order[end]] * max(width, 1) <= STEP_VALUES and (
            lengths[order[end]] <= 2 * lengths[order[start]]
        ):
            end += 1
        yield order[start:end]
        start = end


def _nearest(parts: np.ndarray, listed: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per block and row the nearest entry of the block's shortlist, the lowest of equals, and its
    squared distance. ``parts`` are blocks of ``BLOCK`` rows."""
    lengths = listed.sum(1)
    longest = int(lengths.max())
    # Entries of the shortlist in ascending order, then the last one again.
    short = np.argsort(~listed, axis=1, kind="stable")[:, :longest]
    short = np.take_along_axis(short, np.minimum(np.arange(longest), lengths[:, None] - 1), 1)
    d = ((parts[:, :, None, :] - book[short][:, None]) ** 2).sum(3)
    best = d.argmin(2)
    return np.take_along_axis(short, best, 1), np.take_along_axis(d, best[:, :, None], 2)[:, :, 0]


def _judge(blocks: Blocks, p: int, listed: np.ndarray, book: np.ndarray, which: np.ndarray) -> Iterator[tuple]:
    """Rows (in curve order), their entries and squared distances, for the blocks ``which``."""
    listed = listed[which]
    rows = blocks.sorted.shape[1]
    for step in _steps(listed, book.shape[1]):
        at = blocks.begins[which[step], None] + np.arange(BLOCK)
        inside = at < rows
        best, d = _nearest(blocks.sorted[p][np.minimum(at, rows - 1)], listed[step], book)
        yield at[inside], best[inside], d[inside]


def round_sums(blocks: Blocks, boxes: tuple[np.ndarray, ...], books: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Parts and sums per position and entry, and how many distances were computed."""
    low, high, sums = boxes
    parts, k, width = books.shape
    sizes, totals, computed = np.zeros((parts, k), "int64"), np.zeros((parts, k, width), "int64"), 0
    for p in range(parts):
        listed = shortlists(low[p], high[p], books[p])
        lengths = listed.sum(1)
        alone = lengths == 1
        entry = listed[alone].argmax(1)
        np.add.at(sizes[p], entry, blocks.sizes[alone])
        np.add.at(totals[p], entry, sums[p][alone])
        computed += int((lengths[~alone] * blocks.sizes[~alone]).sum())
        for at, best, _ in _judge(blocks, p, listed, books[p], np.flatnonzero(~alone)):
            np.add.at(sizes[p], best, 1)
            np.add.at(totals[p], best, blocks.sorted[p][at])
    return sizes, totals, computed


def encode(blocks: Blocks, boxes: tuple[np.ndarray, ...], books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of each part of each vector, and the vectors' squared distances summed up."""
    rows = blocks.values.shape[1]
    codes, errors = np.zeros((rows, len(books)), "uint8"), np.zeros(rows, "int64")
    for p, book in enumerate(books):
        listed = shortlists(boxes[0][p], boxes[1][p], book)
        for at, best, d in _judge(blocks, p, listed, book, np.arange(len(blocks.begins))):
            row = blocks.order[p][at]
            codes[row, p] = best
            errors[row] += d
    return codes, errors


# -- passes ----------------------------------------------------------------------------


def _finite(v: Column) -> Column:
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & ~odd


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    x = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype("float64"))
    if len(x) and np.abs(x).max() >= MOST_VALUE:
        raise ValueError(f"a component times {SCALE} is {MOST_VALUE} or more")
    return x.astype("int64").reshape(-1, dims)


def _sliced(dims: int) -> Callable:
    """One row per slice of vectors: ids, labels, integers, and what the blocks hold."""
    most = max(BLOCK, SLICE_VALUES // max(dims, 1) // BLOCK * BLOCK)

    def row(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = _integers(batch.column("v"), dims)
        blocks = Blocks(values)
        binary = [values.astype("<i4"), blocks.order.astype("<i4"), *[b.astype("<i8") for b in blocks.boxes()]]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(batch)], pa.int32()), batch.column(c)) for c in ("vec_id", "label")]
        names = ["vec_ids", "labels", "values", "places", "low", "high", "sums"]
        return pa.RecordBatch.from_arrays([*lists, *[pa.array([x.tobytes()], pa.binary()) for x in binary]], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        have = 0
        for batch in batches:
            start = 0
            while start < len(batch):
                taken = batch.slice(start, most - have)
                held.append(taken)
                start, have = start + len(taken), have + len(taken)
                if have == most:
                    yield row(pa.concat_batches(held))
                    held, have = [], 0
        if held:
            yield row(pa.concat_batches(held))

    return run


def _blocks_of(batch: pa.RecordBatch, i: int, dims: int) -> tuple[Blocks, tuple[np.ndarray, ...]]:
    values, places = (np.frombuffer(batch.column(c)[i].as_buffer(), "<i4") for c in ("values", "places"))
    values = values.reshape(-1, dims)
    blocks = Blocks(values, order=places.reshape(PARTS, len(values)).astype("int64"))
    shape = (PARTS, len(blocks.begins), dims // PARTS)
    boxes = tuple(np.frombuffer(batch.column(c)[i].as_buffer(), "<i8").reshape(shape) for c in ("low", "high", "sums"))
    return blocks, boxes


def _sums(books: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, width = books.shape
        sizes, totals = np.zeros((parts, k), "int64"), np.zeros((parts, k, width), "int64")
        for batch in batches:
            for i in range(len(batch)):
                more, added, _ = round_sums(*_blocks_of(batch, i, parts * width), books)
                sizes, totals = sizes + more, totals + added
        part, entry = np.nonzero(sizes)
        if len(part):
            offsets = pa.array(np.arange(0, len(part) * width + 1, max(width, 1))[: len(part) + 1].astype("int32"))
            lists = pa.ListArray.from_arrays(offsets, pa.array(totals[part, entry].ravel()))
            columns = [pa.array(part.astype("int32")), pa.array(entry.astype("int32")), pa.array(sizes[part, entry]), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "size", "totals"])

    return run


def _codes(books: np.ndarray) -> Callable:
    dims = books.shape[0] * books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                codes, errors = encode(*_blocks_of(batch, i, dims), books)
                text, width = codes.tobytes().hex(), 2 * codes.shape[1]
                code = pa.array([text[k : k + width] for k in range(0, len(text), width)])
                columns = [batch.column(c)[i].values for c in ("vec_ids", "labels")]
                yield pa.RecordBatch.from_arrays([*columns, code, pa.array(errors)], names=["vec_id", "label", "code", "error"])

    return run


def _new_books(slices: DataFrame, books: np.ndarray) -> np.ndarray:
    """The floor of the mean of each entry's parts; unused entries stay."""
    parts = slices.drop("vec_ids", "labels").mapInArrow(_sums(books), "part int, entry int, size long, totals array<long>")
    # As many rows as the codebooks have values.
    found = (
        parts.select("part", "entry", "size", F.posexplode("totals").alias("at", "total"))
        .groupBy("part", "entry", "at")
        .agg(F.sum("size").alias("size"), F.sum("total").alias("total"))
        .toArrow()
    )
    part, entry, at, size, total = (found[c].to_numpy() for c in ("part", "entry", "at", "size", "total"))
    books = books.copy()
    books[part, entry, at] = np.floor_divide(total, size)
    return books


def codebooks_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.ravel().tolist()))


def compress(vectors: DataFrame) -> tuple[DataFrame, np.ndarray | None]:
    """``vec_id, label, code, error`` for each kept row of ``vectors``, stored, and the codebooks.

    ``vectors`` has ``vec_id, label, embedding``; other columns are ignored. Rows whose vector is
    null or holds null or non-finite components are dropped. All others must have one length,
    which ``PARTS`` divides, and components below ``MOST_VALUE / SCALE``; else this fails. The
    codebooks start from the rows with the smallest ids, rows without an id last and equal ids
    in the order of their vectors; with fewer than ``ENTRIES`` rows they have as many entries.
    Rows that repeat an id stay apart. ``code`` has two hex digits per part, ``error`` is the sum
    of squared distances to the entries. An empty table gives no rows and no codebooks.
    """
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("v")).where(_finite(F.col("v")))
    kind = vectors.schema["label"].dataType.simpleString()
    of_size = F.size("v")
    length = kept.agg(F.min(of_size).alias("least"), F.max(of_size).alias("most")).first()
    if length.least is None:
        return vectors.sparkSession.createDataFrame([], f"vec_id long, label {kind}, code string, error long"), None
    dims = length.most
    if length.least != dims or dims % PARTS or not 0 < dims <= MOST_LENGTH:
        raise ValueError(f"vectors of {length.least} to {dims} components; one length is needed that {PARTS} divides")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").toArrow()
    seeds = _integers(first["v"].combine_chunks(), dims)
    books = np.ascontiguousarray(seeds.reshape(len(seeds), PARTS, dims // PARTS).transpose(1, 0, 2))
    columns = "values binary, places binary, low binary, high binary, sums binary"
    slices = stage(kept.mapInArrow(_sliced(dims), f"vec_ids array<long>, labels array<{kind}>, {columns}"), "vector_blocks")
    for _ in range(ROUNDS):
        books = _new_books(slices, books)
    coded = stage(slices.mapInArrow(_codes(books), f"vec_id long, label {kind}, code string, error long"), "vector_codes")
    drop_stage(slices)
    return coded, books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the errors summed over equal labels, those without one together."""
    key = F.when(F.col("label").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    rows = coded.withColumn("label_key", key)
    sums = stage(rows.groupBy("label_key").agg(F.sum("error").alias("label_error")), "label_errors")
    return join_lookup(rows, sums, "label_key").drop("label_key")


def op12_vector_codes(spark, sf_dir):
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest() if books is not None else ""
    columns = ["vec_id", "code", "error", "label_error"]
    return with_label_errors(coded).select(*columns, F.lit(digest).alias("codebooks_sha256"))


def _oracle() -> str:
    """The rounds one after the other; a distance and its entry are one number, so the least is the lowest."""
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""near{k} AS (
  SELECT r, p, min(d * {ENTRIES} + e) % {ENTRIES} AS e, min(d * {ENTRIES} + e) // {ENTRIES} AS d
  FROM (SELECT x.r, x.p, c.e, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d
        FROM parts x JOIN book{k} c ON x.p = c.p AND x.i = c.i GROUP BY x.r, x.p, c.e) GROUP BY r, p
)""")
        if k < ROUNDS:
            steps.append(f"""book{k + 1} AS (
  SELECT c.p, c.e, c.i, coalesce(m.v, c.v) AS v FROM book{k} c LEFT JOIN (
    SELECT x.p, n.e, x.i, floor(sum(x.v)::DOUBLE / count(*))::BIGINT AS v
    FROM parts x JOIN near{k} n ON x.r = n.r AND x.p = n.p GROUP BY x.p, n.e, x.i) m
  ON c.p = m.p AND c.e = m.e AND c.i = m.i
)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS r, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, i // (n // {PARTS}) AS p, i % (n // {PARTS}) AS i, floor({SCALE} * x::DOUBLE)::BIGINT AS v
  FROM (SELECT r, len(v) AS n, unnest(v) AS x, unnest(range(len(v))) AS i FROM kept)
), book0 AS (
  SELECT p, r AS e, i, v FROM parts WHERE r < {ENTRIES}
), {", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)}, coded AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', n.e::INTEGER), '' ORDER BY n.p) AS code, sum(n.d)::BIGINT AS error
  FROM kept k JOIN near{ROUNDS} n ON k.r = n.r GROUP BY k.r, k.vec_id, k.label
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, i)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded
"""


QUERIES = {"op12_vector_codes": op12_vector_codes}
ORACLES = {"op12_vector_codes": _oracle()}
