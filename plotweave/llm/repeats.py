"""Removal of long repeated byte strings by bucket refinement, without a suffix array of all bytes.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts elsewhere. Sorting all
suffixes would move every position of the corpus; here the buckets are refined instead.

* Every string of that length has an anchor: the place of the least hash among its q-grams.
  Equal strings have it at the same distance. Strings that follow one another mostly share
  their anchor, so a text is a list of runs of string starts, one anchor each, about one for
  every 85 bytes.
* The initial buckets are those of the anchors' q-grams. Runs alone in their bucket are done:
  none of their strings is anywhere else.
* In the other buckets, runs whose whole text is equal point to one bucket identifier: all
  their strings are repeats, and one of them stands for all from then on.
* What is left is split: first into blocks of ``BLOCK`` string starts, whose buckets are the
  bytes common to all strings of the block, then into single strings. The outcome of each
  level is used as it is by the next, which only sees what is still open.

Buckets are aggregates and joins on hashes, so none of them has to fit a task. A bucket's
identifier is a 64-bit hash of its bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plotweave.llm.common import ROW, bucketed, documents, own_texts, slices
from plotweave.session import drop_stage, stage

LENGTH = 200
GRAM = 32
BLOCK = 13
_STEP, _ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_RUNS = f"{ROW} long, anchor int, first int, last int, core long, whole long"


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on."""
    v = data.astype("uint64")
    for width in (1, 2, 4):
        v = v[:-width] | (v[width:] << np.uint64(8 * width))
    n = len(data) - GRAM + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, "uint64")
        for k in range(0, GRAM, 8):
            h = (h ^ v[k : k + n]) * _STEP
            h ^= h >> np.uint64(29)
        h *= _ONE
        return h ^ (h >> np.uint64(32))


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` keys side by side, by doubling."""
    least, have = keys, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def runs_of(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of string starts with one anchor: owner, anchor, first and last start, as places in
    ``data``, which holds texts one after the other that end at ``ends[1:]``."""
    none = (np.zeros(0, "int64"),) * 4
    width = length - GRAM + 1
    if len(data) < length:
        return none
    h = _gram_hashes(data)
    n = len(h)
    bits = max(n.bit_length(), 1)
    # The leftmost of equal hashes: the place is the lower part of the key.
    keys = (h >> np.uint64(bits) << np.uint64(bits)) | np.arange(n, dtype="uint64")
    anchors = (_sliding_least(keys, width) & np.uint64((1 << bits) - 1)).astype("int64")
    owner = np.repeat(np.arange(len(ends) - 1), np.maximum(np.diff(ends) - length + 1, 0))
    counts = np.maximum(np.diff(ends) - length + 1, 0)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + ends[:-1][owner]
    if not len(starts):
        return none
    at = anchors[starts]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    return owner[first], at[first], starts[first], starts[last]


def _hash(view: memoryview, begins: list[int], ends: list[int], seeds: list[int]) -> pa.Array:
    of = xxhash.xxh3_64_intdigest
    found = [of(view[a:b], s) for a, b, s in zip(begins, ends, seeds)]
    return pa.array(np.array(found, "uint64").view("int64"))


def _rows(view: memoryview, rows: list[int], base: np.ndarray, anchor, first, last, core) -> pa.RecordBatch:
    """Runs with the hashes of their core (begin, end, seed) and of their whole text."""
    whole_seed = ((anchor - first) * 4099 + (anchor - last) + 1).tolist()
    begin, end, seed = core
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows, pa.int64()),
            *[pa.array((x - base).astype("int32")) for x in (anchor, first, last)],
            _hash(view, begin.tolist(), end.tolist(), seed.tolist()),
            _hash(view, first.tolist(), (last + LENGTH).tolist(), whole_seed),
        ],
        names=[ROW, "anchor", "first", "last", "core", "whole"],
    )


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after the other, and where each one ends."""
    texts = own_texts(texts)
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", "uint8")[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _all_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 2_000_000):
            data, ends = _bytes_of(part.column("text"))
            owner, anchor, first, last = runs_of(data, ends)
            numbers = part.column(ROW).to_numpy()
            core = (anchor, anchor + GRAM, np.zeros(len(anchor), "int64"))
            yield _rows(memoryview(data), numbers[owner].tolist(), ends[:-1][owner], anchor, first, last, core)


def _finer(block: int) -> Callable:
    """Splits runs into blocks of ``block`` string starts, counted from the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2_000_000):
                data, ends = _bytes_of(part.column("text"))
                runs = part.column("runs")
                owner = np.repeat(np.arange(len(runs)), runs.value_lengths().to_numpy(zero_copy_only=False))
                flat = runs.flatten()
                base = ends[:-1][owner]
                anchor, first, last = (np.asarray(flat.field(f)).astype("int64") + base for f in ("anchor", "first", "last"))
                # Distances to the anchor, from the last start to the first, and their blocks.
                low, high = (anchor - last) // block, (anchor - first) // block
                count = high - low + 1
                of = np.repeat(np.arange(len(owner)), count)
                k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + low[of]
                a, base = anchor[of], base[of]
                starts = np.maximum(first[of], a - (k + 1) * block + 1), np.minimum(last[of], a - k * block)
                core = a - k * block, a - (k + 1) * block + 1 + LENGTH, k + 1
                numbers = part.column(ROW).to_numpy()[owner[of]].tolist()
                yield _rows(memoryview(data), numbers, base, a, *starts, core)

    return run


def _resolve(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of runs that have a twin, and the runs that are still open.

    A run is open if it has no twin but shares its bucket; of twins in such a bucket the first
    one stays in play.
    """
    twins = runs.groupBy("core", "whole").agg(F.count("*").alias("twins"))
    of_core = twins.groupBy("core").agg(
        F.sum("twins").alias("members"), F.count("*").alias("kinds"), F.count_if(F.col("twins") == 1).alias("alone")
    ).where("members > 1")
    state = twins.join(of_core, "core").select(
        "core", "whole", "twins", ((F.col("kinds") > 1) & (F.col("alone") > 0)).alias("open")
    ).where("open or twins > 1")
    known = stage(runs.join(state, ["core", "whole"]), "refined")
    repeated = known.where("twins > 1").select(ROW, F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end"))
    fields = F.struct(ROW, "anchor", "first", "last")
    first_twin = known.where("open and twins > 1").groupBy("core", "whole").agg(F.min(fields).alias("r")).select("r.*")
    alone = known.where("open and twins = 1").select(ROW, "anchor", "first", "last")
    return repeated, alone.unionByName(first_twin)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``row_no, doc_id, text, spans`` for each row of ``docs``: the bytes to remove.

    ``docs`` has ``doc_id, text``; other columns are ignored. ``spans`` are the merged runs
    (start, end in UTF-8 bytes) of bytes covered by a string of ``LENGTH`` bytes that also
    starts at another place, in the same text or another row's. Null and empty texts, and
    texts shorter than that, have none. Rows that repeat a longer text are repeats of each
    other, whatever their ids. An empty table gives no rows.

    Texts are shuffled once, into buckets that the later levels join to where they lie.
    """
    rows = docs.select(F.monotonically_increasing_id().alias(ROW), F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = bucketed(rows, ROW, "texts")
    texts = table.select(ROW, "text")
    runs = stage(texts.mapInArrow(_all_runs, _RUNS), "runs")
    # Most runs are alone in their bucket: only counts are needed to leave them out.
    # They are stored first, so that the join can split a bucket that many runs are in.
    several = stage(runs.groupBy("core").agg(F.count("*").alias("members")).where("members > 1"), "buckets")
    shared = stage(runs.join(several.select("core"), "core", "left_semi").select(runs.columns), "shared_runs")
    drop_stage(runs)
    spans, left = _resolve(shared)
    for block in (BLOCK, 1):
        of_text = left.groupBy(ROW).agg(F.collect_list(F.struct("anchor", "first", "last")).alias("runs"))
        finer = texts.join(of_text.hint("shuffle_hash"), ROW).select(ROW, "text", "runs").mapInArrow(_finer(block), _RUNS)
        more, left = _resolve(stage(finer, "finer_runs"))
        spans = spans.unionByName(more)
    of_text = spans.groupBy(ROW).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("all"))
    first = F.col("all")[0]
    # Merge: a span that begins within the last one extends it.
    def step(s, x):
        joins = x["start"] <= s["now"]["end"]
        wider = F.struct(s["now"]["start"].alias("start"), F.greatest(s["now"]["end"], x["end"]).alias("end"))
        return F.struct(
            F.when(joins, s["done"]).otherwise(F.concat(s["done"], F.array(s["now"]))).alias("done"),
            F.when(joins, wider).otherwise(x).alias("now"),
        )

    begin = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("done"), first.alias("now"))
    merged = F.aggregate("all", begin, step, lambda s: F.concat(s["done"], F.array(s["now"])))
    found = of_text.select(ROW, merged.alias("spans"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return table.join(found.hint("shuffle_hash"), ROW, "left").select(ROW, "doc_id", "text", F.coalesce("spans", none).alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the bytes of each text that are left, as binary.

    A cut may fall within a character, so what is left need not be UTF-8.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, ends = _bytes_of(part.column("text"))
                view, kept = memoryview(data), []
                for a, b, spans in zip(ends.tolist(), ends[1:].tolist(), part.column("spans").to_pylist()):
                    edges = [0, *[e for s in spans for e in (s["start"], s["end"])], b - a]
                    kept.append(b"".join([view[a + x : a + y] for x, y in zip(edges[::2], edges[1::2])]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(ends)), part.column("spans"), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "spans", "kept"],
                )

    schema = "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"
    return repeated_spans(docs).select("doc_id", "text", "spans").mapInArrow(cut, schema)


def op10_repeats(spark, sf_dir):
    cut = remove_repeats(documents(spark, sf_dir))
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {"op10_repeats": op10_repeats}
ORACLES: dict[str, str] = {}
