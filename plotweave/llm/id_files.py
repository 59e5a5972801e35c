"""Token-id shards with a minimal perfect hash index from document keys to places.

Format. ``shards`` is a table with one row per shard: ``shard``, ``part``, ``n_ids`` and
``payload``, the bare ids of its documents one after the other, little-endian, two bytes each
(four where the vocabulary needs it), beside them the documents' keys and offsets. Shards are
numbered in ascending document order. ``index`` has one row per hash bucket of keys: ``seed``,
``pilots`` and, by slot, ``fingerprints`` and the places ``shards, offsets, lengths, starts,
parts``. A key's slot is computed from its hash, which the bucket's seed makes distinct, and one
pilot, so a lookup needs one bucket row, whatever the number of documents. A key that was never
stored is told apart by its fingerprint, and for certain by the key beside the payload. Both
tables lie in files by bucket and by shard; the lookup of a few keys reads only theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from plotweave.llm.common import bucketed, documents, slices
from plotweave.llm.token_ids import default_path, encoder as encoder_of
from plotweave.session import stage

END = 2
SHARD_IDS = 1 << 19
SHARDS_PER_TASK = 1 << 24
BUCKET_KEYS = 2000
KEYS_PER_PILOT = 3
PILOTS_AT_ONCE = 64
# Up to so many index buckets, or shards, a lookup names them to the scan.
FEW = 1000

_ONE, _TWO = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of 64-bit keys, one-to-one for each seed."""
    return mixed_by(keys, np.array(seed))


def mixed_by(keys: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + (seeds.astype("uint64") + np.uint64(1)) * _STEP
        x = (x ^ (x >> np.uint64(30))) * _ONE
        x = (x ^ (x >> np.uint64(27))) * _TWO
        return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 2_000_003) >> np.uint64(32)).astype("<u4")


def key_hashes(doc_ids: pa.Array, repeats: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key. Which keys share one changes with the seed."""
    ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("int64").view("uint64")
    rest = repeats.astype("uint64") * np.uint64(2) + doc_ids.is_null().to_numpy(zero_copy_only=False).astype("uint64")
    return mixed(mixed(ids, 2 * seed) ^ mixed(rest, 2 * seed + 1), seed)


def distinct_hashes(doc_ids: pa.Array, repeats: np.ndarray) -> tuple[int, np.ndarray]:
    """The first seed by which no two of the keys, which are distinct, share a hash."""
    seed = 0
    while True:
        hashes = key_hashes(doc_ids, repeats, seed)
        if len(np.unique(hashes)) == len(hashes):
            return seed, hashes
        seed += 1


def build_pilots(keys: np.ndarray) -> np.ndarray:
    """Pilots that send ``keys``, which are distinct, to the slots 0..n-1 without a clash.

    Keys fall into groups of about four. From the largest group on, pilots are tried until
    all its keys land on free slots. A group of one key gets a free slot outright: its pilot
    is ``-1 - slot``.
    """
    n = len(keys)
    groups = max(1, -(-n // KEYS_PER_PILOT))
    group_of = (mixed(keys, 0) % np.uint64(groups)).astype("int64")
    order = np.argsort(group_of, kind="stable")
    sizes = np.bincount(group_of, minlength=groups)
    ends = np.cumsum(sizes)
    pilots, used = np.zeros(groups, "<i4"), np.zeros(n, bool)
    singles = []
    for g in np.argsort(-sizes, kind="stable"):
        if sizes[g] == 0:
            break
        members = keys[order[ends[g] - sizes[g] : ends[g]]]
        if sizes[g] == 1:
            singles.append(g)
            continue
        pilot = 1
        while True:
            # A run of pilots at a time: one row of slots for each.
            tried = np.arange(pilot, pilot + PILOTS_AT_ONCE)
            slots = (mixed_by(members[None, :], tried[:, None]) % np.uint64(n)).astype("int64")
            ordered = np.sort(slots, axis=1)
            good = ~used[slots].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                break
            pilot += PILOTS_AT_ONCE
        first = int(good.argmax())
        used[slots[first]], pilots[g] = True, tried[first]
    for g, slot in zip(singles, np.flatnonzero(~used)):
        pilots[g] = -1 - slot
    return pilots


def slots_of(keys: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    """The slot of each key; any slot for keys that were not stored."""
    group_of = (mixed(keys, 0) % np.uint64(len(pilots))).astype("int64")
    pilot = pilots[group_of].astype("int64")
    slots = np.where(pilot < 0, -1 - pilot, 0)
    at = pilot >= 0
    slots[at] = (mixed_by(keys[at], pilot[at]) % np.uint64(n)).astype("int64")
    return slots


@dataclass(frozen=True)
class IdFiles:
    """``shards`` and ``index`` are stored tables; ``part_starts`` (part, part_start) has a row
    per written partition."""

    shards: DataFrame
    index: DataFrame
    part_starts: DataFrame
    n_buckets: int


_SHARD = "part int, shard long, n_ids long, payload binary, doc_ids array<long>, repeats array<long>, starts array<long>, offsets array<long>, lengths array<long>"


def write_ids(
    docs: DataFrame, tokenizer: str | None = None, end: int = END, shard_ids: int = SHARD_IDS
) -> IdFiles:
    """Encode ``doc_id, text`` and store the ids in ascending document order.

    Each document's ids are followed by ``end``; a null text is an empty one. Rows that repeat
    an id are stored side by side in the order of their texts, as repeats 0, 1, …; rows
    without id come first and have the key null. Other columns are ignored. An empty table
    gives empty tables.

    One shuffle, of the texts, by ranges of ids. A task holds one shard of ``shard_ids`` ids
    (a single longer document makes a longer shard).
    """
    path = tokenizer or default_path()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(path), TaskContext.get().partitionId()
        width = "<u2" if encoder.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        tail = int(end).to_bytes(4, "little")
        shard, total, last, repeat = part * SHARDS_PER_TASK, 0, object(), 0
        rows, held = [], 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(r[4] for r in rows), "<u4").astype(width)
            lengths = [len(r[4]) // 4 for r in rows]
            starts = [r[2] for r in rows]
            columns = {
                "part": [part], "shard": [shard], "n_ids": [len(ids)], "payload": [ids.tobytes()],
                "doc_ids": [[r[0] for r in rows]], "repeats": [[r[1] for r in rows]],
                "starts": [starts], "offsets": [[s - starts[0] for s in starts]], "lengths": [lengths],
            }
            types = [pa.int32(), pa.int64(), pa.int64(), pa.binary()] + [pa.list_(pa.int64())] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns.values(), types)], names=list(columns)
            )

        for batch in batches:
            for piece in slices(batch, "text"):
                encoded = encoder.encode(piece.column("text"))
                for doc_id, ids in zip(piece.column("doc_id").to_pylist(), encoded):
                    repeat = repeat + 1 if doc_id == last else 0
                    last = doc_id
                    ids += tail
                    rows.append((doc_id, repeat, total, 0, ids))
                    total += len(ids) // 4
                    held += len(ids) // 4
                    if held >= shard_ids:
                        yield flush()
                        rows, held, shard = [], 0, shard + 1
        if rows:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    stored = bucketed_by_shard(ordered.mapInArrow(shards, _SHARD))
    places = stored.select(
        "part", "shard", F.explode(F.arrays_zip("doc_ids", "repeats", "starts", "offsets", "lengths")).alias("x")
    ).select(
        F.col("x.doc_ids").alias("doc_id"), F.col("x.repeats").alias("repeat"), "part", "shard",
        F.col("x.starts").alias("start"), F.col("x.offsets").alias("offset"), F.col("x.lengths").alias("length"),
    )
    totals = stored.groupBy("part").agg(
        F.sum("n_ids").alias("n"), F.sum(F.size("doc_ids")).alias("keys")
    ).collect()
    part_starts, before = [], 0
    for row in sorted(totals, key=lambda r: r.part):
        part_starts.append((row.part, before))
        before += row.n
    n_buckets = max(1, -(-sum(r["keys"] for r in totals) // BUCKET_KEYS))
    spark = docs.sparkSession
    return IdFiles(
        stored.select("shard", "part", "n_ids", "payload", "doc_ids", "repeats", "offsets"),
        bucketed(_index(places, n_buckets), "bucket", "id_index"),
        # One row per partition written.
        spark.createDataFrame(part_starts, "part int, part_start long"),
        n_buckets,
    )


def bucketed_by_shard(shards: DataFrame) -> DataFrame:
    """Stored so that a shard is found, and joined to, without moving payloads.

    The shards stay with the task that made them; its files are split by bucket.
    """
    return bucketed(shards, "shard", "id_shards", move=False)


def _bucket(n_buckets: int):
    return F.pmod(F.xxhash64("doc_id", "repeat", F.lit(17)), F.lit(n_buckets)).alias("bucket")


_INDEX = "bucket long, n int, seed long, pilots binary, fingerprints binary, shards binary, parts binary, offsets binary, lengths binary, starts binary"


def _index(places: DataFrame, n_buckets: int) -> DataFrame:
    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        seed, keys = distinct_hashes(group.column("doc_id").combine_chunks(), group.column("repeat").to_numpy())
        n, pilots = len(keys), build_pilots(keys)
        by_slot = np.argsort(slots_of(keys, pilots, n))
        column = lambda c: group.column(c).to_numpy()[by_slot].astype("<i8").tobytes()
        return pa.table(
            {
                "bucket": pa.array([group.column("bucket")[0].as_py()], pa.int64()),
                "n": pa.array([n], pa.int32()),
                "seed": pa.array([seed], pa.int64()),
                "pilots": [pilots.tobytes()],
                "fingerprints": [fingerprints(keys)[by_slot].tobytes()],
                "shards": [column("shard")], "parts": [column("part")], "offsets": [column("offset")],
                "lengths": [column("length")], "starts": [column("start")],
            }
        )

    return places.select(_bucket(n_buckets), "*").groupBy("bucket").applyInArrow(build, _INDEX)


def find(files: IdFiles, keys: DataFrame) -> DataFrame:
    """``doc_id, repeat, part, shard, offset, length, start`` of the keys that are stored.

    ``keys`` has distinct ``doc_id, repeat``. One bucket of the index serves all its keys;
    ``start`` counts the ids before the document. A key that is not stored passes the fingerprint
    once in 2**32 times; ``read_ids`` compares the keys themselves.
    """

    def look_up(wanted: pa.Table, bucket: pa.Table) -> pa.Table:
        if not bucket.num_rows or not wanted.num_rows:
            return wanted.slice(0, 0).select(["doc_id", "repeat"]).append_column(
                "part", pa.array([], pa.int32())
            ).append_column("shard", pa.array([], pa.int64())).append_column(
                "offset", pa.array([], pa.int64())
            ).append_column("length", pa.array([], pa.int64())).append_column("start", pa.array([], pa.int64()))
        row = {c: bucket.column(c)[0].as_py() for c in bucket.column_names}
        keys = key_hashes(wanted.column("doc_id").combine_chunks(), wanted.column("repeat").to_numpy(), row["seed"])
        slots = slots_of(keys, np.frombuffer(row["pilots"], "<i4"), row["n"])
        stored = np.frombuffer(row["fingerprints"], "<u4")[slots] == fingerprints(keys)
        values = {c: np.frombuffer(row[c], "<i8")[slots][stored] for c in ("parts", "shards", "offsets", "lengths", "starts")}
        hit = wanted.filter(pa.array(stored)).select(["doc_id", "repeat"])
        return pa.table(
            {
                "doc_id": hit.column("doc_id"), "repeat": hit.column("repeat"),
                "part": pa.array(values["parts"].astype("int32")), "shard": values["shards"],
                "offset": values["offsets"], "length": values["lengths"], "start": values["starts"],
            }
        )

    hashed = keys.select(_bucket(files.n_buckets), "doc_id", "repeat")
    index = _only(files.index, "bucket", hashed)
    schema = "doc_id long, repeat long, part int, shard long, offset long, length long, start long"
    found = hashed.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(look_up, schema)
    return found.join(F.broadcast(files.part_starts), "part").withColumn(
        "start", F.col("start") + F.col("part_start")
    ).drop("part_start")


def _only(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``table`` with the values of ``key`` that are wanted named to its scan, if they are few."""
    few = [r[0] for r in wanted.select(key).distinct().limit(FEW + 1).collect()]
    return table if len(few) > FEW else table.where(F.col(key).isin(few))


def read_ids(files: IdFiles, keys: DataFrame) -> DataFrame:
    """``doc_id, repeat, start, n_tokens, ids`` (unsigned 32-bit) of the keys that are stored.

    The places found in the index go to their shards; payloads are read where they lie.
    """

    def cut(places: pa.Table, shard: pa.Table) -> pa.Table:
        out = []
        if places.num_rows and not shard.num_rows:
            places = places.slice(0, 0)
        elif places.num_rows:
            offsets, doc_ids, repeats = (shard.column(c)[0].values for c in ("offsets", "doc_ids", "repeats"))
            at = pa.array(np.searchsorted(offsets.to_numpy(), places.column("offset").to_numpy()))
            same = pc.equal(repeats.take(at), places.column("repeat"))
            mine, asked = doc_ids.take(at), places.column("doc_id")
            equal = pc.fill_null(pc.equal(mine, asked), False)
            places = places.filter(pc.and_(same, pc.or_(equal, pc.and_(pc.is_null(mine), pc.is_null(asked)))))
            payload = shard.column("payload")[0].as_py()
            width = "<u2" if len(payload) == 2 * shard.column("n_ids")[0].as_py() else "<u4"
            ids = np.frombuffer(payload, width).astype("<u4")
            spans = zip(places.column("offset").to_pylist(), places.column("length").to_pylist())
            out = [ids[o : o + n].tobytes() for o, n in spans]
        return pa.table(
            {
                "doc_id": places.column("doc_id"), "repeat": places.column("repeat"),
                "start": places.column("start"), "n_tokens": places.column("length"),
                "ids": pa.array(out, pa.binary()),
            }
        )

    schema = "doc_id long, repeat long, start long, n_tokens long, ids binary"
    places = find(files, keys)
    shards = _only(files.shards, "shard", places)
    return places.groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(cut, schema)


def keys_of(docs: DataFrame) -> DataFrame:
    """The keys under which ``write_ids`` stores the rows of ``docs``."""
    per_id = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    return per_id.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("repeat"))


def op7_id_files(spark, sf_dir):
    docs = documents(spark, sf_dir)
    read = read_ids(write_ids(docs), keys_of(docs))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op7_id_files": op7_id_files}
ORACLES: dict[str, str] = {}
