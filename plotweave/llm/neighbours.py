"""Approximate nearest neighbours by cross-polytope hashing with several probes.

A pseudo-rotation, three times random signs and a fast Hadamard transform, turns a unit
vector; the nearest signed axis is its bucket. Every table has a rotation of its own, holds
all vectors, and a query looks into the buckets of its best few axes. What it meets is ranked
by the exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from plotweave.session import stage

TABLES = 10
PROBES = 8
NEAREST = 5
SEED = 20_11
# A cell, the unit of work, holds so many vectors and so many queries of one bucket.
CELL_VECTORS = 4096
CELL_QUERIES = 1024
# What a product of unit vectors may be off per dimension, and pairs ranked exactly at a time.
ROUNDING = 1e-15
PAIRS_AT_ONCE = 1 << 14


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of the rows, whose length is a power of two."""
    n, step = x.shape[1], 1
    x = x.copy()
    while step < n:
        pairs = x.reshape(len(x), n // (2 * step), 2, step)
        low, high = pairs[:, :, 0].copy(), pairs[:, :, 1].copy()
        pairs[:, :, 0], pairs[:, :, 1] = low + high, low - high
        step *= 2
    return x / np.sqrt(n)


def rotated(vectors: np.ndarray, table: int, seed: int) -> np.ndarray:
    """The rows padded to a power of two and turned by the rotation of ``table``."""
    size = 1 << max(0, (vectors.shape[1] - 1).bit_length())
    x = np.zeros((len(vectors), size))
    x[:, : vectors.shape[1]] = vectors
    signs = np.random.default_rng([seed, table, size]).choice([-1.0, 1.0], (3, size))
    for s in signs:
        x = hadamard(x * s)
    return x


def buckets(vectors: np.ndarray, table: int, seed: int, probes: int | None) -> np.ndarray:
    """Per row the ``probes`` signed axes nearest to it (all if None), the nearest first: axis * 2 + sign."""
    x = rotated(vectors, table, seed)
    signed = np.stack([x, -x], axis=2).reshape(len(x), -1)
    return np.argsort(-signed, axis=1, kind="stable")[:, :probes]


def _scaled(v: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two, so that squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(v).max(axis=1))
    return np.ldexp(v, -exponent[:, None])


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype("float64").reshape(-1, dimensions)


def usable_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, v`` of rows with an id and a vector of finite numbers that is not all zero."""
    v = F.col(vector_column)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(
        F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", finite) & F.exists("v", lambda x: x != 0)
    )


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """``class_id, v, ids``: every distinct vector once, with its ``most`` smallest ids.

    No neighbour list needs more of them. The limit works on each task's rows before they
    are shuffled, so a vector that a third of all rows have moves a few rows per task.
    """
    order = Window.partitionBy("v").orderBy("vec_id")
    few = rows.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= most)
    classes = few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return stage(classes.select(F.monotonically_increasing_id().alias("class_id"), "v", "ids"), "vector_classes")


def _hashed(rows: DataFrame, columns: list[str], tables: int, probes: int | None, seed: int) -> DataFrame:
    """``dims, table, bucket`` and ``columns`` (among them ``v``), a row per table and probe."""
    kept = [rows.schema[c] for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                at = pa.array(np.flatnonzero(sizes == d))
                part = batch.take(at)
                x = _scaled(_matrix(part.column("v"), d))
                for t in range(tables):
                    found = buckets(x, t, seed, probes)
                    for p in range(found.shape[1]):
                        n = len(x)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([d] * n, pa.int32()), pa.array([t] * n, pa.int32()), pa.array(found[:, p], pa.int32())]
                            + [part.column(c.name) for c in kept],
                            names=["dims", "table", "bucket"] + [c.name for c in kept],
                        )

    types = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in kept)
    return rows.select(columns).mapInArrow(run, f"dims int, table int, bucket int, {types}")


def _lists(classes: DataFrame, asked: DataFrame, nearest: int, tables: int, probes: int | None, seed: int) -> DataFrame:
    """``query_class, found``: the ``nearest`` + 1 best entries that each class of ``asked`` meets
    in its ``probes`` buckets of each table; in all buckets if ``probes`` is None."""
    place = ["dims", "table", "bucket"]
    index = _hashed(classes, ["class_id", "v", "ids"], tables, 1, seed)
    probe = _hashed(asked, ["class_id", "v"], tables, probes, seed)
    # One row per bucket: tables times twice the dimensions.
    full = stage(
        index.select(*place, F.lit(1).alias("a"), F.lit(0).alias("b"))
        .unionByName(probe.select(*place, F.lit(0).alias("a"), F.lit(1).alias("b")))
        .groupBy(*place)
        .agg(F.sum("a").alias("n_vectors"), F.sum("b").alias("n_queries")),
        "buckets",
    )
    parts = full.select(
        *place,
        F.ceil(F.col("n_vectors") / CELL_VECTORS).cast("int").alias("vector_parts"),
        F.ceil(F.col("n_queries") / CELL_QUERIES).cast("int").alias("query_parts"),
    ).where((F.col("n_vectors") > 0) & (F.col("n_queries") > 0))

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        """Each row to its own part, and to every part of the other side."""
        own_part = F.pmod(F.xxhash64("class_id"), F.col(f"{own}_parts")).cast("int")
        rows = side.join(F.broadcast(parts), place).withColumn(f"{own}_part", own_part)
        return rows.withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1))).drop(
            "vector_parts", "query_parts"
        )

    cell = place + ["vector_part", "query_part"]
    left = dealt(probe, "query", "vector").select(*cell, F.col("class_id").alias("query_class"), "v")
    right = dealt(index, "vector", "query").select(*cell, "class_id", "v", "ids")

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = {"query_class": [], "class_id": [], "score": [], "ids": []}
        if asked.num_rows and held.num_rows:
            d = asked.column("dims")[0].as_py()
            asked, held = asked.combine_chunks(), held.combine_chunks()
            q, c = (_scaled(_matrix(t.column("v").chunk(0), d)) for t in (asked, held))
            first = np.array([x[0] for x in held.column("ids").to_pylist()])
            near = (q / np.linalg.norm(q, axis=1)[:, None]) @ (c / np.linalg.norm(c, axis=1)[:, None]).T
            most = min(nearest + 1, len(c))
            # The product only preselects: everything within its rounding of the last one needed.
            least = np.partition(near, len(c) - most, axis=1)[:, len(c) - most] - ROUNDING * d
            row, column = np.nonzero(near >= least[:, None])
            exact = np.empty(len(row))
            for k in range(0, len(row), PAIRS_AT_ONCE):
                x, y = q[row[k : k + PAIRS_AT_ONCE]], c[column[k : k + PAIRS_AT_ONCE]]
                exact[k : k + PAIRS_AT_ONCE] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
            order = np.lexsort((first[column], -exact, row))
            of_row = np.searchsorted(row, np.arange(len(q)))
            chosen = order[(of_row[:, None] + np.arange(most)).ravel()]
            members = column[chosen]
            out = {
                "query_class": np.repeat(asked.column("query_class").to_numpy(), most),
                "class_id": held.column("class_id").to_numpy()[members],
                "score": exact[chosen],
                "ids": held.column("ids").combine_chunks().take(pa.array(members)),
            }
        schema = pa.schema([("query_class", pa.int64()), ("class_id", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])
        return pa.table({k: pa.array(v, schema.field(k).type) if not isinstance(v, (pa.Array, pa.ChunkedArray)) else v for k, v in out.items()}, schema=schema)

    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
        meet, "query_class long, class_id long, score double, ids array<long>"
    )
    pairs = found.groupBy("query_class", "class_id").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    entries = pairs.select("query_class", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query_class").orderBy(F.desc("score"), "vec_id")
    best = entries.withColumn("n", F.row_number().over(order)).where(F.col("n") <= nearest + 1)
    return best.groupBy("query_class").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("found"))


def search(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    nearest: int = NEAREST,
    tables: int = TABLES,
    probes: int = PROBES,
    seed: int = SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``nearest`` rows found for each query row.

    ``is_query`` chooses query rows by ``vec_id``; all rows are candidates, but for the
    query's own id. ``score`` is the cosine in double precision; ties go to the smaller id.
    Rows without an id, and vectors that are null, empty, zero or hold a null or a number
    that is not finite, take no part. Vectors of different lengths are never compared. Rows
    that repeat id and vector count once. An empty table gives no rows.

    A query has ``nearest`` rows, or all other vectors of its length if they are fewer: one
    whose buckets hold too few looks into all buckets of one table, an exact search.

    Equal vectors are searched for, and found, as one. Any other query's cost is the share of the
    index in its ``tables * probes`` buckets. Work is dealt out in cells of a bucket's vectors
    by its queries, both bounded, so neither a full bucket nor a popular query is one task.
    """
    rows = usable_vectors(vectors, id_column, vector_column)
    classes = distinct_vectors(rows, nearest + 1)
    queries = rows.where(is_query).distinct().join(classes.select("class_id", "v"), "v").select("vec_id", "class_id")
    queries = stage(queries.withColumnRenamed("vec_id", "query_id"), "queries")
    asked = classes.join(queries.select("class_id").distinct(), "class_id", "left_semi")
    short = lambda rows: rows.where(F.coalesce(F.size(others), F.lit(0)) < nearest)
    others = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    lists = stage(_lists(classes, asked, nearest, tables, probes, seed), "lists")
    answered = queries.join(lists, F.col("class_id") == F.col("query_class"), "left")
    # The buckets of these held too little: one table, whose buckets hold every vector once.
    lacking = stage(short(answered).select("class_id").distinct(), "lacking")
    if not lacking.isEmpty():
        rest = classes.join(lacking, "class_id", "left_semi")
        lists = lists.join(lacking, F.col("query_class") == F.col("class_id"), "left_anti").unionByName(
            _lists(classes, rest, nearest, 1, None, seed)
        )
        answered = queries.join(lists, F.col("class_id") == F.col("query_class"))
    return answered.select("query_id", F.posexplode(F.slice(others, 1, nearest)).alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"
    )


def op9_neighbours(spark, sf_dir):
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


QUERIES = {"op9_neighbours": op9_neighbours}
ORACLES: dict[str, str] = {}
