"""Dense vectors: vectorising, nearest centroids, seeding and Lloyd's iterations.

Points are ``id, v`` with ``v`` an array of float or double; centroids are
``cluster_id, v``. Centroids that fit the budget go to the tasks as one matrix; more of them are
stored in blocks, of which driver and tasks hold one at a time. The points never move. Distances
are computed on Arrow batches with numpy, which measured about 20 times faster per point than
array lambdas for 10 centroids of 64 dimensions.

Sums over points are sums of whole numbers (``functions.exact``), so means and costs are the
same bits whatever the partitions and whichever tasks were run again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from plotweave.functions.exact import sum_of, sum_parts, unit_of, units
from plotweave.functions.vectors import distance
from plotweave.operators.batches import Counted, batch_matrix, blocks, nearest_rows, second_distances
from plotweave.plans.lookup import BROADCAST_BYTES, join_lookup
from plotweave.runs import Run
from plotweave.session import drop_stage, stage, stage_path

# When a centroid counts as unmoved, and how many the seeding picks.
TOLERANCE = 0.01
CLUSTERS = 3

# Centroids go to the tasks in blocks of about so many values.
CENTROID_VALUES = BROADCAST_BYTES // 8
# A seeding stores the points' distances after so many picks, and starts from there.
PICKS_PER_STORE = 16
# Farthest points that a seeding gets from each pass; it picks as many as that pass proves.
CANDIDATES = 64
# Bytes of past turns that the driver holds before it stores them.
HELD_BYTES = 32 * 1024 * 1024
# With pruning, points are settled anew when fewer comparisons than this share were spared.
SPARED = 0.5


# -- vectors ---------------------------------------------------------------------------


def vector_coordinates(
    scores: DataFrame, dictionary: DataFrame, score: str = "tfidf", budget: int = BROADCAST_BYTES
) -> DataFrame:
    """``product_id, term_index, <score>``: the sparse form. Terms not listed vanish.

    Pass stored tables; the dictionary is broadcast if it fits, else only its most
    frequent terms are.
    """
    joined = join_lookup(scores, dictionary.select("term", "term_index"), "term", budget=budget)
    return joined.select("product_id", "term_index", score)


def vectorize(scores: DataFrame, dictionary: DataFrame, score: str = "tfidf") -> DataFrame:
    """``id, v``: a dense vector in dictionary order per product, 0 for missing terms.

    For dictionaries small enough that a vector fits in a row; ``vector_coordinates`` has
    no such limit. A product without any listed term gets a vector of zeros. Fails if a
    product has two rows for one term.
    """
    length = int(dictionary.agg((F.max("term_index") + 1).alias("n")).first().n or 0)
    listed = join_lookup(scores, dictionary.select("term", "term_index"), "term", "left")
    entry = F.when(
        F.col("term_index").isNotNull(), F.struct("term_index", F.col(score).alias("value"))
    )
    entries = listed.groupBy(F.col("product_id").alias("id")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )

    def gap_and_value(e, i):
        previous = F.when(i == 0, F.lit(-1)).otherwise(F.get("entries", i - 1)["term_index"])
        gap = e["term_index"] - previous - 1
        checked = F.when(gap < 0, F.raise_error(F.lit("two scores for one product and term")).cast("int"))
        return F.concat(
            F.array_repeat(F.lit(0.0), F.coalesce(checked, gap).cast("int")), F.array(e["value"])
        )

    used = F.coalesce(F.get("entries", F.size("entries") - 1)["term_index"] + 1, F.lit(0))
    return entries.select(
        "id",
        F.concat(
            F.flatten(F.transform("entries", gap_and_value)),
            F.array_repeat(F.lit(0.0), (F.lit(length) - used).cast("int")),
        ).alias("v"),
    )


# -- centroid tables -------------------------------------------------------------------


@dataclass(frozen=True)
class _Centroids:
    ids: np.ndarray
    matrix: np.ndarray


def _centroid_bytes(centroids: DataFrame) -> int:
    return centroids.agg(F.sum(F.size("v").cast("long") * 8).alias("n")).first().n or 0


def _collect_centroids(centroids: DataFrame) -> _Centroids:
    """The centroids in cluster order; the caller has measured them."""
    rows = centroids.select("cluster_id", F.col("v").cast("array<double>").alias("v")).orderBy("cluster_id").toArrow()
    if not rows.num_rows:
        raise ValueError("no centroids")
    v = rows["v"].combine_chunks()
    matrix = v.flatten().to_numpy().reshape(rows.num_rows, -1)
    return _Centroids(rows["cluster_id"].to_numpy(), matrix)


def _vectors(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1] or 1, dtype="int32")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def _local_table(spark: SparkSession, columns: dict, types: dict) -> DataFrame:
    schema = pa.schema(list(types.items()))
    return spark.createDataFrame(pa.table(columns, schema=schema))


def _centroid_table(spark: SparkSession, ids, matrix) -> DataFrame:
    return _local_table(
        spark,
        {"cluster_id": pa.array(ids, pa.int32()), "v": _vectors(matrix)},
        {"cluster_id": pa.int32(), "v": pa.list_(pa.float64())},
    )


# -- operators -------------------------------------------------------------------------


def assign(
    points: DataFrame, centroids: DataFrame, with_vectors: bool = False, budget: int = BROADCAST_BYTES
) -> DataFrame:
    """``id, cluster_id, distance``: the nearest centroid, the lowest id among equals.

    ``with_vectors`` passes ``v`` on, so that ``update_centroids`` needs no second look at the
    points. A point without a vector has no cluster. Centroids beyond ``budget`` bytes are met
    block by block, in a pass over the points for each.
    """
    names = ["id", "cluster_id", "distance"] + (["v"] if with_vectors else [])
    if _centroid_bytes(centroids) > budget:
        return _assign_in_blocks(points, centroids, budget).select(names)
    known = _collect_centroids(centroids)
    step = max(1, CENTROID_VALUES // max(known.matrix.shape[1], 1))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            valid = v.is_valid().to_numpy(zero_copy_only=False)
            best, d = nearest_rows(batch_matrix(v, known.matrix.shape[1]), known.matrix, step)
            cluster, distance = np.zeros(len(v), "int32"), np.zeros(len(v))
            cluster[valid], distance[valid] = known.ids[best], d
            columns = [batch.column("id"), pa.array(cluster, mask=~valid), pa.array(distance, mask=~valid)]
            yield pa.RecordBatch.from_arrays(columns + ([v] if with_vectors else []), names=names)

    kind = {c: points.schema[c].dataType.simpleString() for c in ("id", "v")}
    schema = f"id {kind['id']}, cluster_id int, distance double" + (f", v {kind['v']}" if with_vectors else "")
    return points.select("id", "v").mapInArrow(nearest, schema)


def centroid_blocks(centroids: DataFrame, budget: int = BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """``cluster_id, v, block``, stored by block, and the number of blocks, none above ``budget`` bytes.

    Fails if a single centroid is larger.
    """
    rows = centroids.select(F.col("cluster_id").cast("int").alias("cluster_id"), F.col("v").cast("array<double>").alias("v"))
    n = max(1, -(-2 * _centroid_bytes(rows) // budget))
    while True:
        block = F.pmod(F.xxhash64("cluster_id"), F.lit(n)).cast("int")
        largest = rows.groupBy(block.alias("block")).agg(F.sum(F.size("v").cast("long") * 8).alias("n"), F.count("*").alias("rows"))
        found = largest.agg(F.max("n").alias("n"), F.min_by("rows", -F.col("n")).alias("rows")).first()
        if found.n is None or found.n <= budget:
            break
        if found.rows == 1:
            raise ValueError("a single centroid is larger than the budget")
        n *= 2
    path = stage_path(rows.sparkSession, "centroid_blocks")
    rows.withColumn("block", block).write.partitionBy("block").parquet(path)
    stored = rows.sparkSession.read.parquet(path)
    stored.stored_at = path
    return stored, n


def _assign_in_blocks(points: DataFrame, centroids: DataFrame, budget: int) -> DataFrame:
    """``id, v, cluster_id, distance``, stored. Every block is a pass that keeps the nearest so far."""
    stored, n = centroid_blocks(centroids, budget)
    best = points.select("id", "v", F.lit(None).cast("int").alias("cluster_id"), F.lit(None).cast("double").alias("distance"))
    before: DataFrame | None = None
    for b in range(n):
        of_block = stored.where(F.col("block") == b)
        if of_block.isEmpty():
            continue
        nearer = stage(best.mapInArrow(_nearer(_collect_centroids(of_block)), best.schema), "nearest")
        drop_stage(before)
        best = before = nearer
    drop_stage(stored)
    if before is None:
        raise ValueError("no centroids")
    return best


def _nearer(known: _Centroids):
    """The nearest of ``known`` and of the one found before, the lowest id among equals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid = batch.column("v").is_valid().to_numpy(zero_copy_only=False)
            place, found = nearest_rows(batch_matrix(batch.column("v"), known.matrix.shape[1]), known.matrix)
            cluster, d = np.zeros(len(valid), "int32"), np.full(len(valid), np.inf)
            cluster[valid], d[valid] = known.ids[place], found
            old = batch.column("cluster_id").fill_null(0).to_numpy(zero_copy_only=False)
            least = batch.column("distance").fill_null(np.inf).to_numpy(zero_copy_only=False)
            better = (d < least) | ((d == least) & (cluster < old))
            columns = [np.where(better, cluster, old).astype("int32"), np.where(better, d, least)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), *[pa.array(c, mask=~valid) for c in columns]], names=batch.schema.names
            )

    return run


def centroid_distances(points: DataFrame, centroids: DataFrame, budget: int = BROADCAST_BYTES) -> DataFrame:
    """``id, cluster_id, distance`` for every point and each centroid; block by block beyond ``budget``."""
    if _centroid_bytes(centroids) > budget:
        stored, _ = centroid_blocks(centroids, budget)
        blocks_used = sorted(r.block for r in stored.select("block").distinct().collect())
        found = [centroid_distances(points, stored.where(F.col("block") == b), budget) for b in blocks_used]
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        return every
    known = _collect_centroids(centroids)
    ids, matrix = known.ids, known.matrix

    @F.arrow_udf("array<double>")
    def distances(v: pa.Array) -> pa.Array:
        x = batch_matrix(v, matrix.shape[1])
        d = np.stack([np.sqrt(((x - center) ** 2).sum(1)) for center in matrix], axis=1)
        valid = v.is_valid().to_numpy(zero_copy_only=False)
        # Null where the vector is; all others have as many distances as there are centroids.
        offsets = np.concatenate([[0], np.cumsum(np.where(valid, len(matrix), 0))]).astype("int32")
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(d.ravel()))
        return pc.if_else(pa.array(valid), lists, pa.scalar(None, lists.type))

    each = points.select("id", F.posexplode(distances("v")).alias("place", "distance"))
    cluster = F.get(F.lit([int(i) for i in ids]), F.col("place"))
    return each.select("id", cluster.cast("int").alias("cluster_id"), "distance")


def _largest(table: DataFrame) -> float:
    """The largest absolute value in the vectors of ``table``."""
    return float(table.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("x")).first().x or 0.0)


def update_centroids(assigned: DataFrame, centroids: DataFrame, bound: float | None = None) -> DataFrame:
    """``cluster_id, v, size``: the mean of each cluster's vectors.

    ``assigned`` is ``cluster_id, v``, and no value in it exceeds ``bound``, which is looked up
    otherwise: pass a stored table. A cluster without points keeps its centroid. The means are
    the same bits whatever the order of the rows.
    """
    unit = unit_of(_largest(assigned) if bound is None else bound)
    means = (
        assigned.select("cluster_id", F.posexplode("v").alias("dim", "x"))
        .groupBy("cluster_id", "dim")
        .agg(*sum_parts(units(F.col("x").cast("double"), unit), "x"), F.count("*").alias("size"))
        .select("cluster_id", "dim", "size", (sum_of("x", unit) / F.col("size")).alias("x"))
        .groupBy("cluster_id")
        .agg(
            F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("mean"),
            F.max("size").alias("size"),
        )
    )
    old = centroids.select("cluster_id", F.col("v").alias("old"))
    return old.join(means, "cluster_id", "left").select(
        "cluster_id",
        F.coalesce(F.col("mean.x"), F.col("old").cast("array<double>")).alias("v"),
        F.coalesce("size", F.lit(0)).alias("size"),
    )


def centroid_shifts(old: DataFrame, new: DataFrame) -> DataFrame:
    """``cluster_id, shift``: how far each centroid moved."""
    return (
        old.select("cluster_id", F.col("v").alias("old"))
        .join(new.select("cluster_id", F.col("v").alias("new")), "cluster_id")
        .select("cluster_id", distance(F.col("old"), F.col("new")).alias("shift"))
    )


def converged(shifts: DataFrame, tol: float = TOLERANCE) -> DataFrame:
    """One row ``max_shift, converged``: no centroid moved farther than ``tol``."""
    largest = F.max("shift")
    return shifts.agg(largest.alias("max_shift"), (largest <= tol).alias("converged"))


def choose_centroids(points: DataFrame, k: int = CLUSTERS, seeds: DataFrame | None = None) -> DataFrame:
    """``cluster_id, id, v, min_distance``: farthest-first centroids.

    Starts from ``seeds`` (``id, v``, or centroids ``cluster_id, v`` as a file has them, whose
    ids are then null; the point with the smallest id by default) and adds the point whose
    nearest centroid is farthest, the smallest id among equals, until there are ``k`` or every
    point equals a centroid. All seeds are kept, even if there are more than ``k``.

    A pass over the points returns the ``CANDIDATES`` farthest ones. Distances only shrink, so the
    next picks are among them for as long as the farthest of them is ahead of the first one left
    out: one pass at least gives one pick, mostly many. Now and then the points' distances to what
    is chosen so far are stored with them, and only newer centroids are compared, so the work
    grows with ``k``, not its square.
    """
    spark = points.sparkSession
    id_type = points.schema["id"].dataType.simpleString()
    table = points.select("id", "v", F.lit(None).cast("double").alias("least"))
    if seeds is None:
        seeds = points.orderBy("id").limit(1)
    if "id" not in seeds.columns:
        rows = seeds.select(F.lit(None).cast(id_type).alias("id"), "v", "cluster_id").orderBy("cluster_id").collect()
    else:
        rows = seeds.select("id", "v").orderBy("id").collect()
    chosen = [(r.id, list(r.v), None) for r in rows]
    if not chosen:
        raise ValueError("no seed: there are no points")
    stored, newest = None, [v for _, v, _ in chosen]

    while len(chosen) < k:
        found = _farthest(table, np.array(newest, dtype="float64")).orderBy(F.desc("d"), "id").limit(CANDIDATES + 1)
        picks = next_picks([(r.id, list(r.v), r.d) for r in found.collect()], k - len(chosen))
        if not picks:
            break
        chosen += picks
        newest += [v for _, v, _ in picks]
        if len(newest) >= PICKS_PER_STORE and len(chosen) < k:
            before, stored = stored, stage(_with_least(table, np.array(newest, dtype="float64")), "least_distances")
            drop_stage(before)
            table, newest = stored, [newest[-1]]
    drop_stage(stored)
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(chosen)],
        f"cluster_id int, id {id_type}, v array<double>, min_distance double",
    )


def next_picks(farthest: list[tuple], most: int) -> list[tuple]:
    """The picks that ``farthest`` proves: points id, vector, distance, the farthest and then the
    smallest id first; of those left out, if any, the first one is the last in the list."""
    beyond = farthest[CANDIDATES] if len(farthest) > CANDIDATES else None
    points = farthest[:CANDIDATES]
    if not points:
        return []
    matrix = np.array([v for _, v, _ in points], dtype="float64")
    least, picks = np.array([d for _, _, d in points]), []
    while len(picks) < most:
        d = least.max()
        at = min(np.flatnonzero(least == d), key=lambda i: points[i][0])
        if d <= 0:
            break
        if picks and beyond is not None and (d < beyond[2] or (d == beyond[2] and points[at][0] > beyond[0])):
            break
        picks.append((points[at][0], points[at][1], float(d)))
        least = np.minimum(least, nearest_rows(matrix, matrix[at : at + 1])[1])
    return picks


def _least_distances(batch: pa.RecordBatch, matrix: np.ndarray) -> np.ndarray:
    """Per row with a vector the distance to the nearest of ``matrix`` and of those before."""
    d = nearest_rows(batch_matrix(batch.column("v"), matrix.shape[1]), matrix)[1]
    before = batch.column("least").fill_null(np.inf).to_numpy(zero_copy_only=False)
    return np.minimum(np.where(np.isnan(d), 0.0, d), before)


def _with_least(table: DataFrame, matrix: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("v").is_valid())
            if batch.num_rows:
                least = pa.array(_least_distances(batch, matrix))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), least], names=["id", "v", "least"])

    return table.mapInArrow(run, table.schema)


def _farthest(table: DataFrame, matrix: np.ndarray) -> DataFrame:
    """Rows ``id, v, d``: of every task the points that are farthest from all centroids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            batch = batch.filter(batch.column("v").is_valid())
            if not batch.num_rows:
                continue
            d = pa.array(_least_distances(batch, matrix))
            v = batch.column("v").cast(pa.list_(pa.float64()))
            found = pa.table({"id": batch.column("id"), "v": v, "d": d}).filter(pc.greater(d, 0.0))
            kept = found if kept is None else pa.concat_tables([kept, found])
            first = pc.sort_indices(kept, sort_keys=[("d", "descending"), ("id", "ascending")])[: CANDIDATES + 1]
            kept = kept.take(first).combine_chunks()
        if kept is not None:
            yield from kept.to_batches()

    schema = table.select("id", F.col("v").cast("array<double>").alias("v"), F.lit(0.0).alias("d")).schema
    return table.mapInArrow(run, schema)


# -- iterations ------------------------------------------------------------------------


@dataclass(frozen=True)
class LloydResult:
    """``centroids``: cluster_id, v. ``assignments``: id, cluster_id, distance.
    ``history``: iteration, cluster_id, v, size, shift, cost. ``spared``: per turn of this call
    the share of comparisons that pruning left out."""

    centroids: DataFrame
    assignments: DataFrame
    history: DataFrame
    iterations: int
    converged: bool
    spared: tuple[float, ...] = ()


@dataclass
class _Step:
    """What one pass over the points yields per cluster."""

    sums: np.ndarray
    sizes: np.ndarray
    costs: np.ndarray
    compared: int = 0


@dataclass(frozen=True)
class _Units:
    """Units of the sums of values and of squared distances."""

    value: float
    square: float

    @staticmethod
    def of(points: DataFrame, matrix: np.ndarray) -> "_Units":
        largest = max(_largest(points), float(np.abs(matrix).max(initial=0.0)))
        return _Units(unit_of(largest), unit_of(4.0 * max(matrix.shape[1], 1) * largest * largest))


def _step(points: DataFrame, known: _Centroids, unit: _Units, settled: np.ndarray | None = None) -> _Step:
    """Sums, sizes and costs per cluster from one pass over the points.

    Every task adds up its points per cluster, so it passes on one row per cluster and
    nothing of the points; these rows are summed up by a shuffle. With ``settled``, the centroids
    by which ``points`` got their ``cluster`` and the bound ``other`` on all other distances,
    points that cannot have changed are compared with their own centroid only.
    """
    matrix = known.matrix
    k, dims = matrix.shape
    moved = None if settled is None else np.sqrt(((matrix - settled) ** 2).sum(1))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, costs = Counted((k, dims), unit.value), Counted((k,), unit.square)
        sizes, compared = np.zeros(k, "int64"), 0
        for batch in batches:
            valid = batch.column("v").is_valid()
            x = batch_matrix(batch.column("v"), dims)
            if moved is None:
                best, d = nearest_rows(x, matrix)
                compared += len(x) * k
            else:
                cluster, other = (batch.column(c).filter(valid).to_numpy() for c in ("cluster", "other"))
                best, d, open_rows = _nearest_if_moved(x, matrix, cluster, other, moved)
                compared += len(x) + open_rows * k
            sizes += np.bincount(best, minlength=k)
            sums.add_rows(x, best)
            costs.add(d * d, best)
        used = np.flatnonzero(sizes)
        if len(used) or compared:
            used = used if len(used) else np.zeros(1, "int64")
            high, low = sums.parts()
            cost_high, cost_low = costs.parts()
            share = np.zeros(len(used), "int64")
            share[0] = compared
            columns = {
                "cluster": pa.array(used, pa.int32()), "size": sizes[used], "compared": share, "cost_high": cost_high[used],
                "cost_low": cost_low[used], "high": _vectors(high[used]), "low": _vectors(low[used]),
            }
            yield pa.RecordBatch.from_pydict(columns)

    numbers = ["size", "compared", "cost_high", "cost_low"]
    schema = "cluster int, " + ", ".join(f"{n} long" for n in numbers) + ", high array<long>, low array<long>"
    columns = [] if settled is None else ["cluster", "other"]
    parts = points.select("v", *columns).mapInArrow(partial, schema)
    merged = (
        parts.select("cluster", *numbers, F.posexplode(F.arrays_zip("high", "low")).alias("dim", "x"))
        .groupBy("cluster", "dim")
        .agg(*[F.sum(n).alias(n) for n in numbers], F.sum("x.high").alias("high"), F.sum("x.low").alias("low"))
        .toArrow()
    )
    cluster, dim = merged["cluster"].to_numpy(), merged["dim"].to_numpy()
    sums, sizes, costs = np.zeros((k, dims)), np.zeros(k, "int64"), np.zeros(k)
    sums[cluster, dim] = Counted.value(merged["high"].to_numpy(), merged["low"].to_numpy(), unit.value)
    sizes[cluster] = merged["size"].to_numpy()
    costs[cluster] = Counted.value(merged["cost_high"].to_numpy(), merged["cost_low"].to_numpy(), unit.square)
    return _Step(sums, sizes, costs, int(merged["compared"].to_numpy()[dim == 0].sum()))


def _nearest_if_moved(x, matrix, cluster, other, moved) -> tuple[np.ndarray, np.ndarray, int]:
    """``nearest_rows``, with no look at other centroids where these are too far away to have
    come nearest: each is at least ``other`` away less what the one that moved most has moved."""
    own = np.sqrt(((x - matrix[cluster]) ** 2).sum(1))
    order = np.argsort(-moved, kind="stable")[:2]
    others = np.where(cluster == order[0], moved[order[-1]] if len(moved) > 1 else 0.0, moved[order[0]])
    near = own >= (other - others) - 1e-9 * (other + own)
    best, d = cluster.astype("int64"), own
    if near.any():
        best[near], d[near] = nearest_rows(x[near], matrix)
    return best, d, int(near.sum())


def _settled(points: DataFrame, known: _Centroids) -> DataFrame:
    """``v, cluster, other``, stored: each point's nearest centroid, and a bound on the distances to
    all others."""
    matrix = known.matrix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("v").is_valid())
            x = batch_matrix(batch.column("v"), matrix.shape[1])
            best, _ = nearest_rows(x, matrix)
            other = second_distances(x, matrix, best)
            yield pa.RecordBatch.from_arrays(
                [batch.column("v"), pa.array(best.astype("int32")), pa.array(other)], names=["v", "cluster", "other"]
            )

    kind = points.schema["v"].dataType.simpleString()
    return stage(points.select("v").mapInArrow(run, f"v {kind}, cluster int, other double"), "settled_points")


_HISTORY = "iteration int, cluster_id int, v array<double>, size long, shift double, cost double"


class _Past:
    """The turns so far: held by the driver, and stored in groups of ``HELD_BYTES``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held, self.bytes, self.stored = spark, [], 0, []

    def add(self, turn: pa.Table) -> None:
        self.held.append(turn)
        self.bytes += turn.nbytes
        if self.bytes >= HELD_BYTES:
            self._store()

    def _store(self) -> None:
        self.stored.append(stage(self.spark.createDataFrame(pa.concat_tables(self.held)), "turns"))
        self.held, self.bytes = [], 0

    def table(self, empty: pa.Table) -> DataFrame:
        if self.held or not self.stored:
            self.held = self.held or [empty]
            self._store()
        out = self.stored[0]
        for more in self.stored[1:]:
            out = out.unionByName(more)
        return out


def lloyd(
    points: DataFrame,
    centroids: DataFrame,
    tol: float = TOLERANCE,
    max_iter: int | None = None,
    round_digits: int | None = None,
    run: str | None = None,
    prune: bool = False,
    budget: int = BROADCAST_BYTES,
) -> LloydResult:
    """Lloyd's iterations from given centroids until none moves farther than ``tol``.

    One job and one pass over the points per iteration; persist them beforehand if they fit
    the cluster's memory. With ``max_iter`` it may end before it converges, which
    ``converged`` tells. A cluster without points keeps its centroid. ``round_digits`` rounds
    the returned centroids, not the ones iterated on.

    With ``run``, a folder, every turn is committed there, and a call with the same arguments
    goes on after the last one that was. With ``prune``, the points are stored with their nearest
    centroid and a bound on the distance to all others, and those that cannot change are compared
    with one centroid only; the result is the same, and it pays with many clusters. Centroids
    beyond ``budget`` bytes are worked on as tables, ``assign`` and ``update_centroids`` in turn;
    that form knows neither ``run`` nor ``prune``.
    """
    spark = points.sparkSession
    if _centroid_bytes(centroids) > budget:
        if run or prune:
            raise ValueError("centroids beyond the budget: neither run nor prune")
        return _lloyd_on_tables(points, centroids, tol, max_iter, round_digits, budget)
    known = _collect_centroids(centroids)
    k, dims = known.matrix.shape
    table = points.select("id", "v")
    past, done, iteration, spared = _Past(spark), False, 0, []
    start = zlib.crc32(known.matrix.tobytes(), zlib.crc32(known.ids.astype("int64").tobytes()))
    log = run and Run(spark, run, {"form": "dense", "clusters": k, "start": start, "tol": tol})
    unit = None
    if not (log and log.turns and log.turns[-1]["done"]):
        unit = _Units.of(table, known.matrix)
    if log and log.turns:
        iteration, done = log.turns[-1]["turn"], log.turns[-1]["done"]
        past.stored.append(log.tables("history", _HISTORY))
        last = log.table(iteration, "history", _HISTORY).toArrow().sort_by("cluster_id")
        known = _Centroids(known.ids, last["v"].combine_chunks().flatten().to_numpy().reshape(k, dims))
    settled: DataFrame | None = None
    anchor, pays = None, 0.0
    while not done and (max_iter is None or iteration < max_iter):
        iteration += 1
        settle = prune and iteration > 1 and (settled is None or pays < SPARED)
        if settle:
            before, settled, anchor = settled, _settled(table, known), known.matrix
            drop_stage(before)
        step = _step(table, known, unit) if settled is None else _step(settled, known, unit, anchor)
        every = max(int(step.sizes.sum()) * k, 1)
        pays = 1.0 - step.compared / every
        spared.append(0.0 if settle else pays)
        used = step.sizes > 0
        means = known.matrix.copy()
        means[used] = step.sums[used] / step.sizes[used, None]
        shifts = np.sqrt(((means - known.matrix) ** 2).sum(1))
        known = _Centroids(known.ids, means)
        done = bool((shifts <= tol).all())
        turn = _turn(iteration, known, step, shifts)
        past.add(turn)
        if log:
            log.commit({"history": spark.createDataFrame(turn)}, done=done)
    drop_stage(settled)
    final = known.matrix if round_digits is None else known.matrix.round(round_digits)
    result = _centroid_table(spark, known.ids, final)
    empty = _turn(0, known, _Step(final, np.zeros(k, "int64"), np.zeros(k)), np.zeros(k)).slice(0, 0)
    return LloydResult(result, assign(table, result), past.table(empty), iteration, done, tuple(spared))


def _turn(iteration: int, known: _Centroids, step: _Step, shifts) -> pa.Table:
    columns = {
        "iteration": pa.array([iteration] * len(known.ids), pa.int32()), "cluster_id": pa.array(known.ids, pa.int32()),
        "v": _vectors(known.matrix), "size": pa.array(step.sizes), "shift": pa.array(shifts), "cost": pa.array(step.costs),
    }
    return pa.table(columns)


def _lloyd_on_tables(
    points: DataFrame, centroids: DataFrame, tol: float, max_iter: int | None, round_digits: int | None, budget: int
) -> LloydResult:
    """The iterations with centroids that neither the driver nor a task can hold."""
    bound = max(_largest(points), _largest(centroids))
    dims = centroids.agg(F.max(F.size("v")).alias("n")).first().n
    unit = unit_of(4.0 * dims * bound * bound)
    known = stage(centroids.select("cluster_id", F.col("v").cast("array<double>").alias("v")), "centroids")
    past, done, iteration = [], False, 0
    while not done and (max_iter is None or iteration < max_iter):
        iteration += 1
        assigned = assign(points, known, True, budget).where("cluster_id IS NOT NULL")
        square = units(F.col("distance") * F.col("distance"), unit)
        costs = assigned.groupBy("cluster_id").agg(*sum_parts(square, "cost")).select("cluster_id", sum_of("cost", unit).alias("cost"))
        new = update_centroids(assigned, known, bound).join(costs, "cluster_id", "left").fillna(0.0, "cost")
        shifts = centroid_shifts(known, new)
        turn = stage(
            new.join(shifts, "cluster_id").select(F.lit(iteration).alias("iteration"), "cluster_id", "v", "size", "shift", "cost"), "turn"
        )
        past.append(turn)
        known = turn.select("cluster_id", "v")
        done = converged(turn, tol).first().converged
    history = past[0] if past else known.select(F.lit(0).alias("iteration"), "*", F.lit(0).cast("long").alias("size"), F.lit(0.0).alias("shift"), F.lit(0.0).alias("cost")).where("false")
    for turn in past[1:]:
        history = history.unionByName(turn)
    final = known
    if round_digits is not None:
        final = stage(known.withColumn("v", F.transform("v", lambda x: F.bround(x, round_digits))), "rounded")
    return LloydResult(final, assign(points, final, budget=budget), history, iteration, done)
