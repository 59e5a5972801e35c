"""Seeding and Lloyd's iterations on coordinates: one row per point and non-zero term.

Vectors over a dictionary of millions of terms are stored as ``id, term, value`` and never
made dense; centroids are ``cluster_id, term, value``. Everything stays in Spark: the driver
sees one row per cluster.

Coordinates are laid out by point: buckets of ``cell``, a hash of the id, and the id. A point's coordinates
lie together, so sums over a point need no exchange. A point with more than ``CELL_ROWS``
coordinates has several cells, chosen by term, whose sums are added up in a second small step;
so no bucket holds more than its share of one.

Centroids come in blocks of ``BLOCK`` clusters, a column each. A coordinate meets a block once,
by broadcast; only the nearest centroid of a block leaves a point. Of a block beyond the budget
the most frequent terms are broadcast, and only coordinates of the others move.

A squared distance is the centroid's own squared length plus, for each of the point's terms,
what that term changes in it. All of these are whole numbers of a common unit, so a distance
does not depend on the order of the sum and is 0 where point and centroid are equal. Means,
costs and shifts are summed the same way (``functions.exact``): a retried task or another
partitioning gives the same bits, and the same number of turns.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from plotweave.functions.exact import sum_of, sum_parts, unit_of, units
from plotweave.operators.dense import CLUSTERS, TOLERANCE
from plotweave.plans.lookup import BROADCAST_BYTES, hot_rows, row_bytes
from plotweave.runs import Run
from plotweave.session import drop_stage, stage, stage_bucketed, stage_measured

BLOCK = 16
# Coordinates of one point beyond which it gets several cells.
CELL_ROWS = 1 << 20
# What the coordinates are laid out by.
CELL = ["cell", "id"]
# Bits of a squared distance: the sums over a point stay below 64.
DISTANCE_BITS = 60
# Farthest points that a seeding looks at after each pass; it picks as many as that pass proves.
CANDIDATES = BLOCK


def coordinates_of(points: DataFrame) -> DataFrame:
    """Dense ``id, v`` as coordinates; the position in the vector is the term.

    Zeros are left out but for the first position, which keeps points of zeros only.
    """
    exploded = points.select("id", F.posexplode("v").alias("term", "x"))
    kept = exploded.where((F.col("x") != 0) | (F.col("term") == 0))
    return kept.select("id", "term", F.col("x").cast("double").alias("value"))


def as_coordinates(scores: DataFrame, score: str = "tfidf") -> DataFrame:
    """A score table ``product_id, term, <score>`` as coordinates ``id, term, value``."""
    return scores.select(F.col("product_id").alias("id"), "term", F.col(score).alias("value"))


def centroids_of(vectors: DataFrame) -> DataFrame:
    """Dense centroids ``cluster_id, v`` as coordinates; zeros are left out."""
    entries = vectors.select("cluster_id", F.posexplode("v").alias("term", "value"))
    return entries.where("value <> 0").withColumn("value", F.col("value").cast("double"))


# -- layout ----------------------------------------------------------------------------


@dataclass(frozen=True)
class _Scale:
    """The largest absolute value, and the largest squared length, of points or centroids."""

    value: float
    norm: float

    def with_(self, other: "_Scale") -> "_Scale":
        return _Scale(max(self.value, other.value), max(self.norm, other.norm))

    @property
    def distance_unit(self) -> float:
        """Twice the largest length is the farthest that two of them can be apart."""
        return unit_of(4.0 * self.norm, DISTANCE_BITS)


def stored_coordinates(coordinates: DataFrame) -> DataFrame:
    """The coordinates laid out by point once, for the many passes over them.

    Columns are ``id, term, value, cell, parts``; ``parts`` is the number of the point's cells.
    One shuffle. Rows without an id, a term or a value are left out.
    """
    rows = coordinates.select("id", "term", F.col("value").cast("double").alias("value")).dropna()
    sizes = rows.groupBy("id").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("parts")).where("parts > 1")
    # At most one row for CELL_ROWS coordinates.
    sizes, found = stage_measured(sizes, "large_points", F.count("*").alias("n"))
    parts = F.lit(1)
    if found["n"]:
        rows, parts = rows.join(sizes, "id", "left"), F.coalesce("parts", F.lit(1))
    cell = F.xxhash64("id") + F.pmod(F.xxhash64("term"), parts)
    table = stage_bucketed(rows.select("id", "term", "value", cell.alias("cell"), parts.cast("int").alias("parts")), CELL, "coordinates")
    table.large, table.terms = found["n"] > 0, None
    table.scale = _scale_of_points(table)
    return table


def _laid(coordinates: DataFrame) -> DataFrame:
    return coordinates if "scale" in vars(coordinates) else stored_coordinates(coordinates)


def _point_sums(laid: DataFrame, rows, sums: list[Column], names: list[str]) -> DataFrame:
    """``id, parts`` and ``sums`` of what ``rows`` makes of the coordinates, per point.

    Points of one cell are summed where they lie. Those of several are summed per cell first.
    """
    columns = ["id", "parts", *names]
    if not laid.large:
        return rows(laid).groupBy("cell", "id", "parts").agg(*sums).select(columns)
    small = rows(laid.where("parts = 1")).groupBy("cell", "id", "parts").agg(*sums).select(columns)
    return small.unionByName(rows(laid.where("parts > 1")).groupBy("id", "parts").agg(*sums).select(columns))


def _squares(largest: float) -> tuple[Column, float]:
    """Squares of values up to ``largest``, in whole units rounded up, and the unit."""
    unit = unit_of(largest * largest, 38)
    return units(F.col("value") * F.col("value"), unit) + 1, unit


def _scale_of_points(laid: DataFrame) -> _Scale:
    """In whole numbers, so that it is the same whatever the order of the rows."""
    largest = laid.agg(F.max(F.abs("value")).alias("x")).first().x or 0.0
    square, unit = _squares(largest)
    longest = _point_sums(laid, lambda rows: rows, [F.sum(square).alias("n")], ["n"]).agg(F.max("n").alias("n")).first().n
    return _Scale(largest, (longest or 0) * unit)


def _scale_of_centroids(centroids: DataFrame) -> _Scale:
    largest = centroids.agg(F.max(F.abs("value")).alias("x")).first().x or 0.0
    square, unit = _squares(largest)
    longest = centroids.groupBy("cluster_id").agg(F.sum(square).alias("n")).agg(F.max("n").alias("n")).first().n
    return _Scale(largest, (longest or 0) * unit)


# -- nearest centroids -----------------------------------------------------------------


@dataclass(frozen=True)
class _Block:
    """Up to ``BLOCK`` centroids: ``term`` and ``c<j>`` per cluster; their squared lengths in units."""

    table: DataFrame
    ids: list[int]
    unit: float
    lengths: list[int]
    bytes: float

    def changes(self) -> list[Column]:
        """Sums of what a point's terms change in each centroid's squared length."""
        out = []
        for j in range(len(self.ids)):
            c = F.coalesce(f"c{j}", F.lit(0.0))
            difference = F.col("value") - c
            out.append(F.sum(units(difference * difference, self.unit) - units(c * c, self.unit)).alias(f"d{j}"))
        return out

    @property
    def names(self) -> list[str]:
        return [f"d{j}" for j in range(len(self.ids))]

    def distances(self) -> list[Column]:
        return [F.col(f"d{j}") + F.lit(n) for j, n in enumerate(self.lengths)]


def _block(centroids: DataFrame, ids: list[int], unit: float) -> _Block:
    """The clusters ``ids`` side by side, stored, with what a distance needs of them."""
    columns = [F.sum(F.when(F.col("cluster_id") == i, F.col("value"))).alias(f"c{j}") for j, i in enumerate(ids)]
    wide = centroids.where(F.col("cluster_id").isin(ids)).groupBy("term").agg(*columns)
    table, found = stage_measured(
        wide, "centroid_block", F.sum(row_bytes("term", 8 * len(ids))).alias("bytes"),
        *[F.sum(units(F.col(f"c{j}") * F.col(f"c{j}"), unit)).alias(f"n{j}") for j in range(len(ids))],
    )
    return _Block(table, ids, unit, [found[f"n{j}"] or 0 for j in range(len(ids))], found["bytes"] or 0.0)


def _sums_of_block(laid: DataFrame, block: _Block, budget: int) -> DataFrame:
    """``id, parts`` and the block's changes per point."""
    sums, names = block.changes(), block.names
    if block.bytes <= budget:
        return _point_sums(laid, lambda rows: rows.join(F.broadcast(block.table), "term", "left"), sums, names)
    if laid.terms is None:
        laid.terms = stage(laid.groupBy("term").agg(F.count("*").alias("rows_per_key")), "term_rows")
    weighted = stage(block.table.join(laid.terms, "term", "left").fillna(0, "rows_per_key"), "weighted_block")
    hot = hot_rows(weighted, "term", "rows_per_key", budget, 8 * len(block.ids)).select(block.table.columns)
    by_broadcast = _point_sums(laid, lambda rows: rows.join(F.broadcast(hot), "term"), sums, names)
    # Only the coordinates of less frequent terms move.
    rest = laid.join(F.broadcast(hot.select("term")), "term", "left_anti").join(block.table.hint("shuffle_merge"), "term", "left")
    both = by_broadcast.unionByName(rest.groupBy("id", "parts").agg(*sums))
    return both.groupBy("id", "parts").agg(*[F.sum(n).alias(n) for n in names])


def _nearest_of_block(laid: DataFrame, block: _Block, budget: int) -> DataFrame:
    """``id, parts, d, cluster_id``: the block's nearest centroid, the lowest of equals; d in units."""
    each = [F.struct(d.alias("d"), F.lit(i).cast("int").alias("cluster_id")) for i, d in zip(block.ids, block.distances())]
    found = _sums_of_block(laid, block, budget).select("id", "parts", F.array_min(F.array(*each)).alias("nearest"))
    return found.select("id", "parts", "nearest.d", "nearest.cluster_id")


def _least(found: list[DataFrame]) -> DataFrame:
    """The nearest of several tables of nearest centroids."""
    if len(found) == 1:
        return found[0]
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    best = every.groupBy("id", "parts").agg(F.min(F.struct("d", "cluster_id")).alias("nearest"))
    return best.select("id", "parts", "nearest.d", "nearest.cluster_id")


def _nearest(laid: DataFrame, centroids: DataFrame, ids: list[int], unit: float, budget: int) -> DataFrame:
    """``id, parts, d, cluster_id``. With several blocks each one's nearest are stored first."""
    blocks = [ids[k : k + BLOCK] for k in range(0, len(ids), BLOCK)]
    found = [_nearest_of_block(laid, _block(centroids, b, unit), budget) for b in blocks]
    return _least(found if len(blocks) == 1 else [stage(f, "nearest") for f in found])


def _ids_of(centroids: DataFrame) -> list[int]:
    ids = sorted(r.cluster_id for r in centroids.select("cluster_id").distinct().collect())
    if not ids:
        raise ValueError("no centroids")
    return ids


def assign_sparse(coordinates: DataFrame, centroids: DataFrame, budget: int = BROADCAST_BYTES) -> DataFrame:
    """``id, cluster_id, distance``: the nearest centroid, the lowest id among equals.

    Below the sum per point there is no exchange, if ``coordinates`` are stored ones and a block
    of centroids fits the budget.
    """
    laid = _laid(coordinates)
    unit = laid.scale.with_(_scale_of_centroids(centroids)).distance_unit
    found = _nearest(laid, centroids, _ids_of(centroids), unit, budget)
    return found.select("id", "cluster_id", _distance(unit).alias("distance"))


def _distance(unit: float) -> Column:
    return F.sqrt(F.col("d") * F.lit(unit))


# -- means -----------------------------------------------------------------------------


def _placed(found: DataFrame) -> DataFrame:
    """Nearest centroids stored beside the coordinates, a row per cell of each point."""
    cells = found.select("id", "d", "cluster_id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return stage_bucketed(cells.withColumn("cell", F.xxhash64("id") + F.col("part")), CELL, "assignments", move=False)


def update_sparse(coordinates: DataFrame, assignments: DataFrame, centroids: DataFrame) -> DataFrame:
    """``cluster_id, term, value``: the mean of each cluster's points.

    A cluster without points keeps its centroid. Pass stored assignments.
    """
    laid = _laid(coordinates)
    beside = "cell" in assignments.columns
    of_point = assignments.where("part = 0") if beside else assignments
    sizes = of_point.groupBy("cluster_id").agg(F.count("*").alias("size"))
    key = CELL if beside else ["id"]
    members = laid.join(assignments.select(*key, "cluster_id").hint("shuffle_hash"), key)
    unit = unit_of(laid.scale.value)
    totals = members.groupBy("cluster_id", "term").agg(*sum_parts(units(F.col("value"), unit), "total"))
    # One row per cluster.
    means = totals.join(F.broadcast(sizes), "cluster_id").select(
        "cluster_id", "term", (sum_of("total", unit) / F.col("size")).alias("value")
    )
    kept = centroids.join(F.broadcast(sizes), "cluster_id", "left_anti").select("cluster_id", "term", "value")
    return means.unionByName(kept)


def shifts_sparse(old: DataFrame, new: DataFrame, bound: float | None = None) -> DataFrame:
    """``cluster_id, shift``: how far each centroid moved. No value exceeds ``bound``."""
    if bound is None:
        bound = old.select("value").unionByName(new.select("value")).agg(F.max(F.abs("value")).alias("x")).first().x or 0.0
    both = old.select("cluster_id", "term", (-F.col("value")).alias("value")).unionByName(
        new.select("cluster_id", "term", "value")
    )
    moved = both.groupBy("cluster_id", "term").agg(F.sum("value").alias("d"))
    unit = unit_of(4.0 * bound * bound)
    squares = moved.groupBy("cluster_id").agg(*sum_parts(units(F.col("d") * F.col("d"), unit), "square"))
    return squares.select("cluster_id", F.sqrt(sum_of("square", unit)).alias("shift"))


# -- seeding ---------------------------------------------------------------------------


def choose_centroids_sparse(
    coordinates: DataFrame,
    k: int = CLUSTERS,
    seeds: list | DataFrame | None = None,
    budget: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Farthest-first centroids and the picks they came from.

    ``seeds`` are ids of points (each must exist; the smallest id by default), or centroids
    ``cluster_id, term, value``, which need not be points. All of them are kept, even if there
    are more than ``k``. Returns ``cluster_id, term, value`` and ``cluster_id, id,
    min_distance``; the id of a given centroid is null. Pass stored coordinates.

    A pass compares the points with the newest centroids and stores a row per point. Of its
    ``CANDIDATES`` farthest points all distances to one another are looked up, so that the next
    picks follow without another pass, until one could be a point beyond them.
    """
    laid = _laid(coordinates)
    spark = laid.sparkSession
    id_type = laid.schema["id"].dataType
    centroids, picks = _given(laid, seeds)
    unit = laid.scale.with_(_scale_of_centroids(centroids)).distance_unit
    best: DataFrame | None = None
    newest, ids = centroids, [p[0] for p in picks]
    while len(picks) < k:
        found = _nearest(laid, newest, ids, unit, budget)
        before, best = best, stage(_least([found] + ([best] if best is not None else [])), "nearest")
        drop_stage(before)
        chosen = _next_picks(laid, best, k - len(picks), unit)
        if not chosen:
            break
        first = max(p[0] for p in picks) + 1
        picks += [(first + j, i, (d * unit) ** 0.5) for j, (i, d) in enumerate(chosen)]
        ids = [first + j for j in range(len(chosen))]
        newest = _points(laid, [(first + j, i) for j, (i, _) in enumerate(chosen)])
        centroids = centroids.unionByName(newest)
    drop_stage(best)
    schema = f"cluster_id int, id {id_type.simpleString()}, min_distance double"
    return stage(centroids, "centroids"), spark.createDataFrame(picks, schema)


def _next_picks(laid: DataFrame, best: DataFrame, most: int, unit: float) -> list[tuple]:
    """The next points of the seeding with their distances (squared, in units): one at least,
    unless every point equals a centroid, and as many as the farthest points prove."""
    top = best.select("id", "d").orderBy(F.desc("d"), "id").limit(CANDIDATES + 1).collect()
    beyond = top[CANDIDATES] if len(top) > CANDIDATES else None
    least = {r.id: r.d for r in top[:CANDIDATES] if r.d > 0}
    apart: dict | None = None
    chosen: list[tuple] = []
    while least and len(chosen) < most:
        d = max(least.values())
        pick = min(i for i, x in least.items() if x == d)
        # Distances of the points beyond only shrink.
        if chosen and beyond is not None and (d < beyond.d or (d == beyond.d and pick > beyond.id)):
            break
        chosen.append((pick, d))
        if len(chosen) == most:
            break
        if apart is None:
            apart = _apart(laid, list(least), unit)
        least = {i: min(x, apart[i, pick]) for i, x in least.items() if i != pick}
        least = {i: x for i, x in least.items() if x > 0}
    return chosen


def _apart(laid: DataFrame, ids: list, unit: float) -> dict:
    """Squared distances, in units, of each two of the points ``ids``, which are few."""
    points = _points(laid, list(enumerate(ids)))
    block = _block(points, list(range(len(ids))), unit)
    joined = points.join(block.table, "term", "left").groupBy("cluster_id").agg(*block.changes())
    rows = joined.select("cluster_id", *[d.alias(n) for d, n in zip(block.distances(), block.names)]).collect()
    return {(ids[r.cluster_id], ids[j]): r[n] for r in rows for j, n in enumerate(block.names)}


def _points(laid: DataFrame, chosen: list[tuple]) -> DataFrame:
    """The points with the given ids as centroids; few, since the caller names them."""
    id_type = laid.schema["id"].dataType.simpleString()
    named = laid.sparkSession.createDataFrame(chosen, f"cluster_id int, id {id_type}")
    return stage(laid.join(F.broadcast(named), "id").select("cluster_id", "term", "value"), "points")


def _given(laid: DataFrame, seeds: list | DataFrame | None) -> tuple[DataFrame, list[tuple]]:
    if isinstance(seeds, DataFrame):
        ids = sorted(r.cluster_id for r in seeds.select("cluster_id").distinct().collect())
        if not ids:
            raise ValueError("no seed was given")
        return seeds.select(F.col("cluster_id").cast("int").alias("cluster_id"), "term", "value"), [(i, None, None) for i in ids]
    if seeds is None:
        first = laid.agg(F.min("id").alias("id")).first().id
        if first is None:
            raise ValueError("no seed: there are no points")
        seeds = [first]
    chosen = list(enumerate(sorted(set(seeds))))
    centroids = _points(laid, chosen)
    known = {r.cluster_id for r in centroids.select("cluster_id").distinct().collect()}
    missing = [p for i, p in chosen if i not in known]
    if missing:
        raise ValueError(f"seeds that are no points: {missing}")
    return centroids, [(i, p, None) for i, p in chosen]


# -- iterations ------------------------------------------------------------------------


@dataclass(frozen=True)
class SparseLloydResult:
    """``centroids``: cluster_id, term, value. ``assignments``: id, cluster_id, distance.
    ``history``: iteration, cluster_id, size, shift, cost. ``past_centroids``: iteration,
    cluster_id, term, value."""

    centroids: DataFrame
    assignments: DataFrame
    history: DataFrame
    past_centroids: DataFrame
    iterations: int
    converged: bool


_HISTORY = "iteration int, cluster_id int, size long, shift double, cost double"


def lloyd_sparse(
    coordinates: DataFrame,
    centroids: DataFrame,
    tol: float = TOLERANCE,
    max_iter: int | None = None,
    round_digits: int | None = None,
    budget: int = BROADCAST_BYTES,
    run: str | None = None,
) -> SparseLloydResult:
    """Lloyd's iterations on coordinates, as ``lloyd`` does on dense vectors.

    Runs until no centroid moves farther than ``tol``; with ``max_iter`` it may end before,
    which ``converged`` tells. Every turn stores its assignments, deleted when the next turn
    has its own, and its centroids, which are the history. With ``run``, a folder, every turn is
    committed there, and a call with the same arguments goes on after the last one that was.
    Pass stored coordinates.
    """
    laid = _laid(coordinates)
    spark = laid.sparkSession
    ids = _ids_of(centroids)
    scale = laid.scale.with_(_scale_of_centroids(centroids))
    unit = scale.distance_unit
    log = run and Run(spark, run, {"form": "coordinates", "clusters": len(ids), "ids": zlib.crc32(str(ids).encode()), "tol": tol, "unit": unit})
    turns, rows, done, iteration = [], [], False, 0
    if log and log.turns:
        kept = centroids.select(F.col("cluster_id").cast("int").alias("cluster_id"), "term", "value").schema
        for turn in log.turns:
            iteration, done, centroids = turn["turn"], turn["done"], log.table(turn["turn"], "centroids", kept)
            turns.append(centroids.select(F.lit(iteration).alias("iteration"), "cluster_id", "term", "value"))
        rows = [tuple(r) for r in log.tables("history", _HISTORY).collect()]
    assigned: DataFrame | None = None
    while not done and (max_iter is None or iteration < max_iter):
        iteration += 1
        before, assigned = assigned, _placed(_nearest(laid, centroids, ids, unit, budget))
        drop_stage(before)
        cost = sum_parts(F.col("d"), "cost")
        found = assigned.where("part = 0").groupBy("cluster_id").agg(F.count("*").alias("size"), *cost)
        of_cluster = {r.cluster_id: r for r in found.select("cluster_id", "size", sum_of("cost", unit).alias("cost")).collect()}
        old, centroids = centroids, stage(update_sparse(laid, assigned, centroids), "centroids")
        shifts = {r.cluster_id: r["shift"] for r in shifts_sparse(old, centroids, scale.value).collect()}
        done = all(s <= tol for s in shifts.values())
        of_turn = []
        for i in sorted(shifts):
            own = of_cluster.get(i)
            of_turn.append((iteration, i, own.size if own else 0, shifts[i], own.cost if own else 0.0))
        if log:
            stored = centroids
            centroids = log.commit({"centroids": stored, "history": spark.createDataFrame(of_turn, _HISTORY)}, done=done)["centroids"]
            drop_stage(stored)
        rows += of_turn
        turns.append(centroids.select(F.lit(iteration).alias("iteration"), "cluster_id", "term", "value"))
    drop_stage(assigned)
    final = centroids
    if round_digits is not None:
        final = stage(centroids.withColumn("value", F.bround("value", round_digits)), "rounded")
    past = turns[0] if turns else centroids.select(F.lit(0).alias("iteration"), "*").where("false")
    for turn in turns[1:]:
        past = past.unionByName(turn)
    assignments = stage(assign_sparse(laid, final, budget), "assignments")
    return SparseLloydResult(final, assignments, spark.createDataFrame(rows, _HISTORY), past, iteration, done)
