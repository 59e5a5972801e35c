import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotweave.functions import distance
from plotweave.operators import dense
from plotweave.operators.dense import (
    assign,
    centroid_distances,
    centroid_shifts,
    choose_centroids,
    converged,
    lloyd,
    update_centroids,
    vectorize,
)
from plotweave.runs import run_history


@pytest.fixture(scope="module")
def points(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")).persist()


@pytest.fixture(scope="module")
def local(points):
    rows = points.orderBy("id").collect()
    return [r.id for r in rows], np.array([r.v for r in rows], dtype="float64")


@pytest.fixture(scope="module")
def centroids(points):
    return choose_centroids(points, 4)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def brute_nearest(x, c):
    d = np.sqrt(((x[:, None, :] - c[None]) ** 2).sum(2))
    return d.argmin(1), d.min(1)


def matrix_of(centroids):
    return np.array([r.v for r in centroids.orderBy("cluster_id").collect()])


def test_choose_centroids_against_brute_force(local, centroids):
    ids, x = local
    picked, distances = [0], []
    while len(picked) < 4:
        d = brute_nearest(x, x[picked])[1]
        distances.append(d.max())
        picked.append(int(d.argmax()))
    rows = centroids.orderBy("cluster_id").collect()
    assert [r.id for r in rows] == [ids[i] for i in picked]
    assert rows[0].min_distance is None
    assert [r.min_distance for r in rows[1:]] == pytest.approx(distances)
    assert distances == sorted(distances, reverse=True)


def test_choose_stops_when_all_points_are_centroids(spark):
    points = spark.createDataFrame(
        [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 2.0])], "id string, v array<double>"
    )
    rows = choose_centroids(points, 5).orderBy("cluster_id").collect()
    assert [r.id for r in rows] == ["a", "c"]


def test_farthest_tie_goes_to_the_smallest_id(spark):
    points = spark.createDataFrame(
        [(i, [float(x)]) for i, x in [(5, 0), (9, 3), (7, -3), (8, 3)]], "id long, v array<double>"
    ).repartition(4)
    rows = choose_centroids(points, 2).collect()
    assert [r.id for r in rows] == [5, 7]
    given = choose_centroids(points, 3, seeds=points.where("id = 9")).collect()
    assert [r.id for r in given] == [9, 7, 5]


def test_assign_matches_brute_force_and_the_expression(points, local, centroids):
    ids, x = local
    cluster, d = brute_nearest(x, matrix_of(centroids))
    rows = {r.id: r for r in assign(points, centroids).collect()}
    assert len(rows) == len(ids)
    assert [rows[i].cluster_id for i in ids] == cluster.tolist()
    assert [rows[i].distance for i in ids] == pytest.approx(d.tolist(), abs=1e-12)
    by_expression = (
        points.select("id", F.col("v").cast("array<double>").alias("v"))
        .join(centroids.select("cluster_id", F.col("v").alias("c")))
        .select("id", "cluster_id", distance(F.col("v"), F.col("c")).alias("distance"))
    )
    expected = {(r.id, r.cluster_id): r.distance for r in by_expression.collect()}
    found = {(r.id, r.cluster_id): r.distance for r in centroid_distances(points, centroids).collect()}
    assert found == pytest.approx(expected, abs=1e-12)


def test_assign_ties_go_to_the_lowest_cluster(spark):
    points = spark.createDataFrame([(1, [0.0]), (2, [2.0]), (3, None)], "id long, v array<double>")
    centroids = spark.createDataFrame([(7, [1.0]), (3, [-1.0]), (5, [2.0])], "cluster_id int, v array<double>")
    assert sorted(rows_of(assign(points, centroids))) == [(1, 3, 1.0), (2, 5, 0.0), (3, None, None)]


def test_wrong_length_is_an_error(spark):
    points = spark.createDataFrame([(1, [0.0, 1.0])], "id long, v array<double>")
    centroids = spark.createDataFrame([(0, [1.0])], "cluster_id int, v array<double>")
    with pytest.raises(Exception, match="length differs"):
        assign(points, centroids).collect()


def test_update_and_empty_cluster(spark):
    old = spark.createDataFrame([(0, [0.0, 0.0]), (1, [9.0, 9.0])], "cluster_id int, v array<double>")
    members = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, 2.0])], "cluster_id int, v array<double>")
    new = update_centroids(members, old)
    assert sorted(rows_of(new)) == [(0, [2.0, 2.0], 2), (1, [9.0, 9.0], 0)]
    shifts = centroid_shifts(old, new)
    assert rows_of(shifts.orderBy("cluster_id")) == [(0, pytest.approx(8**0.5)), (1, 0.0)]
    assert rows_of(converged(shifts)) == [(pytest.approx(8**0.5), False)]
    assert converged(shifts, 3.0).first().converged


def test_lloyd_against_brute_force(points, local, centroids):
    x, c = local[1], matrix_of(centroids)
    for _ in range(5):
        best = brute_nearest(x, c)[0]
        c = np.array([x[best == j].mean(0) if (best == j).any() else c[j] for j in range(len(c))])
    result = lloyd(points, centroids, tol=0.0, max_iter=5)
    assert matrix_of(result.centroids) == pytest.approx(c, abs=1e-9)
    assert result.iterations == 5


def test_lloyd_properties(points, local, centroids):
    result = lloyd(points, centroids)
    history = result.history.collect()
    cost = {}
    for r in history:
        cost[r.iteration] = cost.get(r.iteration, 0.0) + r.cost
    costs = [cost[i] for i in sorted(cost)]
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))
    assert result.converged and result.iterations == max(cost)
    assert all(r.shift <= 0.01 for r in history if r.iteration == result.iterations)
    assert any(r.shift > 0.01 for r in history if r.iteration == result.iterations - 1)
    assert sorted(r.id for r in result.assignments.collect()) == local[0]


def history_of(result):
    return sorted(tuple(map(str, r)) for r in result.history.collect())


def test_partitioning_and_order_do_not_matter(points, centroids):
    """Not even in the last bit."""
    found = [lloyd(points.orderBy(F.desc("id")).repartition(n), centroids, max_iter=4) for n in (1, 7, 64)]
    histories = [history_of(r) for r in found]
    assert histories[0] == histories[1] == histories[2]
    means = []
    for n in (1, 7, 64):
        assigned = assign(points.repartition(n), centroids, with_vectors=True).persist()
        means.append(matrix_of(update_centroids(assigned, centroids)).tobytes())
    assert len(set(means)) == 1


def test_a_run_goes_on_after_its_last_committed_turn(spark, points, centroids, tmp_path, monkeypatch):
    whole = lloyd(points, centroids)
    assert whole.iterations > 4
    path = str(tmp_path / "run")
    lloyd(points, centroids, max_iter=3, run=path)
    # What a lost driver had not committed.
    (tmp_path / "run" / "turn-000004-history-lost").mkdir()
    (tmp_path / "run" / "turn-000004-history-lost" / "part-0.parquet").write_bytes(b"cut off")
    (tmp_path / "run" / ".turn-000004-lost").write_text("{")
    assert sorted(tuple(map(str, r)) for r in run_history(spark, path).collect()) == [r for r in history_of(whole) if int(r[0]) <= 3]
    steps, plain = [], dense._step
    monkeypatch.setattr(dense, "_step", lambda *a: steps.append(1) or plain(*a))
    again = lloyd(points, centroids, run=path)
    assert history_of(again) == history_of(whole) and again.converged
    assert len(steps) == whole.iterations - 3
    done = lloyd(points, centroids, run=path)
    assert history_of(done) == history_of(whole) and done.iterations == whole.iterations == 3 + len(steps)
    with pytest.raises(ValueError, match="another run"):
        lloyd(points, centroids, tol=0.5, run=path)
    with pytest.raises(ValueError, match="no turn"):
        run_history(spark, str(tmp_path))


def jobs_of(spark, work):
    """How many jobs ``work`` starts."""
    name = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


@pytest.fixture(scope="module")
def grouped(spark):
    """Points in separate groups."""
    rng = np.random.default_rng(8)
    middle = rng.normal(scale=20.0, size=(30, 6))
    x = middle[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 6))
    x[11] = x[12]
    return x, spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>").persist()


def test_pruning_changes_nothing(grouped):
    x, points = grouped
    seeds = choose_centroids(points, 40)
    plain, pruned = (lloyd(points, seeds, prune=p) for p in (False, True))
    assert plain.iterations > 3 and history_of(plain) == history_of(pruned)
    assert sorted(rows_of(plain.assignments)) == sorted(rows_of(pruned.assignments))
    assert set(plain.spared) == {0.0} and max(pruned.spared) > 0.8


def test_many_picks_of_one_pass(spark, grouped):
    x, points = grouped
    found = []
    jobs = jobs_of(spark, lambda: found.append(choose_centroids(points, 100)))
    picked, least = [0], np.full(len(x), np.inf)
    while len(picked) < 100:
        least = np.minimum(least, np.sqrt(((x - x[picked[-1]]) ** 2).sum(1)))
        picked.append(int(least.argmax()))
    assert [r.id for r in found[0].orderBy("cluster_id").collect()] == picked
    assert jobs < 100


def test_centroids_beyond_the_budget(points, spark, monkeypatch):
    """Blocks of a few centroids: the same nearest ones, and the same iterations."""
    many = choose_centroids(points, 60).select("cluster_id", "v")
    tied = many.unionByName(many.where("cluster_id < 5").selectExpr("cluster_id + 100 AS cluster_id", "v"))
    small = 64 * 8 * 9
    held = []
    monkeypatch.setattr(dense, "_collect_centroids", lambda c, plain=dense._collect_centroids: held.append(plain(c)) or held[-1])
    with_null = points.unionByName(spark.createDataFrame([(-1, None)], points.schema))
    assert sorted(rows_of(assign(with_null, tied, budget=small)), key=str) == sorted(rows_of(assign(with_null, tied)), key=str)
    assert max(k.matrix.nbytes for k in held[:-1]) <= small and len(held) > 7
    one, two = lloyd(points, many, max_iter=2), lloyd(points, many, max_iter=2, budget=small)
    assert matrix_of(two.centroids) == pytest.approx(matrix_of(one.centroids), abs=1e-12)
    key = lambda r: sorted((h.iteration, h.cluster_id, h["size"], round(h["shift"], 9), round(h.cost, 9)) for h in r.history.collect())
    assert key(one) == key(two)
    few = points.where("id < 20")
    assert sorted(rows_of(centroid_distances(few, many, budget=small))) == sorted(rows_of(centroid_distances(few, many)))
    with pytest.raises(ValueError, match="larger than the budget"):
        assign(points, many, budget=100)


def test_rounding_and_iteration_limit(points, centroids):
    result = lloyd(points, centroids, tol=0.0, max_iter=2, round_digits=5)
    assert result.iterations == 2 and not result.converged
    assert (matrix_of(result.centroids) == matrix_of(result.centroids).round(5)).all()


def test_an_empty_cluster_keeps_its_centroid(spark):
    points = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, v array<double>")
    start = spark.createDataFrame([(0, [0.4]), (1, [99.0])], "cluster_id int, v array<double>")
    result = lloyd(points, start)
    assert sorted(rows_of(result.centroids)) == [(0, [0.5]), (1, [99.0])]


def test_duplicate_score_is_an_error(spark):
    scores = spark.createDataFrame([("p", "a", 1.0), ("p", "a", 2.0)], "product_id string, term string, tfidf double")
    dictionary = spark.createDataFrame([("a", 0), ("b", 1)], "term string, term_index int")
    with pytest.raises(Exception, match="two scores"):
        vectorize(scores, dictionary).collect()


def test_no_points_move_between_tasks(points, centroids):
    plan = assign(points, centroids)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_all_seeds_are_kept_and_may_come_from_a_file(points, centroids):
    rows = choose_centroids(points, 2, seeds=points.where("id < 4")).collect()
    assert [r.id for r in rows] == [0, 1, 2, 3]
    known = centroids.where("cluster_id < 2").select("cluster_id", "v")
    going_on = choose_centroids(points, 4, seeds=known).orderBy("cluster_id").collect()
    expected = centroids.orderBy("cluster_id").collect()
    assert [r.id for r in going_on] == [None, None, expected[2].id, expected[3].id]
    assert [r.min_distance for r in going_on[2:]] == [r.min_distance for r in expected[2:]]


def test_stored_distances_change_nothing(points, centroids, monkeypatch):
    monkeypatch.setattr("plotweave.operators.dense.PICKS_PER_STORE", 2)
    rows = lambda df: [(r.cluster_id, r.id, r.min_distance) for r in df.orderBy("cluster_id").collect()]
    assert rows(choose_centroids(points, 4)) == rows(centroids)


def test_blocks_of_centroids_change_nothing(points, centroids, monkeypatch):
    whole = sorted(rows_of(assign(points, centroids)))
    monkeypatch.setattr("plotweave.operators.dense.CENTROID_VALUES", 1)
    assert sorted(rows_of(assign(points, centroids))) == whole


def test_update_reads_the_points_once(points, spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    seeds = choose_centroids(table, 3)
    plan = update_centroids(assign(table, seeds, with_vectors=True), seeds)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("MapInArrow") == 1
