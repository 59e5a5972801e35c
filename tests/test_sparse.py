import numpy as np
import pytest
from pyspark.sql import functions as F

from plotweave.operators import sparse
from plotweave.operators.dense import assign, choose_centroids, lloyd
from plotweave.operators.sparse import (
    assign_sparse,
    choose_centroids_sparse,
    coordinates_of,
    centroids_of,
    lloyd_sparse,
    stored_coordinates,
)


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 9)) * (rng.random((120, 9)) < 0.4)
    x[5] = x[17] = x[40]
    x[60] = 0.0
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, v array<double>").persist()


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


def dense_values(centroids):
    return {
        (r.cluster_id, j): x for r in centroids.collect() for j, x in enumerate(r.v) if abs(x) > 1e-12
    }


def sparse_values(centroids):
    return {(r.cluster_id, r.term): r.value for r in centroids.collect() if abs(r.value) > 1e-12}


@pytest.fixture(params=["one block", "many blocks"])
def form(request, monkeypatch):
    if request.param == "many blocks":
        monkeypatch.setattr("plotweave.operators.sparse.BLOCK", 1)
        monkeypatch.setattr("plotweave.operators.sparse.CELL_ROWS", 3)


@pytest.mark.parametrize("budget", [1 << 26, 400])
def test_agrees_with_dense(points, form, budget):
    dense = choose_centroids(points, 4)
    sparse, picks = choose_centroids_sparse(coordinates_of(points), 4, budget=budget)
    assert sparse_values(sparse) == pytest.approx(dense_values(dense))
    assert [r.id for r in picks.orderBy("cluster_id").collect()] == [
        r.id for r in dense.orderBy("cluster_id").collect()
    ]
    a = sorted_rows(assign(points, dense))
    b = sorted_rows(assign_sparse(coordinates_of(points), sparse, budget))
    assert [r[:2] for r in a] == [r[:2] for r in b]
    assert [r[2] for r in b] == pytest.approx([r[2] for r in a], abs=1e-9)
    one = lloyd(points, dense, tol=0.0, max_iter=3)
    two = lloyd_sparse(coordinates_of(points), sparse, tol=0.0, max_iter=3, budget=budget)
    assert sparse_values(two.centroids) == pytest.approx(dense_values(one.centroids), abs=1e-9)
    assert two.iterations == one.iterations
    h1 = sorted_rows(one.history.select("iteration", "cluster_id", "size", F.round("shift", 9)))
    h2 = sorted_rows(two.history.select("iteration", "cluster_id", "size", F.round("shift", 9)))
    assert h1 == h2
    assert sorted_rows(two.assignments.select("id", "cluster_id")) == sorted_rows(
        one.assignments.select("id", "cluster_id")
    )


def test_copies_of_a_centroid_are_not_picked(spark, form):
    rows = [(i, t, v) for i in range(6) for t, v in [("a", 0.1 + i % 2), ("b", 0.7), ("c", 1 / 3)]]
    coordinates = spark.createDataFrame(rows, "id long, term string, value double")
    centroids, picks = choose_centroids_sparse(coordinates, 5)
    assert [r.id for r in picks.orderBy("cluster_id").collect()] == [0, 1]


def test_given_seeds(points):
    _, picks = choose_centroids_sparse(coordinates_of(points), 3, seeds=[7, 3])
    dense = choose_centroids(points, 3, seeds=points.where("id in (3, 7)"))
    assert [r.id for r in picks.orderBy("cluster_id").collect()] == [
        r.id for r in dense.orderBy("cluster_id").collect()
    ]


def test_empty_cluster_keeps_its_centroid(spark, form):
    coordinates = spark.createDataFrame([("x", "a", 1.0), ("y", "a", 2.0)], "id string, term string, value double")
    start = spark.createDataFrame([(0, "a", 1.4), (1, "b", 50.0)], "cluster_id int, term string, value double")
    result = lloyd_sparse(coordinates, start)
    assert result.converged
    assert sorted_rows(result.centroids) == [(0, "a", 1.5), (1, "b", 50.0)]
    assert sorted_rows(result.history.select("iteration", "cluster_id", "size")) == [
        (1, 0, 2), (1, 1, 0), (2, 0, 2), (2, 1, 0),
    ]


def test_a_point_on_its_centroid_and_ties(spark):
    """Long vectors: distance 0 on the centroid itself, and dense and sparse agree on ties."""
    rng = np.random.default_rng(5)
    x = rng.normal(scale=100.0, size=(40, 300))
    points = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    centre = rng.normal(size=300)
    rows = [(3, x[7].tolist()), (1, (centre + 1).tolist()), (2, (centre + 1).tolist())]
    centroids = spark.createDataFrame(rows, "cluster_id int, v array<double>")
    dense = sorted_rows(assign(points, centroids))
    sparse = sorted_rows(assign_sparse(coordinates_of(points), centroids_of(centroids)))
    assert sparse[7] == (7, 3, 0.0)
    assert [r[:2] for r in sparse] == [r[:2] for r in dense]
    assert [r[2] for r in sparse] == pytest.approx([r[2] for r in dense], abs=1e-9)
    assert {r[1] for r in sparse} == {1, 3}


def test_seeds_are_kept_checked_and_may_be_centroids(points):
    coordinates = coordinates_of(points)
    _, picks = choose_centroids_sparse(coordinates, 2, seeds=[1, 2, 3, 4])
    assert [r.id for r in picks.orderBy("cluster_id").collect()] == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="no points"):
        choose_centroids_sparse(coordinates, 2, seeds=[9999])
    dense = choose_centroids(points, 2).select("cluster_id", "v")
    expected = choose_centroids(points, 4).orderBy("cluster_id").collect()
    _, picks = choose_centroids_sparse(coordinates, 4, seeds=centroids_of(dense))
    found = picks.orderBy("cluster_id").collect()
    assert [r.id for r in found] == [None, None, expected[2].id, expected[3].id]
    assert [r.min_distance for r in found[2:]] == pytest.approx([r.min_distance for r in expected[2:]])


def test_history_has_every_turn(points):
    coordinates = coordinates_of(points)
    start, _ = choose_centroids_sparse(coordinates, 3)
    result = lloyd_sparse(coordinates, start)
    turns = {r.iteration for r in result.past_centroids.select("iteration").distinct().collect()}
    assert result.converged and turns == set(range(1, result.iterations + 1))
    costs = [r.c for r in result.history.groupBy("iteration").agg(F.sum("cost").alias("c")).orderBy("iteration").collect()]
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))
    rounded = lloyd_sparse(coordinates, start, round_digits=5)
    assert all(r.value == round(r.value, 5) for r in rounded.centroids.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_below_the_sum_per_point(points):
    """Coordinates lie by point: a distance is summed where they are."""
    coordinates = stored_coordinates(coordinates_of(points))
    centroids, _ = choose_centroids_sparse(coordinates, 3)
    plan = plan_of(assign_sparse(coordinates, centroids))
    assert plan.count("HashAggregate") >= 1 and "Bucketed: true" in plan
    # What is broadcast is the block of centroids.
    assert plan.replace("BroadcastExchange", "").count("Exchange") == 0
    placed = sparse._placed(sparse._nearest(coordinates, centroids, [0, 1, 2], 1e-9, 1 << 26))
    members = plan_of(sparse.update_sparse(coordinates, placed, centroids)).split("total_high")[-1]
    assert "ShuffledHashJoin" in members and "Exchange" not in members.split("ShuffledHashJoin")[1].split("BroadcastExchange")[0]


def test_a_large_point_has_several_cells(spark, monkeypatch):
    monkeypatch.setattr(sparse, "CELL_ROWS", 50)
    rows = [("big", f"t{k}", float(k % 7)) for k in range(1000)] + [("small", "t3", 1.0), ("other", "t5", 2.0)]
    laid = stored_coordinates(spark.createDataFrame(rows, "id string, term string, value double"))
    cells = laid.groupBy("id", "cell").count().collect()
    assert max(r["count"] for r in cells) < 100 and sum(r.id == "big" for r in cells) == 20
    start = spark.createDataFrame([(0, "t3", 1.0), (1, "t4", 4.0)], "cluster_id int, term string, value double")
    norm = sum(v * v for _, _, v in rows[:1000])
    expected = {"big": (1, (norm - 16.0) ** 0.5), "small": (0, 0.0), "other": (0, 5**0.5)}
    found = {r.id: (r.cluster_id, r.distance) for r in assign_sparse(laid, start).collect()}
    assert found == {i: (c, pytest.approx(d)) for i, (c, d) in expected.items()}
    result = lloyd_sparse(laid, start)
    assert {(r.term, r.value) for r in result.centroids.where("cluster_id = 1 AND term = 't6'").collect()} == {("t6", 6.0)}


def exact_rows(df):
    return sorted(tuple(map(repr, r)) for r in df.collect())


def test_partitions_and_order_do_not_matter(points, spark):
    """The same bits, and as many turns."""
    found = []
    for n in (1, 7, 64):
        coordinates = coordinates_of(points.orderBy(F.desc("id")).repartition(n))
        start, picks = choose_centroids_sparse(coordinates, 4)
        result = lloyd_sparse(stored_coordinates(coordinates), start, max_iter=3)
        found.append((exact_rows(result.history), exact_rows(result.past_centroids), exact_rows(picks)))
    assert found[0] == found[1] == found[2]


def test_a_run_goes_on_after_its_last_committed_turn(points, tmp_path, monkeypatch):
    coordinates = stored_coordinates(coordinates_of(points))
    start, _ = choose_centroids_sparse(coordinates, 3)
    whole = lloyd_sparse(coordinates, start)
    assert whole.iterations > 2
    path = str(tmp_path / "run")
    lloyd_sparse(coordinates, start, max_iter=2, run=path)
    (tmp_path / "run" / "turn-000003-centroids-lost").mkdir()
    turns, plain = [], sparse._placed
    monkeypatch.setattr(sparse, "_placed", lambda found: turns.append(1) or plain(found))
    again = lloyd_sparse(coordinates, start, run=path)
    for table in ("history", "past_centroids", "assignments"):
        assert exact_rows(getattr(again, table)) == exact_rows(getattr(whole, table))
    assert len(turns) == whole.iterations - 2 and again.converged
    assert lloyd_sparse(coordinates, start, run=path).iterations == whole.iterations


def test_many_picks_of_one_pass(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 30)) * (rng.random((400, 30)) < 0.5)
    x[9] = x[10]
    points = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    coordinates = stored_coordinates(coordinates_of(points))
    passes, plain = [], sparse._nearest
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sparse, "_nearest", lambda *a: passes.append(1) or plain(*a))
        _, picks = choose_centroids_sparse(coordinates, 40)
    picked, least = [0], np.full(400, np.inf)
    while len(picked) < 40:
        least = np.minimum(least, np.sqrt(((x - x[picked[-1]]) ** 2).sum(1)))
        picked.append(int(least.argmax()))
    assert [r.id for r in picks.orderBy("cluster_id").collect()] == picked
    assert len(passes) < 20
