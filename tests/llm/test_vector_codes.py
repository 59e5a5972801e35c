"""Vector codes against plain integer arithmetic."""

import hashlib
import itertools
import random

import duckdb
import numpy as np
import pytest

from plotweave.llm import vector_codes as codes


def brute(rows, entries=64, parts=16, rounds=2):
    """``rows`` are id, label, vector."""
    kept = [r for r in rows if r[2] is not None and all(x is not None and np.isfinite(x) for x in r[2])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    whole = [[int(np.floor(256 * float(np.float32(x)))) for x in v] for _, _, v in kept]
    width = len(whole[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    square = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    nearest = lambda x, book: min((square(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            members = [[] for _ in book]
            for c in cut:
                members[nearest(c[p], book)[1]].append(c[p])
            books[p] = [tuple(sum(x) // len(m) for x in zip(*m)) if m else e for m, e in zip(members, book)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for (i, label, _), c in zip(kept, cut):
        near = [nearest(x, b) for x, b in zip(c, books)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in near), sum(d for d, _ in near)))
    sums = {label: sum(r[3] for r in out if r[1] == label) for label in {r[1] for r in out}}
    return sorted([(str(i), c, e, sums[label], digest) for i, label, c, e in out])


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")


def found(docs):
    coded, books = codes.compress(docs)
    digest = hashlib.sha256(codes.codebooks_text(books).encode()).hexdigest()
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, digest) for r in codes.with_label_errors(coded).collect())


@pytest.mark.parametrize("n,spread,slice_values", [(300, 1.0, 1 << 20), (500, 0.02, 64 * 32), (40, 1.0, 64 * 32), (700, 30.0, 64 * 128)])
def test_equals_plain_arithmetic(spark, monkeypatch, n, spread, slice_values):
    """Clustered and tied vectors, rows to drop, repeated rows and ids, labels that are null."""
    monkeypatch.setattr(codes, "SLICE_VALUES", slice_values)
    pick = random.Random(n)
    vector = lambda: [float(np.float32(pick.gauss(pick.choice([0, spread]), spread))) for _ in range(32)]
    rows = [(k, pick.choice([None, 1, 2, 3]), vector()) for k in range(n)]
    rows += [(7, 1, rows[7][2]), (7, 2, vector()), (None, None, vector())]
    odd = [None, [None] * 32, [float("nan")] * 32, [1.0] * 31 + [float("-inf")]]
    rows += [(-k - 1, 4, v) for k, v in enumerate(odd)] + [(1000, 5, [0.0] * 32), (1001, 5, [-0.001] * 32)]
    pick.shuffle(rows)
    docs = table(spark, rows)
    extra = docs.selectExpr("*", "1 AS code", "'x' AS error", "2 AS label_error")
    assert found(extra) == brute(rows)


def test_lengths_and_sizes_that_do_not_fit(spark):
    for vectors in ([[0.5] * 32, [0.5] * 16], [[0.5] * 20], [[]], [[1e30] * 32]):
        with pytest.raises(Exception, match="components|component"):
            codes.compress(table(spark, [(k, 1, v) for k, v in enumerate(vectors)]))


def test_empty(spark):
    coded, books = codes.compress(table(spark, []))
    assert books is None and codes.with_label_errors(coded).collect() == []
    assert codes.compress(table(spark, [(1, 1, None)]))[1] is None


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = codes.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    along = cells[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_boxes_spare_distances():
    """Sums from boxes alone where a block has one entry, and fewer distances elsewhere."""
    pick = np.random.default_rng(1)
    values = np.concatenate([pick.normal(m, 3, (2000, 32)) for m in (-900, 0, 900)]).astype("int64")
    blocks = codes.Blocks(values)
    books = np.stack([p[pick.choice(len(values), 64)] for p in blocks.values])
    sizes, totals, computed = codes.round_sums(blocks, blocks.boxes(), books)
    assert computed < 0.5 * values.shape[0] * 16 * 64
    for p in range(16):
        d = ((blocks.values[p][:, None] - books[p][None]) ** 2).sum(2).argmin(1)
        assert (np.bincount(d, minlength=64) == sizes[p]).all()
        assert all((blocks.values[p][d == k].sum(0) == totals[p, k]).all() for k in range(64))


def test_sql_twin(spark, sf_dir):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    rows = codes.op12_vector_codes(spark, sf_dir)
    expected = connection.sql(codes.ORACLES["op12_vector_codes"])
    assert rows.columns == expected.columns
    assert sorted(map(tuple, rows.collect())) == sorted(expected.fetchall())
