"""Components against all pairs, and repeats against all strings."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from plotweave.llm import near_duplicates as near
from plotweave.llm import repeats
from plotweave.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOW)) if w]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def expected(docs, n_components=None, similarity=75):
    """(id, set size, smallest id reachable) of each row, by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    if n_components is not None:
        n_components.append(len(set(label)))
    rank = lambda d: (d is not None, d or 0)
    least = {}
    for x, (d, _) in zip(label, docs):
        least[x] = min(least.get(x, d), d, key=rank)
    return sorted(((d, len(s), least[x]) for (d, _), s, x in zip(docs, sets, label)), key=lambda r: tuple(rank(v) for v in r))


def found(rows):
    rank = lambda d: (d is not None, d or 0)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=lambda r: tuple(rank(v) for v in r))


def check(spark, docs):
    rows = near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    n_components = []
    assert found(rows) == expected(docs, n_components)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert sum(r.kept_row for r in rows) == n_components[0]


def test_odd_rows(corpus):
    docs = [(r.doc_id, r.text) for r in corpus.collect()]
    check(corpus.sparkSession, docs)


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(near.op4_near_duplicates(spark, sf_dir).collect()) == expected(docs)


def test_sql_twin(spark, sf_dir):
    import duckdb

    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    rows = near.op4_near_duplicates(spark, sf_dir)
    expected = connection.sql(near.ORACLES["op4_near_duplicates"])
    assert rows.columns == expected.columns
    assert sorted(map(tuple, rows.collect())) == sorted(expected.fetchall())


def test_families_and_a_shared_passage(spark, monkeypatch):
    """Chains of edits, a family larger than a short list, and texts that share one passage."""
    monkeypatch.setattr(near, "SHORT_LIST", 6)
    monkeypatch.setattr(near, "BLOCK", 5)
    pick = random.Random(11)
    word = lambda: f"w{pick.randrange(4000)}"
    passage = [word() for _ in range(60)]
    docs = []
    for family in range(6):
        text = [word() for _ in range(120)]
        for _ in range(12):
            docs.append((len(docs), " ".join(text)))
            # Each copy is edited further, so that only neighbours in the chain are similar.
            text[pick.randrange(120)] = word()
            text[pick.randrange(120)] = word()
    for _ in range(40):
        docs.append((len(docs), " ".join(passage + [word() for _ in range(pick.randrange(15, 40))])))
    check(spark, docs)


def test_threshold_is_exact(spark):
    """Sets of 100 and 75 shingles of which the smaller is a part: exactly 75 %, and just below."""
    words = [f"v{k}" for k in range(104)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:79])), (3, " ".join(words[:78]))]
    rows = near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert found(rows) == expected(docs)


def test_one_row_of_each_group_is_left(corpus):
    rows = near.drop_near_duplicates(corpus)
    assert rows.columns == corpus.columns
    kept = [(r.doc_id, r.text) for r in rows.collect()]
    assert sum(t == corpus.collect()[0].text for _, t in kept) == 1
    assert {r.score for r in rows.collect()} == {-1}


def test_empty(empty):
    assert near.near_duplicates(empty).count() == 0
    assert repeats.repeated_spans(empty).count() == 0


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 100 + k) for k in range(1, 40)] + [(200 + k, 200 + (k + 1) % 9) for k in range(9)]
    random.Random(1).shuffle(edges)
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {n: (0 if n < 100 else 100 if n < 200 else 200) for e in edges for n in e}
    assert len(rows) == len({n for e in edges for n in e})


def brute_cut(texts, length=200):
    data = [(t or "").encode() for t in texts]
    counts = collections.Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        covered = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                covered[k] += 1
                covered[k + length] -= 1
        gone = np.cumsum(covered)[: len(b)] > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def cut(docs):
    rows = repeats.remove_repeats(docs).collect()
    return sorted(
        (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in rows
    )


def test_repeats_of_odd_rows(corpus):
    docs = corpus.where("doc_id is null or doc_id <> 11")
    assert cut(docs) == brute_cut([r.text for r in docs.collect()])


@pytest.mark.parametrize("seed", range(3))
def test_repeats_at_every_length(spark, seed):
    """Shared passages around the limit, at random places, in periodic and in plain text."""
    pick = random.Random(seed)
    letters = "ab" if seed == 0 else "abcdefghij é"
    text = lambda n: "".join(pick.choice(letters) for _ in range(n))
    passages = [text(n) for n in (198, 199, 200, 201, 230, 500)] + ["xy" * 150, "z" * 450, "é" * 150]
    texts = []
    for _ in range(40):
        parts = [text(pick.randrange(0, 300)) if pick.random() < 0.6 else pick.choice(passages) for _ in range(6)]
        texts.append("".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert cut(docs) == brute_cut(texts)


def test_repeats_query(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = repeats.op10_repeats(spark, sf_dir).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == brute_cut(texts)


def test_other_similarities_and_sketches(spark):
    """Links at other thresholds, with sketches of other sizes; too small ones are refused."""
    pick = random.Random(4)
    docs = []
    for _ in range(25):
        text = [f"w{pick.randrange(9000)}" for _ in range(300)]
        for changes in (0, 3, 8, 15, 30):
            copy = list(text)
            for _ in range(changes):
                copy[pick.randrange(300)] = f"x{pick.randrange(9000)}"
            docs.append((len(docs), " ".join(copy)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for similarity, k in ((50, 64), (90, 32), (60, 128)):
        assert found(near.near_duplicates(table, similarity, k=k).collect()) == expected(docs, similarity=similarity)
    with pytest.raises(ValueError, match="too small"):
        near.near_duplicates(table, 30, k=16)
    assert 25 <= near.least_shared(75, 64) <= 27


def test_a_hub_is_sent_to_several_tasks(spark, monkeypatch):
    """One text that many different ones are near."""
    monkeypatch.setattr(near, "HUB", 4)
    pick = random.Random(2)
    base = [f"w{k}" for k in range(200)]
    docs = [(0, " ".join(base))]
    for _ in range(60):
        copy = list(base)
        for _ in range(3):
            copy[pick.randrange(200)] = f"x{pick.randrange(10**6)}"
        docs.append((len(docs), " ".join(copy)))
    check(spark, docs)
