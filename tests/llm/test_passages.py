"""Removal of repeated passages against a plain reading of the rule."""

import hashlib
import random
import re

import duckdb
import pytest

from plotweave.llm import passages

SPACES = re.compile("[\x20\x09-\x0d]+")


def brute(docs, width=50):
    texts = [(i, [w for w in SPACES.split(t or "") if w]) for i, t in docs]
    order = lambda i: passages.LAST if i is None else i
    least = {}
    for i, words in texts:
        for k in range(len(words) - width + 1):
            window = tuple(words[k : k + width])
            least[window] = min(least.get(window, passages.LAST), order(i))
    out = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - width + 1):
            if least[tuple(words[k : k + width])] < order(i):
                gone |= set(range(k, k + width))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((str(i), len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def cut(docs):
    rows = passages.remove_passages(docs).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in rows)


def test_odd_rows(corpus):
    assert cut(corpus) == brute([(r.doc_id, r.text) for r in corpus.collect()])


def test_empty(empty):
    assert passages.remove_passages(empty).collect() == []


def planted(seed):
    """Passages around the limit in many surroundings, periodic texts, copies, odd spaces."""
    pick = random.Random(seed)
    word = lambda: pick.choice(["a", "b"]) if seed == 0 else f"w{pick.randrange(500)}é"
    text = lambda n: [word() for _ in range(n)]
    shared = [text(n) for n in (48, 49, 50, 51, 60, 130)] + [["x", "y"] * 60, ["z"] * 120, ["long" * 40] * 70]
    out = []
    for _ in range(120):
        parts = [text(pick.randrange(0, 80)) if pick.random() < 0.5 else pick.choice(shared) for _ in range(5)]
        out.append(pick.choice([" ", "\n", " \t ", "\x0b"]).join(w for p in parts for w in p))
    ids = list(range(100)) + [pick.randrange(100) for _ in range(15)] + [None] * 5
    pick.shuffle(ids)
    return list(zip(ids, out))


@pytest.mark.parametrize("seed,most", [(0, 256), (1, 256), (2, 3), (3, 3)])
def test_passages_in_many_surroundings(spark, monkeypatch, seed, most):
    monkeypatch.setattr(passages, "MOST_KINDS", most)
    docs = planted(seed)
    assert cut(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_sql_twin(spark, sf_dir):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    rows = passages.op13_passages(spark, sf_dir)
    expected = connection.sql(passages.ORACLES["op13_passages"])
    assert rows.columns == expected.columns
    assert sorted(map(tuple, rows.collect())) == sorted(expected.fetchall())


def test_a_string_has_one_verdict(spark, monkeypatch):
    """Strings whose windows have several smallest documents meet each copy once."""
    base = [f"w{k}" for k in range(400)]
    docs = [(k, " ".join(base[7 * k : 7 * k + 55])) for k in range(40)] + [(100 + k, " ".join(base)) for k in range(20)]
    stored, stage = [], passages.stage

    def kept(table, name):
        stored.append((name, stage(table, name)))
        return stored[-1][1]

    monkeypatch.setattr(passages, "stage", kept)
    assert cut(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)
    verdicts = [t for name, t in stored if name == "verdicts"]
    assert verdicts and all(v.count() == v.select("key").distinct().count() for v in verdicts)
    assert max(v.selectExpr("max(size(runs))").first()[0] or 0 for v in verdicts) > 1


def test_copies_are_dealt_anew_once(spark, monkeypatch):
    """A full bucket's strings go on to longer runs once each, however many copies they have."""
    monkeypatch.setattr(passages, "MOST_KINDS", 3)
    common = [f"w{k}" for k in range(70)]
    texts = [" ".join([*(f"a{j}x{k}" for k in range(30)), *common, *(f"b{j}x{k}" for k in range(30))]) for j in range(12)]
    stage, rows = passages.stage, []

    def kept(table, name):
        stored = stage(table, name)
        rows.append((name, stored.count()))
        return stored

    monkeypatch.setattr(passages, "stage", kept)
    dealt = []
    for copies in (2, 6):
        rows.clear()
        docs = [(100 * c + j, text) for c in range(copies) for j, text in enumerate(texts)]
        assert cut(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)
        first, *again = [n for name, n in rows if name == "super_kmers"]
        assert first >= copies * len(texts) and len(again) == len(passages.GRAMS) - 1
        dealt.append(again)
    assert dealt[0] == dealt[1]


def test_full_buckets_take_one_more_dealing(spark, monkeypatch):
    """Near copies need a fixed number of stored tables; windows side by side with one verdict are one run."""
    monkeypatch.setattr(passages, "MOST_KINDS", 3)
    base = [f"w{k}" for k in range(160)]
    docs = []
    for j in range(40):
        words = list(base)
        words[j * 31 % 160] = f"own{j}"
        docs.append((j, " ".join(words)))
    stored, stage = [], passages.stage

    def kept(table, name):
        stored.append((name, stage(table, name)))
        return stored[-1][1]

    monkeypatch.setattr(passages, "stage", kept)
    assert cut(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)
    names = [name for name, _ in stored]
    assert names == ["super_kmers", "shared_buckets", "live_super_kmers", "kinds", "super_kmers", "shared_windows", "verdicts"]
    runs = [r.runs for r in stored[-1][1].collect()]
    assert max(len(r) for r in runs) > 1 and max(w.n for r in runs for w in r) > 1
    assert not any(a.first + a.n == b.first and a.least == b.least for r in runs for a, b in zip(r, r[1:]))
