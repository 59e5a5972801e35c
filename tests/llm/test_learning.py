"""Toxicity, quality, neighbours and the pipeline."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from plotweave.llm import neighbours, quality, toxicity
from plotweave.llm.common import held_out
from plotweave.llm.registry import oracles, queries
from plotweave.llm.token_ids import default_path


def auc(labels, scores):
    y = np.array(labels)
    rank = np.argsort(np.argsort(np.array(scores) + 0.0, kind="stable")) + 1.0
    for s in set(scores):
        at = np.array(scores) == s
        rank[at] = rank[at].mean()
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


# -- toxicity --------------------------------------------------------------------------


def brute_segments(scores):
    """Ruzzo and Tompa's definition: the best segment, then the same to its left and right."""
    if not len(scores):
        return []
    best, at = 0.0, None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = sum(scores[a:b])
            if s > best + 1e-12:
                best, at = s, (a, b)
    if at is None:
        return []
    a, b = at
    left = brute_segments(scores[:a])
    right = [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]
    return left + [(a, b, best)] + right


def test_segments_are_the_maximal_ones():
    pick = random.Random(4)
    for _ in range(300):
        scores = [pick.choice([-3.0, -2.0, -1.0, -0.7, 0.3, 1.1, 2.0, 4.0]) + pick.random() * 0.01 for _ in range(pick.randint(0, 14))]
        found = toxicity.segments(np.array(scores))
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in brute_segments(scores)]
        assert all(abs(s - sum(scores[a:b])) < 1e-9 for a, b, s in found)


def insults(spark, n=1500):
    pick = random.Random(9)
    plain = [f"word{k}" for k in range(300)]
    rude = ["blarg", "blargish", "zorky", "fnurd"]
    rows = []
    for i in range(n):
        text = [pick.choice(plain) for _ in range(pick.randrange(20, 120))]
        bad = pick.random() < 0.2
        if bad:
            at = pick.randrange(len(text))
            text[at:at] = [pick.choice(rude) for _ in range(4)]
        rows.append((i, " ".join(text), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxic_passages_are_found_and_scored(spark):
    rows = insults(spark)
    model = toxicity.train(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    assert {"blarg", "zorky", "fnurd"} <= set(model.scores)
    scored = {r.doc_id: r for r in toxicity.score_toxicity(rows, model).collect()}
    out = [r for r in rows.select("*", held_out(F.col("doc_id")).alias("h")).collect() if r.h]
    assert auc([r.toxic for r in out], [scored[r.doc_id].score for r in out]) > 0.99
    for r in out:
        words = r.text.split()
        found = {k for p in scored[r.doc_id].passages for k in range(p.start, p.end)}
        assert {k for k, w in enumerate(words) if not w.startswith("word")} == found


def test_toxicity_of_odd_rows(spark, corpus, empty):
    rows = insults(spark, 400)
    model = toxicity.train(rows, rows.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")))
    scored = toxicity.score_toxicity(corpus, model).collect()
    assert len(scored) == corpus.count() and all(0 <= r.score <= 1 for r in scored)
    by_text = {}
    for r in scored:
        by_text.setdefault((r.doc_id, r.n_words), set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert toxicity.score_toxicity(empty, model).count() == 0
    nothing = toxicity.train(corpus, rows.where("false").select("doc_id", "toxic"))
    assert {r.score for r in toxicity.score_toxicity(corpus, nothing).collect()} == {0.0}


def test_extreme_value_fit_finds_the_parameters():
    """Texts without a segment only say that their best score is below the least one."""
    rng = np.random.default_rng(2)
    n = rng.integers(20, 3000, 6000)
    for k, rate in ((0.02, 1.3), (0.004, 0.6), (0.3, 3.0)):
        best = (np.log(k * n) - np.log(-np.log(rng.random(len(n))))) / rate
        seen = np.where(best > 0.4, best, 0.0)
        found = toxicity.extreme_value_fit(n, seen)
        assert found == pytest.approx((k, rate), rel=0.12)
    assert toxicity.extreme_value_fit(np.array([10, 20]), np.zeros(2))[1] == 1.0


def test_chances_hold_on_clean_text_that_chose_nothing():
    """The share of held-out texts with a chance below each level is that level."""
    rng = np.random.default_rng(3)
    value = {f"w{j}": v for j, v in enumerate(rng.uniform(1.0, 4.0, 40))}
    words = np.array([*value, *[f"x{j}" for j in range(400)]])
    scanner = toxicity._Scanner(value)

    def scanned(texts):
        found = scanner.scan(pa.array([" ".join(rng.choice(words, n)) for n in texts]))
        return np.array([n for n, _ in found]), np.array([max((s for *_, s in x), default=0.0) for _, x in found])

    n, best = scanned(rng.integers(50, 400, 3000))
    k, rate = toxicity.extreme_value_fit(n, best)
    n, best = scanned(rng.integers(50, 400, 6000))
    chance = 1.0 - np.exp(-k * n * np.exp(-rate * best))
    for level in (0.2, 0.1, 0.05, 0.02):
        share = (chance < level).mean()
        assert abs(share - level) < 4 * (level * (1 - level) / len(n)) ** 0.5 + 0.15 * level


def test_strongly_toxic_texts_do_not_tie(spark):
    rows = insults(spark)
    model = toxicity.train(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    texts = [(k, "word1 word2 " + "blarg zorky fnurd " * 4**k) for k in range(6)]
    scored = toxicity.score_toxicity(spark.createDataFrame(texts, "doc_id long, text string"), model).orderBy("doc_id").collect()
    evidence = [-sum(p.log_chance for p in r.passages) for r in scored]
    assert all(a < b for a, b in zip(evidence, evidence[1:])) and evidence[-1] > 1000
    assert all(a.score <= b.score for a, b in zip(scored, scored[1:])) and len({r.score for r in scored}) > 3


def test_held_out_fold(spark):
    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_held_out_labels_are_not_learned_from(spark):
    rows = insults(spark, 600)
    turned = rows.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    models = [toxicity.train(rows.select("doc_id", "text"), x.select("doc_id", "toxic")) for x in (rows, turned)]
    assert models[0] == models[1]


# -- quality ---------------------------------------------------------------------------


def test_gradients_are_right():
    rng = np.random.default_rng(1)
    n = quality.N_FEATURES
    x, counts, y = rng.normal(size=(9, n)), np.array([2, 4, 3]), np.array([1.0, 0.0, 1.0])
    h, a = 5, 4
    w = [rng.normal(size=s) * 0.3 for s in ((n, h), (h,), (h, a), (h, a), (a,), (h,), (1,))]
    loss = lambda w: float(np.mean(np.log1p(np.exp((1 - 2 * y) * quality._forward(tuple(w), x, counts)["logit"]))))
    for i, d in enumerate(quality._gradients(tuple(w), x, counts, y)):
        for at in [tuple(rng.integers(0, s) for s in w[i].shape) for _ in range(4)]:
            up, down = [v.copy() for v in w], [v.copy() for v in w]
            up[i][at] += 1e-6
            down[i][at] -= 1e-6
            assert abs((loss(up) - loss(down)) / 2e-6 - np.asarray(d)[at]) < 1e-6


def test_passages_cover_the_whole_text():
    texts = ["", None, "a" * 255, "b" * 256, "c" * 257, "é" * 1000]
    x, counts = quality.encode_passages(pa.array(texts))
    assert counts.tolist() == [1, 1, 1, 1, 2, 8] and x.shape == (14, quality.N_FEATURES) and np.isfinite(x).all()
    sliced, _ = quality.encode_passages(pa.array(texts).slice(2, 2))
    assert np.allclose(sliced, x[2:4])


def test_quality_held_out(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/../sf0.1/labels.parquet").collect()}
    rows = [r for r in quality.op6_quality(spark, f"{sf_dir}/../sf0.1").collect() if r.held_out and r.doc_id in labels]
    assert auc([labels[r.doc_id] for r in rows], [r.score for r in rows]) > 0.98
    assert np.mean([labels[r.doc_id] == r.predicted for r in rows]) > 0.97


def test_toxicity_held_out(spark, sf_dir):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/../sf0.1/labels.parquet").collect()}
    rows = [r for r in toxicity.op5_toxicity(spark, f"{sf_dir}/../sf0.1").collect() if r.held_out and r.doc_id in labels]
    assert auc([labels[r.doc_id] for r in rows], [r.score for r in rows]) > 0.85
    assert np.mean([labels[r.doc_id] == r.predicted for r in rows]) > 0.95


def test_quality_of_odd_rows(spark, corpus, empty, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    rows = quality.score_quality(corpus, model)
    assert rows.count() == corpus.count() and rows.where("score between 0 and 1").count() == corpus.count()
    assert set(corpus.columns) <= set(rows.columns)
    kept = quality.keep_good(corpus, model)
    assert kept.columns == corpus.columns and {r.score for r in kept.collect()} <= {-1}
    assert quality.score_quality(empty, model).count() == 0
    assert not quality.train(docs, labels.where("false")).trained
    assert quality.score_quality(corpus, quality.train(empty, labels)).count() == corpus.count()


def test_training_takes_whole_texts(spark, monkeypatch):
    """Bags of all passages, no more than allowed together, and repeated rows once."""
    bags = []
    plain = quality.fit
    monkeypatch.setattr(quality, "fit", lambda b, y: bags.append([len(x) for x in b]) or plain(b, y))
    rows = [(k, "good words here " * 16 * (200 if k % 4 else 1)) for k in range(40)]
    docs = spark.createDataFrame(rows + rows[:10] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(40)], "doc_id long, quality int")
    fold = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5]
    quality.train(docs, labels)
    assert sorted(bags[0]) == sorted(200 if k % 4 else 1 for k in fold)
    quality.train(docs, labels, passages=1000)
    assert 600 < sum(bags[1]) <= 1000 and set(bags[1]) <= {1, 200}


# -- neighbours ------------------------------------------------------------------------


def brute_neighbours(rows, is_query, k=5):
    good = [(i, np.array(v, float) / np.abs(np.array(v, float)).max()) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if is_query(i):
            near = [(-float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w))), j) for j, w in good if j != i and len(w) == len(v)]
            out[i] = sorted((round(s, 9), j) for s, j in near)[:k]
    return out


def test_rotations_keep_lengths():
    x = np.random.default_rng(0).normal(size=(20, 50))
    assert np.allclose(np.linalg.norm(neighbours.rotated(x, 3, 1), axis=1), np.linalg.norm(x, axis=1))
    axes = neighbours.buckets(x, 0, 1, 4)
    assert axes.shape == (20, 4) and (axes[:, 0] != axes[:, 1]).all()


def test_odd_vectors_and_ties(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_VECTORS", 16)
    monkeypatch.setattr(neighbours, "CELL_QUERIES", 4)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    rows += [(200 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(40)]
    rows += [(300, None), (310, []), (320, [0.0] * 6), (330, [float("nan")] * 6), (340, [float("inf")] + [1.0] * 5), (350, [None] + [1.0] * 5), (None, [1.0] * 6)]
    rows += [(400, [1.0, 2.0]), (401, [2.0, 1.0]), (402, [1e200, 1e200]), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("class_id", F.lit("x"))
    # All buckets are probed, so the result must be the exact one.
    found = neighbours.search(docs, F.col("vec_id") % 10 == 0, probes=1000).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query.setdefault(r.query_id, []).append((round(-r.score, 9), r.vec_id))
    expected = brute_neighbours(list({i: (i, v) for i, v in rows}.values()), lambda i: i % 10 == 0)
    assert {q: [s for s, _ in x] for q, x in by_query.items()} == {q: [s for s, _ in x] for q, x in expected.items() if x}
    assert [j for _, j in by_query[200]] == [201, 202, 203, 204, 205] and [j for _, j in by_query[210]] == [200, 201, 202, 203, 204]
    assert neighbours.search(docs.where("false"), F.col("vec_id") % 10 == 0).count() == 0


def test_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/../sf0.1/embeddings.parquet")
    expected = brute_neighbours([(r.vec_id, list(r.embedding)) for r in table.collect()], lambda i: i % 50 == 0)
    found = {}
    for r in neighbours.op9_neighbours(spark, f"{sf_dir}/../sf0.1").collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = [len({j for _, j in near} & found[q]) / len(near) for q, near in expected.items()]
    assert set(found) == set(expected) and np.mean(hits) >= 0.9


def listed(found):
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((round(-r.score, 9), r.vec_id))
    return out


def test_ties_of_many_multiples_go_to_the_smallest_ids(spark):
    """Multiples of one vector by powers of two have one cosine with each other."""
    base = [0.3, -1.7, 2.2, 0.9, 0.1, -0.4, 1.1, 3.3]
    rows = [(k, [x * 2.0 ** (k % 37) for x in base]) for k in range(1, 300)]
    random.Random(4).shuffle(rows)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = listed(neighbours.search(table, F.col("vec_id") % 50 == 0).collect())
    for q, near in found.items():
        assert [i for _, i in near] == [1, 2, 3, 4, 5], q


def test_small_tables_and_isolated_queries_have_all_neighbours(spark, tmp_path):
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 6, 10, 20):
        rows = [(i * 50, rng.normal(size=64).tolist()) for i in range(n)]
        spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/{n}/embeddings.parquet")
        found = listed(neighbours.op9_neighbours(spark, f"{tmp_path}/{n}").collect())
        assert {q: len(x) for q, x in found.items()} == {i: min(5, n - 1) for i, _ in rows if n > 1}
        if n <= 6:
            assert found == {q: x for q, x in brute_neighbours(rows, lambda i: True).items() if x}
    # A crowd, one vector away from it, and four of another length.
    crowd = rng.normal(size=64)
    rows = [(i, (crowd + 0.01 * rng.normal(size=64)).tolist()) for i in range(1, 60)]
    rows += [(0, (-crowd).tolist())] + [(100 + 50 * k, rng.normal(size=32).tolist()) for k in range(4)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = listed(neighbours.search(table, F.col("vec_id") % 50 == 0).collect())
    expected = brute_neighbours(rows, lambda i: i % 50 == 0)
    assert {q: len(x) for q, x in found.items()} == {q: len(x) for q, x in expected.items()}
    assert all(found[q] == expected[q] for q in (0, 100, 150, 200, 250) if q in expected)


# -- pipeline and registry -------------------------------------------------------------


def test_stages(spark, corpus, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, sf_dir).persist()
        assert docs.columns == corpus_pipeline.COLUMNS, name
        after = docs.count()
        assert after == before if name == "pii" else 0 < after < before
        before = after
    kept = {r.doc_id for r in docs.collect()}
    pieces = corpus_pipeline.pack_sequences(spark, docs, sf_dir).collect()
    assert {r.doc_id for r in pieces} == kept


def plain_words(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(low)) if w]


def plain_groups(docs):
    """The smallest id that links lead to, by comparing all pairs of shingle sets."""
    sets = {}
    for i, text in docs:
        w = plain_words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((least[a], least[b]))
            least = {i: x if m == y else m for i, m in least.items()}
    return least


def test_stages_against_plain_versions(spark, sf_dir):
    """Near duplicates, decontamination, pseudonyms and packing, each on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = stages["near_duplicates"](spark, docs, sf_dir).persist()
    assert {r.doc_id for r in kept.collect()} == {m for m in plain_groups(texts.items()).values()}
    clean = stages["decontamination"](spark, kept, sf_dir).persist()
    split = lambda t: [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").lower()) if w]
    runs = lambda w, n: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    items = [split(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    long, short = (set().union(*(runs(w, n) for w in items)) for n in (10, 3))
    left = {r.doc_id for r in clean.collect()}
    before = {r.doc_id for r in kept.collect()}
    # What has ten words of an item goes; what has not even three of one in a row stays.
    assert left <= before and not any(runs(split(texts[i]), 10) & long for i in left)
    assert {i for i in before if not runs(split(texts[i]), 3) & short} <= left < before
    private = stages["pii"](spark, clean, sf_dir).persist()
    assert {r.doc_id for r in private.collect()} == left and all(r.n_chars == len(r.text) for r in private.collect())
    # Texts without a digit or a mail address are as they were.
    assert all(r.text == texts[r.doc_id] for r in private.collect() if not re.search("[0-9@]|[0-9a-fA-F]{32}", texts[r.doc_id]))
    encode = Tokenizer.from_file(default_path()).encode
    pieces = {}
    for r in stages["packing"](spark, private, sf_dir).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for r in private.collect():
        assert [x for _, ids in sorted(pieces.pop(r.doc_id)) for x in ids] == [*encode(r.text, add_special_tokens=False).ids, 0]
    assert not pieces


def test_stages_take_odd_rows(spark, corpus, empty, sf_dir):
    clashing = corpus.withColumns({c: F.lit(None).cast("string") for c in ("lang", "source", "text_key", "others", "replaced")})
    clashing = clashing.withColumn("n_chars", F.length("text").cast("long"))
    for name, apply in corpus_pipeline.STAGES[1:]:
        for docs in (clashing, clashing.where("false")):
            out = apply(spark, docs, sf_dir)
            n = out.count()
            if name != "packing":
                assert n <= docs.count() and out.columns == docs.columns


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0


def test_every_operator_is_registered():
    names = set(queries())
    assert {n.split("_")[0] for n in names - {"pipeline"}} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names
    assert set(oracles()) <= names
