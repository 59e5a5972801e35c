"""The worked example, stage by stage, and properties on the generated tables."""

import math

import pytest
from pyspark.sql import functions as F

from plotweave.operators.counts import max_counts, top_words, word_count
from plotweave.operators.dense import assign, choose_centroids, lloyd, vector_coordinates, vectorize
from plotweave.operators.terms import as_reviews, drop_stop_words, review_term_counts, tokenize
from plotweave.operators.tfidf import (
    document_frequency,
    product_count,
    term_dictionary,
    term_frequency,
    tfidf,
)
from plotweave.plans import flows
from plotweave.session import stage
from plotweave.sources import read_reviews, write_dictionary, write_triples, read_dictionary, read_triples

REVIEWS = [
    ("P1", "Space robots fight; robots win."),
    ("P1", "The robots love space"),
    ("P2", "Synopsis: Love story in Paris"),
    ("P2", "A love story: truncated tail here"),
    ("P3", "Space battle, don't miss"),
    ("P3", "ok"),
    ("P4", "Quiet garden garden"),
    ("P5", "a ok"),
]
TF = {
    ("P1", "fight"): 1 / 5, ("P1", "love"): 1 / 3, ("P1", "robots"): 3 / 8, ("P1", "space"): 2 / 8,
    ("P1", "win"): 1 / 5, ("P2", "love"): 2 / 5, ("P2", "paris"): 1 / 3, ("P2", "story"): 2 / 5,
    ("P3", "battle"): 1 / 3, ("P3", "don"): 1 / 3, ("P3", "space"): 1 / 3, ("P4", "garden"): 2 / 3,
    ("P4", "quiet"): 1 / 3,
}
DICTIONARY = ["battle", "don", "fight", "garden", "love", "paris", "quiet", "robots", "space", "story", "win"]
VECTORS = {
    "P1": "0 0 0.13863 0 0.09589 0 0 0.25993 0.07192 0 0.13863",
    "P2": "0 0 0 0 0.11507 0.23105 0 0 0 0.27726 0",
    "P3": "0.23105 0.23105 0 0 0 0 0 0 0.09589 0 0",
    "P4": "0 0 0 0.46210 0 0 0.23105 0 0 0 0",
}


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def stop(spark):
    return spark.createDataFrame([("the",), ("miss",)], "term string")


@pytest.fixture(scope="module")
def reviews(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("reviews")
    blocks = [f"product/productId: {p}\nreview/score: 4.0\nreview/text: {t}\n" for p, t in REVIEWS]
    (folder / "r.txt").write_text("\n".join(blocks))
    return read_reviews(spark, str(folder)).persist()


@pytest.fixture(scope="module")
def tf(reviews, stop):
    return stage(term_frequency(review_term_counts(reviews, stop)), "tf")


def test_terms(reviews, stop):
    kept = {}
    for r in tokenize(reviews, stop).collect():
        kept.setdefault((r.product_id, r.review_id), []).append(r.term)
    assert sorted(map(" ".join, kept.values())) == sorted([
        "space robots fight robots win", "robots love space", "love story paris", "love story",
        "space battle don", "quiet garden garden",
    ])


def test_word_count_and_top(reviews, stop):
    counts = word_count(reviews, stop)
    assert rows_of(counts) == [
        ("battle", 1), ("don", 1), ("fight", 1), ("garden", 2), ("love", 3), ("paris", 1),
        ("quiet", 1), ("robots", 3), ("space", 3), ("story", 2), ("win", 1),
    ]
    assert [tuple(r) for r in top_words(counts, 3).collect()] == [("love", 3), ("robots", 3), ("space", 3)]
    assert [r.term for r in top_words(counts, 4).collect()] == ["story", "love", "robots", "space"]
    assert rows_of(flows.corpus_top_words(reviews, stop, 2)) == [("robots", 3), ("space", 3)]


def test_counts_per_review(reviews, stop):
    rows = review_term_counts(reviews, stop).collect()
    assert sorted((r.product_id, r.term, r.term_count, r.total_count) for r in rows if r.term == "robots") == [
        ("P1", "robots", 1, 3), ("P1", "robots", 2, 5),
    ]


def test_term_frequency(tf):
    assert {(r.product_id, r.term): r.tf for r in tf.collect()} == pytest.approx(TF)


@pytest.mark.parametrize("budget", [1 << 26, 10])
def test_all_reviews_denominator(reviews, stop, budget):
    found = term_frequency(review_term_counts(reviews, stop), "all_reviews", budget)
    expected = dict(TF)
    expected.update({("P1", t): 1 / 8 for t in ("fight", "win", "love")}, **{})
    expected[("P2", "paris")] = 1 / 5
    assert {(r.product_id, r.term): r.tf for r in found.collect()} == pytest.approx(expected)
    with pytest.raises(ValueError):
        term_frequency(found, "none")


def test_dictionary_and_counts(tf):
    dictionary = term_dictionary(tf).orderBy("term_index").collect()
    assert [tuple(r) for r in dictionary] == [(t, i) for i, t in enumerate(DICTIONARY)]
    assert product_count(tf).first().n_products == 4
    assert ("love", 2) in rows_of(document_frequency(tf)) and ("win", 1) in rows_of(document_frequency(tf))


@pytest.mark.parametrize("budget", [1 << 26, 600])
def test_tfidf(tf, budget):
    found = {(r.product_id, r.term): r.tfidf for r in tfidf(tf, budget).collect()}
    df = {t: sum(1 for _, u in TF if u == t) for t in DICTIONARY}
    assert found == pytest.approx({k: x * math.log(4 / (1 + df[k[1]])) for k, x in TF.items()})


def test_vectors_seeds_and_clusters(tf):
    scores, dictionary = stage(tfidf(tf), "tfidf"), stage(term_dictionary(tf), "dictionary")
    vectors = vectorize(scores, dictionary).persist()
    for r in vectors.collect():
        assert r.v == pytest.approx([float(x) for x in VECTORS[r.id].split()], abs=5e-6)
    sparse = {(r.product_id, r.term_index): r.tfidf for r in vector_coordinates(scores, dictionary).collect()}
    assert sparse == {(r.id, i): x for r in vectors.collect() for i, x in enumerate(r.v) if x}
    centroids = choose_centroids(vectors, 3)
    assert [r.id for r in centroids.orderBy("cluster_id").collect()] == ["P1", "P4", "P2"]
    assert [round(r.min_distance, 6) for r in centroids.orderBy("cluster_id").collect()[1:]] == [0.622323, 0.491728]
    result = lloyd(vectors, centroids)
    assert rows_of(result.assignments.select("id", "cluster_id")) == [("P1", 0), ("P2", 2), ("P3", 0), ("P4", 1)]
    assert rows_of(result.history.select("iteration", "cluster_id", F.round("shift", 6))) == [
        # Half the distance 0.471739 between P1 and P3.
        (1, 0, 0.235869), (1, 1, 0.0), (1, 2, 0.0), (2, 0, 0.0), (2, 1, 0.0), (2, 2, 0.0),
    ]
    mean = "0.11552 0.11552 0.06931 0 0.04795 0 0 0.12997 0.08391 0 0.06931"
    first = result.centroids.where("cluster_id = 0").first().v
    assert first == pytest.approx([float(x) for x in mean.split()], abs=5e-6)
    assert assign(vectors, centroids).where("id = 'P3'").first().distance == pytest.approx(0.471739, abs=1e-6)
    by_coordinates = flows.cluster_products(scores, 3)
    assert rows_of(by_coordinates.assignments.select("id", "cluster_id")) == [
        ("P1", 0), ("P2", 2), ("P3", 0), ("P4", 1),
    ]


def test_unlisted_terms_give_zeros(spark, tf):
    dictionary = spark.createDataFrame([("garden", 0), ("quiet", 1), ("zebra", 2)], "term string, term_index int")
    found = {r.id: r.v for r in vectorize(tf, dictionary, "tf").collect()}
    assert found["P1"] == [0.0, 0.0, 0.0]
    assert found["P4"] == pytest.approx([2 / 3, 1 / 3, 0.0])


def test_flow_tables(reviews, stop):
    tables = flows.tfidf_vectors(reviews, stop)
    assert tables.n_products == 4
    assert tables.vectors.count() == tables.tfidf.count() == 13
    assert tables.dictionary.count() == 11


def test_files_round_trip(spark, tf, tmp_path):
    write_triples(tf, str(tmp_path / "tf"))
    assert rows_of(read_triples(spark, str(tmp_path / "tf"))) == rows_of(tf)
    write_dictionary(term_dictionary(tf), str(tmp_path / "d"))
    lines = [t for f in sorted((tmp_path / "d").glob("part-*")) for t in f.read_text().split()]
    assert lines == DICTIONARY
    assert sorted(r.term for r in read_dictionary(spark, str(tmp_path / "d")).collect()) == DICTIONARY


@pytest.fixture(scope="module")
def conversations(spark, sf_dir):
    return as_reviews(spark.read.parquet(f"{sf_dir}/conversations.parquet"), "conv_id", "turn").persist()


def test_properties(conversations):
    counts = review_term_counts(conversations).persist()
    per_review = counts.groupBy("product_id", "review_id").agg(
        F.sum("term_count").alias("sum"), F.min("total_count").alias("low"), F.max("total_count").alias("high")
    )
    assert per_review.where("sum <> low or low <> high").count() == 0
    tokens = tokenize(conversations)
    assert counts.agg(F.sum("term_count")).first()[0] == tokens.count()
    assert rows_of(tokens.groupBy("product_id", "review_id", "term").count()) == rows_of(
        counts.select("product_id", "review_id", "term", "term_count")
    )
    tf = stage(term_frequency(counts), "tf")
    assert tf.where("tf <= 0 or tf > 1").count() == 0
    dictionary = term_dictionary(tf)
    assert rows_of(dictionary.select("term")) == rows_of(tf.select("term").distinct())
    ordered = [r.term for r in dictionary.orderBy("term_index").collect()]
    assert ordered == sorted(ordered)
    assert [r.term_index for r in dictionary.orderBy("term_index").collect()] == list(range(len(ordered)))
    n = product_count(tf).first().n_products
    assert document_frequency(tf).where(F.col("df") > n).count() == 0


@pytest.mark.parametrize("budget", [1 << 26, 30000])
def test_hot_and_cold_terms_together_are_all_terms(conversations, budget):
    tf = stage(term_frequency(review_term_counts(conversations)), "tf")
    rounded = lambda df: rows_of(df.select("product_id", "term", F.round("tfidf", 9)))
    assert rounded(tfidf(tf, budget)) == rounded(tfidf(tf))


def test_many_repeats_of_one_word(spark):
    text = "word " * 200_000 + "other words word"
    reviews = spark.createDataFrame([("P", 1, text)], "product_id string, review_id int, text string")
    rows = rows_of(review_term_counts(reviews).select("term", "term_count", "total_count"))
    assert rows == [("other", 1, 200_003), ("word", 200_001, 200_003), ("words", 1, 200_003)]


def test_long_stop_word_list(conversations, spark, monkeypatch):
    from plotweave.operators import terms

    stop = spark.createDataFrame([("the",), ("and",), ("que",), (None,)], "term string")
    expected = [rows_of(f(conversations, stop.where("term is not null"))) for f in (tokenize, review_term_counts, word_count)]
    monkeypatch.setattr(terms, "LITERAL_BYTES", 1)
    assert [rows_of(f(conversations, stop)) for f in (tokenize, review_term_counts, word_count)] == expected
    salted = drop_stop_words(tokenize(conversations), stop, budget=0)
    assert rows_of(salted) == expected[0]


def test_max_counts(spark):
    counts = spark.createDataFrame([("a", 3), ("a", 7), ("b", -2)], "term string, count long")
    assert rows_of(max_counts(counts)) == [("a", 7), ("b", 0)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(conversations, stop, tf):
    assert "Exchange" not in plan_of(review_term_counts(conversations, stop))
    assert plan_of(term_frequency(review_term_counts(conversations, stop))).count("Exchange") == 1
    anti = plan_of(drop_stop_words(tokenize(conversations), stop))
    assert "BroadcastHashJoin" in anti and "LeftAnti" in anti
    assert "TakeOrderedAndProject" in plan_of(top_words(word_count(conversations)))
    for df in (tfidf(tf), word_count(conversations, stop), vectorize(tf, term_dictionary(tf), "tf")):
        assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df)
