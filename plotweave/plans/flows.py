"""The three flows from reviews to results, each as one call."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from plotweave.functions.text import MIN_TERM_LENGTH
from plotweave.operators import sparse
from plotweave.operators.counts import TOP_WORDS, top_words, word_count
from plotweave.operators.dense import CLUSTERS, TOLERANCE, vector_coordinates
from plotweave.operators.terms import StopWords, review_term_counts
from plotweave.operators.tfidf import (
    MATCHING_REVIEWS,
    product_count,
    term_dictionary,
    term_frequency,
    tfidf,
)
from plotweave.session import stage


@dataclass(frozen=True)
class TfidfTables:
    """``tf``, ``dictionary``, ``tfidf`` and ``vectors`` (product_id, term_index, tfidf) are
    stored tables; ``n_products`` is a number."""

    tf: DataFrame
    dictionary: DataFrame
    n_products: int
    tfidf: DataFrame
    vectors: DataFrame


def tfidf_vectors(
    reviews: DataFrame,
    stop_words: StopWords = None,
    denominator: str = MATCHING_REVIEWS,
    min_length: int = MIN_TERM_LENGTH,
) -> TfidfTables:
    """Reviews to one sparse TF-IDF vector per product."""
    counts = review_term_counts(reviews, stop_words, min_length)
    tf = stage(term_frequency(counts, denominator), "tf")
    dictionary = stage(term_dictionary(tf), "dictionary")
    scores = stage(tfidf(tf), "tfidf")
    vectors = stage(vector_coordinates(scores, dictionary), "vectors")
    return TfidfTables(tf, dictionary, product_count(tf).first().n_products, scores, vectors)


def cluster_products(
    scores: DataFrame,
    k: int = CLUSTERS,
    seeds: list | DataFrame | None = None,
    tol: float = TOLERANCE,
    max_iter: int | None = None,
    round_digits: int | None = None,
) -> sparse.SparseLloydResult:
    """TF-IDF scores to ``k`` clusters: farthest-first seeding, then Lloyd's iterations."""
    coordinates = sparse.stored_coordinates(sparse.as_coordinates(scores))
    centroids, _ = sparse.choose_centroids_sparse(coordinates, k, seeds)
    return sparse.lloyd_sparse(coordinates, centroids, tol, max_iter, round_digits)


def corpus_top_words(
    reviews: DataFrame, stop_words: StopWords = None, n: int = TOP_WORDS
) -> DataFrame:
    """Reviews to the most frequent words of the corpus."""
    return top_words(word_count(reviews, stop_words), n)
