"""Word counts over the corpus and the most frequent words."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plotweave.functions.text import MIN_TERM_LENGTH
from plotweave.operators.terms import StopWords, drop_stop_words, stop_word_list, tokenize

# Fixed value: the length of the top-words report.
TOP_WORDS = 1000


def word_count(
    reviews: DataFrame, stop_words: StopWords = None, min_length: int = MIN_TERM_LENGTH
) -> DataFrame:
    """``term, count`` over all reviews, also those without a product.

    Occurrences are counted before the shuffle. Stop words are dropped from the counts, one
    row per term, so no frequent term is joined row by row.
    """
    counts = tokenize(reviews, None, min_length).groupBy("term").agg(F.count("*").alias("count"))
    if stop_words is None:
        return counts
    stop = stop_word_list(stop_words)
    if stop is not None:
        return counts.where(~F.col("term").isin(stop)) if stop else counts
    keyed = counts.withColumns({"product_id": F.col("term"), "review_id": F.lit(0)})
    return drop_stop_words(keyed, stop_words).select("term", "count")


def max_counts(counts: DataFrame) -> DataFrame:
    """One row per term with its largest count, at least 0, for tables with repeated terms."""
    return counts.groupBy("term").agg(F.greatest(F.max("count"), F.lit(0)).alias("count"))


def top_words(counts: DataFrame, n: int = TOP_WORDS) -> DataFrame:
    """The ``n`` terms with the largest counts in ascending order of ``count, term``.

    Of terms with one count the larger term comes first into the report.
    """
    best = max_counts(counts).orderBy(F.desc("count"), F.desc("term")).limit(n)
    return best.orderBy("count", "term")
