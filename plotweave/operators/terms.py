"""From reviews to terms: tokenising, stop words, counts per review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from plotweave.functions.text import MIN_TERM_LENGTH, terms_in
from plotweave.plans.lookup import BROADCAST_BYTES, broadcast_bytes, join_lookup
from plotweave.session import stage

# Stop words of up to so many bytes travel as a literal set inside the plan.
LITERAL_BYTES = 64 * 1024

# A table with a column ``term``, or the words themselves.
StopWords = DataFrame | list[str] | None


def as_reviews(
    table: DataFrame, product_id: str = "product_id", review_id="review_id", text: str = "text"
) -> DataFrame:
    """Any table as reviews: ``product_id, review_id, text``.

    ``review_id`` is a column name or a column; it has to be unique within a product.
    """
    return table.select(
        F.col(product_id).alias("product_id"),
        (F.col(review_id) if isinstance(review_id, str) else review_id).alias("review_id"),
        F.col(text).alias("text"),
    )


def stop_word_list(stop_words: StopWords) -> list[str] | None:
    """The stop words as a list, or None if they measure too much for a literal."""
    if stop_words is None:
        return []
    if isinstance(stop_words, DataFrame):
        size = stop_words.agg(F.sum(F.octet_length("term")).alias("n")).first().n or 0
        if size > LITERAL_BYTES:
            return None
        stop_words = [r.term for r in stop_words.select("term").distinct().collect()]
    words = sorted({word for word in stop_words if word is not None})
    return words if sum(len(w.encode()) for w in words) <= LITERAL_BYTES else None


def _stop_word_table(spark: SparkSession, stop_words: StopWords) -> DataFrame:
    if isinstance(stop_words, DataFrame):
        table = stop_words.select("term")
    else:
        table = spark.createDataFrame([(w,) for w in stop_words], "term string")
    return table.where(F.col("term").isNotNull()).distinct()


def _kept(text: Column, stop: list[str], min_length: int) -> Column:
    terms = terms_in(text, min_length)
    return F.filter(terms, lambda term: ~term.isin(stop)) if stop else terms


def tokenize(
    reviews: DataFrame, stop_words: StopWords = None, min_length: int = MIN_TERM_LENGTH
) -> DataFrame:
    """One row per kept term occurrence: ``product_id, review_id, term``. No shuffle."""
    stop = stop_word_list(stop_words)
    terms = reviews.select(
        "product_id", "review_id", F.explode(_kept(F.col("text"), stop or [], min_length)).alias("term")
    )
    return terms if stop is not None else drop_stop_words(terms, stop_words)


def drop_stop_words(
    terms: DataFrame, stop_words: StopWords, budget: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows whose ``term`` is no stop word, compared exactly.

    A list within the broadcast budget is broadcast. Of a larger one the words that make up
    most rows are, by ``join_lookup``, so that no frequent term is one task.
    """
    stop = _stop_word_table(terms.sparkSession, stop_words)
    size = broadcast_bytes(stop, "term")
    if size <= budget:
        return terms.join(F.broadcast(stop), "term", "left_anti").select(terms.columns)
    marked = stage(stop.withColumn("is_stop_word", F.lit(True)), "stop_words")
    joined = join_lookup(stage(terms, "terms"), marked, "term", "left", budget=budget, lookup_bytes=size)
    return joined.where(F.col("is_stop_word").isNull()).select(terms.columns)


def review_term_counts(
    reviews: DataFrame, stop_words: StopWords = None, min_length: int = MIN_TERM_LENGTH
) -> DataFrame:
    """``product_id, review_id, term, term_count, total_count`` per review and term.

    Reviews without a product are dropped. A review is one row, so its counts need no
    shuffle: the sorted terms are joined into one string in which equal terms are
    neighbours, and each run of equal terms is one match.
    """
    stop = stop_word_list(stop_words)
    kept = reviews.where(F.col("product_id").isNotNull()).select(
        "product_id", "review_id", _kept(F.col("text"), stop or [], min_length).alias("terms")
    )
    line = F.concat(F.array_join(F.sort_array("terms"), " "), F.lit(" "))
    runs = kept.select(
        "product_id",
        "review_id",
        F.explode(F.regexp_extract_all(line, F.lit(r"([a-z]+) (?:\1 )*+"), F.lit(0))).alias("run"),
        F.size("terms").cast("long").alias("total_count"),
    )
    term = F.substring_index("run", " ", 1)
    # A run is the term and a space, as often as the term occurs.
    occurrences = F.call_function("div", F.octet_length("run"), F.octet_length(term) + 1)
    counts = runs.select(
        "product_id", "review_id", term.alias("term"), occurrences.alias("term_count"), "total_count"
    )
    if stop is not None:
        return counts
    per_review = Window.partitionBy("product_id", "review_id")
    return drop_stop_words(counts.drop("total_count"), stop_words).withColumn(
        "total_count", F.sum("term_count").over(per_review)
    )
