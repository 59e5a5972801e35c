"""Term frequency, dictionary, document frequency and TF-IDF per product."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from plotweave.plans.lookup import BROADCAST_BYTES, join_lookup, row_bytes
from plotweave.session import stage, stage_measured

MATCHING_REVIEWS = "matching_reviews"
ALL_REVIEWS = "all_reviews"


def term_frequency(
    counts: DataFrame, denominator: str = MATCHING_REVIEWS, budget: int = BROADCAST_BYTES
) -> DataFrame:
    """``product_id, term, tf`` from the counts per review.

    The denominator is the number of kept terms in the product's reviews that contain the
    term, or with ``all_reviews`` in all its reviews. One shuffle on (product, term), with
    partial sums before it, so neither a large product nor a frequent term is a hot group.
    """
    if denominator not in (MATCHING_REVIEWS, ALL_REVIEWS):
        raise ValueError(f"denominator must be {MATCHING_REVIEWS!r} or {ALL_REVIEWS!r}")
    per_term = counts.groupBy("product_id", "term").agg(
        F.sum("term_count").alias("occurrences"), F.sum("total_count").alias("matching")
    )
    if denominator == MATCHING_REVIEWS:
        return per_term.select(
            "product_id", "term", (F.col("occurrences") / F.col("matching")).alias("tf")
        )
    per_term = stage(per_term, "term_counts")
    products = per_term.groupBy("product_id").agg(
        F.sum("occurrences").alias("all_terms"), F.count("*").alias("product_terms")
    )
    joined = join_lookup(
        per_term,
        stage(products, "product_terms"),
        "product_id",
        weight="product_terms",
        payload=16,
        budget=budget,
    )
    return joined.select(
        "product_id", "term", (F.col("occurrences") / F.col("all_terms")).alias("tf")
    )


def document_frequency(tf: DataFrame) -> DataFrame:
    """``term, df``: in how many products a term occurs."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def product_count(tf: DataFrame) -> DataFrame:
    """One row ``n_products``: the products with at least one kept term."""
    return tf.agg(F.count_distinct("product_id").alias("n_products"))


def term_dictionary(tf: DataFrame) -> DataFrame:
    """``term, term_index``: the distinct terms, numbered from 0 in sorted order.

    The terms are range-partitioned, sorted and stored, one file per range. A row's place in
    its file is then fixed, and its index is that place plus the number of terms in the
    files before. Only the file sizes reach the driver.
    """
    spark = tf.sparkSession
    ordered = stage(
        tf.select("term").distinct().repartitionByRange("term").sortWithinPartitions("term"),
        "sorted_terms",
    ).select(
        "term",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("place"),
    )
    sizes = ordered.groupBy("file").agg(F.count("*").alias("n")).collect()
    offsets, total = [], 0
    for row in sorted(sizes, key=lambda r: _file_number(r.file)):
        offsets.append((row.file, total))
        total += row.n
    # One row per file, so no more than there are shuffle partitions.
    starts = spark.createDataFrame(offsets, "file string, start long")
    return ordered.join(F.broadcast(starts), "file").select(
        "term", (F.col("start") + F.col("place")).alias("term_index")
    )


def _file_number(name: str) -> tuple[int, int]:
    """The partition and, for partitions of several files, the file within it."""
    part, within = re.fullmatch(r"part-(\d+)-.*c(\d+)\..*", name).groups()
    return int(part), int(within)


def tfidf(tf: DataFrame, budget: int = BROADCAST_BYTES) -> DataFrame:
    """``product_id, term, tfidf`` with idf = ln(products / (1 + df)).

    ``tf`` is read three times (df, product count, join), so pass a stored table. The
    frequencies are joined on by ``join_lookup``: ``df`` is itself the number of rows a
    term has, so it tells the frequent terms from the rare ones.
    """
    frequencies, measured = stage_measured(
        document_frequency(tf), "document_frequency", F.sum(row_bytes("term")).alias("bytes")
    )
    n_products = product_count(tf).first().n_products
    joined = join_lookup(
        tf, frequencies, "term", weight="df", budget=budget, lookup_bytes=measured["bytes"] or 0.0
    )
    idf = F.log(F.lit(float(n_products)) / (F.lit(1.0) + F.col("df")))
    return joined.select("product_id", "term", (F.col("tf") * idf).alias("tfidf"))
