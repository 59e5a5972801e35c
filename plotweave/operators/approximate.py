"""Approximate numbers of products, from sketches that can be stored and merged per load.

An opt-in: TF-IDF itself uses exact counts. A sketch of a term takes a few bytes while the term
is rare and some ``2**PRECISION`` bytes at most, and the sketches of two loads give that of both
together, so a count over all loads needs no look at the older ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# 2**PRECISION buckets: a standard error of about 1.6 % beyond some hundred products.
PRECISION = 12


def product_sketches(tf: DataFrame, precision: int = PRECISION) -> DataFrame:
    """``term, sketch``: the products of each term; the row with a null term has all products.

    ``tf`` is one load's ``product_id, term``. Rows without a product or a term count nowhere.
    Partial sketches are made before the shuffle.
    """
    rows = tf.select("product_id", "term").dropna()
    sketch = F.hll_sketch_agg("product_id", F.lit(precision)).alias("sketch")
    # Every row counts twice: for its term, and for all.
    both = rows.withColumn("term", F.explode(F.array("term", F.lit(None).cast("string"))))
    return both.groupBy("term").agg(sketch)


def merged_sketches(*loads: DataFrame) -> DataFrame:
    """The sketches of several loads as those of all together. A product may be in many loads."""
    every = loads[0]
    for load in loads[1:]:
        every = every.unionByName(load)
    return every.groupBy("term").agg(F.hll_union_agg("sketch").alias("sketch"))


def approximate_document_frequency(sketches: DataFrame) -> DataFrame:
    """``term, df``: in about how many products a term occurs."""
    return sketches.where("term IS NOT NULL").select("term", F.hll_sketch_estimate("sketch").alias("df"))


def approximate_product_count(sketches: DataFrame) -> DataFrame:
    """One row ``n_products``: about how many products have a term; 0 without any."""
    counted = F.max(F.when(F.col("term").isNull(), F.hll_sketch_estimate("sketch")))
    return sketches.agg(F.coalesce(counted, F.lit(0)).cast("long").alias("n_products"))
