"""Counts from sketches against exact ones."""

import pytest
from pyspark.sql import functions as F

from plotweave.operators.approximate import (
    approximate_document_frequency,
    approximate_product_count,
    merged_sketches,
    product_sketches,
)


def estimates(sketches):
    return {r.term: r.df for r in approximate_document_frequency(sketches).collect()}, approximate_product_count(sketches).first()[0]


@pytest.fixture(scope="module")
def tf(spark):
    """A term in all of 30,000 products, one in a third, some in few; rows that repeat."""
    ids = spark.range(30_000).withColumnRenamed("id", "product_id")
    terms = [ids.withColumn("term", F.lit("all")), ids.where("product_id % 3 = 0").withColumn("term", F.lit("third"))]
    few = ids.where("product_id < 40").withColumn("term", F.concat(F.lit("t"), (F.col("product_id") % 8).cast("string")))
    every = terms[0].unionByName(terms[1]).unionByName(few)
    return every.unionByName(few).withColumn("tf", F.lit(0.5))


def test_estimates_are_close(tf):
    df, n = estimates(product_sketches(tf))
    assert n == pytest.approx(30_000, rel=0.06) and df["all"] == n
    assert df["third"] == pytest.approx(10_000, rel=0.06)
    assert {t: df[t] for t in df if t[0] == "t" and t != "third"} == {f"t{k}": 5 for k in range(8)}


def test_loads_merge_to_the_whole(tf):
    """Products in several loads count once: the merged sketches are those of all rows."""
    loads = [product_sketches(tf.where(F.pmod("product_id", F.lit(5)).isin(k))) for k in ([0, 1, 2], [2, 3], [3, 4, 0])]
    assert estimates(merged_sketches(*loads)) == estimates(product_sketches(tf))


def test_nulls_and_nothing(spark):
    rows = [(1, "a"), (None, "a"), (1, None), (2, "b"), (2, "b")]
    sketches = product_sketches(spark.createDataFrame(rows, "product_id long, term string"))
    assert estimates(sketches) == ({"a": 1, "b": 1}, 2)
    assert estimates(sketches.where("false")) == ({}, 0)
