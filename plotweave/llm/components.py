"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plotweave.session import stage_measured


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``); the component's smallest node.

    Alternates two steps that keep the components: every node sends its larger neighbours to
    its smallest one, then its smaller neighbours. The edges are a set of stars after a
    number of turns that grows with the logarithm of the longest path. Minima are
    pre-aggregated, so a hub is no hot group, and every turn is stored.
    """
    def marked(rows: DataFrame) -> tuple[DataFrame, tuple]:
        stored, found = stage_measured(
            rows, "edges", F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31))).alias("s"),
        )
        return stored, (found["n"], found["x"], found["s"])

    now, mark = marked(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        following, next_mark = marked(small)
        done = next_mark == mark
        now, mark = following, next_mark
        if done:
            break
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
