"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs once cold and then twice; the seconds reported are the mean of the two
warm runs, ``cold`` holds the first ones.
"""

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from plotweave.operators.dense import assign, choose_centroids, lloyd, update_centroids
from plotweave.operators.terms import as_reviews, review_term_counts
from plotweave.operators.tfidf import term_dictionary, term_frequency, tfidf
from plotweave.plans.flows import cluster_products, corpus_top_words
from plotweave.session import local_session, stage
from plotweave.sources import read_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def finish(df: DataFrame) -> None:
    """Compute every row and column of the result."""
    df.write.format("noop").mode("overwrite").save()


def headline(spark: SparkSession) -> dict:
    def documents():
        return as_reviews(read_table(spark, f"{SF_DIR}/documents.parquet", spread=True), "source", "doc_id")

    def conversations():
        return as_reviews(read_table(spark, f"{SF_DIR}/conversations.parquet", spread=True), "conv_id", "turn")

    def points():
        table = read_table(spark, f"{SF_DIR}/embeddings.parquet")
        return table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))

    def scores(reviews):
        return tfidf(stage(term_frequency(review_term_counts(reviews)), "tf"))

    seeds = stage(choose_centroids(points(), 10), "bench_seeds")

    def one_step():
        finish(update_centroids(assign(points(), seeds, with_vectors=True), seeds))

    def to_convergence():
        finish(lloyd(points(), seeds).assignments)

    return {
        "word_count_top_1000": lambda: finish(corpus_top_words(documents())),
        "review_term_counts": lambda: finish(review_term_counts(documents())),
        "term_dictionary": lambda: finish(term_dictionary(term_frequency(review_term_counts(documents())))),
        "tfidf_documents": lambda: finish(scores(documents())),
        "tfidf_conversations": lambda: finish(scores(conversations())),
        "choose_centroids_k10": lambda: choose_centroids(points(), 10),
        "assign_update_step_k10": one_step,
        "lloyd_k10": to_convergence,
        "cluster_conversations_k3": lambda: finish(
            cluster_products(stage(scores(conversations()), "tfidf"), 3).assignments
        ),
    }


def main() -> None:
    spark = local_session(CPUS, "bench")
    seconds, cold = {}, {}
    for name, run in headline(spark).items():
        times = []
        for _ in range(3):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        cold[name] = round(times[0], 3)
        seconds[name] = round(sum(times[1:]) / 2, 3)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold": cold,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
