"""Columnar input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """A Parquet table.

    ``spread`` is for text tables stored in fewer splits than there are cores, as small
    files are: their rows are dealt out before the costly tokenising. Large inputs have
    more splits than cores and are left as they are.
    """
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if spread and table.rdd.getNumPartitions() < cores:
        return table.repartition(cores)
    return table
