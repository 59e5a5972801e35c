"""Readers and writers for the text forms of the stage tables.

Parquet is what the stages use among themselves; these files are for exchange. Lines that
do not parse are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plotweave.functions.text import trim_control
from plotweave.functions.vectors import fixed_decimals, format_vector, parse_vector
from plotweave.session import stage


def _fields(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.split("value", "\t").alias("fields"))


def _field(i: int) -> Column:
    return F.get("fields", F.lit(i))


def _with_all_numbers(vectors: DataFrame) -> DataFrame:
    return vectors.where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))


def _numbered_vectors(spark: SparkSession, path: str, vector: Column, **others: Column) -> DataFrame:
    """``cluster_id, v`` and ``others``: the rows of centroid files from 0, in the order of file names and lines.

    A row's number is its place in its file split plus the rows of the splits before; the
    driver sees one number per split.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), vector.alias("v"),
        *[c.alias(name) for name, c in others.items()],
    )
    placed = stage(_with_all_numbers(rows).withColumn("place", F.monotonically_increasing_id()), "vector_lines")
    sizes = placed.groupBy("file", "split").agg(F.count("*").alias("n"), F.min("place").alias("first")).collect()
    starts, total = [], 0
    for r in sorted(sizes, key=lambda r: (r.file, r.split)):
        starts.append((r.file, r.split, total - r.first))
        total += r.n
    # One row per file split.
    offsets = spark.createDataFrame(starts, "file string, split long, offset long")
    return placed.join(F.broadcast(offsets), ["file", "split"]).select(
        (F.col("place") + F.col("offset")).cast("int").alias("cluster_id"), "v", *others
    )


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """``term`` per line, trimmed."""
    return spark.read.text(path).select(trim_control(F.col("value")).alias("term"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``term`` per line, trimmed. Number the terms with ``term_dictionary``."""
    return read_stop_words(spark, path)


def read_triples(
    spark: SparkSession, path: str, score: str = "tf", id_type: str = "string"
) -> DataFrame:
    """``product_id, term, <score>`` from tab-separated lines."""
    return _fields(spark, path).select(
        _field(0).try_cast(id_type).alias("product_id"),
        _field(1).alias("term"),
        _field(2).try_cast("double").alias(score),
    ).where(F.col("product_id").isNotNull() & F.col("term").isNotNull() & F.col(score).isNotNull())


def read_vectors(spark: SparkSession, path: str, id_type: str = "string") -> DataFrame:
    """``id, v`` from lines of an id, a tab and space-separated numbers."""
    return _with_all_numbers(
        _fields(spark, path).select(
            _field(0).try_cast(id_type).alias("id"), parse_vector(_field(1)).alias("v")
        )
    ).where(F.col("id").isNotNull())


def read_keyed_centroids(spark: SparkSession, path: str) -> DataFrame:
    """``cluster_id, v, min_distance`` from lines of any key, a tab and the vector.

    ``min_distance`` is the key, null where it is no number.
    """
    fields = F.split("value", "\t")
    return _numbered_vectors(
        spark, path, parse_vector(F.get(fields, F.lit(1))), min_distance=F.get(fields, F.lit(0)).try_cast("double")
    )


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """``cluster_id, v`` from lines with nothing but the vector."""
    return _numbered_vectors(spark, path, parse_vector(F.col("value")))


def read_coordinate_centroids(spark: SparkSession, path: str) -> DataFrame:
    """``cluster_id, term, value`` from tab-separated lines."""
    rows = read_triples(spark, path, "value", "int")
    return rows.select(F.col("product_id").alias("cluster_id"), "term", "value")


def read_word_counts(spark: SparkSession, path: str) -> DataFrame:
    """``term, count`` from tab-separated lines."""
    return _fields(spark, path).select(
        _field(0).alias("term"), _field(1).try_cast("long").alias("count")
    ).where(F.col("term").isNotNull() & F.col("count").isNotNull())


def _lines(table: DataFrame, *columns: str | Column) -> DataFrame:
    fields = [F.col(c).cast("string") if isinstance(c, str) else c for c in columns]
    return table.select(F.concat_ws("\t", *fields))


def write_triples(table: DataFrame, path: str, score: str = "tf") -> None:
    """``product_id \\t term \\t score`` lines."""
    _lines(table, "product_id", "term", score).write.text(path)


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """The terms in index order, one per line; the files in name order continue each other."""
    ordered = dictionary.repartitionByRange("term_index").sortWithinPartitions("term_index")
    ordered.select("term").write.text(path)


def write_vectors(vectors: DataFrame, path: str) -> None:
    """``id \\t v1 v2 …`` lines."""
    _lines(vectors, "id", format_vector(F.col("v"))).write.text(path)


def write_keyed_centroids(centroids: DataFrame, path: str) -> None:
    """``min_distance \\t v1 v2 …`` lines in cluster order; a seed has distance 0."""
    ordered = centroids.repartition(1).sortWithinPartitions("cluster_id")
    key = F.coalesce("min_distance", F.lit(0.0)).cast("string")
    _lines(ordered, key, format_vector(F.col("v"))).write.text(path)


def write_centroids(centroids: DataFrame, path: str) -> None:
    """The vectors alone, with five decimals, in cluster order."""
    ordered = centroids.repartition(1).sortWithinPartitions("cluster_id")
    ordered.select(fixed_decimals(F.col("v"))).write.text(path)


def write_coordinate_centroids(centroids: DataFrame, path: str, digits: int | None = None) -> None:
    """``cluster_id \\t term \\t value`` lines, rounded half to even if ``digits`` are given."""
    value = F.col("value") if digits is None else F.bround("value", digits)
    _lines(centroids.withColumn("value", value), "cluster_id", "term", "value").write.text(path)


def write_word_counts(counts: DataFrame, path: str) -> None:
    """``term \\t count`` lines."""
    _lines(counts, "term", "count").write.text(path)


def write_history(history: DataFrame, path: str) -> None:
    """A clustering history as Parquet with one folder per iteration."""
    history.write.partitionBy("iteration").parquet(path)


def read_history(spark: SparkSession, path: str, iteration: int | None = None) -> DataFrame:
    """All iterations, or only the folder of one."""
    history = spark.read.parquet(path)
    return history if iteration is None else history.where(F.col("iteration") == iteration)
