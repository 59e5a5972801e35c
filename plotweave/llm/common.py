"""Helpers the operators share: row numbers, words, stored tables, batches of bounded size."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plotweave.session import stage, stage_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Text handed to Python code is worked on in slices of about this many bytes.
SLICE_BYTES = 8_000_000
ROW = "row_no"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def split_words(text: Column, separators: str) -> Column:
    """The words of ``text`` between runs of ``separators``, without empty ones."""
    return F.array_remove(F.split(text, separators), "")


def numbered(table: DataFrame, *columns: str | Column, id_column: str = "doc_id") -> DataFrame:
    """``row_no``, the id and the columns asked for, stored.

    Operators identify rows by ``row_no``, so rows that repeat an id, or have none, stay
    apart. Storing fixes the numbers for all later reads.
    """
    rows = table.select(F.monotonically_increasing_id().alias(ROW), F.col(id_column), *columns)
    return stage(rows, "numbered")


def bucketed(table: DataFrame, key: str, name: str, move: bool = True) -> DataFrame:
    """``table`` stored in hash buckets of ``key``: joins on ``key`` don't move it again.

    The files lie in the shared folder; the catalog entry is the session's own. Without
    ``move`` the rows stay with their tasks, each of which writes a file per bucket it has.
    """
    spark = table.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known_as = f"plotweave_{name}_{uuid.uuid4().hex}"
    (
        (table.repartition(n, key) if move else table)
        .write.bucketBy(n, key)
        .option("path", stage_path(spark, name))
        .option("compression", "zstd")
        .format("parquet")
        .saveAsTable(known_as)
    )
    return spark.table(known_as)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose ``column`` has about ``most`` bytes together."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= most:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < len(sizes):
        yield batch.slice(start)


def own_texts(texts: pa.Array) -> pa.Array:
    """The texts, nulls as empty ones, in an array that is no slice of another.

    Arrow's ``ascii_lower`` misreads slices.
    """
    texts = texts.cast(pa.large_string())
    return pa.compute.if_else(texts.is_valid(), texts, "")


def smallest_by_hash(table: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of ``key``: the documented training samples."""
    return table.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(most)


def held_out(doc_id: Column) -> Column:
    """Whether the row belongs to the fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
