"""From raw documents to packed token sequences, in five stages.

Each stage takes what the one before it kept, as a table with the columns of ``documents``, and
calls one operator of ``plotweave.llm``. ``run`` writes the result of every stage to the shared
folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plotweave.llm import decontamination, near_duplicates, packing, pii, quality
from plotweave.session import stage

# All stages but the last return these columns; of them only ``text`` and ``n_chars`` change, in ``pii``.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores as good; the model is trained on the labelled ones among ``docs``."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return near_duplicates.drop_near_duplicates(docs)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data; ``n_chars`` follows the text."""
    out = pii.pseudonymize(docs).select(docs.columns)
    changed = F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.withColumn("n_chars", F.coalesce(changed, F.col("n_chars"))) if "n_chars" in docs.columns else out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_dedup),
    ("decontamination", benchmark_filter),
    ("pii", pii_pseudonyms),
    ("packing", pack_sequences),
]

# Training, and the tokenizer's merges, are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``: one row per packed piece, with a checksum of its ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline_{name}")
    return packing.digest(docs)
