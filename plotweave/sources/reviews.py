"""Reader for review files: blocks of ``key: value`` lines that start with a product id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from plotweave.functions.text import first_segment, trim_control, whole_text
from plotweave.session import stage, stage_path

# Fixed values of the file format.
PRODUCT_KEY = "product/productId"
TEXT_KEY = "review/text"
OTHER_KEYS = {
    "user_id": "review/userId",
    "profile_name": "review/profileName",
    "helpfulness": "review/helpfulness",
    "score": "review/score",
    "time": "review/time",
    "summary": "review/summary",
}

FIRST_SEGMENT = "first_segment"
FULL = "full"


def _after_key(line: Column) -> Column:
    """What follows the first colon of a ``key: value`` line, null without a value."""
    key = F.substring_index(line, ":", 1)
    return F.when(F.rtrim(line, F.lit(":")) != key, F.substr(line, F.length(key) + 2))


def _product_id(value: Column) -> Column:
    return trim_control(F.when(F.rtrim(value, F.lit(":")) != "", F.substring_index(value, ":", 1)))


def _review_text(value: Column, text_rule: str) -> Column:
    if text_rule == FIRST_SEGMENT:
        return first_segment(value)
    if text_rule == FULL:
        return whole_text(value)
    raise ValueError(f"text_rule must be {FIRST_SEGMENT!r} or {FULL!r}")


def _key_lines(block: Column, key: str) -> Column:
    """All lines of a block with exactly this key."""
    pattern = rf"(?:^|[\r\n])({key}(?::[^\r\n]*)?)(?=[\r\n]|\z)"
    return F.regexp_extract_all(block, F.lit(pattern), F.lit(1))


def _other_fields(block: Column) -> list[Column]:
    found = {
        name: trim_control(_after_key(F.get(_key_lines(block, key), F.lit(0))))
        for name, key in OTHER_KEYS.items()
    }
    found["score"] = found["score"].try_cast("double")
    found["time"] = F.timestamp_seconds(found["time"].try_cast("long"))
    return [value.alias(name) for name, value in found.items()]


NO_VALUE, NO_TEXT = "no value", "no text"


def _reason(value: Column) -> Column:
    """Why a text line has no text: nothing after its key, or nothing that the text rule leaves."""
    return F.when(value.isNull(), NO_VALUE).otherwise(NO_TEXT)


def _well_formed(lines: DataFrame, malformed: Observation | None, extra: list[str]) -> DataFrame:
    if malformed is not None:
        lines = lines.observe(
            malformed, F.count(F.when(F.col("text").isNull(), 1)).alias("malformed_lines")
        )
    # A filter would be moved below the text rule, which would then be applied once more for it.
    found = F.explode(F.when(F.col("text").isNotNull(), F.array("text"))).alias("text")
    return lines.select("product_id", "review_id", found, *extra)


@dataclass(frozen=True)
class CheckedReviews:
    """``reviews``: as the reader gives them. ``rejected``: file, block_start, product_id, line,
    reason of each text line that it drops. Both are stored, by one pass over the files."""

    reviews: DataFrame
    rejected: DataFrame


def _checked(lines: DataFrame, extra: list[str]) -> CheckedReviews:
    spark = lines.sparkSession
    path = stage_path(spark, "checked_reviews")
    kept = F.col("text").isNotNull()
    columns = {
        "reason": F.when(~kept, _reason(F.col("value"))), "line": F.when(~kept, F.col("line")),
        "file": F.when(~kept, F.col("file")), "rejected": ~kept,
    }
    rows = lines.withColumns(columns).select(
        "product_id", "review_id", "text", *extra, "file", "block_start", "line", "reason", "rejected"
    )
    rows.write.partitionBy("rejected").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    return CheckedReviews(
        stored.where("NOT rejected").select("product_id", "review_id", "text", *extra),
        stored.where("rejected").select("file", "block_start", "product_id", "line", "reason"),
    )


def read_reviews(
    spark: SparkSession,
    path: str | list[str],
    text_rule: str = FIRST_SEGMENT,
    all_fields: bool = False,
    line_break: str = "\n",
    malformed: Observation | None = None,
) -> DataFrame:
    """``product_id, review_id, text`` from review files, one row per text line.

    The start of the next block is the record separator, so a record holds its product id
    and its texts wherever the file is split, and no shuffle is needed to bring them
    together. ``\\n`` also suits files with ``\\r\\n``; pass ``\\r`` for files with bare
    carriage returns. One block has to stay below Spark's 2 GB for a record; where one
    product id heads an unlimited number of texts use ``read_review_lines``.

    A text before any product id has a null id. Text lines without a usable text are
    dropped; ``malformed`` counts them as ``malformed_lines``.
    """
    lines = _text_lines(spark, path, text_rule, all_fields, line_break)
    return _well_formed(lines, malformed, list(OTHER_KEYS) if all_fields else [])


def read_reviews_checked(
    spark: SparkSession,
    path: str | list[str],
    text_rule: str = FIRST_SEGMENT,
    all_fields: bool = False,
    line_break: str = "\n",
) -> CheckedReviews:
    """``read_reviews``, stored, beside the lines that it drops and why, from the same pass.

    ``block_start`` is where the file split of the line begins.
    """
    lines = _text_lines(spark, path, text_rule, all_fields, line_break)
    return _checked(lines, list(OTHER_KEYS) if all_fields else [])


def _text_lines(
    spark: SparkSession, path: str | list[str], text_rule: str, all_fields: bool, line_break: str
) -> DataFrame:
    """Every text line: ``product_id, review_id, file, block_start, line, value, text``."""
    blocks = spark.read.option("lineSep", f"{line_break}{PRODUCT_KEY}:").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start")
    )
    value, key = F.col("value"), f"{PRODUCT_KEY}:"
    block = F.when(value.startswith(key), F.substr(value, F.lit(len(key) + 1))).otherwise(value)
    first_line = F.substring_index(F.substring_index("block", "\n", 1), "\r", 1)
    # Only the first block of a file can lack the id; it starts with a line of another key.
    no_id = first_line.rlike(r"^[^:\s]+/[^:\s]+(:|\z)")
    lines = blocks.select(block.alias("block"), "file", "block_start").select(
        F.when(~no_id, _product_id(first_line)).alias("product_id"), "file", "block_start",
        F.explode(_key_lines(F.col("block"), TEXT_KEY)).alias("line"),
        *(_other_fields(F.col("block")) if all_fields else []),
    )
    return lines.withColumns(
        {"review_id": F.monotonically_increasing_id(), "value": _after_key(F.col("line"))}
    ).withColumn("text", _review_text(F.col("value"), text_rule))


def read_review_lines(
    spark: SparkSession,
    path: str | list[str],
    text_rule: str = FIRST_SEGMENT,
    malformed: Observation | None = None,
) -> DataFrame:
    """The same reviews, carrying the product id forward line by line.

    For files in which any number of texts may follow one id. Lines are ordered within
    their file split, whose size is bounded by ``spark.sql.files.maxPartitionBytes``; the
    last id of each split is then carried into the splits after it.
    """
    return _well_formed(_lines_with_ids(spark, path, text_rule), malformed, [])


def read_review_lines_checked(
    spark: SparkSession, path: str | list[str], text_rule: str = FIRST_SEGMENT
) -> CheckedReviews:
    """``read_review_lines``, stored, beside the lines that it drops and why."""
    return _checked(_lines_with_ids(spark, path, text_rule), [])


def _lines_with_ids(spark: SparkSession, path: str | list[str], text_rule: str) -> DataFrame:
    """Every text line, as ``_text_lines`` gives them."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("review_id"),
        F.col("value").alias("line"),
    )
    key = F.substring_index("line", ":", 1)
    own_id = F.struct(_product_id(_after_key(F.col("line"))).alias("id"))
    wanted = stage(
        lines.select(
            "file",
            "split",
            "review_id",
            F.when(key == PRODUCT_KEY, own_id).alias("own"),
            F.when(key == TEXT_KEY, F.col("line")).alias("line"),
        ).where(F.col("own").isNotNull() | F.col("line").isNotNull()),
        "review_lines",
    )
    # The struct keeps an id line without a value apart from no id line at all.
    so_far = Window.partitionBy("file", "split").orderBy("review_id")
    before = (
        Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    )
    splits = (
        wanted.groupBy("file", "split")
        .agg(F.max_by("own", F.when(F.col("own").isNotNull(), F.col("review_id"))).alias("own"))
        .select("file", "split", F.last("own", ignorenulls=True).over(before).alias("carried"))
    )
    carried = wanted.withColumn("own", F.last("own", ignorenulls=True).over(so_far)).where(
        F.col("line").isNotNull()
    )
    joined = carried.join(splits, ["file", "split"], "left").select(
        F.coalesce("own", "carried").getField("id").alias("product_id"),
        "review_id",
        "file",
        F.col("split").alias("block_start"),
        "line",
        _after_key(F.col("line")).alias("value"),
    )
    return joined.withColumn("text", _review_text(F.col("value"), text_rule))
