"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over word positions: the words under the mask are hashed, the others
are ignored, so a substituted word spoils only the seeds that look at it. Hashes of all corpus
positions meet those of the benchmark; the words around every hit are then compared with the
item, and the longest run that is equal but for few substitutions decides.

Built-in functions only. The corpus is never shuffled: hits are rare, and those of one
alignment are reduced to one row in the task that finds them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from plotweave.llm.common import documents, split_words
from plotweave.session import stage

# Positions a seed looks at; no two masks ignore the same words. Every run of 10 to 23 words that
# meets OVERLAP_WORDS and OVERLAP_SHARE has one of them on equal words only, wherever the others
# are, and every longer run that meets them contains such a run.
MASKS = [(0, 1, 3, 4, 5, 6), (0, 1, 2, 5, 7, 9), (0, 1, 2, 4, 9, 10)]
SPAN = 1 + max(max(m) for m in MASKS)
# Items with fewer words say nothing about where a text comes from.
LEAST_WORDS = 3
# What an overlap needs: so many equal words (or all of a shorter item), and such a share.
OVERLAP_WORDS = 10
OVERLAP_SHARE = 0.8
# So many equal words make up for one that differs.
MATCHES = round(OVERLAP_SHARE / (1 - OVERLAP_SHARE))
BROADCAST_BYTES = 32 * 1024 * 1024
SEED_BYTES = 64
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


# Characters of scripts that set no spaces between words are words of their own: Thai, Lao, Burmese,
# Khmer, kana and Han, all of them above the characters of other scripts that most texts consist of.
UNSPACED = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]"
HIGH = r"[^\x00-\u0dff]"


def words_of(text: Column) -> Column:
    lower = F.lower(F.coalesce(text, F.lit("")))
    apart = F.when(lower.rlike(HIGH), F.regexp_replace(lower, f"({UNSPACED})", " $1 ")).otherwise(lower)
    return split_words(apart, SEPARATORS)


def _seed(words: Column, at: Column, mask: tuple[int, ...]) -> Column:
    """The hash of the words under ``mask``; null where the mask passes the end."""
    looked_at = [F.get(words, at + F.lit(k)) for k in mask]
    inside = at + F.lit(max(mask)) < F.size(words)
    return F.when(inside, F.xxhash64(F.lit(len(mask)), F.lit(mask[-1]), *looked_at))


def _seeds(words: Column, at: Column, masks: list[tuple[int, ...]]) -> Column:
    return F.explode(F.array(*[_seed(words, at, m) for m in masks]))


def _positions(words: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), F.size(words) - 1))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _overlap(doc: Column, item: Column) -> Column:
    """The run of aligned words with the most matches among all whose share of matches is at
    least ``OVERLAP_SHARE``: struct start, n_words, n_matched.

    Ties go to the earlier run. It begins and ends with a match; without any match it is empty.
    """
    same = F.zip_with(doc, item, lambda x, y: F.coalesce(x == y, F.lit(False)))
    # The edges of runs: the mismatches, and the places before and after all words.
    edges = lambda same: F.concat(
        F.array(F.lit(-1)),
        F.filter(F.sequence(F.lit(0), F.size(same) - 1), lambda i: ~F.get(same, i)),
        F.array(F.size(same)),
    )
    return _let(same, lambda same: _let(edges(same), lambda e: _let(_widest(e), lambda w: _trimmed(same, e, w))))


def _widest(edges: Column) -> Column:
    """The run between two edges, as struct first, last of their numbers.

    The run between edges a and b has the share where level(b) >= level(a) - ``MATCHES``, with
    level(x) = edge(x) - (``MATCHES`` + 1) x. Only edges below all levels before them can begin
    a best run; those are met with the ends from both lists' ends in one walk.
    """
    level = F.transform(edges, lambda at, x: at - x * (MATCHES + 1))

    def lower(s: Column, here: Column) -> Column:
        kept = F.when(here < s["least"], F.concat(s["starts"], F.array(s["x"]))).otherwise(s["starts"])
        return F.struct((s["x"] + 1).alias("x"), F.least(s["least"], here).alias("least"), kept.alias("starts"))

    none = F.array().cast("array<int>")
    first = F.struct(F.lit(0).alias("x"), F.lit(2**31 - 1).alias("least"), none.alias("starts"))
    starts = lambda level: F.aggregate(level, first, lower, lambda s: s["starts"])
    names = "r b first last matched".split()

    def state(*values: Column) -> Column:
        return F.struct(*[v.cast("int").alias(n) for n, v in zip(names, values)])

    def walk(level: Column, starts: Column) -> Column:
        def step(s: Column, _: Column) -> Column:
            a, b = F.get(starts, s["r"]), s["b"]
            fits = F.get(level, b) >= F.get(level, a) - MATCHES
            matched = (F.get(edges, b) - b) - (F.get(edges, a) - a)
            better = fits & (matched >= s["matched"])
            pick = lambda new, old: F.when(better, new).otherwise(s[old])
            moved = state(
                s["r"] - fits.cast("int"), b - (~fits).cast("int"), pick(a, "first"), pick(b, "last"), pick(matched, "matched")
            )
            return F.when((s["r"] >= 0) & (b >= 0), moved).otherwise(s)

        start = state(F.size(starts) - 1, F.size(level) - 1, F.lit(0), F.lit(1), F.lit(0))
        return F.aggregate(F.sequence(F.lit(1), F.size(starts) + F.size(level)), start, step)

    return _let(level, lambda level: _let(starts(level), lambda starts: walk(level, starts)))


def _trimmed(same: Column, edges: Column, widest: Column) -> Column:
    begin = F.get(edges, widest["first"]) + 1
    inner = F.slice(same, begin + 1, F.get(edges, widest["last"]) - begin)
    before = lambda run: F.greatest(F.array_position(run, True) - 1, F.lit(0)).cast("int")
    length = F.size(inner) - before(inner) - before(F.reverse(inner))
    return F.struct(
        (begin + before(inner)).alias("start"),
        F.when(widest["matched"] > 0, length).otherwise(0).alias("n_words"),
        widest["matched"].alias("n_matched"),
    )


def overlaps(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, text_key, item_id, start, n_words, n_matched, item_words``: the best overlap of
    each text with each item that it shares a passage with.

    ``docs`` has ``doc_id, text`` and ``benchmark`` has ``item_id, text``; other columns are
    ignored. ``text_key`` is a hash of the text, so rows that share an id stay apart, and equal
    rows give one result. Null and empty texts overlap with nothing. Items shorter than the
    masks are searched for whole, items under ``LEAST_WORDS`` words not at all; of scripts without
    spaces every character is a word. An overlap is any
    run of aligned words with ``OVERLAP_WORDS`` matches (all words of a shorter item) and a share
    of matches of ``OVERLAP_SHARE``; the one with the most matches is given. Ties between
    overlaps go to the earlier place, then to the shorter run.

    The benchmark's seeds are broadcast if they fit ``broadcast_bytes``; a larger benchmark is
    worked through in blocks of items, each of which fits.
    """
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", words_of(F.col("text")).alias("item"))
    items = stage(items.withColumn("item_words", F.size("item")).where(F.col("item_words") >= LEAST_WORDS), "items")
    short = [r[0] for r in items.where(F.col("item_words") < SPAN).select("item_words").distinct().collect()]
    masks = MASKS + [tuple(range(n)) for n in sorted(short)]
    size = items.agg(
        (F.sum("item_words") * F.lit(SEED_BYTES * len(masks)) + F.sum(F.octet_length(F.array_join("item", " ")))).alias("b")
    ).first().b or 0
    blocks = max(1, -(-int(size) // broadcast_bytes))
    found = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else items
        some = _overlaps_of_block(docs, part, masks)
        found = some if found is None else found.unionByName(some)
    keys = ["doc_id", "text_key", "item_id"]
    best = F.max_by(F.struct("start", "n_words", "n_matched", "item_words"), F.struct("n_matched", -F.col("start"), -F.col("n_words"))).alias("b")
    return found.groupBy(*keys).agg(best).select(*keys, "b.*")


def _overlaps_of_block(docs: DataFrame, items: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    item = F.col("item")
    seeds = (
        items.select("item_id", "item_words", "item", _positions(item).alias("item_at"))
        .select("item_id", "item_words", "item_at", _seeds(item, F.col("item_at"), masks).alias("seed"))
        .where(F.col("seed").isNotNull())
    )
    words, at = F.col("words"), F.col("at")
    hits = (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
        .where(F.size(words) >= LEAST_WORDS)
        .select("doc_id", "text_key", "words", _positions(words).alias("at"))
        .select("doc_id", "text_key", "words", "at", _seeds(words, at, masks).alias("seed"))
        .join(F.broadcast(seeds), "seed")
    )
    shift = (F.col("at") - F.col("item_at")).alias("shift")
    head = F.greatest(-F.col("shift"), F.lit(0))
    around = F.slice(words, F.greatest(F.col("shift"), F.lit(0)) + 1, F.col("item_words") - head)
    one = (
        hits.select("doc_id", "text_key", "item_id", "item_words", "words", shift)
        .select("doc_id", "text_key", "item_id", "shift", around.alias("around"))
        .groupBy("doc_id", "text_key", "item_id", "shift")
        .agg(F.first("around").alias("around"))
    )
    compared = one.join(F.broadcast(items), "item_id").select(
        "doc_id", "text_key", "item_id", "item_words", "shift",
        _overlap(F.col("around"), F.slice(item, head + 1, F.size("around"))).alias("o"),
    )
    return compared.select(
        "doc_id", "text_key", "item_id",
        (F.greatest(F.col("shift"), F.lit(0)) + F.col("o.start")).alias("start"),
        F.col("o.n_words"), F.col("o.n_matched"), "item_words",
    ).where(F.col("n_matched") >= F.least(F.lit(OVERLAP_WORDS), F.col("item_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, columns as they are."""
    named = docs.columns
    key = "__text_key"
    hit = overlaps(docs, benchmark).select(F.col("doc_id").alias("__doc_id"), F.col("text_key").alias(key)).distinct()
    hit = stage(hit, "overlaps")
    rows = docs.withColumn("__own_key", F.xxhash64("text"))
    same = (F.col("__own_key") == F.col(key)) & F.col("doc_id").eqNullSafe(F.col("__doc_id"))
    return rows.join(hit, same, "left_anti").select(*named)


def op3_decontamination(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return overlaps(documents(spark, sf_dir), benchmark).drop("text_key")


QUERIES = {"op3_decontamination": op3_decontamination}
ORACLES: dict[str, str] = {}
