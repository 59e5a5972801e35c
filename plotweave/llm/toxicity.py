"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens, which are words and the beginnings of words, are scored by their log-odds between
toxic and clean documents, with a Dirichlet prior taken from all training tokens. Every maximal
scoring segment of a text is found in one pass; how high a segment must score to be more than
chance follows from an extreme-value distribution, and a document's probability from its
significance.

The best score S of clean text of n words has P(S <= x) = exp(-k n exp(-rate x)). Both numbers are
fitted by maximum likelihood to documents whose words were scored without them: the sample is
dealt into ``FOLDS`` parts, and each is scanned with the scores that the others give.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plotweave.llm.common import documents, held_out, lower_ascii, own_texts, slices, smallest_by_hash, split_words
from plotweave.session import stage

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Nothing is learned from more labelled documents than this; which ones a hash decides.
TRAINING_DOCUMENTS = 20_000
# Besides a word itself, its first letters are tokens, so that inflected and rare forms count.
PREFIXES = (5, 4)
MARK = "*"
# The prior's weight as a share of all counts, and what log-odds need to differ from chance.
PRIOR_SHARE = 0.05
SIGNIFICANT_Z = 3.5
LEAST_DOCUMENTS = 5
# Taken off every word's score, so that ordinary text scores below zero.
DRIFT = 0.7
# Parts of the sample; each is judged by the words that the others choose.
FOLDS = 4
# A segment is toxic if clean text has one as high less often than this.
SIGNIFICANCE = 0.01


@dataclass(frozen=True)
class ToxicityModel:
    """``scores`` of the words that differ; all others score ``-DRIFT``. ``k`` and ``rate`` are
    those of the extreme-value distribution, ``slope`` and ``offset`` of the calibration."""

    scores: dict[str, float]
    k: float
    rate: float
    slope: float
    offset: float
    base: float


def log_odds(counts: DataFrame, totals: tuple[float, float]) -> DataFrame:
    """``word, score`` of the words whose log-odds are significant.

    ``counts`` has ``word, toxic, clean``: in how many documents of each kind a word occurs;
    ``totals`` are the sums of both. The prior has ``PRIOR_SHARE`` of all counts, distributed
    as all tokens are.
    """
    n1, n0 = totals
    weight = PRIOR_SHARE * (n1 + n0)
    y1, y0 = F.col("toxic"), F.col("clean")
    prior = F.lit(PRIOR_SHARE) * (y1 + y0)
    odds = lambda y, n: F.log((y + prior) / (F.lit(n + weight) - y - prior))
    score = odds(y1, n1) - odds(y0, n0)
    deviation = F.sqrt(1.0 / (y1 + prior) + 1.0 / (y0 + prior))
    scored = counts.where(y1 + y0 >= LEAST_DOCUMENTS).withColumn("score", score)
    return scored.where(F.col("score") / deviation >= SIGNIFICANT_Z).select("word", "score")


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time.

    ``scores`` are those of runs of words. Each run with a positive score starts a candidate;
    candidates merge as long as the sum from an earlier one on grows.
    """
    total = 0.0
    found: list[list] = []  # start, end, sum before, sum after, previous one with a lower sum before
    for i, s in enumerate(scores.tolist()):
        before, total = total, total + s
        if s <= 0:
            continue
        new = [i, i + 1, before, total, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3], -1]
            del found[j:]
    return [(a, b, high - low) for a, b, low, high, _ in found]


class _Scanner:
    """Words of texts to segments; texts in one Arrow array."""

    def __init__(self, scores: dict[str, float]):
        self.tables = []
        for size in (0, *PREFIXES):
            own = {w: s for w, s in scores.items() if (w.index(MARK) if MARK in w else 0) == size}
            words = pa.array([w.rstrip(MARK) for w in own], pa.large_string())
            self.tables.append((size, words, np.array([*own.values(), 0.0])))

    def _scores(self, words: pa.Array) -> np.ndarray:
        """Each word's score, or that of its longest beginning that has one."""
        out = np.zeros(len(words))
        for size, known, scores in self.tables:
            tokens = pc.utf8_slice_codeunits(words, 0, size) if size else words
            found = pc.index_in(tokens, value_set=known).fill_null(len(known)).to_numpy(zero_copy_only=False)
            out = np.where(out > 0, out, scores[found])
        return out

    def scan(self, texts: pa.Array) -> list[tuple[int, list[tuple[int, int, float]]]]:
        """Per text the number of words, and its segments in words."""
        texts = pc.ascii_lower(own_texts(texts))
        split = pc.split_pattern_regex(texts, SEPARATORS)
        flat = split.flatten()
        ends = split.offsets.to_numpy().astype("int64")
        ends = ends - ends[0]
        real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        words = flat.dictionary_encode()
        score = self._scores(words.dictionary)[words.indices.to_numpy()]
        # Positions without the empty words.
        place = np.concatenate([[0], np.cumsum(real)])
        hits = np.flatnonzero(score > 0)
        at, value = place[hits], score[hits]
        bounds = place[ends]
        first, last = np.searchsorted(hits, ends[:-1]), np.searchsorted(hits, ends[1:])
        return [
            (int(b - a), self._of_text(at[f:l] - a, value[f:l]))
            for a, b, f, l in zip(bounds, bounds[1:], first, last)
        ]

    @staticmethod
    def _of_text(at: np.ndarray, value: np.ndarray) -> list[tuple[int, int, float]]:
        """Segments from the places of the scoring words; the words between them cost the drift."""
        if not len(at):
            return []
        runs = np.empty(2 * len(at) - 1)
        runs[::2] = value - DRIFT
        runs[1::2] = -DRIFT * (np.diff(at) - 1)
        return [(int(at[a // 2]), int(at[(b - 1) // 2]) + 1, s) for a, b, s in segments(runs)]


def _log_chance(n: np.ndarray, best: np.ndarray, k: float, rate: float) -> np.ndarray:
    """The decimal logarithm of how many segments of that score ``n`` words of clean text have."""
    return (np.log(k) + np.log(np.maximum(n, 1)) - rate * best) / math.log(10.0)


def _evidence(n: int, found: list[tuple[int, int, float]], k: float, rate: float) -> float:
    """How unlikely the significant segments of a text are: the sum of -log10 of their chances."""
    if not found:
        return 0.0
    chance = _log_chance(np.array([n] * len(found)), np.array([s for *_, s in found]), k, rate)
    return float(-chance[chance < math.log10(SIGNIFICANCE)].sum())


def extreme_value_fit(n: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """``k`` and ``rate`` of the best scores of clean texts of ``n`` words, by maximum likelihood.

    A text without any segment has the best score 0: all that is known is that it is below the
    least one of the others. For a given rate the best k is known, so one number is searched.
    """
    n = np.maximum(n, 1).astype("float64")
    some = best > 0
    m = int(some.sum())
    if m < 5 or best[some].max() <= best[some].min():
        return max(m, 1) / max(float(n.sum()), 1.0), 1.0
    x = np.where(some, best, best[some].min())
    total = float(best[some].sum())

    def likelihood(rate: float) -> float:
        return m * (math.log(rate) - math.log(float((n * np.exp(-rate * x)).sum()))) - rate * total

    # The logarithm of the rate, in ever smaller steps around the best one.
    low, high = math.log(0.02), math.log(20.0)
    for _ in range(8):
        grid = np.linspace(low, high, 21)
        at = int(np.argmax([likelihood(math.exp(r)) for r in grid]))
        low, high = grid[max(at - 1, 0)], grid[min(at + 1, 20)]
    rate = math.exp((low + high) / 2)
    return m / float((n * np.exp(-rate * x)).sum()), rate


def train(docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCUMENTS) -> ToxicityModel:
    """A model from at most ``most`` labelled documents outside the held-out fold.

    ``labels`` has ``doc_id, toxic``; rows with a null in either are left out, and of texts
    that are equal one is used. Word counts are made in Spark; the significant words, no more
    than the bounded sample has, and the segments of the sample reach the driver. Without
    documents of both kinds the model scores everything as the share of toxic labels.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = smallest_by_hash(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id", most)
    # The sample is bounded by ``most``.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy(F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")).agg(
        F.first(F.coalesce("text", F.lit(""))).alias("text"), F.max("toxic").alias("toxic")
    )
    sample = stage(rows, "toxicity_sample")
    kinds = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    base = kinds.get(1, 0) / max(1, sum(kinds.values()))
    if not kinds.get(1) or not kinds.get(0):
        return ToxicityModel({}, 1.0, 1.0, 0.0, 0.0, base)
    words = F.array_distinct(split_words(lower_ascii(F.col("text")), SEPARATORS))
    begun = [
        F.transform(words, lambda w: F.when(F.length(w) >= size, F.concat(F.substr(w, F.lit(1), F.lit(size)), F.lit(MARK))))
        for size in PREFIXES
    ]
    tokens = F.array_compact(F.array_distinct(F.concat(words, *begun)))
    toxic = F.col("toxic")
    fold = F.pmod(F.xxhash64("text_key", F.lit(FOLDS)), F.lit(FOLDS)).cast("int").alias("fold")
    counts = stage(
        sample.select(F.explode(tokens).alias("word"), "toxic", fold)
        .groupBy("word", "fold")
        .agg(F.sum(toxic.cast("double")).alias("toxic"), F.sum((1 - toxic).cast("double")).alias("clean")),
        "toxicity_words",
    )
    scanned = []
    for part in range(FOLDS):
        own = _scan(sample.where(fold == part).select("text_key", "text", "toxic"), _scores(counts.where(F.col("fold") != part)))
        scanned.append(own.toArrow())
    return _calibrated(_scores(counts), pa.concat_tables(scanned).sort_by("text_key"), base)


def _scores(counts: DataFrame) -> dict[str, float]:
    """The significant words of some folds' counts; no more than the bounded sample has."""
    every = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    totals = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    return {r.word: r.score for r in log_odds(every, (totals[0] or 0.0, totals[1] or 0.0)).collect()}


def _calibrated(scores: dict[str, float], scanned: pa.Table, base: float) -> ToxicityModel:
    """The extreme-value distribution of clean text, and the probability given the evidence."""
    n, best = scanned["n_words"].to_numpy(), scanned["best"].to_numpy()
    toxic = scanned["toxic"].to_numpy().astype(float)
    k, rate = extreme_value_fit(n[toxic == 0], best[toxic == 0])
    evidence = np.array([_evidence(a, _triples(s), k, rate) for a, s in zip(n, scanned["segments"].to_pylist())])
    slope, offset = _logistic(np.log1p(evidence), toxic)
    return ToxicityModel(scores, k, rate, slope, offset, base)


def _triples(rows) -> list[tuple[int, int, float]]:
    return [(int(r["start"]), int(r["end"]), float(r["score"])) for r in rows]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """A logistic curve of one variable, with a slight pull towards zero, by Newton steps."""
    a = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([((y - p) * x).sum() - 0.1 * a, (y - p).sum() - 0.01 * b])
        hessian = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a + float(np.clip(step[0], -5, 5)), b + float(np.clip(step[1], -5, 5))
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 0.0), b


_SEGMENTS = "array<struct<start:int,end:int,score:double>>"


def _scan(rows: DataFrame, scores: dict[str, float]) -> DataFrame:
    """``rows`` without ``text``, with ``n_words``, ``best`` and ``segments``."""
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(scores)
        struct = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            for part in slices(batch, "text"):
                found = scanner.scan(part.column("text"))
                columns = [part.column(f.name) for f in kept]
                columns += [
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([max((s for *_, s in x), default=0.0) for _, x in found], pa.float64()),
                    pa.array([[{"start": a, "end": b, "score": s} for a, b, s in x] for _, x in found], struct),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + ["n_words", "best", "segments"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(scan, f"{types}, n_words long, best double, segments {_SEGMENTS}")


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, n_words, passages`` for each row of ``docs`` (``doc_id, text``).

    ``passages`` are the significant segments: start and end in words, score, and ``chance``,
    how many as high are expected in clean text of this length, with its decimal logarithm. ``score`` is the probability
    of a toxic label. Only the text counts. Null and empty texts have no words and the score
    of a text without evidence; equal texts score equally; other columns are ignored. No
    shuffle; the model is the bounded list of significant words.
    """
    scanned = _scan(docs.select("doc_id", "text"), model.scores)
    n = F.greatest("n_words", F.lit(1))
    # In logarithms, so that no chance is too small to tell from another.
    chance = lambda s: F.lit(math.log(model.k)) + F.log(n) - F.lit(model.rate) * s["score"]
    struct = lambda s: F.struct(s["start"], s["end"], s["score"], F.exp(chance(s)).alias("chance"), (chance(s) / math.log(10.0)).alias("log_chance"))
    passages = F.filter(F.transform("segments", struct), lambda s: s["log_chance"] < math.log10(SIGNIFICANCE))
    evidence = F.aggregate(F.transform("passages", lambda s: -s["log_chance"]), F.lit(0.0), lambda a, x: a + x)
    x = F.log1p(evidence) * model.slope + model.offset
    score = 1.0 / (1.0 + F.exp(-x)) if model.scores else F.lit(model.base)
    scored = scanned.withColumn("passages", passages)
    return scored.select("doc_id", score.alias("score"), "n_words", "passages")


def op5_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
    )


QUERIES = {"op5_toxicity": op5_toxicity}
ORACLES: dict[str, str] = {}
