"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded as a vector; gated attention gives
each a weight, learned from document labels alone; the weighted sum is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plotweave.llm.common import documents, held_out, own_texts, slices, smallest_by_hash

PASSAGE_BYTES = 256
# The classes of bytes whose shares describe a passage; all other bytes are one more class.
CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b"\t", b".", b",",
    b"!", b"?", b";:", b"'\"", b"#", b"$", b"%", b"&", b"*", b"|", b"-_", b"/\\", b"()[]{}<>", b"=+~^`@",
]
# Where a passage repeats itself at these distances, it is padding rather than prose.
LAGS = tuple(range(1, 33))
HASHED = 16

# Nothing is learned from more labelled documents than this, nor from more passages together;
# which ones a hash decides. Those that take part do so with their whole texts.
TRAINING_DOCUMENTS = 6_000
TRAINING_PASSAGES = 200_000
HIDDEN, ATTENTION = 24, 12
EPOCHS, BATCH, STEP, DECAY = 30, 64, 0.01, 1e-4
THRESHOLD = 0.3
# Text that is encoded at a time, in bytes; it takes some thirty times as much memory.
SLICE = 1_000_000


def _class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES) + 1, "int32")
    table[128:] = len(CLASSES)
    for k, members in enumerate(CLASSES):
        table[list(members)] = k
    return table


_CLASS_OF = _class_table()
_N_CLASSES = len(CLASSES) + 2
_PAIR_OF = (np.arange(_N_CLASSES * _N_CLASSES) * 2654435761 % 4294967296 % HASHED).astype("int32")
N_FEATURES = _N_CLASSES + 4 + HASHED


def encode_passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The passages' vectors, and how many passages each text has; an empty text has one.

    Passages are runs of ``PASSAGE_BYTES`` bytes, the last one shorter. A vector holds the
    shares of the byte classes, the passage's length, how often a byte equals the one some
    places before (the best and the mean distance), the mean word length, and hashed shares of
    pairs of neighbouring classes.
    """
    texts = own_texts(texts)
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", "uint8")[offsets[0] : offsets[-1]]
    ends = offsets - offsets[0]
    sizes = np.diff(ends)
    counts = np.maximum(-(-sizes // PASSAGE_BYTES), 1)
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(sizes)), counts)
    begins = ends[:-1][owner] + (np.arange(len(owner)) - first[owner]) * PASSAGE_BYTES
    lengths = np.minimum(ends[1:][owner] - begins, PASSAGE_BYTES)
    n = len(owner)
    passage = np.repeat(np.arange(n, dtype="int32"), lengths)
    classes = _CLASS_OF[data]
    per = np.maximum(lengths, 1).astype("float64")
    shares = np.bincount(passage * _N_CLASSES + classes, minlength=n * _N_CLASSES).reshape(n, _N_CLASSES) / per[:, None]
    pair = _PAIR_OF[classes[:-1] * _N_CLASSES + classes[1:]]
    inside = passage[:-1] == passage[1:]
    hashed = np.bincount((passage[:-1] * HASHED + pair)[inside], minlength=n * HASHED).reshape(n, HASHED) / per[:, None]
    same = np.zeros((len(LAGS), n))
    for k, lag in enumerate(LAGS):
        equal = (data[lag:] == data[:-lag]) & (passage[lag:] == passage[:-lag]) if len(data) > lag else np.zeros(0, bool)
        same[k] = np.bincount(passage[lag:][equal], minlength=n) if len(equal) else 0
    same /= np.maximum(per - np.array(LAGS)[:, None], 1.0)
    space = shares[:, 3] + shares[:, 4]
    extra = np.stack([per / PASSAGE_BYTES, same.max(axis=0), same.mean(axis=0), np.log1p(1.0 / np.maximum(space, 1.0 / PASSAGE_BYTES))], axis=1)
    return np.concatenate([shares, extra, hashed], axis=1), counts


@dataclass(frozen=True)
class QualityModel:
    """The network's weights; ``mean`` and ``scale`` standardise the vectors."""

    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    base: float
    trained: bool


def _forward(w: tuple[np.ndarray, ...], x: np.ndarray, counts: np.ndarray) -> dict:
    """Bags of passages to logits; ``counts`` says how many rows of ``x`` each bag has."""
    encode, encode_0, tanh_w, gate_w, attention, out, out_0 = w
    starts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    h = np.maximum(x @ encode + encode_0, 0)
    t, g = np.tanh(h @ tanh_w), 1 / (1 + np.exp(-(h @ gate_w)))
    energy = (t * g) @ attention
    energy = energy - np.maximum.reduceat(energy, starts)[owner]
    e = np.exp(energy)
    a = e / np.add.reduceat(e, starts)[owner]
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "owner": owner, "logit": z @ out + out_0, "starts": starts}


def _gradients(w: tuple[np.ndarray, ...], x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    encode, _, tanh_w, gate_w, attention, out, _ = w
    f = _forward(w, x, counts)
    p = 1 / (1 + np.exp(-f["logit"]))
    d_logit = (p - y) / len(y)
    d_z = d_logit[:, None] * out
    own = d_z[f["owner"]]
    d_a = (own * f["h"]).sum(axis=1)
    mean = np.add.reduceat(f["a"] * d_a, f["starts"])[f["owner"]]
    d_energy = f["a"] * (d_a - mean)
    d_t = d_energy[:, None] * attention * f["g"] * (1 - f["t"] ** 2)
    d_g = d_energy[:, None] * attention * f["t"] * f["g"] * (1 - f["g"])
    d_h = f["a"][:, None] * own + d_t @ tanh_w.T + d_g @ gate_w.T
    d_h = d_h * (f["h"] > 0)
    return [
        x.T @ d_h, d_h.sum(axis=0), f["h"].T @ d_t, f["h"].T @ d_g,
        ((f["t"] * f["g"]) * d_energy[:, None]).sum(axis=0), f["z"].T @ d_logit, d_logit.sum(keepdims=True),
    ]


def fit(bags: list[np.ndarray], y: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """Adam on the cross-entropy of the bags' labels."""
    rows = np.concatenate(bags)
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    bags = [np.clip((b - mean) / scale, -8, 8) for b in bags]
    rng = np.random.default_rng(seed)
    n, start = N_FEATURES, lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = [
        start(n, HIDDEN), np.zeros(HIDDEN), start(HIDDEN, ATTENTION), start(HIDDEN, ATTENTION), start(ATTENTION),
        start(HIDDEN), np.array([np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))]),
    ]
    m, v, step = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
    for epoch in range(EPOCHS):
        rate = STEP * (1 - epoch / EPOCHS)
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            x = np.concatenate([bags[i] for i in chosen])
            counts = np.array([len(bags[i]) for i in chosen])
            step += 1
            for i, d in enumerate(_gradients(tuple(w), x, counts, y[chosen])):
                d = d + DECAY * w[i]
                m[i] = 0.9 * m[i] + 0.1 * d
                v[i] = 0.999 * v[i] + 0.001 * d * d
                w[i] = w[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return mean, scale, tuple(w)


def training_rows(docs: DataFrame, labels: DataFrame, most: int, passages: int) -> DataFrame:
    """``text, quality`` of the labelled rows outside the held-out fold that are learned from.

    They are taken in the order of a hash, ``most`` at most and as many whole texts as have no
    more than ``passages`` passages together; a text that alone has more is passed over. Rows
    that repeat id and text count once.
    """
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = smallest_by_hash(usable.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")), "doc_id", most)
    # Bounded by ``most``; so is the list of rows below.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    size = F.greatest(F.ceil(F.octet_length(F.coalesce("text", F.lit(""))) / PASSAGE_BYTES), F.lit(1))
    known = rows.select("doc_id", F.xxhash64("text").alias("of_text"), size.cast("long").alias("size")).distinct()
    taken, total = [], 0
    for r in known.orderBy(F.xxhash64("doc_id"), "doc_id", "of_text").limit(most).collect():
        if total + r["size"] <= passages:
            taken.append((r.doc_id, r.of_text))
            total += r["size"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    listed = docs.sparkSession.createDataFrame(taken, f"doc_id {kind}, of_text long")
    return rows.withColumn("of_text", F.xxhash64("text")).join(F.broadcast(listed), ["doc_id", "of_text"]).select("doc_id", "text", "quality")


def train(
    docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCUMENTS, passages: int = TRAINING_PASSAGES
) -> QualityModel:
    """A model from the rows that ``training_rows`` chooses.

    ``labels`` has ``doc_id, quality``; rows with a null in either are left out. The passages'
    vectors are made in Spark; those of the bounded sample reach the driver. Without documents of
    both kinds the model scores everything as the share of labels 1.
    """

    def bags_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                x, counts = encode_passages(part.column("text"))
                ends = np.cumsum(counts)
                bags = [x[a:b].astype("<f4").tobytes() for a, b in zip(ends - counts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"), pa.array(bags, pa.binary())], names=["doc_id", "quality", "bag"]
                )

    rows = training_rows(docs, labels, most, passages)
    kind = rows.schema["doc_id"].dataType.simpleString()
    sample = rows.mapInArrow(bags_of, f"doc_id {kind}, quality int, bag binary").distinct().select("quality", "bag").toArrow()
    # In one order whatever the partitions were.
    sample = sample.sort_by([("bag", "ascending"), ("quality", "ascending")])
    y = np.array(sample.column("quality").to_pylist(), float)
    base = float(y.mean()) if len(y) else 0.5
    if base in (0.0, 1.0) or not len(y):
        return QualityModel(np.zeros(N_FEATURES), np.ones(N_FEATURES), (), base, False)
    bags = [np.frombuffer(b.as_py(), "<f4").reshape(-1, N_FEATURES).astype(float) for b in sample.column("bag")]
    mean, scale, weights = fit(bags, y)
    return QualityModel(mean, scale, weights, base, True)


def score_quality(
    docs: DataFrame, model: QualityModel, score_as: str = "score", passage_as: str = "main_passage"
) -> DataFrame:
    """``docs`` with ``score``, the probability of good quality, and ``main_passage``, the number
    of the passage with the greatest attention weight, or under other names.

    All passages of a text count. Only the text is looked at; a null text is an empty one, and
    an empty text is one passage of nothing. Equal texts score equally; all columns are kept
    (one of the same name is replaced). No shuffle.
    """
    kept = [f for f in docs.schema.fields if f.name not in (score_as, passage_as)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                n = part.num_rows
                if model.trained:
                    x, counts = encode_passages(part.column("text"))
                    f = _forward(model.weights, np.clip((x - model.mean) / model.scale, -8, 8), counts)
                    p = 1 / (1 + np.exp(-f["logit"]))
                    best = np.maximum.reduceat(f["a"], f["starts"])[f["owner"]] == f["a"]
                    at = np.flatnonzero(best)
                    _, one = np.unique(f["owner"][at], return_index=True)
                    main = at[one] - f["starts"]
                else:
                    p, main = np.full(n, model.base), np.zeros(n, "int64")
                columns = [part.column(f.name) for f in kept] + [pa.array(p), pa.array(main, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + [score_as, passage_as])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.select([f"`{f.name}`" for f in kept]).mapInArrow(score, f"{types}, `{score_as}` double, `{passage_as}` long")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, columns as they are."""
    scored = score_quality(docs, model, "__score", "__passage")
    return scored.where(F.col("__score") >= threshold).select([f"`{c}`" for c in docs.columns])


def op6_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "main_passage",
    )


QUERIES = {"op6_quality": op6_quality}
ORACLES: dict[str, str] = {}
