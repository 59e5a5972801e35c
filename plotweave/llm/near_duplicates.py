"""Near-duplicate documents from bottom-k sketches of one hash function.

A document is the set of its five-word shingles; its sketch is the ``SKETCH`` smallest hashes.
Documents with equal sets are one node. Inverted lists of the retained hashes propose pairs,
the sketch of the union of both estimates their similarity, and the exact Jaccard coefficient
of the full sets confirms each link.

Every node is first compared with the first node of each of its lists; after that only nodes
which are not connected yet can still add anything, and lists of copies, however many, are
done. What is left of short lists are pairs; what is left of long ones is compared in blocks,
which leave out whatever is connected and give no rows but links. Of a node's hashes only the rarest need lists: two sets with more
common hashes than one leaves out must share one of the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from plotweave.llm.common import ROW, bucketed, documents, own_texts, slices
from plotweave.llm.components import components
from plotweave.session import stage, stage_measured

SHINGLE_WORDS = 5
# Links have 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
SKETCH = 64
# How likely it may be that a link is missed because two sketches happen to share too little.
MISSED = 2e-9
# Pairs of one node that are worked on together; a node with more is sent to several tasks.
HUB = 256
# Lists of up to this many nodes give their remaining pairs as rows; the nodes of longer ones
# are compared in blocks of so many, by matrices of so many columns.
SHORT_LIST = 32
BLOCK = 256
COLUMNS = 4096

_BYTES = np.arange(256, dtype="uint8")
_BYTES[65:91] += 32
_BYTES[9:14] = 32
_STEP, _ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ONE
    x = (x ^ (x >> np.uint64(27))) * _TWO
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct 63-bit hashes of its shingles.

    A-Z are lower-cased; words are what stands between spaces, tabs and line breaks. A text
    with fewer words than ``size`` has one shingle, its whole sequence; one without words has
    none.
    """
    texts = own_texts(texts)
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", "uint8")
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(_BYTES[data].tobytes()))
    split = pc.split_pattern(plain, " ")
    words = split.flatten().dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words.dictionary.cast(pa.large_binary()).to_pylist()], "uint64")
    real = np.array([len(w) > 0 for w in words.dictionary.to_pylist()], bool)
    codes = words.indices.to_numpy()
    present = real[codes] if len(codes) else np.zeros(0, bool)
    ends = split.offsets.to_numpy().astype("int64")
    ends = np.concatenate([[0], np.cumsum(present)])[ends - ends[0]]
    h = hashes[codes[present]] if len(codes) else np.zeros(0, "uint64")
    out = []
    with np.errstate(over="ignore"):
        n = len(h)
        rolled = np.zeros(max(n - size + 1, 0), "uint64")
        for k in range(size):
            rolled = _mix(rolled * _STEP + h[k : n - size + 1 + k]) if len(rolled) else rolled
        rolled >>= np.uint64(1)
        for a, b in zip(ends, ends[1:]):
            if b - a >= size:
                out.append(np.unique(rolled[a : b - size + 1]))
            elif b > a:
                whole = np.zeros(1, "uint64")
                for x in h[a:b]:
                    whole = _mix(whole * _STEP + x)
                out.append(_mix(whole + np.uint64(b - a)) >> np.uint64(1))
            else:
                out.append(np.zeros(0, "uint64"))
    return out


def _sketched(docs: DataFrame, size: int, k: int, others: tuple[str, ...]) -> DataFrame:
    """``row_no, doc_id, text, others, n, key, sketch``; key identifies the set, null for an empty one."""
    carried = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None).cast("string")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                heads = [s[:k].view("int64") for s in sets]
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in heads])]).astype("int32")
                values = pa.array(np.concatenate(heads) if heads else np.zeros(0, "int64"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(ROW), part.column("doc_id"), part.column("text"), part.column("others"),
                        pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(bounds), values),
                    ],
                    names=[ROW, "doc_id", "text", "others", "n", "key", "sketch"],
                )

    rows = docs.select(F.monotonically_increasing_id().alias(ROW), F.col("doc_id").cast("long").alias("doc_id"), "text", carried.alias("others"))
    kind = rows.schema["others"].dataType.simpleString()
    return rows.mapInArrow(run, f"{ROW} long, doc_id long, text string, others {kind}, n long, key binary, sketch array<long>")


def _lists(nodes: DataFrame, similarity: int, k: int) -> DataFrame:
    """``value, node, n``: of each node the rarest retained hashes, those that others have too."""
    postings = nodes.select(F.explode("sketch").alias("value"), "node", "n")
    frequent = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = postings.join(frequent, "value").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values")
    )
    # Sets so small that all they can be similar to are within their sketches.
    whole = F.col("n") <= math.floor(k * similarity / 100)
    needed = F.when(whole, F.ceil(F.col("n") * similarity / 100)).otherwise(F.lit(least_shared(similarity, k)))
    held = F.least(F.col("n"), F.lit(k))
    kept = held - needed + 1 - (held - F.size("values"))
    return shared.where(kept > 0).select(
        F.explode(F.slice("values", 1, F.least(kept, F.size("values")).cast("int"))).alias("v"), "node", "n"
    ).select("v.value", "node", "n")


def least_shared(similarity: int, k: int) -> int:
    """Of the ``k`` least hashes of two sets' union, how many both sets have but for a probability
    of ``MISSED``, if their similarity is at least ``similarity`` percent."""
    share, below = similarity / 100.0, 0.0
    for n in range(k + 1):
        below += math.comb(k, n) * share**n * (1.0 - share) ** (k - n)
        if below > MISSED:
            break
    if n == 0:
        raise ValueError(f"sketches of {k} hashes are too small for a similarity of {similarity} percent")
    return n


def _similar_sizes(a: Column, b: Column, similarity: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * similarity


def _with_hubs(pairs: DataFrame, side: DataFrame) -> DataFrame:
    """``pairs`` (``a, b``, stored) joined to ``side`` on ``a``. Of a node with more than ``HUB``
    pairs every ``HUB`` of them meet a copy of its row, so that no task gets them all."""
    hubs, found = stage_measured(
        pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB).cast("int").alias("copies")).where("copies > 1"),
        "hubs", F.count("*").alias("n"),
    )
    if not found["n"]:
        return pairs.join(side, "a")
    dealt = pairs.join(hubs, "a", "left")
    few = dealt.where("copies IS NULL").drop("copies").join(side, "a")
    copy = F.pmod(F.xxhash64("b"), F.col("copies")).cast("int").alias("copy")
    many = dealt.where("copies IS NOT NULL").select("a", "b", copy)
    copied = side.join(hubs, "a").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    return few.unionByName(many.join(copied, ["a", "copy"]).drop("copy"))


def _estimated(pairs: DataFrame, table: DataFrame, k: int, similarity: int) -> DataFrame:
    """The pairs (``a, b``) whose estimate, from the sketch of the union, is high enough."""
    side = lambda x: table.select(F.col(ROW).alias(x), F.col("sketch").alias(f"sketch_{x}"), F.col("n").alias(f"n_{x}"))
    both = _with_hubs(pairs, side("a")).join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    common = F.size(F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), union))
    exact = (F.col("n_a") <= k) & (F.col("n_b") <= k) & (F.size(F.array_union("sketch_a", "sketch_b")) <= k)
    least = F.when(exact, similarity / 100.0 - 1e-9).otherwise(least_shared(similarity, k) / k - 1e-9)
    return both.where(common / F.size(union) >= least).select("a", "b")


def _confirmed(pairs: DataFrame, table: DataFrame, size: int, similarity: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_b", 4_000_000):
                # A text that stands in many pairs is cut up once.
                of_a = part.column("text_a").dictionary_encode()
                sets_a, sets_b = shingle_sets(of_a.dictionary, size), shingle_sets(part.column("text_b"), size)
                good = []
                for i, y in zip(of_a.indices.to_pylist(), sets_b):
                    x = sets_a[i]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(100 * both >= similarity * (len(x) + len(y) - both))
                at = pa.array(np.flatnonzero(good))
                yield part.select(["a", "b"]).take(at)

    text = lambda x: table.select(F.col(ROW).alias(x), F.col("text").alias(f"text_{x}"))
    both = _with_hubs(pairs, text("a")).join(text("b"), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _pairs_of_first(lists: DataFrame, similarity: int) -> DataFrame:
    """Each node with the first node of each of its lists."""
    first = lists.groupBy("value").agg(F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("size")).where("size > 1")
    pairs = lists.join(first.select("value", "first"), "value").where(F.col("node") != F.col("first.node"))
    return pairs.where(_similar_sizes(F.col("n"), F.col("first.n"), similarity)).select(
        F.col("first.node").alias("a"), F.col("node").alias("b")
    ).distinct()


def _open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists, with ``component``, that hold nodes not connected to each other yet."""
    known = lists.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = stage(known, "labelled_lists")
    still = known.groupBy("value").agg(
        F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low <> high").select("value", "size")
    return known.drop("size").join(still, "value")


def _pairs_within(lists: DataFrame, similarity: int) -> DataFrame:
    """All pairs of unconnected nodes in the same list; for short lists."""
    other = lists.select("value", *[F.col(c).alias(f"{c}_2") for c in ("node", "n", "component")])
    within = lists.join(other, "value").where("node < node_2 and component <> component_2")
    within = within.where(_similar_sizes(F.col("n"), F.col("n_2"), similarity))
    return within.select(F.col("node").alias("a"), F.col("node_2").alias("b")).distinct()


def _blocks(lists: DataFrame) -> DataFrame:
    """``node, component, block, whole``: every node in one block of at most about ``BLOCK``.

    Nodes go by the longest of their lists, and by their component if that is a large one;
    then ``whole`` names it, since nothing within it is left to compare.
    """
    nodes = lists.groupBy("node", "component").agg(F.max(F.struct("size", "value")).alias("longest"))
    nodes = nodes.select("node", "component", F.col("longest.value").alias("of_list"))
    large = nodes.groupBy("component").agg(F.count("*").alias("members")).where(F.col("members") >= BLOCK)
    nodes = nodes.join(large.select("component", F.col("component").alias("whole")), "component", "left")
    keys = ["of_list", F.coalesce("whole", F.lit(-1)).alias("whole")]
    nodes = stage(nodes.select("node", "component", *keys), "open_nodes")
    parts = nodes.groupBy("of_list", "whole").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    return stage(
        nodes.join(parts, ["of_list", "whole"]).select(
            "node", "component", F.xxhash64("of_list", "whole", part).alias("block"), "whole"
        ),
        "blocks",
    )


def _links_of_long_lists(lists: DataFrame, table: DataFrame, size: int, similarity: int) -> DataFrame:
    """Links ``a, b`` between unconnected nodes of long lists, as many as connect them.

    Two blocks meet if a list has nodes of both. A meeting compares full sets by one matrix
    product over the hashes that several of its nodes have; no pair is a row until it is a
    link, and links that connect nothing new in the meeting are left out.
    """
    blocks = _blocks(lists)
    of_list = lists.select("value", "node").join(blocks, "node").select("value", "block", "whole").distinct()
    of_list = stage(of_list, "blocks_of_lists")
    other = of_list.select("value", F.col("block").alias("block_2"), F.col("whole").alias("whole_2"))
    meetings = of_list.join(other, "value").where("block <= block_2 and (whole <> whole_2 or whole = -1)")
    meetings = meetings.select(F.col("block").alias("one"), F.col("block_2").alias("two")).distinct()
    sides = F.when(F.col("one") == F.col("two"), F.array("one")).otherwise(F.array("one", "two"))
    sent = meetings.select("one", "two", F.explode(sides).alias("block")).join(blocks, "block")
    texts = table.select(F.col(ROW).alias("node"), "text")
    sent = sent.select("one", "two", "block", "node", "component").join(texts, "node")

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        node, component = rows.column("node").to_numpy(), rows.column("component").to_numpy()
        side = rows.column("block").to_numpy() == rows.column("one")[0].as_py()
        alone = rows.column("one")[0] == rows.column("two")[0]
        sets = shingle_sets(rows.column("text").combine_chunks(), size)
        left = np.flatnonzero(side)
        right = left if alone else np.flatnonzero(~side)
        n = np.array([len(s) for s in sets], "float64")
        common = _common([sets[i] for i in left], [sets[i] for i in right])
        union = n[left][:, None] + n[right][None, :] - common
        linked = (100 * common >= similarity * union) & (component[left][:, None] != component[right][None, :])
        joined: dict[int, int] = {}

        def root(x: int) -> int:
            while joined.setdefault(x, x) != x:
                joined[x] = joined[joined[x]]
                x = joined[x]
            return x

        out = []
        for i, j in zip(*np.nonzero(linked)):
            x, y = root(component[left[i]]), root(component[right[j]])
            if x != y:
                joined[max(x, y)] = min(x, y)
                out.append((node[left[i]], node[right[j]]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return sent.groupBy("one", "two").applyInArrow(compare, "a long, b long")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set of ``left`` has in common with each of ``right``."""
    out = np.zeros((len(left), len(right)))
    sizes = [len(s) for s in left + right]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, counts = np.unique(np.concatenate(left + right), return_inverse=True, return_counts=True)
    several = np.cumsum(counts > 1) - 1
    shared = counts[column] > 1
    owner, column = owner[shared], several[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for begin in range(0, int(several[-1]) + 1 if len(several) else 0, COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS])
        block = np.zeros((len(sizes), COLUMNS), "float32")
        block[owner[a:b], column[a:b] - begin] = 1
        out += block[: len(left)] @ block[len(left) :].T
    return out


def near_duplicates(
    docs: DataFrame,
    similarity: int = SIMILARITY,
    size: int = SHINGLE_WORDS,
    k: int = SKETCH,
    others: tuple[str, ...] = (),
) -> DataFrame:
    """``row_no, doc_id, text, n_shingles, component_id, kept, kept_row`` for each row of ``docs``.

    ``docs`` has ``doc_id, text``; of its other columns those named in ``others`` are passed
    on, as one struct ``others``. Two rows are linked when
    ``100 * common shingles >= similarity * shingles of either``. ``component_id`` is the
    smallest id that links lead to (no id counts as the smallest), ``kept`` says whether it is
    the row's own, and ``kept_row`` is true for one row of each component, even if an id
    occurs in several rows. Rows without words, null texts among them, are linked with
    nothing. Equal texts always belong together. An empty table gives no rows. A link is missed
    with a probability of ``MISSED`` at most; a ``k`` too small for that is an error.

    Texts are shuffled once, into buckets that later steps join to where they lie; after that
    only hashes, pairs, and the texts of pairs that are confirmed are moved.
    """
    table = bucketed(_sketched(docs, size, k, others), ROW, "sketches")
    classes = stage(
        table.where("n > 0").groupBy("key").agg(
            F.min(ROW).alias("node"), F.min(F.struct("doc_id", ROW)).alias("least")
        ),
        "shingle_sets",
    )
    nodes = table.select(F.col(ROW).alias("node"), "n", "sketch").join(classes.select("node"), "node")
    lists = stage(_lists(nodes, similarity, k), "lists")

    def links(pairs: DataFrame) -> DataFrame:
        likely = stage(_estimated(stage(pairs, "pairs"), table, k, similarity), "likely_pairs")
        return stage(_confirmed(likely, table, size, similarity), "links")

    edges = links(_pairs_of_first(lists, similarity))
    labels = stage(components(edges), "labels")
    left = stage(_open_lists(lists, labels), "open_lists")
    short, long = left.where(F.col("size") <= SHORT_LIST), left.where(F.col("size") > SHORT_LIST)
    more = links(_pairs_within(short, similarity)).unionByName(_links_of_long_lists(long, table, size, similarity))
    labels = stage(components(edges.unionByName(more)), "labels")
    known = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Stored first, so that the join can split a large component.
    known = stage(known.select("key", "least", "component"), "known")
    least = stage(known.groupBy("component").agg(F.min("least").alias("least_of_all")), "least")
    of_key = stage(known.join(least, "component").select("key", "least_of_all"), "kept")
    keeper, some = F.col("least_of_all"), F.col("n") > 0
    decided = table.select(ROW, "doc_id", "n", "key").join(of_key, "key", "left").select(
        ROW,
        F.when(some, keeper["doc_id"]).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(some, keeper["doc_id"].eqNullSafe(F.col("doc_id"))).otherwise(F.lit(True)).alias("kept"),
        F.when(some, keeper[ROW] == F.col(ROW)).otherwise(F.lit(True)).alias("kept_row"),
    )
    rows = table.select(ROW, "doc_id", "text", "others", F.col("n").alias("n_shingles"))
    return rows.join(decided.hint("shuffle_hash"), ROW)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component, columns as they are; of copies the row with the smallest id."""
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    kept = near_duplicates(docs, others=rest).where("kept_row")
    named = [F.col("others").getField(c).alias(c) if c in rest else F.col(c) for c in docs.columns]
    return kept.select(named)


def op4_near_duplicates(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


QUERIES = {"op4_near_duplicates": op4_near_duplicates}

# Every pair of documents with a common shingle, and everything that links lead to.
_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) >= 5
    THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles AS a JOIN shingles AS b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sets UNION
  SELECT r.a, l.b FROM reached AS r JOIN links AS l ON l.a = r.b)
SELECT s.doc_id, len(s) AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
FROM sets AS s JOIN reached AS r ON r.a = s.doc_id GROUP BY s.doc_id, s.s
"""
ORACLES = {"op4_near_duplicates": _SQL}
