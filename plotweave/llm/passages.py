"""Removal of passages that repeat across documents, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the least hash among its runs of
``gram`` words, so equal windows have equal minimisers. Consecutive windows that share one are a
super-k-mer: one packed string, a few words longer than a window, that stands for about twenty
windows.

* Every text is cut into super-k-mers; of each a row with its minimiser (the bucket) and a
  128-bit hash of its string is stored. Buckets that only documents of one id have are done.
* Equal strings are one kind, so copies are counted before anything else moves. A bucket with one
  kind needs no look at the windows.
* In the other buckets one string of each kind travels to its bucket's task, which sorts all
  windows of the bucket and so finds the smallest document of each.
* A bucket with more than ``MOST_KINDS`` kinds is a passage that many documents have in different
  surroundings. One string of each kind is dealt anew by whole windows, which have one kind each by
  themselves and need only their smallest document. So no task sorts more than ``MOST_KINDS``
  strings at a time, whatever the data. What is found in the windows of a string is put together as
  the string's verdict, so copies never meet the windows, and a super-k-mer meets one verdict at most.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from plotweave.llm.common import ROW, bucketed, documents, slices
from plotweave.session import drop_stage, stage, stage_measured

WINDOW = 50
# Words in the runs that choose a bucket: the first dealing, and that of buckets that are too full.
# Dealings in between, by longer runs, would spare more than half of the rows among near copies, but
# each takes about ten more shuffles and stored tables; the most there can be is a row per window either way.
GRAMS = (12, WINDOW)
MOST_KINDS = 256
# Words of more bytes are their hash in packed strings, so that these stay short.
LONG_WORD = 64
SLICE = 2_000_000
# Rows without an id come after all others.
LAST = (1 << 63) - 1

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_RUN = f"{ROW} long, doc long, bucket long, key binary, start int, n int"
# Window of a string that is dealt anew: the string's key, its smallest and largest document, and the
# window's place in it.
_PART = "parent binary, least long, doc long, at int, key binary"
# Of a string: its smallest document before others, and the runs of windows that go.
_VERDICT = "key binary, least long, runs array<struct<first:int,n:int,least:long>>"
_NO_SPANS = "array<struct<start:int,end:int>>"


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


with np.errstate(over="ignore"):
    _OF_BYTE = _mixed(np.arange(1, 257, dtype="uint64") * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base², … modulo 2**64."""
    factors = np.full(n, base, "uint64")
    factors[:1] = 1
    return np.cumprod(factors)


class Words:
    """The words of several texts: one stream in which a space follows every word.

    ``begins`` and ``ends`` are the words' places in ``data``; ``bounds`` tells which words are
    whose.
    """

    def __init__(self, texts: pa.Array):
        texts = pc.binary_join_element_wise(
            texts.cast(pa.large_string()).fill_null(""), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
        )
        offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", "uint8")[offsets[0] : offsets[-1]]
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        after_word = np.concatenate([[False], ~space[:-1]]) & space
        # Words that end before each text's end.
        words = np.concatenate([[0], np.cumsum(after_word)])
        self.bounds = words[offsets - offsets[0]]
        keep = ~space | after_word
        self.data = np.where(space, np.uint8(32), raw)[keep]
        self._places()

    def _places(self) -> None:
        self.ends = np.flatnonzero(self.data == 32)
        self.begins = np.concatenate([[0], self.ends + 1])[:-1]

    def shorten(self) -> "Words":
        """Long words as their hash after a tab, which no word has."""
        if len(self.ends) and (self.ends - self.begins).max() > LONG_WORD:
            pattern = rb"[^ ]{%d,}" % (LONG_WORD + 1)
            short = re.sub(pattern, lambda m: b"\t" + xxhash.xxh3_128_hexdigest(m[0]).encode(), self.data.tobytes())
            self.data = np.frombuffer(short, "uint8")
            self._places()
        return self

    def minimisers(self, gram: int) -> np.ndarray:
        """Per word the least hash of ``gram`` words side by side within the window from it on."""
        n = len(self.ends) - gram + 1
        if n < WINDOW - gram + 1:
            return np.zeros(0, "uint64")
        begins = self.begins[:n]
        with np.errstate(over="ignore"):
            sums = np.zeros(len(self.data) + 1, "uint64")
            np.cumsum(_OF_BYTE[self.data] * _powers(_BASE, len(self.data)), out=sums[1:])
            of_words = sums[self.ends[gram - 1 :]] - sums[begins]
            least = _mixed(of_words * _powers(_INVERSE, len(self.data))[begins])
        have, width = 1, WINDOW - gram + 1
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        return least


def super_kmers(words: Words, gram: int, starts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Index into ``starts`` of each super-k-mer's first window, its windows, and its minimiser.

    ``starts`` are the windows' first words in ascending order. A super-k-mer has at most as many
    windows as can share a run of words, so it is short in periodic texts as well.
    """
    least = words.minimisers(gram)[starts]
    if not len(starts):
        return np.zeros(0, "int64"), np.zeros(0, "int64"), least
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (np.diff(starts) != 1) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(starts)))
    most = WINDOW - gram + 1
    parts = -(-n // most)
    of = np.repeat(np.arange(len(first)), parts)
    k = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = first[of] + k * most
    return begin, np.minimum(n[of] - k * most, most), least[begin]


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    after = np.cumsum(sizes)
    return np.repeat(begins - after + sizes, sizes) + np.arange(int(after[-1]) if len(after) else 0)


def _cut(gram: int, some: bool = False) -> Callable:
    """Super-k-mers of all windows, or the windows of each of the column ``strings``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = Words(part.column("text")).shorten()
                if some:
                    strings = part.column("strings")
                    text_of = np.repeat(np.arange(len(part)), strings.value_lengths().to_numpy(zero_copy_only=False))
                    flat = strings.flatten()
                    begins = np.asarray(flat.field("start")).astype("int64") + words.bounds[text_of]
                    sizes = np.asarray(flat.field("n")).astype("int64")
                else:
                    text_of, begins = np.arange(len(part)), words.bounds[:-1]
                    sizes = np.maximum(np.diff(words.bounds) - WINDOW + 1, 0)
                # The string or text that each window is in.
                starts, owner = _ranges(begins, sizes), np.repeat(np.arange(len(sizes)), sizes)
                at, n, bucket = super_kmers(words, gram, starts, owner)
                first, owner = starts[at], owner[at]
                text = text_of[owner]
                view, of_bytes = memoryview(words.data), xxhash.xxh3_128_digest
                begin, end = words.begins[first].tolist(), words.ends[first + n + WINDOW - 2].tolist()
                keys = pa.array([of_bytes(view[a:b]) for a, b in zip(begin, end)], pa.binary())
                if some:
                    columns = {c: flat.field(f).take(pa.array(owner)) for c, f in (("parent", "key"), ("least", "least"), ("doc", "most"))}
                    columns |= {"at": pa.array((first - begins[owner]).astype("int32")), "key": keys}
                else:
                    columns = {
                        **{c: part.column(c).take(pa.array(text)) for c in (ROW, "doc")}, "bucket": pa.array(bucket.view("int64")), "key": keys,
                        "start": pa.array((first - words.bounds[text]).astype("int32")), "n": pa.array(n.astype("int32")),
                    }
                yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed string of each of ``kinds``."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            words = Words(part.column("text")).shorten()
            kinds = part.column("kinds")
            of = np.repeat(np.arange(len(part)), kinds.value_lengths().to_numpy(zero_copy_only=False))
            flat = kinds.flatten()
            first = np.asarray(flat.field("start")) + words.bounds[of]
            begin, end = words.begins[first], words.ends[first + np.asarray(flat.field("n")) + WINDOW - 2]
            view = memoryview(words.data)
            packed = pa.array([bytes(view[a:b]) for a, b in zip(begin.tolist(), end.tolist())], pa.binary())
            names = ["bucket", "key", "least", "most"]
            yield pa.RecordBatch.from_arrays([*[flat.field(c) for c in names], packed], names=[*names, "packed"])


def sorted_windows(kinds: list[tuple[bytes, int, int, bytes]]) -> Iterator[tuple[bytes, int, int, int]]:
    """``key, first, n, least``: runs of windows with the same smallest document.

    ``kinds`` are a bucket's strings with their key, smallest and largest document. Windows that
    are in no document before the kind's own ones are left out.
    """
    windows = []
    for j, (_, least, _, packed) in enumerate(kinds):
        ends = [*np.flatnonzero(np.frombuffer(packed, "uint8") == 32).tolist(), len(packed)]
        begins = [0, *[e + 1 for e in ends]]
        windows += [(packed[begins[k] : ends[k + WINDOW - 1]], least, j, k) for k in range(len(ends) - WINDOW + 1)]
    windows.sort()
    found: list[list[tuple[int, int]]] = [[] for _ in kinds]
    for _, equal in groupby(windows, key=lambda w: w[0]):
        equal = list(equal)
        for _, _, j, k in equal:
            found[j].append((k, equal[0][1]))
    for (key, _, most, _), of_kind in zip(kinds, found):
        first = n = 0
        least = LAST
        for k, smallest in sorted(of_kind):
            if smallest == least and k == first + n:
                n += 1
                continue
            if least < most:
                yield key, first, n, least
            first, n, least = k, 1, smallest
        if least < most:
            yield key, first, n, least


def _by_sorting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verdicts of the buckets, which come one after the other."""

    def rows():
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "key", "least", "most", "packed")]
            yield from zip(*columns)

    run = pa.struct([("first", pa.int32()), ("n", pa.int32()), ("least", pa.int64())])

    def out(found: list) -> pa.RecordBatch:
        types = [pa.binary(), pa.int64(), pa.list_(run)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*found), types)], names=["key", "least", "runs"]
        )

    found: list = []
    for _, bucket in groupby(rows(), key=lambda r: r[0]):
        # A string's runs come one after the other.
        for key, of_kind in groupby(sorted_windows([r[1:] for r in bucket]), key=lambda r: r[0]):
            runs = [r[1:] for r in of_kind]
            found.append((key, min(r[2] for r in runs), [dict(zip(("first", "n", "least"), r)) for r in runs]))
        if len(found) >= 10_000:
            yield out(found)
            found = []
    if found:
        yield out(found)


def _with_texts(texts: DataFrame, rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """Each text with the rows that belong to it as a list, in the order of their starts."""
    of_text = rows.groupBy(ROW).agg(F.sort_array(F.collect_list(F.struct("start", *columns))).alias(name))
    return texts.join(of_text.hint("shuffle_hash"), ROW).select(ROW, "doc", "text", name)


def _spans(live: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The words of the runs of windows that an earlier document has, as places in the text."""

    def span(run: Column) -> Column:
        begin = F.col("start") + run["first"]
        return F.struct(begin.alias("start"), (begin + run["n"] + F.lit(WINDOW - 1)).alias("end"))

    earlier = F.filter("runs", lambda run: run["least"] < F.col("doc"))
    judged = live.join(verdicts, "key").where("least < doc")
    return judged.select(ROW, F.transform(earlier, span).alias("found"))


def _by_windows(windows: DataFrame) -> DataFrame:
    """Verdicts of the strings that were dealt anew, from their windows."""
    found = windows.groupBy("key").agg(F.min("least").alias("least"), F.max("doc").alias("most")).where("least < most")
    # Stored, so that a join on a window that very many strings have can be split.
    found = stage(found.select("key", "least"), "shared_windows")
    judged = windows.drop("least").join(found, "key").where("least < doc")
    of_string = judged.groupBy(F.col("parent").alias("key")).agg(
        F.min("least").alias("least"), F.sort_array(F.collect_list(F.struct("at", "least"))).alias("windows")
    )

    def at(i: Column) -> Column:
        return F.get("windows", i)

    def begins_run(i: Column) -> Column:
        goes_on = (at(i)["at"] == at(i - 1)["at"] + 1) & (at(i)["least"] == at(i - 1)["least"])
        return (i == 0) | ~goes_on

    def run(i: Column, k: Column) -> Column:
        n = F.coalesce(F.get("begins", k + 1), F.size("windows")) - i
        return F.struct(at(i)["at"].alias("first"), n.alias("n"), at(i)["least"].alias("least"))

    begins = F.filter(F.sequence(F.lit(0), F.size("windows") - 1), begins_run)
    return of_string.withColumn("begins", begins).select("key", "least", F.transform("begins", run).alias("runs"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``row_no, doc_id, text, spans`` for each row of ``docs``: the words to remove.

    ``docs`` has ``doc_id, text``; other columns are ignored. ``spans`` (start, end in words) may
    overlap. They are the windows whose words also stand, one after the other, in a row with a
    smaller id. Rows with the same id are not held against each other; rows without an id come
    after all others and are not held against each other either. Null and empty texts, and those
    shorter than a window, have no spans. An empty table gives no rows.

    Texts are shuffled once, into buckets that later passes join to where they lie.
    """
    rows = docs.select(F.monotonically_increasing_id().alias(ROW), F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = bucketed(rows, ROW, "passage_texts")
    texts = table.select(ROW, F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text")
    runs = stage(texts.mapInArrow(_cut(GRAMS[0]), _RUN), "super_kmers")
    least, most = F.min("doc").alias("least"), F.max("doc").alias("most")
    # Most buckets are one document's: only counts are needed to leave them out.
    shared = stage(runs.groupBy("bucket").agg(least, most).where("least < most"), "shared_buckets")
    live = stage(runs.join(shared.select("bucket"), "bucket", "left_semi").select(runs.columns), "live_super_kmers")
    drop_stage(runs)
    kinds = stage(
        live.groupBy("bucket", "key").agg(least, most, *[F.first(c).alias(c) for c in (ROW, "start", "n")]), "kinds"
    )
    state = kinds.groupBy("bucket").agg(F.count("*").alias("kinds"))
    state = state.select("bucket", (F.col("kinds") > 1).alias("several"), (F.col("kinds") > MOST_KINDS).alias("full"))
    state, measured = stage_measured(
        state, "bucket_states", F.count_if("several").alias("several"), F.count_if("full").alias("full")
    )
    known = kinds.join(state, "bucket")
    whole = F.array(F.struct(F.lit(0).alias("first"), "n", "least")).cast("array<struct<first:int,n:int,least:long>>")
    verdicts = known.where("not several and least < most").select("key", "least", whole.alias("runs"))
    if measured["several"]:
        to_sort = known.where("several and not full").select(ROW, "start", "n", "bucket", "key", "least", "most")
        packed = _with_texts(texts, to_sort, "kinds", "n", "bucket", "key", "least", "most").mapInArrow(
            _pack, "bucket long, key binary, least long, most long, packed binary"
        )
        dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
        verdicts = verdicts.unionByName(dealt.mapInArrow(_by_sorting, _VERDICT))
    if measured["full"]:
        again = known.where("full").select(ROW, "start", "n", "key", "least", "most")
        strings = _with_texts(texts, again, "strings", "n", "key", "least", "most")
        windows = stage(strings.mapInArrow(_cut(GRAMS[1], some=True), _PART), "super_kmers")
        verdicts = verdicts.unionByName(_by_windows(windows))
    # One row per string, so a super-k-mer meets one row at most. By key, lest each branch writes files of its own.
    verdicts = stage(verdicts.repartition("key"), "verdicts")
    of_text = _spans(live, verdicts).groupBy(ROW).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("found")))).alias("spans"))
    none = F.array().cast(_NO_SPANS)
    joined = table.join(of_text.hint("shuffle_hash"), ROW, "left")
    return joined.select(ROW, "doc_id", "text", F.coalesce("spans", none).alias("spans"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            words = Words(part.column("text"))
            spans = part.column("spans")
            of = np.repeat(np.arange(len(part)), spans.value_lengths().to_numpy(zero_copy_only=False))
            flat = spans.flatten()
            change = np.zeros(len(words.ends) + 1, "int64")
            for field, step in (("start", 1), ("end", -1)):
                np.add.at(change, np.asarray(flat.field(field)) + words.bounds[of], step)
            gone = np.cumsum(change[:-1]) > 0
            sizes = words.ends - words.begins + 1
            data = words.data[np.repeat(~gone, sizes)]
            after = np.concatenate([[0], np.cumsum(np.where(gone, 0, sizes))])[words.bounds].tolist()
            view = memoryview(data)
            # Without the space after the last word.
            kept = [bytes(view[a : max(a, b - 1)]) for a, b in zip(after, after[1:])]
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.bounds])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(np.diff(words.bounds)), pa.array(removed),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )


def remove_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words of each text that are left, a space between.

    Null texts are empty ones. See ``repeated_passages`` for what goes.
    """
    schema = "doc_id long, n_words long, n_removed long, kept string"
    return repeated_passages(docs).select("doc_id", "text", "spans").mapInArrow(_kept, schema)


def op13_passages(spark, sf_dir):
    cut = remove_passages(documents(spark, sf_dir))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {"op13_passages": op13_passages}
ORACLES = {
    "op13_passages": r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), places AS (
  SELECT doc_id, words[i] AS word, i,
    CASE WHEN i + 49 <= len(words) THEN sha256(array_to_string(words[i : i + 49], ' ')) END AS passage
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM texts)
), judged AS (
  SELECT doc_id, word, i, passage IS NOT NULL AND min(doc_id) OVER (PARTITION BY passage) < doc_id AS again FROM places
), marked AS (
  SELECT doc_id, word, i,
    coalesce(bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
  FROM judged
), kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id
)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
}
