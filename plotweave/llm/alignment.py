"""Alignment of two tokenizers' tokens over the same bytes, by divide and conquer at shared cuts.

Byte offsets at which a token of each tokenizer ends are shared cuts; between two neighbouring
ones lies a group, which no smaller piece of both token sequences covers exactly. An interval is
split at the shared cut nearest to its middle: ends of the one tokenizer are looked up among the
other's by bisection, from the middle outwards. Both halves are split in turn; an interval
without a cut is a group. All intervals of a level are worked on side by side in numpy, so a
batch of texts takes as many steps as its longest text has levels.

Two tokens are linked where their bytes overlap. How many documents hold an id pair is counted
over the whole corpus: every task adds up the pairs of its documents before they are shuffled.
The counts go back to the documents by broadcast as far as ``BUDGET`` bytes reach, the most
frequent pairs first; for the others the documents' pairs are shuffled to them. So what is
broadcast is bounded, and what is shuffled are rare pairs only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plotweave.llm.common import ROW, documents, slices
from plotweave.llm.token_ids import Encoder, default_path as byte_path, encoder
from plotweave.session import drop_stage, stage, stage_measured

# Of the counts, which take ``PAIR_BYTES`` each, so many bytes are broadcast at most.
BUDGET = 32 * 1024 * 1024
PAIR_BYTES = 16
# Texts, and the ids of texts, are worked on in slices of about so many bytes.
TEXT_SLICE = 4_000_000
ID_SLICE = 500_000
# Pairs a task adds up before it passes them on.
PAIRS_HELD = 2_000_000
# Units remembered per worker process and tokenizer: between one and two times this number.
KNOWN_UNITS = 200_000
SPACE = "\u2581"
_LETTER, _MARK = "[a-zA-Z\u00c0-\u024f]", r"[!-@\[-`{-~\n]"
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# -- tokenizers ------------------------------------------------------------------------


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a letter: printable ones as they are, the others
    in order from U+0100 on."""
    others = [b for b in range(256) if b not in _PLAIN]
    return {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_tokens(path: str) -> pa.Array:
    """The bytes of each id of the byte-level tokenizer; special tokens as their own text."""
    tokenizer = encoder(path, True, KNOWN_UNITS).tokenizer
    letters = _byte_of_letter()
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return pa.array(out, pa.large_binary())


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> "PieceEncoder":
    """The encoder of this worker process; it serves one task after the other."""
    return PieceEncoder(path)


class PieceEncoder(Encoder):
    """Ids of texts by a sentencepiece model. Texts are given with the space that it sets before them.

    A merge makes a piece of the vocabulary, so none crosses a place between two characters that
    stand side by side in no piece. Texts are cut before spaces and between letters and
    punctuation if the vocabulary allows that, and a unit that recurs is encoded once as long as
    the worker remembers it.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        pieces = [self.model.id_to_piece(i) for i in ids]
        of_text = [p.replace(SPACE, " ") for i, p in zip(ids, pieces) if not self.model.is_byte(i) and not self.model.is_control(i)]
        allowed = lambda before, after: not any(re.search(before + after, p) for p in of_text)
        # A line break is a byte of its own: units are encoded after one.
        self.before = self.model.encode("\n")
        self.at_spaces = allowed("[^ ]", " ") and not any("\n" in p for p in of_text)
        self.cuts = [(f"({a})({b})", "\\1\0\\2") for a, b in ((_LETTER, _MARK), (_MARK, _LETTER)) if allowed(a, b)]
        self.tokens = pa.array(
            [
                bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
                for i, p in zip(ids, pieces)
            ],
            pa.large_binary(),
        )
        self._remember(KNOWN_UNITS)

    def encode(self, texts: pa.Array) -> list[bytes]:
        whole = pc.match_substring_regex(texts, f"\\x00|{SPACE}") if self.at_spaces else pa.array(np.ones(len(texts), bool))
        plain = pc.if_else(whole, "", texts)
        out = self._joined(pc.split_pattern(pc.replace_substring_regex(plain, "([^ ]) ", "\\1\0 "), "\0"))
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            out[i] = self._bytes(self.model.encode(texts[i].as_py()[1:]))
        self._forget()
        return out

    def _encoded(self, units: list[str]) -> list[bytes]:
        skipped = len(self.before)
        return [self._bytes(ids[skipped:]) for ids in self.model.encode(["\n" + u for u in units], num_threads=1)]


# -- numpy on token ends ---------------------------------------------------------------


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, … of each run, one run after the other."""
    after = np.cumsum(sizes)
    return np.repeat(begins - after + sizes, sizes) + np.arange(int(after[-1]) if len(after) else 0)


def _shared(ends_a: np.ndarray, ends_b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the tokens ``at`` of the one end where one of the other does."""
    place = np.searchsorted(ends_b, ends_a[at])
    return ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[at]


def _cuts_near_the_middle(ends_a: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Per interval of tokens ``low`` to ``high``, whose last end is shared, the token before
    ``high`` with a shared end that is nearest to the middle, or -1."""
    middle, found = (low + high) // 2, np.full(len(low), -1)
    left, reach, width = np.arange(len(low)), 0, 1
    while len(left):
        # Tokens from ``reach`` to ``reach + width`` places away, the nearer ones first.
        steps = np.arange(reach, reach + width)
        steps = np.stack([steps, -steps], axis=1).ravel()[1 if reach == 0 else 0 :]
        at = middle[left, None] + steps
        inside = (at >= low[left, None]) & (at < high[left, None])
        hit = np.zeros(at.shape, bool)
        hit[inside] = _shared(ends_a, ends_b, at[inside])
        some = hit.any(1)
        found[left[some]] = at[some, hit[some].argmax(1)]
        left = left[~some & inside.any(1)]
        reach, width = reach + width, min(2 * width, max(1, 4_000_000 // max(len(left), 1)))
    return found


def groups(ends_a: np.ndarray, ends_b: np.ndarray, sizes_a: np.ndarray) -> np.ndarray:
    """The last ``a`` token of each group, in order.

    Both arrays hold the ends of several texts' tokens, text after text; ``sizes_a`` tells how
    many of ``a`` each text has. Texts end at a shared cut.
    """
    after = np.cumsum(sizes_a)
    low, high = (after - sizes_a)[sizes_a > 0], after[sizes_a > 0] - 1
    done = []
    while len(low):
        cut = _cuts_near_the_middle(ends_a, ends_b, low, high)
        done.append(high[cut < 0])
        split = cut >= 0
        cut, low, high = cut[split], low[split], high[split]
        low, high = np.concatenate([low, cut + 1]), np.concatenate([cut, high])
        # A single token cannot be split.
        done.append(high[low == high])
        low, high = low[low < high], high[low < high]
    return np.sort(np.concatenate([np.zeros(0, "int64"), *done]))


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens whose bytes overlap: one per stretch between neighbouring ends of either."""
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    ends = ends[np.concatenate([[True], ends[1:] != ends[:-1]])] if len(ends) else ends
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def _ends(tokens: pa.Array, ids: np.ndarray) -> np.ndarray:
    return np.cumsum(np.asarray(pc.binary_length(tokens), "int64")[ids])


class _Ids:
    """The ids of a slice of stored rows, and where their tokens end."""

    def __init__(self, part: pa.RecordBatch, tokens_a: pa.Array, tokens_b: pa.Array):
        (self.a, self.sizes_a), (self.b, self.sizes_b) = _stored(part.column("a")), _stored(part.column("b"))
        self.ends_a, self.ends_b = _ends(tokens_a, self.a), _ends(tokens_b, self.b)
        self.link_a, self.link_b = links(self.ends_a, self.ends_b)
        self.pairs = self.a[self.link_a] * len(tokens_b) + self.b[self.link_b]
        owner = np.repeat(np.arange(len(part)), self.sizes_a)[self.link_a]
        self.n_links = np.bincount(owner, minlength=len(part))
        self.owner = owner


def _stored(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], "<i8")[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", "uint8")[offsets[0] : offsets[-1]]
    return data.view("<u2").astype("int64"), np.diff(offsets) // 2


# -- passes ----------------------------------------------------------------------------


def _tokens(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_a, of_b = encoder(path_a, True, KNOWN_UNITS), piece_encoder(path_b)
        tokens_a, tokens_b = byte_tokens(path_a), of_b.tokens
        if max(len(tokens_a), len(tokens_b)) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        for batch in batches:
            for part in slices(batch, "text", TEXT_SLICE):
                texts = part.column("text").cast(pa.large_string()).fill_null("")
                present = pc.not_equal(texts, "")
                spaced = pc.if_else(present, pc.binary_join_element_wise(pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type)), "")
                (ids_a, sizes_a), (ids_b, sizes_b) = (_flat(e.encode(spaced)) for e in (of_a, of_b))
                valid = present.to_numpy(zero_copy_only=False)
                valid = valid & _joins(tokens_a, ids_a, sizes_a, spaced) & _joins(tokens_b, ids_b, sizes_b, spaced)
                columns = [part.column(ROW), part.column("doc_id")]
                for ids, sizes in ((ids_a, sizes_a), (ids_b, sizes_b)):
                    after = np.concatenate([[0], np.cumsum(sizes * 2)]).tolist()
                    data = memoryview(ids.astype("<u2").tobytes())
                    rows = [data[x:y] if v else b"" for x, y, v in zip(after, after[1:], valid.tolist())]
                    columns.append(pa.array([bytes(r) for r in rows], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[ROW, "doc_id", "a", "b"])

    return run


def _flat(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(rows), "<u4"), np.array([len(r) for r in rows], "int64") // 4


def _joins(tokens: pa.Array, ids: np.ndarray, sizes: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Whether the bytes of each text's tokens are the text."""
    joined = tokens.take(pa.array(ids))
    data = np.frombuffer(joined.buffers()[2] or b"", "uint8")
    ends = np.frombuffer(joined.buffers()[1], "<i8")[: len(ids) + 1]
    mine = ends[np.concatenate([[0], np.cumsum(sizes)])]
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    given = np.frombuffer(texts.buffers()[2] or b"", "uint8")
    if np.array_equal(mine, offsets - offsets[0]) and np.array_equal(data[: mine[-1]], given[offsets[0] : offsets[-1]]):
        return np.ones(len(texts), bool)
    return np.array(
        [
            b - a == y - x and np.array_equal(data[a:b], given[x:y])
            for a, b, x, y in zip(mine.tolist(), mine[1:].tolist(), offsets.tolist(), offsets[1:].tolist())
        ],
        bool,
    )


def _pairs(path_a: str, path_b: str):
    """``pair, n``: in how many documents of the task's share each pair is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_a, tokens_b = byte_tokens(path_a), piece_encoder(path_b).tokens
        space = len(tokens_a) * len(tokens_b)
        pairs, counts, held = [], [], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            every, place = np.unique(np.concatenate(pairs), return_inverse=True)
            return every, np.bincount(place, weights=np.concatenate(counts), minlength=len(every)).astype("int64")

        for batch in batches:
            for part in slices(batch, "a", ID_SLICE):
                ids = _Ids(part, tokens_a, tokens_b)
                of_document = _distinct(ids.owner * space + ids.pairs)
                found, n = np.unique(of_document % space, return_counts=True)
                pairs.append(found)
                counts.append(n)
                held += len(found)
                if held > PAIRS_HELD:
                    every, n = added()
                    pairs, counts, held = [every], [n], len(every)
                    if held > PAIRS_HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(n)], names=["pair", "n"])
                        pairs, counts, held = [], [], 0
        if held:
            every, n = added()
            yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(n)], names=["pair", "n"])

    return run


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _counted(path_a: str, path_b: str, known):
    """Per document everything but what the counts of rare pairs add, which ``rest`` lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_a, tokens_b = byte_tokens(path_a), piece_encoder(path_b).tokens
        space = len(tokens_a) * len(tokens_b)
        words = _decimals(max(len(tokens_a), len(tokens_b)))
        pairs, values = known.value
        for batch in batches:
            for part in slices(batch, "a", ID_SLICE):
                ids = _Ids(part, tokens_a, tokens_b)
                last = groups(ids.ends_a, ids.ends_b, ids.sizes_a)
                rows = len(part)
                of_a = np.repeat(np.arange(rows), ids.sizes_a)
                n_groups = np.bincount(of_a[last], minlength=rows)
                place = np.minimum(np.searchsorted(pairs, ids.pairs), max(len(pairs) - 1, 0))
                here = pairs[place] == ids.pairs if len(pairs) else np.zeros(len(ids.pairs), bool)
                # The lowest bit tells whether the pair is its id's most frequent one.
                value = np.where(here, values[place], 0) if len(pairs) else np.zeros(len(ids.pairs), "int64")
                bounds = np.concatenate([[0], np.cumsum(ids.n_links)])
                total = np.diff(np.concatenate([[0], np.cumsum(value >> 1)])[bounds])
                best = np.diff(np.concatenate([[0], np.cumsum(value & 1)])[bounds])
                rest, times = np.unique((ids.owner * space + ids.pairs)[~here], return_counts=True)
                of_rest = np.concatenate([[0], np.cumsum(np.bincount(rest // space, minlength=rows))]).astype("int32")
                entries = pa.StructArray.from_arrays([pa.array(rest % space), pa.array(times.astype("int64"))], names=["pair", "times"])
                columns = [part.column(ROW), part.column("doc_id")]
                numbers = (ids.sizes_a, ids.sizes_b, n_groups, ids.n_links, best, total)
                columns += [pa.array(x.astype("int64")) for x in numbers]
                columns += [pa.array(_digests(ids, last, words, rows)), pa.ListArray.from_arrays(pa.array(of_rest), entries)]
                names = [ROW, "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rest"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


@lru_cache(maxsize=2)
def _decimals(n: int) -> pa.Array:
    """The numbers below ``n`` with what can stand after one: a comma, a bar, a semicolon."""
    return pa.array([f"{i}{mark}" for i in range(n) for mark in ",|;"], pa.large_string())


def group_texts(ids: _Ids, last: np.ndarray, words: pa.Array) -> tuple[memoryview, np.ndarray]:
    """All texts' groups as ``a1,a2|b1;a3|b2,b3;``, and the places where each text's end."""
    last_b = np.searchsorted(ids.ends_b, ids.ends_a[last])
    mark_a, mark_b = np.zeros(len(ids.a), "int64"), np.zeros(len(ids.b), "int64")
    mark_a[last], mark_b[last_b] = 1, 2
    # A token's place: all of ``a`` up to its group's end, and all of ``b`` of the groups before.
    in_a, in_b = np.diff(np.concatenate([[-1], last])), np.diff(np.concatenate([[-1], last_b]))
    before_a, before_b = np.cumsum(in_a), np.cumsum(in_b)
    order = np.empty(len(ids.a) + len(ids.b), "int64")
    order[np.arange(len(ids.a)) + np.repeat(before_b - in_b, in_a)] = ids.a * 3 + mark_a
    order[np.arange(len(ids.b)) + np.repeat(before_a, in_b)] = ids.b * 3 + mark_b
    joined = words.take(pa.array(order))
    ends = np.frombuffer(joined.buffers()[1], "<i8")
    tokens = np.concatenate([[0], np.cumsum(ids.sizes_a + ids.sizes_b)])
    return memoryview(joined.buffers()[2] or b""), ends[tokens]


def _digests(ids: _Ids, last: np.ndarray, words: pa.Array, rows: int) -> list[str]:
    view, ends = group_texts(ids, last, words)
    # Without the mark after the last id.
    return [hashlib.sha256(view[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(ends.tolist(), ends[1:].tolist())]


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``row_no, doc_id, a, b``, stored: the ids of both tokenizers, two bytes each, little-endian.

    ``docs`` has ``doc_id, text``; other columns are ignored. Special tokens' strings are plain
    text. Texts that are null or empty, or whose tokens' bytes are not a space and the text, have
    no ids; rows that repeat an id stay apart.
    """
    path_a, path_b = path_a or byte_path(), path_b or piece_path()
    rows = docs.select(F.monotonically_increasing_id().alias(ROW), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stage(rows.mapInArrow(_tokens(path_a, path_b), f"{ROW} long, doc_id long, a binary, b binary"), "token_pairs")


def pair_counts(tokens: DataFrame, path_a: str | None = None, path_b: str | None = None) -> tuple[DataFrame, dict]:
    """``pair, n, best``, stored: the documents that hold each linked id pair, and whether the
    pair is its first id's most frequent one; and how many pairs there are, and their sum.

    ``pair`` is the first id times the size of the second vocabulary, plus the second id.
    """
    path_a, path_b = path_a or byte_path(), path_b or piece_path()
    size = len(piece_encoder(path_b).tokens)
    partial = tokens.select("a", "b").mapInArrow(_pairs(path_a, path_b), "pair long, n long")
    counts = stage(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")
    first = F.floor(F.col("pair") / size).alias("first")
    # One row per id of the first vocabulary at most.
    most = counts.groupBy(first).agg(F.max("n").alias("most"))
    judged = counts.withColumn("first", first).join(F.broadcast(most), "first")
    judged = judged.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    out = stage_measured(judged, "pair_values", F.count("*").alias("pairs"), F.sum("n").alias("total"))
    drop_stage(counts)
    return out


def align(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, budget: int = BUDGET
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row of ``docs``.

    ``n_links`` counts pairs of tokens whose bytes overlap. An id pair's count is the number of
    rows that hold it linked; ``count_sum`` adds it up over the links, and ``n_best`` counts the
    links whose pair has the highest count of its ``a`` id, ties included. ``groups_sha256`` is
    the hash of the groups as ``a1,a2|b1;a3|b2,b3``. Rows without ids (see ``aligned``) have
    zeros and ''. An empty table gives no rows.
    """
    path_a, path_b = path_a or byte_path(), path_b or piece_path()
    tokens = aligned(docs, path_a, path_b)
    counts, measured = pair_counts(tokens, path_a, path_b)
    enough = F.lit(True)
    if (measured["pairs"] or 0) * PAIR_BYTES > budget:
        # Their shares of the sum add up to one, so no more than ``budget`` bytes are taken.
        enough = F.col("n") * F.lit(float(budget)) >= F.lit(float(measured["total"])) * PAIR_BYTES
    frequent = counts.where(enough).select("pair", (F.col("n") * 2 + F.col("best").cast("long")).alias("value")).toArrow()
    pairs, values = frequent["pair"].to_numpy(), frequent["value"].to_numpy()
    order = np.argsort(pairs)
    known = docs.sparkSession.sparkContext.broadcast((pairs[order], values[order]))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = f"{ROW} long, doc_id long, " + ", ".join(f"{c} long" for c in numbers)
    found = tokens.mapInArrow(
        _counted(path_a, path_b, known), f"{schema}, groups_sha256 string, rest array<struct<pair: long, times: long>>"
    )
    columns = ["doc_id", *numbers, "groups_sha256"]
    if len(pairs) == (measured["pairs"] or 0):
        return found.select(columns)
    found = stage(found, "alignments")
    rest = found.select(ROW, F.inline("rest")).join(counts.where(~enough).hint("shuffle_hash"), "pair")
    more = rest.groupBy(ROW).agg(
        F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")
    )
    joined = found.drop("rest").join(more, ROW, "left")
    return joined.withColumns(
        {
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0)),
        }
    ).select(columns)


def op11_alignment(spark, sf_dir):
    return align(documents(spark, sf_dir))


QUERIES = {"op11_alignment": op11_alignment}
ORACLES: dict[str, str] = {}
