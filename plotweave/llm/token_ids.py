"""Token ids of texts by a public tokenizer, as little-endian unsigned 32-bit integers.

Byte-level BPE works within units: a single space opens a new one, a single line break stands
alone, and a run of ASCII punctuation never joins the letters before it. So a text is cut at
these places, every unit has its ids whatever stands around it, and a unit that recurs is
encoded once as long as the worker remembers it.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Units remembered per worker process: between one and two times this number.
KNOWN_UNITS = 400_000
LONG_UNIT = 48
# Units that open with a space are encoded so many at a time.
TOGETHER = 64
# White space of any kind; a space before more of it is left to a slower path, one text at a time.
_WHITE = r"\s\v\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}"
_SLOW = f" [{_WHITE}]|\\x00"
_UNIT_START = re.compile(r"(?= \S)")
_OPENED = re.compile(r" \S+").fullmatch
# Where a unit is cut further: before its last punctuation, and around a line break.
_CUTS = [
    (r"([\pL\pN])([!-/:-@\[-`{-~]+)(\n|$)", "\\1\0\\2\\3"),
    (f"([^{_WHITE}])\\n([^{_WHITE}])", "\\1\0\n\0\\2"),
]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False, known_units: int | None = None) -> "Encoder":
    """The encoder of this worker process; it serves one task after the other."""
    return Encoder(path, plain, known_units)


class Encoder:
    """``encode`` gives the ids of texts as bytes; null is the empty text.

    The strings of special tokens in a text are these tokens, as the tokenizer has it by itself;
    if ``plain``, they are ordinary text. ``known_units`` is how many units it remembers.
    """

    cuts = _CUTS

    def __init__(self, path: str, plain: bool = False, known_units: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        special = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Texts with one of them are encoded as a whole.
        self.special = "|".join(re.escape(t) for t in special)
        self.together = not any(" " in t for t in special)
        # Bytes of each id; a vocabulary entry of byte-level BPE has a character for every byte.
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values(), default=-1) + 1, "int64")
        self.n_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self._remember(known_units)

    def _remember(self, known_units: int | None) -> None:
        self.most = known_units
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _forget(self) -> None:
        if len(self.known) > (self.most or KNOWN_UNITS):
            self.older = {u: x for u, x in self.known.items() if len(u) <= LONG_UNIT}
            self.known = {"": b""}

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each of ``texts``, an array of strings."""
        texts = texts.cast(pa.large_string()).fill_null("")
        slow = pc.match_substring_regex(texts, _SLOW)
        whole = pc.match_substring_regex(texts, self.special) if self.special else pa.array(np.zeros(len(texts), bool))
        slow = pc.or_(slow, whole)
        plain = pc.if_else(slow, "", texts)
        out = self._joined(pc.split_pattern(pc.replace_substring(plain, " ", "\0 "), "\0"))
        for i in np.flatnonzero(slow.to_numpy(zero_copy_only=False)):
            text = texts[i].as_py()
            out[i] = self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids) if whole[i].as_py() else b"".join(
                self._ids(_UNIT_START.split(text))
            )
        self._forget()
        return out

    def _ids(self, units: list[str]) -> list[bytes]:
        known = self.known
        new = [u for u in set(units) if u not in known]
        if new:
            older = self.older
            for u in new:
                if u in older:
                    known[u] = older[u]
            new = [u for u in new if u not in known]
            known.update(zip(new, self._encoded(new)))
        return [known[u] for u in units]

    def _encoded(self, units: list[str]) -> list[bytes]:
        """The ids of each of ``units``, which are distinct."""
        opened = [u for u in units if _OPENED(u)] if self.together else []
        ids = self._side_by_side(opened) if opened else None
        if ids is None:
            return self._one_by_one(units)
        found = dict(zip(opened, ids))
        others = [u for u in units if u not in found]
        found.update(zip(others, self._one_by_one(others)))
        return [found[u] for u in units]

    def _side_by_side(self, units: list[str]) -> list[bytes] | None:
        """The ids of units that each open with a space and have no other white space.

        Side by side they are units still, and cost less than one by one; their ids are told apart
        by the bytes they stand for. None if some unit does not end where an id ends.
        """
        lines = ["".join(units[k : k + TOGETHER]) for k in range(0, len(units), TOGETHER)]
        encoded = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        data = b"".join([self._bytes(e.ids) for e in encoded])
        after = np.cumsum(self.n_bytes[np.frombuffer(data, "<u4")])
        ends = np.cumsum([len(u.encode()) for u in units])
        if not len(after) or after[-1] != ends[-1]:
            return None
        last = np.searchsorted(after, ends)
        if (after[last] != ends).any():
            return None
        bounds = [0, *((last + 1) * 4).tolist()]
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def _one_by_one(self, units: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        ids = array("I", ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _joined(self, split: pa.Array) -> list[bytes]:
        """The ids of texts that are given as lists of units.

        Different units are cut further, and only different pieces are looked up; the ids of
        all texts are then gathered from the pieces' ids.
        """
        ends = split.offsets.to_numpy().astype("int64")
        units = split.flatten().dictionary_encode()
        cut = units.dictionary
        for pattern, replacement in self.cuts:
            cut = pc.replace_substring_regex(cut, pattern, replacement)
        cut = pc.split_pattern(cut, "\0")
        pieces = cut.flatten().dictionary_encode()
        ids = self._ids(pieces.dictionary.to_pylist())
        table = np.frombuffer(b"".join(ids), "<u4")
        piece_sizes = np.array([len(x) for x in ids], "int64") // 4
        piece_begins = np.cumsum(piece_sizes) - piece_sizes
        # A unit's ids: those of its pieces, side by side in a table of their own.
        of_units = pieces.indices.to_numpy()
        table = table[_runs(piece_begins[of_units], piece_sizes[of_units])]
        after = np.concatenate([[0], np.cumsum(piece_sizes[of_units])])[cut.offsets.to_numpy()]
        begins, sizes = after[:-1], np.diff(after)
        codes = units.indices.to_numpy()
        all_ids = table[_runs(begins[codes], sizes[codes])].tobytes()
        bounds = (np.concatenate([[0], np.cumsum(sizes[codes])])[ends - ends[0]] * 4).tolist()
        return [all_ids[a:b] for a, b in zip(bounds, bounds[1:])]


def _runs(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, … of each run, one run after the other."""
    after = np.cumsum(sizes)
    total = int(after[-1]) if len(after) else 0
    return np.repeat(begins - after + sizes, sizes) + np.arange(total)
