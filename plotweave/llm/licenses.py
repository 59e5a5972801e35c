"""Licence scan by a positional index of rare words, and phrase counts.

The index lists, for the words of each template that are rarest in the corpus, the templates and
positions where they stand. A file's licence words are looked up in it: a word at place i that a
template has at position p says that the template may begin at i - p. A template counts where its
mandatory phrase stands and the words at the beginnings found near it cover enough of it, by
weight of their rarity.

Built-in functions only, one row at a time; nothing but word counts is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from plotweave.llm.common import documents, lower_ascii, split_words

WORD_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a licence, and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# The wording of common licence notices, the phrase that must stand in them, label.
TEMPLATES = [
    ("released under the mit license", "mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software",
        "permission is hereby granted free of charge",
        "mit",
    ),
    ("licensed under the apache license version 2 0", "apache license", "apache"),
    (
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
        "distributed under the license is distributed on an as is basis",
        "apache",
    ),
    ("this work is licensed under the gnu general public license version 3", "gnu general public license", "gpl"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 of the license "
        "or at your option any later version",
        "gnu general public license as published by the free software foundation",
        "gpl",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met redistributions of source code must retain the above "
        "copyright notice this list of conditions and the following disclaimer",
        "redistribution and use in source and binary forms",
        "bsd",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the "
        "mpl was not distributed with this file you can obtain one at",
        "mozilla public license",
        "mpl",
    ),
    ("licensed under cc by nc 4 0", "cc by nc", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc by sa", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc by 4 0", "cc-by"),
    (
        "this work is licensed under a creative commons attribution 4 0 international license",
        "creative commons attribution 4 0",
        "cc-by",
    ),
]

# The share of each template's different words that are looked up, the rarest first, and how many
# at least.
LOOKED_UP, LEAST_LOOKED_UP = 0.5, 4
# The share of a template, by the rarity of its words, that must be found, and how many words
# besides the mandatory phrase.
COVERAGE = 0.5
LEAST_BESIDE = 2
# The score of a file in which phrases were found but no template.
PHRASE_SCORE = 0.5


def _places(words: Column, word: str) -> Column:
    """The positions of ``word``."""
    at = F.sequence(F.lit(0), F.size(words) - 1)
    return F.when(F.array_contains(words, word), F.filter(at, lambda i: F.get(words, i) == word))


def _phrase_places(words: Column, phrase: str) -> Column:
    """Where the phrase begins; its longest word is looked for first."""
    parts = phrase.split()
    anchor = max(range(len(parts)), key=lambda k: (len(parts[k]), k))

    def complete(i: Column) -> Column:
        out = i >= anchor
        for k, part in enumerate(parts):
            if k != anchor:
                out = out & (F.coalesce(F.get(words, F.greatest(i + (k - anchor), F.lit(-1))), F.lit("")) == part)
        return out

    found = F.filter(_places(words, parts[anchor]), complete)
    return F.coalesce(F.transform(found, lambda i: i - anchor), F.array().cast("array<int>"))


def _marked(words: Column, phrase: str, label: str) -> Column:
    places = _phrase_places(words, phrase)
    return F.transform(places, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))


def _vocabulary(templates: list[tuple[str, str, str]]) -> list[str]:
    return sorted({w for text, _, _ in templates for w in text.split()})


def word_rarity(docs: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES) -> dict[str, float]:
    """The idf of every template word in all of ``docs`` (``text``).

    One number per template word reaches the driver.
    """
    vocabulary = _vocabulary(templates)
    words = F.array_intersect(split_words(lower_ascii(F.col("text")), WORD_SEPARATORS), F.lit(vocabulary))
    # The empty word stands for the file itself.
    counted = docs.select(F.explode(F.concat(words, F.array(F.lit("")))).alias("word")).groupBy("word").count()
    df = {r.word: r["count"] for r in counted.collect()}
    return {w: math.log((1.0 + df.get("", 0)) / (1.0 + df.get(w, 0))) + 1e-9 for w in vocabulary}


def scan_licenses(
    docs: DataFrame,
    rarity: dict[str, float],
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str, str]] = TEMPLATES,
) -> DataFrame:
    """The licence findings of each row of ``docs``, beside its columns.

    Added are ``n_words``; ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` of the
    places where a phrase stands; ``template_labels`` and ``labels`` (with the base ones), both
    lists sorted and distinct; ``score``, the best share of a template that was found, at
    least ``PHRASE_SCORE`` where a phrase stands.

    A template counts where its mandatory phrase stands, ``LEAST_BESIDE`` other words of it do, and
    together they have ``COVERAGE`` of its rarity. Words count that stand where the template
    has them, if it begins at the phrase's place or at one that a looked-up word proposes, no
    farther from it than the template is long; so words left out or put in between cost only
    themselves. Templates are judged one by one, so what else a file holds takes nothing from
    them. ``rarity`` comes from ``word_rarity``. Columns of ``docs`` with these names are replaced.
    Null and empty texts have no words and no findings. Equal rows get equal findings.
    """
    words = F.col("__words")
    rows = docs.withColumn("__words", split_words(lower_ascii(F.col("text")), WORD_SEPARATORS))
    marked = F.flatten(F.array(*[_marked(words, phrase, label) for phrase, label in phrases.items()]))
    rows = rows.withColumn("__base", F.when(_has_any(words, phrases), marked))
    found = _let(_votes(words, rarity, templates), lambda votes: _templates_found(words, votes, rarity, templates))
    rows = rows.withColumn("__found", F.when(_has_any(words, [t[1] for t in templates]), found))
    base, found = F.col("__base"), F.col("__found")
    base_labels = F.coalesce(F.transform(base, lambda b: b["label"]), F.array().cast("array<string>"))
    template_labels = F.coalesce(F.transform(found, lambda t: t["label"]), F.array().cast("array<string>"))
    score = F.greatest(
        F.coalesce(F.array_max(F.transform(found, lambda t: t["share"])), F.lit(0.0)),
        F.when(F.size(base_labels) > 0, PHRASE_SCORE).otherwise(0.0),
    )
    at = F.transform(base, lambda b: b["at"])
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return rows.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "n_base": F.size(base_labels).cast("long"),
            "first_word": F.array_min(at),
            "last_word": F.array_max(at),
            "base_labels": listed(base_labels),
            "template_labels": listed(template_labels),
            "labels": listed(F.concat(base_labels, template_labels)),
            "score": score,
        }
    ).drop("__words", "__base", "__found")


def _has_any(words: Column, phrases) -> Column:
    """Whether the longest word of any phrase stands in the file."""
    anchors = sorted({max(p.split(), key=len) for p in phrases})
    return F.arrays_overlap(words, F.lit(anchors))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def looked_up(text: list[str], rarity: dict[str, float]) -> list[str]:
    """The words of a template that the index has: its rarest ones."""
    by_rarity = sorted(set(text), key=lambda w: (-rarity[w], w))
    return by_rarity[: max(LEAST_LOOKED_UP, math.ceil(LOOKED_UP * len(by_rarity)))]


def postings(templates: list[tuple[str, str, str]], rarity: dict[str, float]) -> dict[str, list[tuple[int, int]]]:
    """The index: word to the templates, by number, and positions where it stands."""
    out: dict[str, list[tuple[int, int]]] = {}
    for t, (text, _, _) in enumerate(templates):
        words = text.split()
        for word in looked_up(words, rarity):
            out.setdefault(word, []).extend((t, p) for p, w in enumerate(words) if w == word)
    return out


# A vote is the template's number times _FAR plus the place where it would begin, plus _BEFORE.
_FAR, _BEFORE = 1 << 40, 1 << 20


def _votes(words: Column, rarity: dict[str, float], templates: list[tuple[str, str, str]]) -> Column:
    """Where the file's looked-up words say that templates begin."""
    index = postings(templates, rarity)
    # What a posting adds to the place of its word.
    steps = {w: [t * _FAR + _BEFORE - p for t, p in places] for w, places in sorted(index.items())}
    listed = F.create_map(*[x for w, of_word in steps.items() for x in (F.lit(w), F.lit(of_word).cast("array<bigint>"))])
    at = F.sequence(F.lit(0), F.size(words) - 1)
    hits = F.filter(at, lambda i: F.get(words, i).isin(sorted(index)))
    each = lambda i: F.transform(F.try_element_at(listed, F.get(words, i)), lambda step: i.cast("bigint") + step)
    return F.array_distinct(F.flatten(F.transform(hits, each)))


def _templates_found(words: Column, votes: Column, rarity: dict[str, float], templates: list[tuple[str, str, str]]) -> Column:
    """The templates that a file has: array of struct label, share."""
    shares = F.array(
        *[
            F.struct(F.lit(label).alias("label"), _share(words, votes, t, text.split(), phrase.split(), rarity).alias("share"))
            for t, (text, phrase, label) in enumerate(templates)
        ]
    )
    return F.filter(shares, lambda x: x["share"] >= COVERAGE)


def _share(words: Column, votes: Column, t: int, text: list[str], phrase: list[str], rarity: dict[str, float]) -> Column:
    """The largest share of the template that stands around one place of its phrase, 0 without one."""
    key_at = _offset(text, phrase)
    template, weights = F.lit(text), F.lit([float(rarity[w]) for w in text])
    every = F.lit(list(range(len(text))))
    whole = sum(rarity[w] for w in text)
    low = t * _FAR
    own = F.transform(
        F.filter(votes, lambda v: (v >= low) & (v < low + _FAR)), lambda v: (v - F.lit(low + _BEFORE)).cast("int")
    )

    def around(begins: Column, begin: Column) -> Column:
        near = F.array_distinct(F.concat(F.array(begin), F.filter(begins, lambda s: F.abs(s - begin) <= len(text))))
        stands = lambda near: F.filter(
            every, lambda p: F.exists(near, lambda s: F.coalesce(F.get(words, p + s) == F.get(template, p), F.lit(False)))
        )

        def judged(found: Column) -> Column:
            beside = F.size(F.filter(found, lambda p: (p < key_at) | (p >= key_at + len(phrase))))
            weight = F.aggregate(found, F.lit(0.0), lambda a, p: a + F.get(weights, p))
            return F.when(beside >= min(LEAST_BESIDE, len(text) - len(phrase)), F.when(F.size(found) == len(text), 1.0).otherwise(weight / F.lit(whole))).otherwise(0.0)

        return _let(_let(near, stands), judged)

    def best(places: Column) -> Column:
        return F.array_max(_let(own, lambda begins: F.transform(places, lambda i: around(begins, i - key_at))))

    return _let(_phrase_places(words, " ".join(phrase)), lambda at: F.when(F.size(at) > 0, best(at)).otherwise(0.0))


def _offset(text: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(text)) if text[i : i + len(phrase)] == phrase)


def op2_license_scan(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return scan_licenses(docs, word_rarity(docs)).drop("text")


QUERIES = {"op2_license_scan": op2_license_scan}
ORACLES: dict[str, str] = {}
