"""Column expressions against plain Python on random inputs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotweave.functions import (
    distance,
    first_segment,
    fixed_decimals,
    format_vector,
    parse_vector,
    terms_in,
    trim_control,
    vector_add,
    vector_divide,
    vector_equal,
    whole_text,
)

PIECES = ["a", "Bc", "don't", "THE", "café", "naïve", "x1y", " ", "\t", "\n", ":", "::", ".", "Synopsis",
          "synopsis:", "SYNOPSIS :", "ß", "中", " ", "\x85", "wordwordword", "-", "\x01", "\r\n", "ok"]
CONTROL = "".join(map(chr, range(33)))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(12))) for _ in range(3000)]
    return made + ["", ":", "::", "synopsis", " Synopsis : ", "synopsis:", "synopsis::x", ":x"]


def apply(spark, texts, expression):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in df.select(expression(F.col("text"))).collect()]


def pieces_of(text):
    """Split at colons, without the empty pieces at the end."""
    parts = text.split(":")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def python_first_segment(text):
    parts = pieces_of(text)
    if not parts:
        return None
    if parts[0].strip(CONTROL).lower() == "synopsis":
        return parts[1].strip(CONTROL) if len(parts) > 1 else None
    return parts[0].strip(CONTROL)


def test_terms(spark, texts):
    expected = [[t for t in re.split("[^a-z]+", text.lower()) if len(t) > 2] for text in texts]
    assert apply(spark, texts, terms_in) == expected
    longer = apply(spark, texts, lambda c: terms_in(c, 5))
    assert longer == [[t for t in terms if len(t) > 4] for terms in expected]


def test_trim(spark, texts):
    assert apply(spark, texts, trim_control) == [t.strip(CONTROL) for t in texts]


def test_first_segment(spark, texts):
    assert apply(spark, texts, first_segment) == [python_first_segment(t) for t in texts]


def test_whole_text(spark, texts):
    label = re.compile(r"[\x00-\x20]*synopsis[\x00-\x20]*:", re.I)
    assert apply(spark, texts, whole_text) == [label.sub("", t, count=1).strip(CONTROL) if label.match(t) else t.strip(CONTROL) for t in texts]


def test_vectors(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(50, 7)) * 10.0 ** rng.integers(-8, 8, (50, 7)), rng.normal(size=(50, 7))
    df = spark.createDataFrame([(x.tolist(), y.tolist()) for x, y in zip(a, b)], "a array<double>, b array<double>")
    row = F.struct(
        distance(F.col("a"), F.col("b")).alias("d"),
        vector_add(F.col("a"), F.col("b")).alias("s"),
        vector_divide(F.col("a"), F.lit(3.0)).alias("q"),
        parse_vector(F.concat(format_vector(F.col("a")), F.lit(" "))).alias("p"),
        fixed_decimals(F.col("b")).alias("f"),
    )
    found = [r[0] for r in df.select(row).collect()]
    assert [r.d for r in found] == pytest.approx(np.sqrt(((a - b) ** 2).sum(1)).tolist())
    assert [r.s for r in found] == (a + b).tolist()
    assert [r.q for r in found] == (a / 3.0).tolist()
    assert [r.p for r in found] == a.tolist()
    assert [r.f for r in found] == [" ".join(f"{x:.5f}" for x in row) for row in b]


def test_fixed_decimals_has_no_grouping(spark):
    df = spark.createDataFrame([([1234567.891, 0.0, -0.5],)], "v array<double>")
    assert df.select(fixed_decimals(F.col("v"))).first()[0] == "1234567.89100 0.00000 -0.50000"


def test_vector_equal(spark):
    rows = [([1.0, 2.0], [1.0, 2.0], True), ([1.0], [1.0, 2.0], False), ([1.0, 2.0], [2.0, 1.0], False), ([], [], True)]
    table = spark.createDataFrame(rows, "a array<double>, b array<double>, same boolean")
    assert all(r.e == r.same for r in table.select(vector_equal(F.col("a"), F.col("b")).alias("e"), "same").collect())
