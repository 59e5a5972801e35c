"""Column expressions on dense vectors (``ARRAY<DOUBLE>``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the number format of a written centroid.
CENTROID_FORMAT = "#0.00000"


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays of one length."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def vector_equal(a: Column, b: Column) -> Column:
    """Whether two arrays have the same length and numbers; null if either is null."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return (F.size(a) == F.size(b)) & F.forall(same, lambda x: x)


def vector_add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def vector_divide(v: Column, n: Column) -> Column:
    return F.transform(v, lambda x: x / n)


def parse_vector(text: Column) -> Column:
    """``'1.0 2.5 '`` to an array; an unreadable number becomes a null element."""
    numbers = F.split(F.trim(text), " +")
    return F.when(F.trim(text) != "", numbers.try_cast("array<double>"))


def format_vector(v: Column) -> Column:
    """An array as space-separated numbers that read back as the same doubles."""
    return F.array_join(v.cast("array<double>").cast("array<string>"), " ")


def fixed_decimals(v: Column) -> Column:
    """An array as space-separated numbers with five decimals, half to even."""
    return F.array_join(
        F.transform(v, lambda x: F.call_function("format_number", x, F.lit(CENTROID_FORMAT))), " "
    )
