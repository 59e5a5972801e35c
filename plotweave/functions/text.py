"""Column expressions on review text. All are built-in, JVM-side functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the review format and of the term rule.
MIN_TERM_LENGTH = 3
SYNOPSIS_LABEL = "synopsis"

CONTROL_CHARACTERS = "".join(chr(c) for c in range(0x21))


def trim_control(text: Column) -> Column:
    """Strip every character up to U+0020 from both ends (``F.trim`` strips spaces only)."""
    return F.trim(text, F.lit(CONTROL_CHARACTERS))


def terms_in(text: Column, min_length: int = MIN_TERM_LENGTH) -> Column:
    """The lower-cased runs of a-z with at least ``min_length`` letters, in text order.

    The same terms as splitting on everything but a-z and dropping the short pieces, in
    one pass over the text and without a lambda.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(f"[a-z]{{{min_length},}}"), F.lit(0))


def first_segment(text: Column) -> Column:
    """Text up to the first colon, or the next piece where the first is the synopsis label.

    Empty pieces at the end do not count. Null where the wanted piece is missing.
    """
    pieces = F.rtrim(text, F.lit(":"))
    first = F.substring_index(pieces, ":", 1)
    second = F.substring_index(F.substring_index(pieces, ":", 2), ":", -1)
    is_label = F.lower(trim_control(first)) == SYNOPSIS_LABEL
    wanted = F.when(~is_label, first).when(pieces.contains(":"), second)
    return trim_control(F.when(pieces != "", wanted))


def whole_text(text: Column) -> Column:
    """The text with all its colons, less a leading synopsis label."""
    label = rf"(?i)^[\x00-\x20]*{SYNOPSIS_LABEL}[\x00-\x20]*:"
    return trim_control(F.regexp_replace(text, label, ""))
