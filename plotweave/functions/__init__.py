from plotweave.functions.text import first_segment, terms_in, trim_control, whole_text
from plotweave.functions.vectors import (
    distance,
    fixed_decimals,
    format_vector,
    parse_vector,
    vector_add,
    vector_divide,
    vector_equal,
)

__all__ = [
    "distance",
    "first_segment",
    "fixed_decimals",
    "format_vector",
    "parse_vector",
    "terms_in",
    "trim_control",
    "vector_add",
    "vector_divide",
    "vector_equal",
    "whole_text",
]
