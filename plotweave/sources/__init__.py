from plotweave.sources.reviews import (
    CheckedReviews,
    read_review_lines,
    read_review_lines_checked,
    read_reviews,
    read_reviews_checked,
)
from plotweave.sources.tables import read_table
from plotweave.sources.text_tables import (
    read_centroids,
    read_coordinate_centroids,
    read_dictionary,
    read_history,
    read_keyed_centroids,
    read_stop_words,
    read_triples,
    read_vectors,
    read_word_counts,
    write_centroids,
    write_coordinate_centroids,
    write_dictionary,
    write_history,
    write_keyed_centroids,
    write_triples,
    write_vectors,
    write_word_counts,
)

__all__ = [
    "CheckedReviews",
    "read_centroids",
    "read_coordinate_centroids",
    "read_dictionary",
    "read_history",
    "read_keyed_centroids",
    "read_review_lines",
    "read_review_lines_checked",
    "read_reviews",
    "read_reviews_checked",
    "read_stop_words",
    "read_table",
    "read_triples",
    "read_vectors",
    "read_word_counts",
    "write_centroids",
    "write_coordinate_centroids",
    "write_dictionary",
    "write_history",
    "write_keyed_centroids",
    "write_triples",
    "write_vectors",
    "write_word_counts",
]
