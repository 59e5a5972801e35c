"""Joining a large table to a lookup table whose size is not known beforehand.

The keys here are mostly terms, and terms are as uneven as words are: a handful make up
most rows. A lookup within the budget is broadcast. A larger one is split by how often its
keys occur in the large table:

* Hot keys are broadcast, so their rows are never shuffled. A key counts as hot when its
  share of the rows is at least ``row bytes / budget``. The shares add up to one, so the
  hot rows together cannot exceed ``budget`` bytes, whatever the data.
* The other keys go through a shuffled join. Each of them holds a share of the rows below
  ``row bytes / budget``, so no task can be overrun by one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plotweave.session import stage

BROADCAST_BYTES = 64 * 1024 * 1024
# What a row of a broadcast hash table costs besides its key and payload.
ROW_OVERHEAD = 100


def row_bytes(key: str, payload: int = 8) -> Column:
    """What a lookup row takes in a broadcast hash table."""
    return (F.octet_length(F.col(key).cast("string")) + F.lit(ROW_OVERHEAD + payload)).cast("double")


def broadcast_bytes(lookup: DataFrame, key: str, payload: int = 0) -> float:
    """What broadcasting the whole lookup would take. Runs a job: pass a stored table."""
    return lookup.agg(F.sum(row_bytes(key, payload))).first()[0] or 0.0


def hot_rows(
    lookup: DataFrame, key: str, weight: str, budget: int = BROADCAST_BYTES, payload: int = 0
) -> DataFrame:
    """The rows of ``lookup`` to broadcast; together at most ``budget`` bytes."""
    total = lookup.agg(F.sum(F.col(weight).cast("double"))).first()[0] or 0.0
    return lookup.where(
        F.col(weight).cast("double") * F.lit(float(budget)) >= F.lit(total) * row_bytes(key, payload)
    )


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    weight: str | None = None,
    payload: int = 8,
    budget: int = BROADCAST_BYTES,
    lookup_bytes: float | None = None,
) -> DataFrame:
    """``rows`` joined to ``lookup`` on ``key``, which is unique in ``lookup``.

    ``how`` is ``inner`` or ``left``. ``weight`` is a column of ``lookup`` with the number of
    rows per key; without one the rows are counted if the lookup turns out to be too large.
    ``payload`` is the width in bytes of the columns beside the key; ``lookup_bytes`` is the
    sum of ``row_bytes`` where the caller has measured it. Both tables should be stored ones:
    they are read more than once.
    """
    if lookup_bytes is None:
        lookup_bytes = broadcast_bytes(lookup, key, payload)
    if lookup_bytes <= budget:
        return rows.join(F.broadcast(lookup), key, how)
    weighted = lookup
    if weight is None:
        weight = "rows_per_key"
        used = rows.groupBy(key).agg(F.count("*").alias(weight))
        weighted = stage(lookup.join(used, key, "left").fillna(0, weight), "weighted_lookup")
    hot = hot_rows(weighted, key, weight, budget, payload).select(lookup.columns)
    by_broadcast = rows.join(F.broadcast(hot), key, "inner")
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return by_broadcast.unionByName(rest.join(lookup.hint("shuffle_merge"), key, how))
