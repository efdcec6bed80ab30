"""Joins against small aggregates, broadcast only when their size is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solarspark.session import stage

BROADCAST_ROWS = 100_000


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` holds no more than ``rows`` rows. Each task sends one number."""
    return df.count() <= rows


def join_aggregate(df: DataFrame, aggregate: DataFrame, on, how: str = "left",
                   keys_from: DataFrame | None = None,
                   max_rows: int = BROADCAST_ROWS, nulls_match: bool = False) -> DataFrame:
    """Join rows to an aggregate that has one row per key ``on``.

    Its size is counted first: over the distinct keys of ``keys_from``, a cheap scan
    of the key columns that bounds the aggregate from above and leaves the aggregate
    lazy, or without that over the aggregate itself, computed once. Up to
    ``max_rows`` it is broadcast and the big side is not shuffled at all. Above that
    it is read back from a table and both sides are shuffled on the key; a key that
    dominates ``df`` is split by the adaptive skew join, which works only when both
    inputs of the join are plain shuffles, hence the table. With ``nulls_match`` the
    group of NULL keys meets its own rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if keys_from is not None:
        small = has_at_most(keys_from.select(*keys).distinct(), max_rows)
        aggregate = aggregate if small else stage(aggregate)
    else:
        aggregate = stage(aggregate)
        small = has_at_most(aggregate, max_rows)
    if not nulls_match:
        return df.join(F.broadcast(aggregate) if small else aggregate, keys, how)
    # A struct of the keys compares equal for NULL as well.
    other = aggregate.select(F.struct(*keys).alias("__key"),
                             *[c for c in aggregate.columns if c not in keys])
    return df.withColumn("__key", F.struct(*keys)).join(
        F.broadcast(other) if small else other, "__key", how).drop("__key")
