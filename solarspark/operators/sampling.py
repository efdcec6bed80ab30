"""Repeatable samples and chronological heads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solarspark.fixed_values import FORECAST_ROWS, SEED


def hash_sample(df: DataFrame, keys, n: int, seed: int = SEED) -> DataFrame:
    """``n`` rows in pseudo-random order of their key; all rows when there are fewer.

    Each task keeps only its own best ``n``, so nothing is sorted as a whole.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return df.orderBy(F.md5(text), *keys).limit(n)


def first_in_time(df: DataFrame, ts: str, keys, n: int = FORECAST_ROWS) -> DataFrame:
    """The earliest ``n`` rows; ``keys`` break ties so that runs agree."""
    return df.orderBy(ts, *keys).limit(n)
