"""Down-sampling to hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solarspark.fixed_values import HOURLY_MEASURES
from solarspark.functions.features import valid
from solarspark.operators.calendar import calendar_keys, with_calendar_keys


def hourly_profile(df: DataFrame, ts: str = "DATETIME", values=HOURLY_MEASURES,
                   include_year: bool = False) -> DataFrame:
    """Mean of each value per (month, day, hour) of the local clock; NaN counts as missing.

    Without the year the result has at most 366 x 24 rows whatever the input.
    """
    keys = calendar_keys(include_year)
    return (with_calendar_keys(df.select(ts, *values), ts, include_year)
            .groupBy(*keys)
            .agg(*[F.avg(valid(df, v)).alias(v) for v in values]))
