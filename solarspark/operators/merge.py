"""Joining the three sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from solarspark.fixed_values import HOURLY_MEASURES
from solarspark.functions.features import valid
from solarspark.operators.calendar import calendar_keys, with_calendar_keys
from solarspark.operators.lookup import join_aggregate
from solarspark.operators.resample import hourly_profile


def union_all(frames, allow_missing: bool = False) -> DataFrame:
    """Union by column name; on request a column absent from a frame becomes NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def dedupe(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed; copies meet map-side, before any shuffle."""
    return df.dropDuplicates()


def drop_null_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop(subset=list(columns))


def repeated_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def assert_unique_key(df: DataFrame, keys) -> None:
    """Raise when a join on ``keys`` would multiply rows."""
    if not repeated_keys(df, keys).isEmpty():
        raise ValueError(f"key {list(keys)} is not unique")


def with_unique_key(df: DataFrame, keys) -> DataFrame:
    """The rows with complete keys; the query that reads them fails if a key repeats.

    The check needs the rows of a key together, as a join on ``keys`` does, and shares
    its shuffle.
    """
    copies = F.count("*").over(Window.partitionBy(*keys))
    fails = F.raise_error(F.lit(f"key {list(keys)} is not unique")).cast("boolean")
    checked = df.na.drop(subset=list(keys)).withColumn("__copies", copies)
    return checked.filter(F.when(F.col("__copies") > 1, fails).otherwise(True)).drop("__copies")


def attach_group_mean(df: DataFrame, keys, value: str, out: str,
                      keys_from: DataFrame | None = None) -> DataFrame:
    """Add to each row the mean of ``value`` over its group; NULL keys get NULL.

    NaN counts as missing, as in the other means.

    ``keys_from`` is a cheaper frame with all keys of ``df``, such as its raw input;
    it serves to count the groups.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    means = df.groupBy(*keys).agg(F.avg(valid(df, value)).alias(out)).withColumn(out, F.when(known, F.col(out)))
    # A plain join would filter NULL keys before the shuffles of ``df``, which could not be shared then.
    joined = join_aggregate(df, means, keys, keys_from=df if keys_from is None else keys_from, nulls_match=True)
    return joined.select(*keys, *[c for c in df.columns if c not in keys], out)


def attach_weather(readings: DataFrame, weather: DataFrame,
                   on=("DATETIME", "PLANT_ID"), drop=("SOURCE_KEY",)) -> DataFrame:
    """Left join plant sensor values; the sensor's own id is dropped."""
    return readings.join(weather.drop(*drop), list(on), "left")


def attach_hourly(readings: DataFrame, series: DataFrame, ts: str = "DATETIME",
                  series_ts: str | None = None, values=HOURLY_MEASURES,
                  include_year: bool = False) -> DataFrame:
    """Give every reading the hourly mean of ``series`` for its calendar hour.

    Without the year the profile has at most 8,784 rows by construction and is
    broadcast; with it the size depends on the data and Spark chooses the join.
    """
    keys = calendar_keys(include_year)
    profile = hourly_profile(series, series_ts or ts, values, include_year)
    if not include_year:
        profile = F.broadcast(profile)
    return (with_calendar_keys(readings, ts, include_year)
            .join(profile, keys, "left")
            .drop("DAY", "HOUR"))
