"""Seasonal and geographic profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solarspark.functions.features import valid
from solarspark.operators.calendar import densify_months
from solarspark.operators.quantiles import exact_quantiles


def monthly(df: DataFrame, ts: str = "DATETIME", columns=("OPTIMAL_TILT", "ghi")) -> DataFrame:
    """Mean of each column per calendar month, all twelve months present."""
    means = df.groupBy(F.month(ts).alias("month")).agg(
        *[F.avg(valid(df, c)).alias(c) for c in columns])
    return densify_months(means)


def city_ranking(df: DataFrame, value: str = "ghi", city: str = "CITY") -> DataFrame:
    """Cities by median, highest first."""
    return (exact_quantiles(df, value, [0.5], [city])
            .select(city, "n", "median")
            .orderBy(F.desc("median"), F.asc(city)))


def city_month(df: DataFrame, ts: str = "DATETIME", value: str = "ghi",
               city: str = "CITY") -> DataFrame:
    """Mean per city and month as a table of twelve month columns m1..m12."""
    return (df.select(city, F.month(ts).alias("__month"), valid(df, value).alias("__v"))
            .groupBy(city)
            .pivot("__month", list(range(1, 13)))
            .agg(F.avg("__v"))
            .select(city, *[F.col(f"`{m}`").alias(f"m{m}") for m in range(1, 13)]))
