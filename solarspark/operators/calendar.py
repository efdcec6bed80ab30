"""Calendar keys and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solarspark.functions.timeparse import month_label


def with_calendar_keys(df: DataFrame, ts: str, include_year: bool = False) -> DataFrame:
    """MONTH, DAY and HOUR of a timestamp, and YEAR on request."""
    keys = {"MONTH": F.month(ts), "DAY": F.dayofmonth(ts), "HOUR": F.hour(ts)}
    if include_year:
        keys = {"YEAR": F.year(ts), **keys}
    return df.withColumns(keys)


def calendar_keys(include_year: bool = False) -> list[str]:
    return (["YEAR"] if include_year else []) + ["MONTH", "DAY", "HOUR"]


def densify_months(df: DataFrame, month: str = "month") -> DataFrame:
    """One row for each of the twelve months, labelled; absent months carry NULL."""
    months = df.sparkSession.range(1, 13).select(F.col("id").cast("int").alias(month))
    return (months.join(df, month, "left")
            .withColumn("label", month_label(F.col(month)))
            .select(month, "label", *[c for c in df.columns if c != month]))
