"""Splitting by time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solarspark.fixed_values import TEST_MONTH, TRAIN_MONTH


def by_month(df: DataFrame, ts: str = "DATETIME", train: int = TRAIN_MONTH,
             test: int = TEST_MONTH) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by calendar month of any year; other months fall out.

    A column MONTH is taken as the month, so that a table partitioned by it is pruned.
    """
    month = F.col("MONTH") if "MONTH" in df.columns else F.month(ts)
    return df.filter(month == train), df.filter(month == test)
