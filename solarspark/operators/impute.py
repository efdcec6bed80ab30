"""Filling gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solarspark.functions.features import valid


def column_means(df: DataFrame, columns) -> DataFrame:
    """One row with the mean of each column over its non-NULL, non-NaN values."""
    return df.agg(*[F.avg(valid(df, c)).alias(c) for c in columns])


def mean_fill(df: DataFrame, columns) -> DataFrame:
    """Replace NULL and NaN by the column mean, cast to the column's type.

    The means arrive through one scalar subquery, so the plan stays lazy and no
    join is needed. A column without a single value stays as it is.
    """
    columns = list(columns)
    means = column_means(df, columns).select(F.struct(*columns).alias("means")).scalar()
    return df.withColumns({
        c: F.coalesce(valid(df, c), means.getField(c).cast(df.schema[c].dataType), F.col(c))
        for c in columns
    })
