"""Class balance and cost weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solarspark.fixed_values import CLEANING_LABEL


def class_ratio(df: DataFrame, label: str = CLEANING_LABEL, keys=(), *more: Column) -> DataFrame:
    """n, positives, negatives, positive_rate and negatives per positive, and ``more`` aggregates.

    One row, or one for each combination of ``keys``.
    """
    counts = df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"), *more)
    return counts.select(
        "*",
        F.try_divide(F.col("positives"), F.col("n")).alias("positive_rate"),
        F.try_divide(F.col("negatives"), F.col("positives")).alias("ratio"))


def with_class_weight(train: DataFrame, label: str = CLEANING_LABEL,
                      out: str = "sample_weight") -> DataFrame:
    """Weight positives by negatives / positives, all else by 1.

    The ratio is a scalar subquery; it fails with a clear message when the training
    rows hold no positive.
    """
    ratio = class_ratio(train, label).select(
        F.when(F.col("positives") > 0, F.col("ratio"))
        .otherwise(F.raise_error(F.lit(f"no row with {label} = 1 to weight")).cast("double"))
    ).scalar()
    return train.withColumn(out, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))
