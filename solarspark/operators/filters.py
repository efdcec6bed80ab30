"""Row predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solarspark.fixed_values import DAYLIGHT_GHI
from solarspark.functions.features import FLOATING


def above(df: DataFrame, column: str, cut: float) -> DataFrame:
    """Rows whose value exceeds ``cut``; NaN, which Spark sorts above all, is left out."""
    keep = F.col(column) > F.lit(cut)
    if isinstance(df.schema[column].dataType, FLOATING):
        keep = keep & ~F.isnan(column)
    return df.filter(keep)


def daylight(df: DataFrame, column: str = "GHI", cut: float = DAYLIGHT_GHI) -> DataFrame:
    """Operating hours: irradiance above ``cut`` W/m2."""
    return above(df, column, cut)


def within(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows with low <= value <= high."""
    return df.filter(F.col(column).between(F.lit(low), F.lit(high)))


def present_columns(df: DataFrame, wanted) -> list[str]:
    """Those of ``wanted`` that the frame has, in order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]
