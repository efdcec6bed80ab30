"""Performance features as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from solarspark.fixed_values import EFFICIENCY_THRESHOLD, SOILING_THRESHOLD

FLOATING = (T.DoubleType, T.FloatType)


def valid(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL, so that aggregates skip both."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.when(~F.isnan(c), c)
    return c


def is_missing(df: DataFrame, name: str, nan: bool = True) -> Column:
    """NULL, or NaN where the type has it."""
    c = F.col(name)
    if nan and isinstance(df.schema[name].dataType, FLOATING):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def clip_col(value: Column, low: float, high: float, strict: bool = False) -> Column:
    """Limit to [low, high]; NULL and NaN give NULL.

    ``strict`` keeps Spark's own treatment instead, which maps both to ``high``.
    """
    clipped = F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))
    if strict:
        return clipped
    return F.when(value.isNotNull() & ~F.isnan(value), clipped)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient where the denominator is positive, else 0."""
    return F.when(denominator > 0.0, numerator / denominator).otherwise(F.lit(0.0))


def efficiency(ac: Column, dc: Column) -> Column:
    """Share of DC power that leaves the inverter, in 32 bits."""
    return ratio_or_zero(ac, dc).cast("float")


def soiling_proxy(daily_yield: Column, plant_mean: Column) -> Column:
    """Shortfall against the plant's mean yield, in 32 bits; 0 without a positive mean.

    The yield counts up over a day, so morning readings look soiled; that bias is
    part of the definition.
    """
    shortfall = F.lit(1.0) - daily_yield / plant_mean
    return F.when(plant_mean > 0, shortfall).otherwise(F.lit(0.0)).cast("float")


def cleaning_flag(proxy: Column, eff: Column, proxy_over=SOILING_THRESHOLD,
                  efficiency_under=EFFICIENCY_THRESHOLD) -> Column:
    """1 for a soiled and inefficient reading, else 0 (thresholds are 64-bit)."""
    hit = (proxy > F.lit(float(proxy_over))) & (eff < F.lit(float(efficiency_under)))
    return F.coalesce(hit, F.lit(False)).cast("int")


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value that repeats after ``period``."""
    angle = value.cast("double") * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def dc_per_ghi(dc: Column, ghi: Column) -> Column:
    return ratio_or_zero(dc, ghi)


def temp_diff(module: Column, ambient: Column) -> Column:
    return module - ambient


def with_time_features(df: DataFrame, ts: str = "DATETIME") -> DataFrame:
    """HOUR and MONTH_NUM as doubles and their cyclic encodings."""
    hour, month = F.hour(ts), F.month(ts)
    hour_sin, hour_cos = cyclic(hour, 24.0)
    month_sin, month_cos = cyclic(month, 12.0)
    return df.withColumns({
        "HOUR": hour.cast("double"),
        "MONTH_NUM": month.cast("double"),
        "HOUR_SIN": hour_sin,
        "HOUR_COS": hour_cos,
        "MONTH_SIN": month_sin,
        "MONTH_COS": month_cos,
    })


def with_power_features(df: DataFrame) -> DataFrame:
    """Power per irradiance and module heating."""
    return df.withColumns({
        "DC_PER_GHI": dc_per_ghi(F.col("DC_POWER"), F.col("GHI")),
        "TEMP_DIFF": temp_diff(F.col("MODULE_TEMPERATURE"), F.col("AMBIENT_TEMPERATURE")),
    })


def max_scale(df: DataFrame, columns, suffix: str = "_SCALED") -> DataFrame:
    """Each column divided by its largest value, found once by a scalar subquery."""
    top = df.agg(F.struct(*[F.max(valid(df, c)).alias(c) for c in columns]).alias("top"))
    top = top.scalar()
    return df.withColumns({
        c + suffix: F.try_divide(F.col(c), top.getField(c)) for c in columns
    })
