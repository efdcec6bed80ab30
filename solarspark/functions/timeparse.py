"""Timestamp parsing and zone shifts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from solarspark.fixed_values import PLANT_ZONE, TIMESTAMP_FORMATS
from solarspark.session import require_utc

FIXED_WIDTH = re.compile(r"(yyyy|MM|dd|HH|mm|ss|[-/:. ])+")


def parse_first(text: Column, formats=TIMESTAMP_FORMATS) -> Column:
    """Timestamp by the first format that fits; NULL when none does.

    A failed parse costs far more than a good one, so a format whose fields all have
    a fixed width is tried only on text of its length.
    """
    return F.coalesce(*[_parse(text, f) for f in formats])


def _parse(text: Column, form: str) -> Column:
    parsed = F.try_to_timestamp(text, F.lit(form))
    if FIXED_WIDTH.fullmatch(form):
        return F.when(F.length(text) == len(form), parsed)
    return parsed


def with_datetime(df: DataFrame, text="DATE_TIME", out="DATETIME", formats=TIMESTAMP_FORMATS):
    """Parse logger text into instants, read as UTC."""
    require_utc(df.sparkSession)
    return df.withColumn(out, parse_first(F.col(text), formats))


def unparseable_count(df: DataFrame, text="DATE_TIME", formats=TIMESTAMP_FORMATS) -> DataFrame:
    """One row: timestamps that are present but fit no format."""
    bad = F.col(text).isNotNull() & parse_first(F.col(text), formats).isNull()
    return df.agg(F.count_if(bad).alias("unparseable"))


def to_local(df: DataFrame, ts: str, zone=PLANT_ZONE, out: str | None = None) -> DataFrame:
    """Shift a UTC column to local wall-clock time, keeping its type.

    A zoneless column is shifted as such; an instant needs a UTC session, since
    its later date parts are taken in the session zone.
    """
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        shifted = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts))
    else:
        require_utc(df.sparkSession)
        shifted = F.from_utc_timestamp(F.col(ts), zone)
    return df.withColumn(out or ts, shifted)


def month_label(month: Column) -> Column:
    """Three-letter English month name of a month number."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMM")
