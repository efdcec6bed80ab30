"""Rows of text files whose values do not fit the declared types.

A reader that keeps malformed rows adds two columns: the raw line, NULL where all values fit,
and the file. Such rows are set apart before gaps are filled, so that a misread number is
neither averaged nor replaced by an average.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MALFORMED = "_malformed"
SOURCE_FILE = "_source_file"


def holds_malformed(df: DataFrame) -> bool:
    return MALFORMED in df.columns


def well_formed(df: DataFrame) -> DataFrame:
    """Rows whose values all fit, without the two columns; any other frame as it is."""
    if not holds_malformed(df):
        return df
    return df.filter(F.col(MALFORMED).isNull()).drop(MALFORMED, SOURCE_FILE)


def malformed_rows(df: DataFrame) -> DataFrame:
    """``file, line``: the others, as they stand in the files."""
    return df.filter(F.col(MALFORMED).isNotNull()).select(
        F.col(SOURCE_FILE).alias("file"), F.col(MALFORMED).alias("line"))


def malformed_counts(df: DataFrame) -> DataFrame:
    """``file, total, malformed`` for every file with rows."""
    return df.groupBy(F.col(SOURCE_FILE).alias("file")).agg(
        F.count("*").alias("total"), F.count(MALFORMED).alias("malformed"))
