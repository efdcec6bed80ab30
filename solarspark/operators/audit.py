"""Counts that describe a table: gaps, duplicates, statistics, volume, classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from solarspark.fixed_values import CLEANING_LABEL, MIN_TOTAL_ROWS
from solarspark.functions.features import is_missing, valid
from solarspark.operators.merge import union_all

LOT = 4096  # copies of a row unfolded at once


def null_counts(df: DataFrame, columns=None, nan: bool = True) -> DataFrame:
    """One wide row: missing values per column, from a single pass.

    NaN counts as missing in floating columns unless ``nan`` is off.
    """
    columns = df.columns if columns is None else columns
    return df.agg(*[F.count_if(is_missing(df, c, nan)).alias(c) for c in columns])


def null_counts_long(df: DataFrame, columns=None, nan: bool = True) -> DataFrame:
    """The same as rows of column, missing."""
    return null_counts(df, columns, nan).unpivot([], None, "column", "missing")


def null_compare(before: dict[str, tuple[DataFrame, list[str]]], after: DataFrame) -> DataFrame:
    """Missing values per source before, and of the merged table after, cleaning.

    Columns of the cleaned table appear only where gaps remain.
    """
    parts = [
        null_counts_long(df, [c for c in columns if c in df.columns])
        .select(F.lit("before").alias("phase"), F.lit(source).alias("source"), "column", "missing")
        for source, (df, columns) in before.items()
    ]
    remaining = null_counts_long(after).filter("missing > 0").select(
        F.lit("after").alias("phase"), F.lit("merged").alias("source"), "column", "missing")
    return union_all([*parts, remaining])


def duplicates(df: DataFrame) -> DataFrame:
    """One row: total, distinct_rows, duplicates and their percentage (0 when empty)."""
    per_row = df.groupBy(*df.columns).agg(F.count("*").alias("__copies"))
    counts = per_row.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("total"),
        F.count("*").alias("distinct_rows"))
    extra = F.col("total") - F.col("distinct_rows")
    return counts.select(
        "total", "distinct_rows", extra.alias("duplicates"),
        F.coalesce(F.try_divide(extra * 100.0, F.col("total")), F.lit(0.0)).alias("percent"))


def profile(df: DataFrame, described=()) -> DataFrame:
    """One wide row with all that the audit of a source tells, from one scan and one shuffle.

    ``total`` and ``distinct_rows``, missing values per column, and statistics of the
    ``described`` columns. Copies of a row meet first and are shuffled as the row and their
    number, without sums of other columns; each copy then counts again. ``profile_tables``
    lays the row out.
    """
    rows = _each_copy(df)
    aggs = [F.count("*").alias("total"), F.count_if("__first").alias("distinct_rows")]
    aggs += [F.count_if(is_missing(df, c)).alias(f"missing{i}") for i, c in enumerate(df.columns)]
    for i, c in enumerate(described):
        aggs += _statistics(df, c, i)
    return rows.agg(*aggs)


def _each_copy(df: DataFrame) -> DataFrame:
    """The rows, copies beside each other, the first of equal ones marked in ``__first``.

    Copies are unfolded in two steps, so that no array grows with their number.
    """
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("__copies"))
    lots = copies.withColumn("__lot", F.explode(F.expr(f"sequence(0, (__copies - 1) div {LOT})")))
    size = F.least(F.lit(LOT), F.col("__copies") - LOT * F.col("__lot")).cast("int")
    return lots.select(*df.columns, "__lot", F.posexplode(F.array_repeat(F.lit(0), size)).alias("__at", "__one")).select(
        *df.columns, ((F.col("__lot") == 0) & (F.col("__at") == 0)).alias("__first"))


def profile_tables(row, columns, described) -> dict[str, list[tuple]]:
    """Rows of the tables nulls, duplicates, describe and volume from one row of ``profile``."""
    extra = row["total"] - row["distinct_rows"]
    return {
        "nulls": [(c, row[f"missing{i}"]) for i, c in enumerate(columns)],
        "duplicates": [(row["total"], row["distinct_rows"], extra,
                        extra * 100.0 / row["total"] if row["total"] else 0.0)],
        "describe": [(c, *(row[f"{name}{i}"] for name in ("n", "mean", "sd", "min", "max")))
                     for i, c in enumerate(described)],
        "volume": [(row["total"],)],
    }


def _statistics(df: DataFrame, column: str, i: int) -> list:
    v = valid(df, column).cast("double")
    return [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"sd{i}"),
            F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}")]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns=None) -> DataFrame:
    """Typed statistics, a row per column: count, mean, stddev, min, max; one pass."""
    columns = numeric_columns(df) if columns is None else list(columns)
    aggs = []
    for i, c in enumerate(columns):
        aggs += _statistics(df, c, i)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                     F.col(f"mean{i}").alias("mean"), F.col(f"sd{i}").alias("stddev"),
                     F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"))
            for i, c in enumerate(columns)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def volume(sources: dict[str, DataFrame], minimum: int = MIN_TOTAL_ROWS) -> DataFrame:
    """Rows per source and in TOTAL, and whether the total reaches ``minimum``."""
    counted = union_all([
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n")
        for name, df in sources.items()])
    return (counted.rollup("source").agg(F.sum("n").alias("rows"))
            .select(F.coalesce("source", F.lit("TOTAL")).alias("source"), "rows",
                    F.when(F.col("source").isNull(), F.col("rows") >= minimum)
                    .alias("requirement_met")))


def class_distribution(df: DataFrame, label: str = CLEANING_LABEL) -> DataFrame:
    """Rows per label value, in order."""
    return df.groupBy(label).agg(F.count("*").alias("count")).orderBy(label)
