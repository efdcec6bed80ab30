"""Distributions, correlation and regression as tables."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solarspark.fixed_values import HISTOGRAM_BINS, LINE_POINTS, MIN_CORRELATION_PAIRS, SCORE_BINS
from solarspark.functions.features import valid
from solarspark.operators.lookup import join_aggregate
from solarspark.operators.quantiles import exact_quantiles, quantile_name

# Share of a sum of squares that may be left of a constant by rounding.
ROUNDING = 1e-12
# Share of a column's variance that has to stay unexplained for a finite inflation factor.
COLLINEAR = 1e-9


def grid_point(index: Column, low: Column, high: Column, points: int) -> Column:
    """Value ``index`` (from 0) of ``points`` evenly spaced values from low to high."""
    step = (high - low) / F.lit(float(points - 1))
    return F.when(index == points - 1, high).otherwise(index * step + low)


def grid_points_reached(x: Column, low: Column, high: Column, points: int) -> Column:
    """How many of the evenly spaced values are <= x, by exact comparison.

    Arithmetic gives the position up to rounding and one comparison on either side
    settles it, which keeps the whole expression inside generated code.
    """
    step = (high - low) / F.lit(float(points - 1))
    position = F.greatest(F.lit(-1.0), F.least(F.lit(float(points - 1)), (x - low) / step))
    guess = F.floor(position)
    above = grid_point(guess + 1, low, high, points)
    here = grid_point(guess, low, high, points)
    index = (F.when((guess + 1 <= points - 1) & (above <= x), guess + 1)
             .when((guess >= 0) & (here > x), guess - 1)
             .otherwise(guess))
    return index + 1


def _range_of(values: DataFrame, keys) -> DataFrame:
    """Lowest and highest value and the count per group; equal ends are set 1 apart."""
    same = F.min("__v") == F.max("__v")
    return values.groupBy(*keys).agg(
        F.when(same, F.min("__v") - 0.5).otherwise(F.min("__v")).alias("__low"),
        F.when(same, F.max("__v") + 0.5).otherwise(F.max("__v")).alias("__high"),
        F.count("*").alias("__all"))


def _bin_of(bins: int) -> Column:
    reached = grid_points_reached(F.col("__v"), F.col("__low"), F.col("__high"), bins + 1)
    return F.least(reached, F.lit(bins)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins from minimum to maximum: bin, low, high, count.

    All bins appear; the last one includes its upper edge.
    """
    values = df.select(valid(df, column).cast("double").alias("__v")).filter("__v is not null")
    ends = _range_of(values, []).select(F.struct("__low", "__high").alias("e")).scalar()
    low, high = ends.getField("__low"), ends.getField("__high")
    counts = (values.withColumns({"__low": low, "__high": high})
              .groupBy(_bin_of(bins).alias("bin")).agg(F.count("*").alias("n")))
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (frame.join(counts, "bin", "left")
            .select("bin",
                    grid_point(F.col("bin") - 1, low, high, bins + 1).alias("low"),
                    grid_point(F.col("bin"), low, high, bins + 1).alias("high"),
                    F.coalesce("n", F.lit(0)).alias("count")))


def density_by_class(df: DataFrame, column: str, label: str, bins: int = SCORE_BINS) -> DataFrame:
    """Density histogram of each class over that class's own range: label, bin, low, high, density."""
    values = df.select(label, valid(df, column).cast("double").alias("__v")).filter(
        "__v is not null")
    ranges = _range_of(values, [label])
    counts = (join_aggregate(values, ranges, label, "inner", keys_from=df, nulls_match=True)
              .groupBy(label, _bin_of(bins).alias("bin"))
              .agg(F.count("*").alias("n")))
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    low = grid_point(F.col("bin") - 1, F.col("__low"), F.col("__high"), bins + 1)
    high = grid_point(F.col("bin"), F.col("__low"), F.col("__high"), bins + 1)
    width = (F.col("__high") - F.col("__low")) / F.lit(float(bins))
    density = F.coalesce("n", F.lit(0)) / (F.col("__all") * width)
    # Structs compare equal for the NULL class as well.
    counts = counts.select(F.struct(label, "bin").alias("__cell"), "n")
    return frame.withColumn("__cell", F.struct(label, "bin")).join(counts, "__cell", "left").select(
        label, "bin", low.alias("low"), high.alias("high"), density.alias("density"))


def center(df: DataFrame, column: str) -> DataFrame:
    """One row: n, mean, median, zeros and the share of zeros among the values."""
    v = valid(df, column)
    basic = df.agg(
        F.avg(v).alias("mean"),
        F.count_if(v == 0).alias("zeros"),
        F.avg((v == 0).cast("double")).alias("zero_share"))
    basic = basic.select(F.struct("*").alias("b")).scalar()
    return exact_quantiles(df, column, [0.5]).select(
        "n", basic.getField("mean").alias("mean"), "median",
        basic.getField("zeros").alias("zeros"), basic.getField("zero_share").alias("zero_share"))


def box_summary(df: DataFrame, column: str, keys=(), reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends and outlier count per group.

    Whiskers end at the outermost values within ``reach`` interquartile ranges of
    the box, or at the box where there are none. Rows with a NULL key are a group.
    """
    keys = list(keys)
    q1, q3 = quantile_name(0.25), quantile_name(0.75)
    quartiles = exact_quantiles(df, column, [0.25, 0.5, 0.75], keys)
    values = df.select(*keys, valid(df, column).cast("double").alias("__v")).filter(
        "__v is not null")
    if keys:
        joined = join_aggregate(values, quartiles, keys, "inner", nulls_match=True)
    else:
        row = quartiles.select(F.struct("*").alias("q")).scalar()
        joined = values.withColumns({c: row.getField(c) for c in quartiles.columns})
    spread = (F.col(q3) - F.col(q1)) * F.lit(reach)
    inside = F.col("__v").between(F.col(q1) - spread, F.col(q3) + spread)
    lowest = F.min(F.when(inside, F.col("__v")))
    highest = F.max(F.when(inside, F.col("__v")))
    return joined.groupBy(*keys).agg(
        F.first("n").alias("n"),
        F.first(q1).alias("q1"), F.first("median").alias("median"), F.first(q3).alias("q3"),
        F.least(F.coalesce(lowest, F.first(q1)), F.first(q1)).alias("whisker_low"),
        F.greatest(F.coalesce(highest, F.first(q3)), F.first(q3)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def _moment_sums(df: DataFrame, columns: list[str]) -> np.ndarray:
    """Sums of the products of every column's presence, centred value and square, 3 k x 3 k.

    Centred is by the mean, or by the value itself where a column has only one; a missing
    value has zeros.
    """
    clean = df.select(*[valid(df, c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    k = range(len(columns))
    one = clean.agg(*[F.when(F.min(f"c{i}") == F.max(f"c{i}"), F.min(f"c{i}")).otherwise(F.avg(f"c{i}")).alias(f"c{i}")
                      for i in k], F.count("*").alias("rows")).first()
    if not one["rows"]:
        return np.zeros((3 * len(columns), 3 * len(columns)))
    centred = clean.select(*[(F.col(f"c{i}") - F.lit(one[i] or 0.0)).alias(f"c{i}") for i in k])
    zero = F.lit(0.0)
    parts = [*[F.col(f"c{i}").isNotNull().cast("double").alias(f"m{i}") for i in k],
             *[F.coalesce(f"c{i}", zero).alias(f"x{i}") for i in k],
             *[F.coalesce(F.col(f"c{i}") * F.col(f"c{i}"), zero).alias(f"q{i}") for i in k]]
    moments = centred.select(*parts)
    rows = VectorAssembler(inputCols=moments.columns, outputCol="z", handleInvalid="keep").transform(moments).select("z")
    return RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "z"), 0, 3 * len(columns)).computeGramianMatrix().toArray()


def corr_matrix(df: DataFrame, columns, min_pairs: int = MIN_CORRELATION_PAIRS) -> DataFrame:
    """Pearson correlation of every pair, long form: i, j, col_i, col_j, pairs, r.

    Each pair uses the rows where both values are present. r is NULL with fewer
    than ``min_pairs`` such rows or when one side is constant on them.

    ``df`` is read twice, for the means and then as vectors of presence, centred value and
    square: one sum of their products, formed partition by partition and in a tree, holds
    all that any pair needs. Only that matrix comes to the driver; its size follows from the
    number of columns.
    """
    columns = list(columns)
    k = len(columns)
    sums = _moment_sums(df, columns)
    m, x, q = slice(0, k), slice(k, 2 * k), slice(2 * k, 3 * k)
    pairs, value, square, product = sums[m, m], sums[x, m], sums[q, m], sums[x, x]
    with np.errstate(all="ignore"):
        # (i, j): variation of i where j is present, and how they vary together.
        own = square - value * value / pairs
        own[own <= ROUNDING * square] = 0.0
        r = (product - value * value.T / pairs) / np.sqrt(own * own.T)
    known = (pairs >= max(min_pairs, 1)) & ~(own == 0.0) & ~(own.T == 0.0)
    return df.sparkSession.createDataFrame(
        [(i, j, columns[i], columns[j], int(pairs[i, j]), float(r[i, j]) if known[i, j] else None)
         for i in range(k) for j in range(k)],
        "i int, j int, col_i string, col_j string, pairs bigint, r double")


def lower_triangle(corr: DataFrame) -> DataFrame:
    """Each pair once, without the diagonal."""
    return corr.filter("i > j")


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line over rows with both values: n, slope, intercept, x_min, x_max."""
    xv, yv = valid(df, x).cast("double"), valid(df, y).cast("double")
    pair = df.select(xv.alias("x"), yv.alias("y")).na.drop()
    return pair.agg(
        F.count("*").alias("n"),
        F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
        F.min("x").alias("x_min"), F.max("x").alias("x_max"))


def fitted_line(fit: DataFrame, points: int = LINE_POINTS) -> DataFrame:
    """Evenly spaced points of the fitted line from the least to the greatest x."""
    index = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    x = grid_point(F.col("point"), F.col("x_min"), F.col("x_max"), points)
    return (fit.withColumn("point", index)
            .select("point", x.alias("x"), "slope", "intercept")
            .select("point", "x", (F.col("intercept") + F.col("slope") * F.col("x")).alias("y")))


def vif(df: DataFrame, columns) -> DataFrame:
    """Variance inflation factor of each column.

    Spark computes the k x k correlations; only that small matrix is worked on by the
    driver. A column that the others determine has an infinite factor, a constant one NULL
    and no part in the factors of the others.
    """
    columns = list(columns)
    matrix = np.full((len(columns), len(columns)), np.nan)
    for cell in corr_matrix(df.select(*columns).na.drop(), columns, 2).collect():
        matrix[cell["i"], cell["j"]] = np.nan if cell["r"] is None else cell["r"]
    varied = [i for i in range(len(columns)) if not np.isnan(matrix[i, i])]
    factors: dict[int, float] = {}
    for i in varied:
        others = [j for j in varied if j != i]
        toward = matrix[i, others]
        explained = toward @ np.linalg.pinv(matrix[np.ix_(others, others)], rcond=1e-10) @ toward
        factors[i] = 1.0 / float(1.0 - explained) if explained < 1.0 - COLLINEAR else float("inf")
    return df.sparkSession.createDataFrame(
        [(c, factors.get(i)) for i, c in enumerate(columns)], "feature string, vif double")
