"""Exact quantiles per group, with linear interpolation.

A wanted rank is searched like a page in a book. Every group starts with the interval from
its least to its greatest value. A pass over the rows counts those of each interval in
equal bins, with the least and greatest value of each bin; the bin that holds the rank
becomes the next interval, drawn tight around the values it really has. The counts meet
map-side, so a pass moves a bounded number of rows whatever the size of a group. A rank
whose interval has one value only is found. Once an interval holds few values they are
moved, sorted in one task, and read at the rank.

Nothing is estimated, so nothing has to be verified. Three or four passes are enough for
any number of rows, unless values lie in clusters of very different scale, each of which
takes one more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from solarspark.functions.features import valid
from solarspark.operators.lookup import join_aggregate
from solarspark.session import stage

# Distinct values one task may hold.
TASK_VALUES = 2_000_000

# Bins of an interval in one pass, and values of an interval that may be moved.
BINS = 1024
INTERVAL_VALUES = 20_000

# So many rows of intermediate results at most are kept by the driver; more go to a table.
LOCAL_ROWS = 10_000

SKETCH_ACCURACY = 10_000
GREATEST = 1.7976931348623157e308


def quantile_name(p: float) -> str:
    return "median" if p == 0.5 else f"q{p * 100:g}".replace(".", "_")


def _settle(df: DataFrame) -> tuple[DataFrame, bool]:
    """``df`` computed once, and whether it is small enough to be sent to all tasks."""
    rows = df.limit(LOCAL_ROWS + 1).collect()
    if len(rows) <= LOCAL_ROWS:
        return df.sparkSession.createDataFrame(rows, df.schema), True
    return stage(df), False


def _ranks(p: float, n: Column) -> tuple[Column, Column, Column]:
    """Place of a quantile among n values and the ranks next to it, from 0."""
    place = F.lit(p) * (n - 1)
    return place, F.floor(place), F.ceil(place)


def exact_quantiles(df: DataFrame, value: str, probabilities=(0.5,), keys=(),
                    interval_values: int = INTERVAL_VALUES) -> DataFrame:
    """One row per group: the keys, ``n`` and a column per probability.

    NULL and NaN are left out; a group without values has no row, except that an
    ungrouped call always gives one. Ranks whose interval holds more than
    ``interval_values`` values are narrowed down further before values are moved.
    """
    keys, probabilities = list(keys), [float(p) for p in probabilities]
    # A struct of the keys compares equal for NULL groups as well.
    group = F.struct(*keys) if keys else F.lit(0)
    data = df.select(group.alias("__g"), valid(df, value).cast("double").alias("__v")).filter(
        F.col("__v").isNotNull())
    ends = data.groupBy("__g").agg(
        F.count("*").alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high"))
    wanted = F.array_distinct(F.array(*[r for p in probabilities for r in _ranks(p, F.col("n"))[1:]]))
    state, small = _settle(ends.select(
        "__g", "n", F.explode(wanted).alias("rank"), "low", "high", F.col("n").alias("held"),
        F.lit(0).cast("bigint").alias("below")))
    width = 2 * len(probabilities)

    while not (wide := state.filter(F.col("held") > interval_values).filter("low < high")).isEmpty():
        counts = _bin_counts(data, _brackets(wide, width), width, small)
        at = (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("held"))
        narrowed = (wide.select("__g", "n", "rank", "below")
                    .join(counts, ["__g", "below"]).filter(at)
                    .select("__g", "n", "rank", "low", "high", "held", F.col("start").alias("below")))
        rest = state.filter((F.col("held") <= interval_values) | (F.col("low") >= F.col("high")))
        state, small = _settle(rest.unionByName(narrowed))

    open_ = state.filter("low < high")
    if not open_.isEmpty():
        moved = (_in_brackets(data, _brackets(open_, width), width, small)
                 .groupBy("__g", "__in.below").agg(F.sort_array(F.collect_list("__v")).alias("values")))
        state = state.join(moved, ["__g", "below"], "left").withColumn("low", F.coalesce(
            F.get("values", (F.col("rank") - F.col("below")).cast("int")), "low"))

    state, _ = _settle(state.groupBy("__g").agg(
        F.max("n").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("rank", "low"))).alias("at")))
    columns = []
    for p in probabilities:
        place, before, after = _ranks(p, F.col("n"))
        low, high = F.col("at")[before], F.col("at")[after]
        # The same weighting of the two neighbours that Spark's percentile uses.
        mixed = (after - place) * low + (place - before) * high
        columns.append(F.when(before == after, low).otherwise(mixed).alias(quantile_name(p)))
    if keys:
        return state.select(*[F.col("__g").getField(k).alias(k) for k in keys], "n", *columns)
    return state.select("n", *columns).agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
        *[F.max(quantile_name(p)).alias(quantile_name(p)) for p in probabilities])


def _brackets(state: DataFrame, width: int) -> DataFrame:
    """One row per group with its intervals in order: in0, in1, ... of (below, low, high)."""
    inside = F.sort_array(F.collect_set(F.struct("below", "low", "high")))
    return state.groupBy("__g").agg(inside.alias("all")).select(
        "__g", *[F.get("all", F.lit(i)).alias(f"in{i}") for i in range(width)])


def _in_brackets(data: DataFrame, brackets: DataFrame, width: int, small: bool) -> DataFrame:
    """Rows within an interval of their group, with that interval as ``__in``."""
    joined = (data.join(F.broadcast(brackets), "__g") if small
              else join_aggregate(data, brackets, "__g", "inner"))
    inside = [F.when(F.col("__v").between(F.col(f"in{i}.low"), F.col(f"in{i}.high")), F.col(f"in{i}"))
              for i in range(width)]
    return joined.select("__g", "__v", F.coalesce(*inside).alias("__in")).filter("__in is not null")


def _bin_counts(data: DataFrame, brackets: DataFrame, width: int, small: bool) -> DataFrame:
    """Bins of every interval that have values: __g, below, low, high, held, start.

    ``start`` is the number of values of the group below the bin.
    """
    v, low, high = F.col("__v"), F.col("__in.low"), F.col("__in.high")
    # Halves of finite ends, so that no difference overflows. Every step keeps the order, and
    # the ends are in the first and the last bin, so each pass parts an interval.
    half = lambda c: F.greatest(F.lit(-GREATEST), F.least(F.lit(GREATEST), c)) * 0.5
    share = F.try_divide(half(v) - half(low), half(high) - half(low))
    index = (F.when(v <= low, 0).when(v >= high, BINS - 1)
             .otherwise(F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BINS), F.lit(BINS - 1))))
    counts = (_in_brackets(data, brackets, width, small)
              .groupBy("__g", F.col("__in.below").alias("below"), index.cast("int").alias("bin"))
              .agg(F.min("__v").alias("low"), F.max("__v").alias("high"), F.count("*").alias("held")))
    upto = F.sum("held").over(Window.partitionBy("__g", "below").orderBy("bin"))
    return counts.select("__g", "below", "low", "high", "held",
                         (F.col("below") + upto - F.col("held")).alias("start"))


def approx_quantiles(df: DataFrame, value: str, probabilities=(0.5,), keys=(),
                     accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """The same shape from a bounded sketch; rank error at most n / accuracy."""
    v = valid(df, value).cast(T.DoubleType())
    return df.groupBy(*keys).agg(
        F.count(v).alias("n"),
        *[F.percentile_approx(v, p, accuracy).alias(quantile_name(p)) for p in probabilities])
