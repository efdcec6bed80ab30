"""Scores of fitted models as tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from solarspark.fixed_values import SWEEP_FIRST, SWEEP_LAST, SWEEP_POINTS
from solarspark.operators.quantiles import TASK_VALUES
from solarspark.operators.stats import grid_point, grid_points_reached
from solarspark.session import stage


def positive_score(scored: DataFrame, probability: str = "probability",
                   out: str = "score") -> DataFrame:
    """Probability of the positive class as a plain double."""
    return scored.withColumn(out, vector_to_array(F.col(probability))[1])


def confusion(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row of tn, fp, fn, tp with class precision and recall (0 where undefined)."""
    y, p = F.col(label), F.col(prediction)
    cells = scored.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))
    return cells.select(
        "*",
        _or_zero(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _or_zero(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def _or_zero(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_metrics(cells: DataFrame) -> DataFrame:
    """Accuracy, F1, precision and recall weighted by class size, from a confusion row."""
    tn, fp, fn, tp = map(F.col, ("tn", "fp", "fn", "tp"))
    n, positives, negatives = tn + fp + fn + tp, tp + fn, tn + fp
    precision1, recall1 = _or_zero(tp, tp + fp), _or_zero(tp, tp + fn)
    precision0, recall0 = _or_zero(tn, tn + fn), _or_zero(tn, tn + fp)

    def weighted(for1, for0):
        return _or_zero(for1 * positives + for0 * negatives, n)

    f1 = _or_zero(2.0 * precision1 * recall1, precision1 + recall1)
    f0 = _or_zero(2.0 * precision0 * recall0, precision0 + recall0)
    return cells.select(
        _or_zero(tp + tn, n).alias("accuracy"), weighted(f1, f0).alias("f1"),
        weighted(precision1, precision0).alias("weighted_precision"),
        weighted(recall1, recall0).alias("weighted_recall"))


def threshold_curve(scored: DataFrame, label: str, score: str, first: float = SWEEP_FIRST,
                    last: float = SWEEP_LAST, points: int = SWEEP_POINTS) -> DataFrame:
    """Precision, recall and F1 at evenly spaced cut-offs; a score equal to one counts.

    Rows are counted once by the number of cut-offs they reach; the running sums go
    over those at most ``points`` + 1 counts, never over rows.
    """
    low, high = F.lit(float(first)), F.lit(float(last))
    x = F.col(score).cast("double")
    reached = F.when(~F.isnan(x), grid_points_reached(x, low, high, points))
    counts = (scored.groupBy(F.coalesce(reached, F.lit(0)).cast("int").alias("reached"))
              .agg(F.count_if(F.col(label) == 1).alias("pos"),
                   F.count_if(F.col(label) == 0).alias("neg"))
              .unionByName(scored.sparkSession.range(0, points + 1).select(
                  F.col("id").cast("int").alias("reached"), F.lit(0).alias("pos"),
                  F.lit(0).alias("neg")))
              .groupBy("reached").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    from_here = Window.orderBy("reached").rowsBetween(0, Window.unboundedFollowing)
    sums = counts.select(
        "reached", F.sum("pos").over(from_here).alias("tp"),
        F.sum("neg").over(from_here).alias("fp"),
        F.sum("pos").over(Window.partitionBy()).alias("positives"))
    precision = _or_zero(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _or_zero(F.col("tp"), F.col("positives"))
    return (sums.filter("reached > 0")
            .select(grid_point(F.col("reached") - 1, low, high, points).alias("threshold"),
                    precision.alias("precision"), recall.alias("recall"))
            .withColumn("f1", _or_zero(2.0 * F.col("precision") * F.col("recall"),
                                       F.col("precision") + F.col("recall"))))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The cut-off of greatest F1, the lowest among equals."""
    return curve.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)


def auc(scored: DataFrame, label: str, score: str = "rawPrediction",
        task_values: int = TASK_VALUES) -> DataFrame:
    """One row: the area under the ROC curve, every distinct score a cut-off.

    It is the share of pairs of a positive and a negative row in which the positive one
    scores higher, ties counting half. Rows are counted per distinct score; the running
    sums go over ranges of scores and over the totals of the ranges, so no task holds
    more than ``task_values`` scores. NULL without rows of both classes.
    """
    x = F.col(score)
    if isinstance(scored.schema[score].dataType, VectorUDT):
        x = vector_to_array(x)[1]
    counts = stage(scored.filter(F.col(label).isin(0, 1)).groupBy(x.cast("double").alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")))
    parts = counts.count() // task_values + 1
    if parts == 1:
        upto = Window.orderBy("s")
        ordered = counts.withColumn("before", F.lit(0))
    else:
        # The table pins which range holds which score.
        ordered = stage(counts.repartitionByRange(parts, "s").withColumn("part", F.spark_partition_id()))
        upto = Window.partitionBy("part").orderBy("s")
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        ranges = ordered.groupBy("part").agg(F.sum("pos").alias("all")).select(
            "part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
        ordered = ordered.join(F.broadcast(ranges), "part")  # one row for each range
    # A positive loses against the negatives above it, and half against equal ones.
    below = F.col("before") + F.sum("pos").over(upto) - F.col("pos")
    lost = ordered.select("pos", "neg", (F.col("neg") * (below + F.col("pos") / 2)).alias("lost"))
    return lost.agg((1.0 - F.try_divide(
        F.sum("lost"), F.sum("pos").cast("double") * F.sum("neg"))).alias("auc"))


def regression_metrics(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: n, rmse and r2 (NULL for a constant label)."""
    y, error = F.col(label), F.col(label) - F.col(prediction)
    return scored.agg(
        F.count("*").alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"),
        F.sum(error * error).alias("sse"), F.regr_sxx(y, y).alias("sst"),
    ).select("n", "rmse", (1.0 - F.try_divide(F.col("sse"), F.col("sst"))).alias("r2"))
