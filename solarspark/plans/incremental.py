"""Preprocessing of readings that land in batches.

A store holds the raw rows of a source without copies, by month and in buckets by plant and
time, and beside them a state: rows, values and sums of each measure per month, and of the
yield per month and plant. States of months add up to the column means and plant means that
preprocessing needs, so gaps are filled and features derived when the store is read, without a
pass over all rows to find means or copies. A batch is compared with, and the state renewed
for, the months that it touches; files of other months stay as they are.

Only the batch is shuffled, once: it is dealt to the buckets, where copies within it meet and
the rows held lie already. The weather joins in the same buckets. A source has buckets for
about a million rows each; when it has outgrown them it is laid out anew, in more.

Landing a batch again, whole or after a failure halfway, changes nothing: rows that are there
are left out, and the state of a month is renewed unless it tells as many rows as there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solarspark import fixed_values as fixed
from solarspark.functions.features import valid
from solarspark.functions.timeparse import with_datetime
from solarspark.operators.lookup import join_aggregate
from solarspark.operators.merge import drop_null_keys
from solarspark.plans import jobs
from solarspark.sources import layout
from solarspark.sources.readers import read_if_exists

GENERATION, WEATHER = "generation", "weather"
LEAST_BUCKETS = 2  # a single one counts as a layout of its own, which others do not meet without a shuffle
PER_PLANT = {GENERATION: ["DAILY_YIELD"], WEATHER: []}


def land_generation(raw: DataFrame, store: str) -> DataFrame:
    """Add inverter readings to the store; the rows that were new, by month: MONTH, rows."""
    return _land(drop_null_keys(raw, "DATE_TIME"), store, GENERATION, fixed.GENERATION_MEASURES)


def land_weather(raw: DataFrame, store: str) -> DataFrame:
    """Add plant sensor readings to the store; rows without a time have a month of their own."""
    return _land(raw, store, WEATHER, fixed.WEATHER_MEASURES)


def _in_months(months: list) -> Column:
    known = F.col("MONTH").isin([m for m in months if m is not None])
    return known | F.col("MONTH").isNull() if None in months else known


def _by_month(rows: DataFrame) -> dict:
    return {r["MONTH"]: r["rows"] for r in rows.groupBy("MONTH").agg(F.count("*").alias("rows")).collect()}


def _land(raw: DataFrame, store: str, source: str, measures) -> DataFrame:
    spark, path = raw.sparkSession, f"{store}/{source}"
    timed = with_datetime(raw).withColumn("MONTH", F.month("DATETIME"))
    arrived = _by_month(timed)
    months = list(arrived)
    # Sources that will be joined start with one number of buckets.
    other = layout.newest(spark, f"{store}/{WEATHER if source == GENERATION else GENERATION}")
    held = layout.newest(spark, path)
    before = {}
    if held is None:
        buckets = max(LEAST_BUCKETS, layout.buckets_for(sum(arrived.values())), other or 0)
    else:
        buckets = held
        before = _by_month(layout.open_by_month(spark, path, buckets, jobs.WEATHER_KEY))
        wanted = layout.buckets_for(sum(before.values()))
        if wanted > 2 * buckets:
            layout.add_buckets(spark, path, buckets, wanted, jobs.WEATHER_KEY)
            buckets = wanted
    rows = timed.repartition(buckets, *jobs.WEATHER_KEY).withColumn("__held", F.lit(False))
    if before:
        there = layout.open_by_month(spark, path, buckets, jobs.WEATHER_KEY).filter(_in_months(months))
        rows = rows.unionByName(there.withColumn("__held", F.lit(True)))
    new = rows.groupBy(*timed.columns).agg(F.max("__held").alias("__held")).filter("not __held").drop("__held")
    layout.add_by_month(new, path, buckets, jobs.WEATHER_KEY, fresh=held is None)

    landed = layout.open_by_month(spark, path, buckets, jobs.WEATHER_KEY).filter(_in_months(months))
    now = _by_month(landed)
    told = read_if_exists(lambda: spark.read.parquet(f"{path}/state"))
    told = {} if told is None else {r["MONTH"]: r["rows"] for r in told.select("MONTH", "rows").collect()}
    stale = [m for m in now if told.get(m) != now[m]]
    if stale:
        _renew(landed.filter(_in_months(stale)), path, source, measures)
    return spark.createDataFrame([(m, n - before.get(m, 0)) for m, n in now.items() if n > before.get(m, 0)],
                                 "MONTH int, rows bigint")


def _sums(rows: DataFrame, columns) -> list[Column]:
    return [F.count("*").alias("rows"), *[expression for c in columns for expression in (
        F.count(valid(rows, c)).alias(f"{c}_n"),
        F.coalesce(F.sum(valid(rows, c).cast("double")), F.lit(0.0)).alias(f"{c}_sum"))]]


def _renew(rows: DataFrame, path: str, source: str, measures) -> None:
    """Replace the state of the months of ``rows``; that of plants first, as the other one tells
    that both are there."""
    states = {"state": rows.groupBy("MONTH").agg(*_sums(rows, measures))}
    if PER_PLANT[source]:
        states = {"plants": rows.groupBy("MONTH", "PLANT_ID").agg(*_sums(rows, PER_PLANT[source])), **states}
    for name, state in states.items():
        (state.hint("rebalance", "MONTH").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("MONTH").parquet(f"{path}/{name}"))


def _mean(column: str) -> Column:
    return F.try_divide(F.sum(f"{column}_sum"), F.sum(f"{column}_n"))


def _filled(spark: SparkSession, path: str, measures) -> tuple[DataFrame, DataFrame]:
    """Rows with gaps filled by the means of the state, and the state."""
    buckets = layout.newest(spark, path)
    rows, state = layout.open_by_month(spark, path, buckets, jobs.WEATHER_KEY), spark.read.parquet(f"{path}/state")
    means = state.agg(F.struct(*[_mean(c).alias(c) for c in measures]).alias("means")).scalar()
    return rows.withColumns({
        c: F.coalesce(valid(rows, c), means.getField(c).cast(rows.schema[c].dataType), F.col(c))
        for c in measures}), state


def landed_generation(spark: SparkSession, store: str) -> DataFrame:
    """The same as ``jobs.clean_generation`` over all readings that have landed."""
    path = f"{store}/{GENERATION}"
    readings, state = _filled(spark, path, fixed.GENERATION_MEASURES)
    mean = state.agg(_mean("DAILY_YIELD")).scalar()
    # A filled gap adds the mean of the whole column to the mean of its plant.
    gaps = F.sum("rows") - F.sum("DAILY_YIELD_n")
    total = F.sum("DAILY_YIELD_sum") + F.when(gaps > 0, gaps * mean).otherwise(0.0)
    by_plant = spark.read.parquet(f"{path}/plants")
    plants = by_plant.groupBy("PLANT_ID").agg(F.try_divide(total, F.sum("rows")).alias("PLANT_MEAN"))
    return jobs.with_performance(join_aggregate(readings, plants, "PLANT_ID", keys_from=by_plant))


def landed_weather(spark: SparkSession, store: str) -> DataFrame:
    """The same as ``jobs.clean_weather`` over all sensor readings that have landed."""
    rows, _ = _filled(spark, f"{store}/{WEATHER}", fixed.WEATHER_MEASURES)
    return rows.select("DATETIME", "PLANT_ID", "SOURCE_KEY", *fixed.WEATHER_MEASURES)


def preprocess_landed(spark: SparkSession, store: str, irradiance: DataFrame, **options) -> DataFrame:
    """The analysis-ready table of everything that has landed; ``options`` as for ``jobs.preprocess``."""
    return jobs.combine(landed_generation(spark, store), landed_weather(spark, store), irradiance, **options)
