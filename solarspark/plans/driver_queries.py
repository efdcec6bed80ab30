"""Every operator run over the benchmark tables.

Line items stand in for inverter readings (supplier = plant, price = DC power,
discounted price = AC power, quantity = daily yield), orders for plant weather and
events for the hourly irradiance series. The tables hold no gaps and no copies, so
queries about those derive them with the same expression as their SQL twin.
Doubles that depend on summation order are rounded to six digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from solarspark.fixed_values import HOURLY_MEASURES, LOCATIONS
from solarspark.functions import features, solar, timeparse
from solarspark.operators import (
    audit,
    evaluate,
    filters,
    imbalance,
    impute,
    merge,
    models,
    profiles,
    quarantine,
    resample,
    sampling,
    split,
    stats,
)
from solarspark.operators.calendar import with_calendar_keys
from solarspark.plans import analyses, jobs
from solarspark.plans import incremental as incremental_plan
from solarspark.schemas import LOCATION, literal_rows
from solarspark.session import scratch_path, stage
from solarspark.sources import ingest, readers, writers

NAN = float("nan")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(value) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, 6)


def readings(spark, sf_dir) -> DataFrame:
    """Line items as inverter readings."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate",
        F.col("l_suppkey").alias("plant_id"),
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).otherwise(0.0).alias("dc_power"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("ac_power"),
        F.col("l_quantity").alias("daily_yield"))


def gappy_events(spark, sf_dir) -> DataFrame:
    """Events with NULL and NaN readings."""
    return table(spark, sf_dir, "events").withColumn(
        "value", F.when(F.col("event_id") % 7 == 0, None)
        .when(F.col("event_id") % 11 == 0, F.lit(NAN)).otherwise(F.col("value")))


def flagged(spark, sf_dir) -> DataFrame:
    """Readings with proxy, efficiency and flag."""
    li = table(spark, sf_dir, "lineitem")
    gen = li.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", F.col("l_suppkey").alias("plant_id"))
    gen = gen.withColumn("efficiency", features.efficiency(
        F.col("l_extendedprice") * (1 - F.col("l_discount")), F.col("l_extendedprice")))
    gen = merge.attach_group_mean(gen, "plant_id", "l_quantity", "plant_mean", keys_from=gen)
    gen = gen.withColumn("proxy", features.soiling_proxy(
        F.col("l_quantity"), F.col("plant_mean")))
    return gen.withColumn("cleaning_flag", features.cleaning_flag(
        F.col("proxy"), F.col("efficiency")))


def scored(spark, sf_dir) -> DataFrame:
    """Line items with a label (returned), a fixed score in [0, 1] and its prediction."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", (F.col("l_returnflag") == "R").cast("int").alias("y"),
        ((F.col("l_discount") * 10 + F.col("l_tax") * 10 + F.col("l_quantity") / 50) / 3)
        .alias("score")).withColumn("prediction", (F.col("score") >= 0.5).cast("double"))


# Sources, sets, joins.

def union_dedupe(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return merge.dedupe(merge.union_all([li, li]))


def union_missing(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return merge.union_all([ev.select("event_id", "ts", "value"),
                            ev.select("event_type", "event_id")], allow_missing=True)


def missing_partitions(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CITY"))
    landed = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("CITY"), F.year("o_orderdate").alias("YEAR"))
    return ingest.missing_partitions(
        ingest.expected_partitions(customers, 1995, 2001), landed)


def location_enrich(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").withColumnsRenamed(
        {"n_nationkey": "s_nationkey", "n_name": "NATION", "n_regionkey": "r_regionkey"})
    region = table(spark, sf_dir, "region").withColumnsRenamed({"r_name": "REGION"})
    placed = ingest.attach_location(table(spark, sf_dir, "supplier"), nation, "s_nationkey")
    return ingest.attach_location(placed, region, "r_regionkey").select(
        "s_suppkey", "s_name", "NATION", "REGION")


def weather_join(spark, sf_dir):
    weather = table(spark, sf_dir, "orders").groupBy(
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("DATETIME"),
        F.col("o_custkey").alias("PLANT_ID")).agg(
            F.first(F.lit("sensor")).alias("SOURCE_KEY"),
            F.avg("o_totalprice").alias("IRRADIATION"))
    gen = table(spark, sf_dir, "lineitem").select(
        F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("DATETIME"),
        F.col("l_suppkey").alias("PLANT_ID"), F.col("l_orderkey").alias("SOURCE_KEY"),
        "l_linenumber")
    return merge.attach_weather(gen, weather).withColumn("IRRADIATION", r6("IRRADIATION"))


def hourly_join(spark, sf_dir):
    ev = timeparse.to_local(table(spark, sf_dir, "events"), "ts")
    series = ev.filter(F.col("event_type") == "view").select(
        "ts", F.col("value").alias("GHI"), F.col("user_id").cast("double").alias("WIND_SPEED"))
    values = ["GHI", "WIND_SPEED"]
    return merge.attach_hourly(ev.select("event_id", "ts", "event_type"), series, "ts",
                               values=values).select(
        "event_id", "event_type", "MONTH", *[r6(v).alias(v) for v in values])


def group_mean(spark, sf_dir):
    gen = readings(spark, sf_dir).withColumn(
        "daily_yield", F.when(F.col("l_linenumber") == 2, F.lit(NAN)).otherwise(F.col("daily_yield")))
    return merge.attach_group_mean(gen, "plant_id", "daily_yield", "plant_mean").select(
        "l_orderkey", "l_partkey", "l_linenumber", "plant_id", r6("plant_mean").alias("plant_mean"))


def repeated_keys(spark, sf_dir):
    return merge.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def csv_scan(spark, sf_dir):
    """Readings written as CSV and read back with the declared schema."""
    path = scratch_path(spark)
    writers.write_csv(generation_source(spark, sf_dir), path)
    return readers.read_generation(spark, path).select(
        "DATE_TIME", "PLANT_ID", "SOURCE_KEY", "DC_POWER", "TOTAL_YIELD")


def malformed(spark, sf_dir):
    """Readings with planted bad numbers: what the scan sets apart, counts and keeps."""
    order = F.split("SOURCE_KEY", "-")[0].cast("bigint")
    raw = generation_source(spark, sf_dir).withColumns({
        "DC_POWER": F.when(order % 53 == 0, F.concat(F.coalesce("DC_POWER", F.lit(1.5)), F.lit(" kW")))
        .otherwise(F.col("DC_POWER").cast("string")),
        "PLANT_ID": F.when(order % 59 == 0, F.lit("seven")).otherwise(F.col("PLANT_ID").cast("string"))})
    path, apart = scratch_path(spark), scratch_path(spark)
    writers.write_csv(raw, path)
    read = readers.read_generation(spark, path, keep_malformed=True)
    writers.write_dataset(quarantine.malformed_rows(read), apart)
    counts = quarantine.malformed_counts(read)
    kept = impute.mean_fill(quarantine.well_formed(read), ["DC_POWER"])
    return merge.union_all([
        counts.agg(F.sum("total").alias("n"), F.sum("malformed").cast("double").alias("value"))
        .select(F.lit("read").alias("item"), "n", "value"),
        readers.read_dataset(spark, apart).agg(
            F.count("*").alias("n"), F.count_if(F.contains("line", F.lit(" kW"))).cast("double").alias("value"))
        .select(F.lit("set apart").alias("item"), "n", "value"),
        kept.agg(F.count("*").alias("n"), r6(F.avg("DC_POWER")).alias("value"))
        .select(F.lit("kept").alias("item"), "n", "value")])


def city_year_scan(spark, sf_dir):
    """Hourly series in files named by city and year, some with other columns in another order."""
    folder = scratch_path(spark)
    series = irradiance_source(spark, sf_dir).drop("SERIAL")
    odd = F.length("CITY") % 2 == 1
    writers.write_city_files(series.filter(~odd), folder)
    writers.write_city_files(series.filter(odd).select(
        "OPTIMAL_TILT", "ghi", "DATETIME", "temp_air", F.lit("x").alias("note"), "CITY", "YEAR"), folder)
    back = readers.read_irradiance(spark, folder, by_header=True)
    return back.groupBy("CITY", "YEAR").agg(
        F.count("*").alias("n"), F.count("dhi").alias("dhi"), F.count("note").alias("notes"),
        F.date_format(F.min("DATETIME"), "yyyy-MM-dd HH:mm:ss").alias("first"), F.max("ghi").alias("highest"), r6(F.avg("temp_air")).alias("temp"),
        r6(F.avg("OPTIMAL_TILT")).alias("tilt"))


def landing_zone(spark, sf_dir):
    """Events landed by type and year, read back and profiled per partition."""
    path = scratch_path(spark)
    series = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("CITY"), F.year("ts").alias("YEAR"), "event_id", "value")
    writers.land_irradiance(series, path)
    return readers.read_dataset(spark, path).groupBy("CITY", "YEAR").agg(
        F.count("*").alias("n"), F.min("value").alias("lowest"), F.max("value").alias("highest"))


# Audits.

def null_audit(spark, sf_dir):
    raw = gappy_events(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 10 > 0, F.col("o_totalprice")))
    clean = impute.mean_fill(raw, ["value"]).withColumn(
        "props", F.when(F.col("event_id") % 5 > 0, F.col("props")))
    return audit.null_compare(
        {"events": (raw, ["event_id", "value", "props"]),
         "orders": (orders, ["o_orderkey", "o_totalprice", "absent"])}, clean)


def null_audit_plain(spark, sf_dir):
    return audit.null_counts_long(gappy_events(spark, sf_dir), ["value", "user_id"], nan=False)


def dup_audit(spark, sf_dir):
    sources = {
        "lineitem": table(spark, sf_dir, "lineitem").select(
            "l_suppkey", "l_quantity", "l_returnflag"),
        "orders": table(spark, sf_dir, "orders"),
        "events": table(spark, sf_dir, "events").select("user_id", "event_type"),
    }
    return merge.union_all([
        audit.duplicates(df).select(F.lit(n).alias("source"), "total", "distinct_rows",
                                    "duplicates", r6("percent").alias("percent"))
        for n, df in sources.items()])


def describe(spark, sf_dir):
    parts = [
        audit.describe(table(spark, sf_dir, "lineitem"),
                       ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
        audit.describe(gappy_events(spark, sf_dir), ["value"])]
    return merge.union_all(parts).select(
        "column", "count", r6("mean").alias("mean"), r6("stddev").alias("stddev"), "min", "max")


def volume(spark, sf_dir):
    names = ["lineitem", "orders", "events"]
    return audit.volume({n: table(spark, sf_dir, n) for n in names})


def flag_distribution(spark, sf_dir):
    return audit.class_distribution(flagged(spark, sf_dir), "cleaning_flag")


# Columns.

def mean_fill(spark, sf_dir):
    filled = impute.mean_fill(gappy_events(spark, sf_dir), ["value"])
    return filled.select("event_id", r6("value").alias("value"))


def efficiency(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "l_orderkey", "l_partkey", "l_linenumber",
        features.efficiency(F.col("ac_power"), F.col("dc_power")).cast("double")
        .alias("efficiency"))


def soiling_proxy(spark, sf_dir):
    return flagged(spark, sf_dir).select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.col("proxy").cast("double").alias("proxy"), "cleaning_flag")


def parse_two_formats(spark, sf_dir):
    text = (F.when(F.col("event_id") % 13 == 0, F.lit("not a time"))
            .when(F.col("event_id") % 2 == 0, F.date_format("ts", "dd-MM-yyyy HH:mm"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    parsed = table(spark, sf_dir, "events").select("event_id", text.alias("DATE_TIME"))
    return parsed.select("event_id", F.date_format(
        timeparse.parse_first(F.col("DATE_TIME")), "yyyy-MM-dd HH:mm:ss").alias("datetime"))


def unparseable(spark, sf_dir):
    text = F.when(F.col("event_id") % 13 == 0, F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return timeparse.unparseable_count(
        table(spark, sf_dir, "events").select(text.alias("DATE_TIME")))


def to_local(spark, sf_dir):
    local = timeparse.to_local(table(spark, sf_dir, "events"), "ts")
    return with_calendar_keys(local, "ts").select("event_id", "ts", "MONTH", "DAY", "HOUR")


def clip(spark, sf_dir):
    return gappy_events(spark, sf_dir).select(
        "event_id", features.clip_col(F.col("value"), 10, 90).alias("clipped"))


def max_scale(spark, sf_dir):
    scaled = features.max_scale(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"])
    return scaled.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        r6("l_extendedprice_SCALED").alias("price"), r6("l_quantity_SCALED").alias("quantity"))


def cyclic(spark, sf_dir):
    return features.with_time_features(table(spark, sf_dir, "events"), "ts").select(
        "event_id", "HOUR", "MONTH_NUM",
        *[r6(c).alias(c) for c in ("HOUR_SIN", "HOUR_COS", "MONTH_SIN", "MONTH_COS")])


def ratio_diff(spark, sf_dir):
    gen = readings(spark, sf_dir).select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("ac_power").alias("DC_POWER"),
        F.col("dc_power").alias("GHI"), F.col("dc_power").alias("MODULE_TEMPERATURE"),
        F.col("ac_power").alias("AMBIENT_TEMPERATURE"))
    return features.with_power_features(gen).select(
        "l_orderkey", "l_partkey", "l_linenumber", r6("DC_PER_GHI").alias("DC_PER_GHI"),
        r6("TEMP_DIFF").alias("TEMP_DIFF"))


def daylight(spark, sf_dir):
    bright = filters.daylight(gappy_events(spark, sf_dir), "value")
    return filters.within(bright, "value", 0, 400).select("event_id", "value")


def solar_position(spark, sf_dir):
    cities = literal_rows(spark, [(k, *place) for k, place in enumerate(LOCATIONS)],
                          T.StructType([T.StructField("k", T.IntegerType()), *LOCATION]))
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", (F.col("user_id") % 5).cast("int").alias("k"))
    sun = solar.with_solar_position(
        ingest.attach_location(ev, cities, "k"), "ts", "LATITUDE", "LONGITUDE")
    return sun.select(
        "event_id", "CITY", r6("SOLAR_ZENITH_ANGLE").alias("zenith"),
        r6("SOLAR_AZIMUTH").alias("azimuth"),
        r6(solar.optimal_tilt(F.col("SOLAR_ZENITH_ANGLE"))).alias("tilt"))


# Profiles and statistics.

def hourly_profile(spark, sf_dir):
    local = timeparse.to_local(table(spark, sf_dir, "events"), "ts")
    return resample.hourly_profile(local, "ts", ["value"]).withColumn("value", r6("value"))


def monthly_profile(spark, sf_dir):
    ev = gappy_events(spark, sf_dir).select("ts", "value", F.col("user_id").cast("double"))
    out = profiles.monthly(ev, "ts", ["value", "user_id"])
    return out.select("month", "label", r6("value").alias("value"), r6("user_id").alias("users"))


def shipped(spark, sf_dir) -> DataFrame:
    """Line items with the nation of their supplier."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("CITY"))
    return (table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), "l_shipdate", "l_extendedprice")
        .join(supplier, "s_suppkey").join(nation, "s_nationkey"))


def city_median(spark, sf_dir):
    out = profiles.city_ranking(shipped(spark, sf_dir), "l_extendedprice")
    return out.withColumn("median", r6("median"))


def city_month_pivot(spark, sf_dir):
    out = profiles.city_month(shipped(spark, sf_dir), "l_shipdate", "l_extendedprice")
    return out.select("CITY", *[r6(f"m{m}").alias(f"m{m}") for m in range(1, 13)])


def corr_input(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("a"), F.col("l_extendedprice").alias("b"),
        F.when(F.col("l_linenumber") == 3, None)
        .when(F.col("l_linenumber") == 4, F.lit(NAN))
        .otherwise(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("c"),
        F.lit(1.5).alias("d"))


def corr_matrix(spark, sf_dir):
    return stats.corr_matrix(corr_input(spark, sf_dir), ["a", "b", "c", "d"]).select(
        "col_i", "col_j", "pairs", r6("r").alias("r"))


def corr_lower(spark, sf_dir):
    lower = stats.lower_triangle(
        stats.corr_matrix(corr_input(spark, sf_dir), ["a", "b", "c"], min_pairs=2))
    return lower.select("col_i", "col_j", r6("r").alias("r"))


def histogram(spark, sf_dir):
    out = stats.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return out.select("bin", r6("low").alias("low"), r6("high").alias("high"), "count")


def unclassed_events(spark, sf_dir) -> DataFrame:
    """Events with gaps in value, some without a type."""
    return gappy_events(spark, sf_dir).withColumn(
        "event_type", F.when(F.col("event_id") % 6 > 0, F.col("event_type")))


def density_by_class(spark, sf_dir):
    out = stats.density_by_class(unclassed_events(spark, sf_dir), "value", "event_type")
    return out.select("event_type", "bin", *[r6(c).alias(c) for c in ("low", "high", "density")])


def center_zero_share(spark, sf_dir):
    out = stats.center(table(spark, sf_dir, "lineitem"), "l_discount")
    return out.select("n", "zeros", *[r6(c).alias(c) for c in ("mean", "median", "zero_share")])


def _rounded_box(box: DataFrame, *keys: str) -> DataFrame:
    return box.select(*keys, "n", "outliers", *[r6(c).alias(c) for c in (
        "q1", "median", "q3", "whisker_low", "whisker_high")])


def box_summary(spark, sf_dir):
    box = stats.box_summary(unclassed_events(spark, sf_dir), "value", ["event_type"])
    return _rounded_box(box, "event_type")


def box_summary_all(spark, sf_dir):
    return _rounded_box(stats.box_summary(table(spark, sf_dir, "lineitem"), "l_extendedprice"))


def linear_fit(spark, sf_dir):
    fit = stats.linear_fit(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return fit.select("n", "x_min", "x_max", r6("slope").alias("slope"),
                      r6("intercept").alias("intercept"))


def fitted_line(spark, sf_dir):
    fit = stats.linear_fit(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return stats.fitted_line(fit).select(
        "point", r6("x").alias("x"), F.round("y", 3).alias("y"))


def vif(spark, sf_dir):
    gen = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("dc"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("ac"),
        (F.col("l_extendedprice") * 2 + 1).alias("twin"), F.lit(3.0).alias("same"))
    return stats.vif(gen, ["dc", "ac", "twin", "same"]).withColumn("vif", F.round("vif", 4))


# Samples, splits, scores.

def topn_chrono(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return sampling.first_in_time(ev, "ts", ["event_id"])


def hash_sample(spark, sf_dir):
    return sampling.hash_sample(table(spark, sf_dir, "events"), "event_id", 50).select(
        "event_id", "event_type")


def temporal_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderdate", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    train, test = split.by_month(orders, "o_orderdate")
    return merge.union_all([
        imbalance.class_ratio(side, "y").select(
            F.lit(name).alias("side"), "n", "positives", "negatives",
            r6("positive_rate").alias("positive_rate"), r6("ratio").alias("ratio"))
        for name, side in (("train", train), ("test", test))])


def class_weight(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return imbalance.with_class_weight(li, "y").withColumn("sample_weight", r6("sample_weight"))


def confusion(spark, sf_dir):
    cells = evaluate.confusion(scored(spark, sf_dir), "y")
    return cells.select("tn", "fp", "fn", "tp", r6("precision").alias("precision"),
                        r6("recall").alias("recall"))


def class_metrics(spark, sf_dir):
    out = evaluate.classification_metrics(evaluate.confusion(scored(spark, sf_dir), "y"))
    return out.select(*[r6(c).alias(c) for c in out.columns])


def threshold_curve(spark, sf_dir):
    out = evaluate.threshold_curve(scored(spark, sf_dir), "y", "score")
    return out.select(*[r6(c).alias(c) for c in out.columns])


def best_threshold(spark, sf_dir):
    curve = evaluate.threshold_curve(scored(spark, sf_dir), "y", "score")
    out = evaluate.best_threshold(curve)
    return out.select(*[r6(c).alias(c) for c in out.columns])


def auc(spark, sf_dir):
    return evaluate.auc(scored(spark, sf_dir), "y", "score").select(r6("auc").alias("auc"))


def reg_metrics(spark, sf_dir):
    fixed_rule = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 2000.0).alias("prediction"))
    out = evaluate.regression_metrics(fixed_rule, "l_extendedprice")
    return out.select("n", r6("rmse").alias("rmse"), r6("r2").alias("r2"))


def search_scores(spark, sf_dir) -> DataFrame:
    """Mean price per quantity band and line number, laid out like a table of grid scores."""
    return table(spark, sf_dir, "lineitem").groupBy(
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("maxDepth"),
        F.col("l_linenumber").alias("numTrees")).agg(F.avg("l_discount").alias("AUC"))


def grid_table(spark, sf_dir):
    out = models.grid_pivot(search_scores(spark, sf_dir), "maxDepth", "numTrees", [1, 2, 3, 4])
    return out.select("maxDepth", *[r6(F.col(f"`{t}`")).alias(f"t{t}") for t in (1, 2, 3, 4)])


def grid_best(spark, sf_dir):
    out = models.grid_best_by(search_scores(spark, sf_dir), ["maxDepth"])
    return out.withColumn("AUC", r6("AUC"))


def grid_slice(spark, sf_dir):
    out = models.grid_slice(search_scores(spark, sf_dir), "maxDepth", 2, "numTrees")
    return out.withColumn("AUC", r6("AUC"))


# The jobs as a whole.

def generation_source(spark, sf_dir) -> DataFrame:
    """Line items as raw inverter readings: gaps, two timestamp formats, missing and
    unreadable times, and rows that come twice."""
    li = table(spark, sf_dir, "lineitem")
    li = li.unionAll(li.filter("l_linenumber = 1 and l_orderkey % 40 = 0"))
    return li.select(
        F.when(F.col("l_orderkey") % 97 == 0, None)
        .when(F.col("l_orderkey") % 89 == 0, F.lit("not a time"))
        .when(F.col("l_linenumber") % 2 == 0, F.date_format("l_shipdate", "dd-MM-yyyy HH:mm"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("DATE_TIME"),
        F.col("l_suppkey").cast("int").alias("PLANT_ID"),
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_linenumber").alias("SOURCE_KEY"),
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).alias("DC_POWER"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("AC_POWER"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity")).otherwise(F.lit(NAN))
        .alias("DAILY_YIELD"),
        F.col("l_quantity").alias("TOTAL_YIELD"))


def weather_source(spark, sf_dir) -> DataFrame:
    """Orders as raw plant weather, one row per customer and date."""
    weather = table(spark, sf_dir, "orders").groupBy("o_orderdate", "o_custkey").agg(
        F.avg("o_totalprice").alias("IRRADIATION"), F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"))
    return weather.select(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("DATE_TIME"),
        F.col("o_custkey").cast("int").alias("PLANT_ID"), F.lit("sensor").alias("SOURCE_KEY"),
        F.col("lowest").alias("AMBIENT_TEMPERATURE"),
        F.when(F.col("o_custkey") % 3 > 0, F.col("highest")).alias("MODULE_TEMPERATURE"),
        "IRRADIATION")


def irradiance_source(spark, sf_dir) -> DataFrame:
    """Events as the raw hourly series, the event type as its city."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("DATETIME"), value.alias("ghi"), (value / 2).alias("dhi"),
        (value * 2).alias("dni"),
        F.when(F.col("event_id") % 9 > 0, value + 1).alias("temp_air"),
        F.col("user_id").cast("double").alias("wind_speed"),
        F.col("event_type").alias("CITY"), F.col("event_id").alias("SERIAL"),
        F.lit(14.5).alias("LATITUDE"),
        F.lit(78.25).alias("LONGITUDE"), F.year("ts").alias("YEAR"),
        value.alias("SOLAR_ZENITH_ANGLE"), value.alias("SOLAR_AZIMUTH"),
        (F.lit(90.0) - value).alias("OPTIMAL_TILT"))


def sources(spark, sf_dir) -> dict[str, DataFrame]:
    return {"generation": generation_source(spark, sf_dir),
            "weather": weather_source(spark, sf_dir),
            "irradiance": irradiance_source(spark, sf_dir)}


def merged(spark, sf_dir) -> DataFrame:
    return jobs.preprocess(**sources(spark, sf_dir), city="view", year=2024)


def _comparable(out: DataFrame) -> DataFrame:
    # Hourly means of cents fall exactly between six-digit neighbours; nine digits do not.
    rounded = {f.name: F.round(F.col(f.name).cast("double"),
                               9 if f.name in HOURLY_MEASURES else 6)
               for f in out.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return out.withColumns({**rounded, "DATETIME": F.date_format(
        "DATETIME", "yyyy-MM-dd HH:mm:ss")})


def preprocess(spark, sf_dir):
    return _comparable(merged(spark, sf_dir))


def incremental(spark, sf_dir):
    """Two batches that overlap, landed one after the other, and the second one twice."""
    raw, store = sources(spark, sf_dir), scratch_path(spark)
    # Means differ in their last bits whenever they are formed anew; rows that come again must be the same.
    raw["weather"] = stage(raw["weather"])
    order = F.split("SOURCE_KEY", "-")[0].cast("bigint")
    for lot in (order % 3 < 2, order % 3 > 0, order % 3 > 0):
        incremental_plan.land_generation(raw["generation"].filter(lot), store)
    for lot in (F.col("PLANT_ID") % 2 == 0, F.col("PLANT_ID") % 3 > 0, F.lit(True)):
        incremental_plan.land_weather(raw["weather"].filter(lot), store)
    return _comparable(incremental_plan.preprocess_landed(
        spark, store, raw["irradiance"], city="view", year=2024))


def laid_out(spark, sf_dir):
    """The same from tables laid out by plant and time."""
    raw, folder = sources(spark, sf_dir), scratch_path(spark)
    buckets = jobs.lay_out(raw["generation"], raw["weather"], folder)
    return _comparable(jobs.preprocess_laid_out(
        spark, folder, buckets, raw["irradiance"], city="view", year=2024))


def job_audit(spark, sf_dir):
    tables = jobs.audit_sources(**sources(spark, sf_dir))
    return tables["nulls"].join(tables["duplicates"], "source").select(
        "source", "column", "missing", "total", "duplicates")


def job_describe(spark, sf_dir):
    out = jobs.audit_sources(**sources(spark, sf_dir))["describe"]
    return out.withColumns({c: r6(c) for c in ("mean", "stddev", "min", "max")})


def job_volume(spark, sf_dir):
    return jobs.audit_sources(**sources(spark, sf_dir))["volume"]


def job_validation(spark, sf_dir):
    """Remaining NULLs and label distribution of the job's written output."""
    path = scratch_path(spark)
    tables = jobs.run_preprocess(**sources(spark, sf_dir), out=path, city="view", year=2024)
    nulls = tables["nulls"].select(F.col("column").alias("item"), F.col("missing").alias("n"))
    flags = tables["flags"].select(
        F.concat(F.lit("flag "), F.col("CLEANING_FLAG")).alias("item"), F.col("count").alias("n"))
    return merge.union_all([nulls, flags])


def merged_correlation(spark, sf_dir):
    clean = merged(spark, sf_dir).select("DC_POWER", "AC_POWER", "GHI", "EFFICIENCY",
                                         "SOILING_PROXY")
    return analyses.correlation(None, stage(clean))["lower"].select(
        "col_i", "col_j", "pairs", r6("r").alias("r"))


def zenith_fit(spark, sf_dir):
    """Line of tilt over zenith through the sample of bright hours."""
    tables = analyses.zenith_fit(irradiance_source(spark, sf_dir), ["SERIAL"])
    return tables["fit"].select("n", r6("slope").alias("slope"), r6("intercept").alias("intercept"))


# Models. Trees of depth 1 without bagging, over features with few values, have a split that
# SQL can find by trying all; the estimators, chains, searches and tables are the jobs' own.

STUMP_FEATURES = ["l_discount", "l_tax", "l_linenumber"]
OTHER_FEATURES = ["l_tax", "l_linenumber"]
STUMP = {"numTrees": 1, "maxDepth": 1, "bootstrap": False, "subsamplingRate": 1.0,
         "featureSubsetStrategy": "all"}


def _month_split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    li = flagged(spark, sf_dir).withColumn("fold", (F.col("l_orderkey") % 2).cast("int"))
    return split.by_month(li, "l_shipdate")


def _classifier_search(spark, sf_dir):
    train, test = _month_split(spark, sf_dir)
    weighted = imbalance.with_class_weight(train, "cleaning_flag")
    model = models.rf_classifier("cleaning_flag", **STUMP)
    return models.tune(weighted, STUMP_FEATURES, model, {"maxDepth": [0, 1]},
                       models.auc_evaluator("cleaning_flag"), folds=2, fold_col="fold"), test


def rf_importance(spark, sf_dir):
    search, _ = _classifier_search(spark, sf_dir)
    return models.importances(search.bestModel, STUMP_FEATURES, spark)


def best_params(spark, sf_dir):
    search, _ = _classifier_search(spark, sf_dir)
    return models.params_table(search, spark)


def rf_scores(spark, sf_dir):
    """Confusion cells and area under the curve of the best forest on the test month."""
    search, test = _classifier_search(spark, sf_dir)
    scored_rows = evaluate.positive_score(models.score(search.bestModel, test))
    cells = evaluate.confusion(scored_rows, "cleaning_flag").select(F.struct("*").alias("c")).scalar()
    return evaluate.auc(scored_rows, "cleaning_flag", "score").select(
        r6("auc").alias("auc"), *[cells.getField(c).alias(c) for c in ("tn", "fp", "fn", "tp")])


def gbt_importance(spark, sf_dir):
    train, _ = _month_split(spark, sf_dir)
    model = models.gbt_classifier("cleaning_flag", maxDepth=1, maxIter=1)
    fitted = models.fit(train, STUMP_FEATURES, model)
    return models.top_features(models.importances(fitted, STUMP_FEATURES, spark))


def reg_importance(spark, sf_dir):
    train, _ = _month_split(spark, sf_dir)
    fitted = models.fit(train, STUMP_FEATURES, models.rf_regressor("l_extendedprice", **STUMP))
    return models.importances(fitted, STUMP_FEATURES, spark)


def search_grid(spark, sf_dir):
    train, _ = _month_split(spark, sf_dir)
    search = models.tune(train, STUMP_FEATURES, models.rf_regressor("l_extendedprice", **STUMP),
                         {"maxDepth": [0, 1]},
                         models.regression_evaluator("rmse", "l_extendedprice"), folds=2,
                         fold_col="fold")
    return models.grid_table(search, spark, "rmse").select("maxDepth", r6("rmse").alias("rmse"))


def _rivals(spark, sf_dir) -> DataFrame:
    train, test = _month_split(spark, sf_dir)
    rivals = {"RF Regressor": (OTHER_FEATURES, models.rf_regressor("l_extendedprice", **STUMP)),
              "GBT Regressor": (STUMP_FEATURES,
                                models.gbt_regressor("l_extendedprice", maxDepth=1, maxIter=1))}
    rows = []
    for name, (columns, model) in rivals.items():
        fitted = models.fit(train, columns, model)
        found = evaluate.regression_metrics(
            models.score(fitted, test), "l_extendedprice").first()
        rows.append({"algorithm": name, "rmse": found["rmse"], "r2": found["r2"]})
    return models.comparison(spark, rows)


def champion(spark, sf_dir):
    best = models.champion(_rivals(spark, sf_dir), "r2", "GBT Regressor")
    return best.select("algorithm", r6("rmse").alias("rmse"), r6("r2").alias("r2"))


def best_scores(spark, sf_dir):
    out = models.best_scores(_rivals(spark, sf_dir))
    return out.select(*[r6(c).alias(c) for c in out.columns])


def split_report(spark, sf_dir):
    """Class balance and complete rows of both months."""
    rows = flagged(spark, sf_dir).withColumn(
        "l_tax", F.when(F.col("l_linenumber") == 3, None)
        .when(F.col("l_linenumber") == 4, F.lit(NAN)).otherwise(F.col("l_tax")))
    train, test = split.by_month(rows, "l_shipdate")
    out = jobs.split_report(train, test, "cleaning_flag", STUMP_FEATURES)
    return out.withColumns({c: r6(c) for c in ("positive_rate", "ratio")})


def model_source(spark, sf_dir) -> DataFrame:
    """Line items as the preprocessed table; model features have few values each."""
    li, tenths = flagged(spark, sf_dir), F.round(F.col("l_discount") * 100).cast("double")
    return li.select(
        F.month("l_shipdate").alias("MONTH"), F.col("l_shipdate").alias("DATETIME"),
        F.col("plant_id").alias("PLANT_ID"), F.concat_ws("-", "l_orderkey", "l_partkey", "l_linenumber").alias("SOURCE_KEY"),
        F.col("l_extendedprice").alias("DC_POWER"), F.col("efficiency").alias("EFFICIENCY"),
        F.col("cleaning_flag").alias("CLEANING_FLAG"), (20.0 + F.col("l_orderkey") % 7).alias("GHI"),
        F.col("l_linenumber").cast("double").alias("DNI"), F.round(F.col("l_tax") * 100).alias("DHI"),
        (F.col("l_partkey") % 5).cast("double").alias("AIR_TEMPERATURE"), tenths.alias("MODULE_TEMPERATURE"),
        (F.col("l_partkey") % 3).cast("double").alias("AMBIENT_TEMPERATURE"),
        F.ceil(F.col("l_quantity") / 5).cast("double").alias("IRRADIATION"),
        (F.col("l_orderkey") % 3).cast("double").alias("WIND_SPEED"),
        (F.col("l_orderkey") % 4).cast("double").alias("SOLAR_ZENITH_ANGLE"))


STUMP_GRID = {name: [value] for name, value in STUMP.items()}
BOOST_GRID = {"maxIter": [1], "maxDepth": [1]}


def baseline_job(spark, sf_dir):
    """The baseline job with a forest of one stump: importances and scores of the test month."""
    tables = jobs.train_baseline(model_source(spark, sf_dir), STUMP_GRID, folds=2).tables
    scores = tables["metrics"].select("auc").crossJoin(
        tables["confusion"].select("tn", "fp", "fn", "tp")).unpivot([], None, "item", "value")
    sides = tables["split"].select(F.concat(F.lit("trainable "), "side").alias("item"), F.col("trainable").cast("double").alias("value"))
    return merge.union_all([
        tables["importances"].select(F.col("Feature").alias("item"), F.col("Importance").alias("value")),
        scores, sides]).withColumn("value", r6("value"))


def tuned_job(spark, sf_dir):
    """The tuning job with stumps: scores of the rivals on the test month and the winners."""
    tables = jobs.tune_models(model_source(spark, sf_dir), {
        "rf": STUMP_GRID, "gbt": BOOST_GRID, "rf_regressor": STUMP_GRID, "gbt_regressor": BOOST_GRID}, folds=2).tables
    return merge.union_all([
        tables["classifiers"].select("algorithm", F.lit("auc").alias("item"), F.col("test_auc").alias("value")),
        tables["classifiers"].select("algorithm", F.lit("f1").alias("item"), F.col("test_f1").alias("value")),
        tables["regressors"].select("algorithm", F.lit("rmse").alias("item"), F.col("rmse").alias("value")),
        tables["regressors"].select("algorithm", F.lit("r2").alias("item"), F.col("r2").alias("value")),
        tables["best_regressor"].select("algorithm", F.lit("winner").alias("item"), F.lit(1.0).alias("value")),
        models.top_features(tables["clf_importances"], 1).select(
            F.col("Feature").alias("algorithm"), F.lit("importance").alias("item"), F.col("Importance").alias("value")),
    ]).withColumn("value", r6("value"))


# Analyses of the hourly series.

def null_keys(spark, sf_dir):
    return merge.drop_null_keys(gappy_events(spark, sf_dir), "value", "user_id").groupBy(
        "event_type").agg(F.count("*").alias("n"))


def analysis_missing(spark, sf_dir):
    clean = jobs.clean_generation(generation_source(spark, sf_dir)).select(
        "PLANT_ID", "SOURCE_KEY", "DC_POWER", F.when(F.col("DC_POWER") > 1000, F.col("AC_POWER")).alias("AC_POWER"))
    return analyses.missing_values(generation_source(spark, sf_dir), weather_source(spark, sf_dir),
                                   irradiance_source(spark, sf_dir), clean)["missing"]


def analysis_dc_power(spark, sf_dir):
    """Centres and the bins around the readings before and after cleaning."""
    tables = analyses.dc_power(generation_source(spark, sf_dir),
                               table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("DC_POWER")))
    def phase(name):
        filled = tables[f"{name}_histogram"].agg(
            F.count("*").alias("bins"), F.sum("count").alias("binned"), F.max("count").alias("fullest"))
        filled = filled.select(F.struct("*").alias("h")).scalar()
        return tables[f"{name}_center"].select(
            F.lit(name).alias("phase"), "n", "zeros", *[r6(c).alias(c) for c in ("mean", "median", "zero_share")],
            *[filled.getField(c).alias(c) for c in ("bins", "binned", "fullest")])

    return merge.union_all([phase("before"), phase("after")])


def analysis_boxes(spark, sf_dir):
    clean = flagged(spark, sf_dir).select(
        F.col("efficiency").alias("EFFICIENCY"), F.col("proxy").alias("SOILING_PROXY"),
        (F.col("l_quantity") * 2).alias("OPTIMAL_TILT"))
    tables = analyses.boxes(generation_source(spark, sf_dir), irradiance_source(spark, sf_dir), clean)
    return merge.union_all([_rounded_box(tables[p], "variable").select(F.lit(p).alias("phase"), "*")
                            for p in ("before", "after")])


def analysis_cities(spark, sf_dir):
    tables = analyses.cities(irradiance_source(spark, sf_dir))
    boxes = _rounded_box(tables["boxes"], "CITY").drop("median", "n")
    return tables["ranking"].join(boxes, "CITY").withColumn("median", r6("median"))


def analysis_monthly(spark, sf_dir):
    out = analyses.monthly_tilt(irradiance_source(spark, sf_dir))["monthly"]
    return out.select("month", "label", r6("OPTIMAL_TILT").alias("tilt"), r6("ghi").alias("ghi"))


def analysis_irradiance(spark, sf_dir):
    tables = analyses.irradiance_levels(irradiance_source(spark, sf_dir))
    return merge.union_all([
        tables[f"{name}_center"].select(F.lit(name).alias("phase"), "n", "zeros",
                                        *[r6(c).alias(c) for c in ("mean", "median", "zero_share")])
        for name in ("before", "after")])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f"dq_{f.__name__}": f for f in (
        union_dedupe, union_missing, missing_partitions, location_enrich, weather_join,
        hourly_join, group_mean, repeated_keys, null_audit, null_audit_plain, dup_audit,
        describe, volume, flag_distribution, mean_fill, efficiency, soiling_proxy,
        parse_two_formats, unparseable, to_local, clip, max_scale, cyclic, ratio_diff, daylight,
        solar_position, hourly_profile, monthly_profile, city_median, city_month_pivot,
        corr_matrix, corr_lower, histogram, density_by_class, center_zero_share, box_summary,
        box_summary_all, linear_fit, fitted_line, vif, topn_chrono, hash_sample,
        temporal_split, class_weight, confusion, class_metrics, threshold_curve,
        best_threshold, auc, reg_metrics, grid_table, grid_best, grid_slice, csv_scan,
        landing_zone, preprocess, job_audit, job_validation, merged_correlation, zenith_fit,
        rf_importance, gbt_importance, reg_importance, search_grid, champion, rf_scores,
        best_params, best_scores, split_report, null_keys, analysis_cities, analysis_monthly,
        analysis_irradiance, malformed, city_year_scan, analysis_missing, analysis_dc_power,
        analysis_boxes, baseline_job, tuned_job, incremental, job_describe,
        job_volume, laid_out)
}
