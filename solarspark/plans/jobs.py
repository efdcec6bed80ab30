"""The batch jobs: audit, preprocessing, validation, baseline model, tuned models."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solarspark import fixed_values as fixed
from solarspark.functions.features import (
    cleaning_flag,
    clip_col,
    efficiency,
    soiling_proxy,
    with_power_features,
    with_time_features,
)
from solarspark.functions.timeparse import to_local, unparseable_count, with_datetime
from solarspark.operators import audit, evaluate, imbalance, models, split
from solarspark.operators.filters import daylight
from solarspark.operators.impute import mean_fill
from solarspark.operators.merge import (
    attach_group_mean,
    attach_hourly,
    attach_weather,
    dedupe,
    drop_null_keys,
    union_all,
    with_unique_key,
)
from solarspark.operators.quarantine import holds_malformed, malformed_counts, malformed_rows, well_formed
from solarspark.operators.sampling import first_in_time
from solarspark.operators.stats import density_by_class
from solarspark.session import materialize
from solarspark.sources.layout import buckets_for, lay_out_together, open_by_key
from solarspark.sources.writers import write_csv, write_dataset

WEATHER_KEY = ("PLANT_ID", "DATETIME")


# Audit of the raw sources.

AUDIT_SCHEMAS = {
    "nulls": "source string, column string, missing bigint",
    "duplicates": "source string, total bigint, distinct_rows bigint, duplicates bigint, percent double",
    "describe": "source string, column string, count bigint, mean double, stddev double, min double, max double",
    "volume": "source string, rows bigint, requirement_met boolean",
}


def audit_sources(generation: DataFrame, weather: DataFrame,
                  irradiance: DataFrame) -> dict[str, DataFrame]:
    """Gaps, duplicates, statistics and volume of the three raw tables, each as one table.

    Every source is scanned once and gives one wide row; the tables are made of these. Of sources read with their malformed rows, these are counted per file and left out of the
    rest.
    """
    read = {"generation": generation, "weather": weather, "irradiance": irradiance}
    described = {
        "generation": ["DC_POWER", "AC_POWER", "DAILY_YIELD"],
        "weather": ["IRRADIATION"],
        "irradiance": fixed.IRRADIANCE_MEASURES,
    }
    found: dict[str, list[tuple]] = {}
    for name, df in read.items():
        df = well_formed(df)
        row = audit.profile(df, described[name]).first()
        for table, rows in audit.profile_tables(row, df.columns, described[name]).items():
            found.setdefault(table, []).extend((name, *r) for r in rows)
    total = sum(rows for _, rows in found["volume"])
    found["volume"] = [(name, rows, None) for name, rows in found["volume"]] + [
        ("TOTAL", total, total >= fixed.MIN_TOTAL_ROWS)]
    spark = generation.sparkSession
    return {**{table: spark.createDataFrame(rows, AUDIT_SCHEMAS[table]) for table, rows in found.items()},
            **_malformed_report(read)}


def _malformed_report(read: dict[str, DataFrame]) -> dict[str, DataFrame]:
    counts = [malformed_counts(df).select(F.lit(n).alias("source"), "*")
              for n, df in read.items() if holds_malformed(df)]
    return {"malformed": union_all(counts)} if counts else {}


# Preprocessing.

def clean_generation(raw: DataFrame, parts: int | None = None) -> DataFrame:
    """Inverter readings with parsed time and performance features.

    Rows are dealt by the key that joins the weather before copies are dropped: copies share
    it, so one shuffle serves both, and with ``parts`` also a layout in so many buckets.
    """
    timed = with_datetime(drop_null_keys(raw, "DATE_TIME"))
    dealt = timed.repartition(parts, *WEATHER_KEY) if parts else timed.repartition(*WEATHER_KEY)
    filled = mean_fill(dedupe(dealt), fixed.GENERATION_MEASURES)
    timed = filled.withColumn("MONTH", F.month("DATETIME"))
    return with_performance(attach_group_mean(timed, "PLANT_ID", "DAILY_YIELD", "PLANT_MEAN", keys_from=raw))


def with_performance(readings: DataFrame) -> DataFrame:
    """Efficiency, soiling proxy and cleaning flag of filled readings that know their PLANT_MEAN."""
    featured = readings.withColumns({
        "EFFICIENCY": efficiency(F.col("AC_POWER"), F.col("DC_POWER")),
        "SOILING_PROXY": soiling_proxy(F.col("DAILY_YIELD"), F.col("PLANT_MEAN"))})
    return featured.withColumn(
        "CLEANING_FLAG", cleaning_flag(F.col("SOILING_PROXY"), F.col("EFFICIENCY"))
    ).select("DATETIME", "MONTH", "PLANT_ID", "SOURCE_KEY", *fixed.GENERATION_MEASURES,
             "EFFICIENCY", "SOILING_PROXY", "CLEANING_FLAG")


def clean_weather(raw: DataFrame) -> DataFrame:
    """Plant sensor readings with parsed time; rows without a time stay and match nothing."""
    filled = mean_fill(dedupe(raw), fixed.WEATHER_MEASURES)
    return with_datetime(filled).select(
        "DATETIME", "PLANT_ID", "SOURCE_KEY", *fixed.WEATHER_MEASURES)


def clean_irradiance(raw: DataFrame, zone: str = fixed.PLANT_ZONE) -> DataFrame:
    """Hourly series in local time under canonical names."""
    filled = mean_fill(drop_null_keys(dedupe(raw), "DATETIME"), fixed.IRRADIANCE_MEASURES)
    local = to_local(filled, "DATETIME", zone)
    return local.select(
        "DATETIME", F.month("DATETIME").alias("MONTH"), "CITY", "YEAR",
        *[F.col(raw_name).alias(name) for raw_name, name in fixed.IRRADIANCE_NAMES.items()],
        "SOLAR_ZENITH_ANGLE",
        clip_col(F.col("OPTIMAL_TILT"), 0, 90).cast("float").alias("OPTIMAL_TILT"),
        "LATITUDE", "LONGITUDE")


def preprocess(generation: DataFrame, weather: DataFrame, irradiance: DataFrame, **options) -> DataFrame:
    """The analysis-ready table of the three raw sources; ``options`` as for ``combine``."""
    return combine(clean_generation(generation), clean_weather(weather), irradiance, **options)


def combine(readings: DataFrame, sensors: DataFrame, irradiance: DataFrame,
            city: str = fixed.PLANT_CITY, year: int = fixed.PLANT_YEAR,
            zone: str = fixed.PLANT_ZONE, include_year: bool = False,
            check_weather_key: bool = True) -> DataFrame:
    """Clean readings with clean weather and the site's hourly irradiance.

    Every generation row is kept. A weather key that occurs twice would multiply
    rows; the result then fails when it is computed, unless ``check_weather_key`` is off.
    """
    if check_weather_key:
        sensors = with_unique_key(sensors, ["DATETIME", "PLANT_ID"])
    site = clean_irradiance(irradiance, zone).filter(
        (F.col("CITY") == city) & (F.col("YEAR") == year))
    merged = attach_hourly(attach_weather(readings, sensors), site, include_year=include_year)
    return merged.select(*fixed.PREPROCESSED_COLUMNS)


def lay_out(generation: DataFrame, weather: DataFrame, folder: str) -> int:
    """Clean readings and clean weather as tables laid out by the key that joins them.

    Returns the number of their buckets, with which ``preprocess_laid_out`` joins them as often
    as needed without a shuffle. It follows from the raw rows, so that the clean ones are
    computed once.
    """
    buckets = buckets_for(max(generation.count(), weather.count()))
    return lay_out_together({"generation": clean_generation(generation, buckets), "weather": clean_weather(weather)},
                            folder, WEATHER_KEY, buckets)


def preprocess_laid_out(spark: SparkSession, folder: str, buckets: int, irradiance: DataFrame, **options) -> DataFrame:
    """The analysis-ready table of sources laid out before; ``options`` as for ``combine``.

    The check of the weather key and the join both find the rows of a key together already.
    """
    readings, sensors = (open_by_key(spark, f"{folder}/{name}", WEATHER_KEY, buckets)
                         for name in ("generation", "weather"))
    return combine(readings, sensors, irradiance, **options)


def validate_preprocessed(sources: dict[str, DataFrame], result: DataFrame,
                          minimum: int = fixed.MIN_TOTAL_ROWS) -> dict[str, DataFrame]:
    """Rows in, rows and columns out, remaining NULLs, label distribution."""
    return {
        "volume": audit.volume(sources, minimum),
        "output": result.agg(F.count("*").alias("rows_out"),
                             F.lit(len(result.columns)).alias("columns_out")),
        "nulls": audit.null_counts_long(result, nan=False),
        "flags": audit.class_distribution(result),
    }


def run_preprocess(generation: DataFrame, weather: DataFrame, irradiance: DataFrame,
                   out: str, csv_out: str | None = None, quarantine: str | None = None,
                   **options) -> dict[str, DataFrame]:
    """Preprocess, write Parquet by month once and validate what was written.

    The report also counts the rows that deduplication takes away and the readings whose
    time cannot be read. Malformed rows of sources read with them are left out, counted per
    file and, where ``quarantine`` names a folder, written there, one table per source.
    """
    read = {"generation": generation, "weather": weather, "irradiance": irradiance}
    if quarantine:
        for name, df in read.items():
            if holds_malformed(df):
                write_dataset(malformed_rows(df), f"{quarantine}/{name}")
    generation, weather, irradiance = map(well_formed, read.values())
    write_dataset(preprocess(generation, weather, irradiance, **options), out,
                  partition_by=["MONTH"])
    result = generation.sparkSession.read.parquet(out).select(*fixed.PREPROCESSED_COLUMNS)
    if csv_out:
        write_csv(result, csv_out)
    sources = {"generation": generation, "weather": weather, "irradiance": irradiance}
    removed = union_all([audit.duplicates(df).select(F.lit(name).alias("source"), "*")
                         for name, df in sources.items()])
    unread = union_all([unparseable_count(df).select(F.lit(name).alias("source"), "*")
                        for name, df in sources.items() if name != "irradiance"])
    return {"result": result, "removed": removed, "unread_times": unread,
            **validate_preprocessed(sources, result), **_malformed_report(read)}


# Models.

@dataclass
class ModelReport:
    """Fitted searches by name and the result tables by name."""

    searches: dict = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)


def model_rows(preprocessed: DataFrame) -> DataFrame:
    """Daylight rows with all engineered model features."""
    return with_power_features(with_time_features(daylight(preprocessed)))


def split_report(train: DataFrame, test: DataFrame, label: str, features) -> DataFrame:
    """Class balance and rows without gaps of both sides, in one pass over each."""
    whole = F.lit(True)
    for c in features:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    sides = union_all([side.select(F.lit(name).alias("side"), F.col(label).alias("__y"),
                                   whole.alias("__whole"))
                       for name, side in (("train", train), ("test", test))])
    return imbalance.class_ratio(sides, "__y", ["side"], F.count_if("__whole").alias("trainable"))


def _scored_once(model, test: DataFrame, *columns: str) -> DataFrame:
    """Scores of the test rows, computed once for all metrics that read them."""
    return materialize(model.transform(test).select(*columns))


ROW_KEYS = ("PLANT_ID", "SOURCE_KEY", "DATETIME")


def train_baseline(preprocessed: DataFrame, grid=None, features=None, folds: int = fixed.FOLDS,
                   parallelism: int = 2, keys=ROW_KEYS, **split_options) -> ModelReport:
    """Tuned random forest for the cleaning flag, with every table its report needs.

    ``keys`` name a reading; the folds follow them.
    """
    spark, label = preprocessed.sparkSession, fixed.CLEANING_LABEL
    features = features or fixed.BASELINE_FEATURES
    train, test = split.by_month(model_rows(preprocessed), **split_options)
    rows = models.stage_training(imbalance.with_class_weight(train, label),
                                 [*features, label, "sample_weight"], keys, folds)
    search = models.tune(
        rows, features, models.rf_classifier(label), grid or fixed.BASELINE_GRID,
        models.auc_evaluator(label), folds, parallelism=parallelism,
        fold_col=models.FOLD_COLUMN, staged=True)
    scored = _scored_once(search.bestModel, test, label, "rawPrediction", "probability",
                          "prediction")
    with_score = evaluate.positive_score(scored)
    cells = materialize(evaluate.confusion(scored, label))
    curve = materialize(evaluate.threshold_curve(with_score, label, "score"))
    auc = models.auc_evaluator(label).evaluate(scored)
    metrics = evaluate.classification_metrics(cells).select(F.lit(auc).alias("auc"), "*")
    return ModelReport({"random_forest": search}, {
        "split": split_report(train, test, label, features),
        "grid": models.grid_table(search, spark),
        "best_params": models.params_table(search, spark),
        "metrics": metrics,
        "confusion": cells,
        "importances": models.importances(search.bestModel, features, spark),
        "score_density": density_by_class(with_score, "score", label),
        "threshold_curve": curve,
        "best_threshold": evaluate.best_threshold(curve),
    })


def _grid_views(key: str, search, scores: DataFrame, values: dict) -> dict[str, DataFrame]:
    """Depth by trees and the learning curve over trees at the best depth, for a forest; the best
    score by step and rounds, for boosted trees. What was not searched has no view."""
    views = {}
    if {"maxDepth", "numTrees"} <= set(values):
        depth = models.best_params(search.bestModel, ["maxDepth"])["maxDepth"]
        views[f"{key}_pivot"] = models.grid_pivot(scores, "maxDepth", "numTrees", values["numTrees"])
        views[f"{key}_curve"] = models.grid_slice(scores, "maxDepth", depth, "numTrees")
    if {"stepSize", "maxIter"} <= set(values):
        views[f"{key}_best_by"] = models.grid_best_by(scores, ["stepSize", "maxIter"])
    return views


def tune_models(preprocessed: DataFrame, grids: dict | None = None, folds: int = fixed.FOLDS,
                parallelism: int = 2, regressor_parallelism: int = 1,
                forecast_keys=("PLANT_ID", "SOURCE_KEY"), forecast_rows: int = fixed.FORECAST_ROWS,
                keys=ROW_KEYS, **split_options) -> ModelReport:
    """Rival classifiers for the cleaning flag and regressors for DC power, and the winners.

    Both classifiers read one staged table and both regressors another, with folds that
    follow the ``keys`` of a reading. Of each regressor the report has all scored rows and, as its forecast, the first
    ``forecast_rows`` in time.
    """
    spark = preprocessed.sparkSession
    flag, power = fixed.CLEANING_LABEL, fixed.POWER_LABEL
    grids = {"rf": fixed.RF_GRID, "gbt": fixed.GBT_GRID, "rf_regressor": fixed.RF_REGRESSOR_GRID,
             "gbt_regressor": fixed.GBT_REGRESSOR_GRID, **(grids or {})}
    train, test = split.by_month(model_rows(preprocessed), **split_options)
    weighted = models.stage_training(imbalance.with_class_weight(train, flag),
                                     [*fixed.CLF_FEATURES, flag, "sample_weight"], keys, folds)
    auc_of, f1_of = models.auc_evaluator(flag), models.f1_evaluator(flag)
    report = ModelReport()

    classifiers = {"Random Forest": ("rf", models.rf_classifier(flag)),
                   "GBT": ("gbt", models.gbt_classifier(flag))}
    rows = []
    for name, (key, model) in classifiers.items():
        search = models.tune(weighted, fixed.CLF_FEATURES, model, grids[key], auc_of, folds,
                             parallelism=parallelism, fold_col=models.FOLD_COLUMN, staged=True)
        scored = _scored_once(search.bestModel, test, flag, "rawPrediction", "prediction")
        report.searches[name] = search
        report.tables[f"{key}_grid"] = models.grid_table(search, spark)
        report.tables[f"{key}_best_params"] = models.params_table(search, spark)
        report.tables |= _grid_views(key, search, report.tables[f"{key}_grid"], grids[key])
        rows.append({"algorithm": name, "cv_auc": float(max(search.avgMetrics)),
                     "test_auc": auc_of.evaluate(scored), "test_f1": f1_of.evaluate(scored)})
    report.tables["classifiers"] = models.comparison(spark, rows)
    best = models.champion(report.tables["classifiers"], "test_auc", "GBT")
    report.tables["best_classifier"] = best
    winner = best.first()["algorithm"]
    report.tables["clf_importances"] = models.importances(
        report.searches[winner].bestModel, fixed.CLF_FEATURES, spark)

    regressors = {"RF Regressor": ("rf_regressor", models.rf_regressor(power)),
                  "GBT Regressor": ("gbt_regressor", models.gbt_regressor(power))}
    rows = []
    readings = models.stage_training(train, [*dict.fromkeys([*fixed.REG_FEATURES, power])], keys, folds)
    for name, (key, model) in regressors.items():
        search = models.tune(readings, fixed.REG_FEATURES, model, grids[key],
                             models.regression_evaluator("rmse", power), folds,
                             parallelism=regressor_parallelism, fold_col=models.FOLD_COLUMN,
                             staged=True)
        scored = _scored_once(search.bestModel, test, "DATETIME", *forecast_keys, power,
                              "prediction")
        report.searches[name] = search
        report.tables[f"{key}_grid"] = models.grid_table(search, spark, "rmse")
        report.tables[f"{key}_best_params"] = models.params_table(search, spark)
        report.tables[f"{key}_scored"] = scored
        report.tables[f"{key}_forecast"] = first_in_time(
            scored, "DATETIME", forecast_keys, forecast_rows).select("DATETIME", power, "prediction")
        found = evaluate.regression_metrics(scored, power).first()
        rows.append({"algorithm": name, "rmse": found["rmse"], "r2": found["r2"]})
    report.tables["regressors"] = models.comparison(spark, rows)
    best = models.champion(report.tables["regressors"], "r2", "GBT Regressor")
    report.tables["best_regressor"] = best
    report.tables["best_scores"] = models.best_scores(report.tables["regressors"])
    key = regressors[best.first()["algorithm"]][0]
    report.tables["forecast"] = report.tables[f"{key}_forecast"]
    return report


def save_importances(table: DataFrame, path: str) -> None:
    """Importances as CSV with header; a row per feature, so one small part."""
    write_csv(table, path)
