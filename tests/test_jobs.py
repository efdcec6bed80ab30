import pytest
from pyspark.sql import functions as F

import fixtures
from solarspark.operators.merge import assert_unique_key
from solarspark import fixed_values as fixed
from solarspark.operators import models, stats
from solarspark.operators.merge import attach_hourly
from solarspark.plans import analyses, jobs
from solarspark.sources import readers


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    paths = fixtures.write_sources(tmp_path_factory.mktemp("raw"))
    return {"generation": readers.read_generation(spark, paths["generation"]),
            "weather": readers.read_weather(spark, paths["weather"]),
            "irradiance": readers.read_irradiance(spark, paths["irradiance"])}


@pytest.fixture(scope="module")
def result(spark, raw, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    return jobs.run_preprocess(**raw, out=f"{out}/clean", csv_out=f"{out}/csv") | {"dir": out}


@pytest.fixture(scope="module")
def clean(result):
    return result["result"]


def test_audit(raw):
    tables = jobs.audit_sources(**raw)
    nulls = {(r.source, r["column"]): r.missing for r in tables["nulls"].collect()}
    assert nulls["generation", "DC_POWER"] == 1 and nulls["generation", "DATE_TIME"] == 1
    assert nulls["weather", "IRRADIATION"] == 1 and nulls["irradiance", "ghi"] == 0
    copies = {r.source: r.duplicates for r in tables["duplicates"].collect()}
    assert copies == {"generation": 3, "weather": 0, "irradiance": 0}
    described = {(r.source, r["column"]) for r in tables["describe"].collect()}
    assert ("weather", "IRRADIATION") in described and len(described) == 3 + 1 + 7
    total = tables["volume"].filter("source = 'TOTAL'").first()
    assert total.rows == 2307 + 1152 + 504 and total.requirement_met is False


def test_preprocessed_shape(clean, result):
    assert clean.columns == fixed.PREPROCESSED_COLUMNS
    types = dict(clean.dtypes)
    assert types["EFFICIENCY"] == types["SOILING_PROXY"] == "float"
    assert types["CLEANING_FLAG"] == types["MONTH"] == "int"
    assert types["OPTIMAL_TILT"] == "double" and types["DATETIME"] == "timestamp"
    # 2,307 raw rows less three copies and one without a time.
    assert clean.count() == 2303
    assert result["output"].first() == (2303, 23)
    assert list((result["dir"] / "csv").glob("*.csv"))


def test_validation_tables(result):
    assert {r["column"]: r.missing for r in result["nulls"].collect()}["GHI"] == 0
    flags = {r.CLEANING_FLAG: r["count"] for r in result["flags"].collect()}
    assert set(flags) == {0, 1} and sum(flags.values()) == 2303


def test_gaps_take_the_mean_of_distinct_rows(raw, clean):
    expected = raw["generation"].dropDuplicates().na.drop(subset=["DATE_TIME"]).agg(
        F.avg("DC_POWER")).first()[0]
    filled = clean.filter("PLANT_ID = 2 and DATETIME = '2020-05-29 01:15:00' "
                          "and SOURCE_KEY = 'inv2_0'").first()
    assert filled.DC_POWER == pytest.approx(expected)


def test_night_rows_are_flagged_by_definition(clean):
    night = clean.filter("DC_POWER = 0 and DAILY_YIELD = 0")
    assert night.count() > 0 and night.filter("CLEANING_FLAG = 0").isEmpty()


def test_irradiance_is_the_sites_own(clean):
    assert clean.select("LATITUDE").distinct().collect() == [(14.813,)]


def test_local_time_turns_the_correlation_around(raw, clean):
    shifted = clean.corr("GHI", "DC_POWER")
    series = raw["irradiance"].filter("CITY = 'Gandikota' and YEAR = 2020").select(
        "DATETIME", F.col("ghi").alias("GHI"))
    unshifted = attach_hourly(clean.drop("GHI", "MONTH"), series, values=["GHI"])
    assert shifted > 0.8 and unshifted.corr("GHI", "DC_POWER") < shifted - 0.5


def test_weather_key_is_checked(raw):
    twice = raw["weather"].unionByName(raw["weather"].withColumn("IRRADIATION", F.lit(9.0)))
    with pytest.raises(Exception, match="not unique"):
        jobs.preprocess(raw["generation"], twice, raw["irradiance"]).count()
    with pytest.raises(ValueError, match="not unique"):
        assert_unique_key(jobs.clean_weather(twice), ["DATETIME", "PLANT_ID"])


def test_time_less_weather_matches_nothing(raw):
    blank = raw["weather"].withColumn("DATE_TIME", F.lit(None).cast("string"))
    out = jobs.preprocess(raw["generation"], blank, raw["irradiance"])
    assert out.filter("IRRADIATION is not null").isEmpty() and out.count() == 2303
    assert jobs.clean_weather(blank).count() == blank.dropDuplicates().count()


@pytest.mark.parametrize("name, tables", [
    ("missing_values", {"missing"}),
    ("dc_power", {"before_histogram", "before_center", "after_histogram", "after_center"}),
    ("irradiance_levels", {"before_histogram", "before_center", "after_histogram", "after_center"}),
    ("boxes", {"before", "after"}),
    ("monthly_tilt", {"monthly"}),
    ("cities", {"ranking", "boxes", "city_month"}),
    ("correlation", {"correlation", "lower"}),
    ("zenith_fit", {"sample", "fit", "line"}),
])
def test_analyses(raw, clean, name, tables):
    out = analyses.run(name, **raw, clean=clean)
    assert set(out) == tables
    for table in out.values():
        assert table.count() > 0


def test_analyses_without_clean_table(raw):
    out = analyses.run("correlation", **raw)
    assert out["lower"].count() == 21
    assert set(analyses.run("boxes", irradiance=raw["irradiance"])) == {"before"}
    assert set(analyses.run("missing_values", generation=raw["generation"])) == {
        "missing_generation"}
    assert analyses.run("cities") == {}
    with pytest.raises(ValueError, match="no analysis"):
        analyses.run("pie")


def test_scaled_boxes_end_at_one(raw, clean):
    rows = {r.variable: r for r in analyses.run("boxes", **raw, clean=clean)["before"].collect()}
    assert rows["ghi"].whisker_high == pytest.approx(1.0)


def test_fit_of_tilt(raw):
    row = analyses.run("zenith_fit", irradiance=raw["irradiance"])["fit"].first()
    assert (row.slope, row.intercept) == pytest.approx((-1, 90), abs=1e-6)


@pytest.fixture(scope="module")
def baseline(clean):
    return jobs.train_baseline(clean, {"numTrees": [4, 6], "maxDepth": [3]}, folds=2)


def test_baseline_tables(baseline, clean):
    t = baseline.tables
    sides = {r.side: r for r in t["split"].collect()}
    day = clean.filter("GHI > 10")
    assert sides["train"].n == day.filter("MONTH = 5").count()
    assert sides["test"].n == day.filter("MONTH = 6").count() == sides["test"].trainable
    cells = t["confusion"].first()
    assert cells.tn + cells.fp + cells.fn + cells.tp == sides["test"].trainable
    metrics = t["metrics"].first()
    assert 0.5 < metrics.auc <= 1 and metrics.weighted_recall == pytest.approx(metrics.accuracy)
    grid = t["grid"].collect()
    assert {(r.numTrees, r.maxDepth) for r in grid} == {(4, 3), (6, 3)}
    assert t["threshold_curve"].count() == 80 and t["best_threshold"].count() == 1
    assert models.best_params(baseline.searches["random_forest"].bestModel,
                              ["numTrees", "maxDepth"])["maxDepth"] == 3


def test_importances_sum_to_one_and_constant_months_have_none(baseline):
    rows = {r.Feature: r.Importance for r in baseline.tables["importances"].collect()}
    assert sum(rows.values()) == pytest.approx(1)
    assert rows["MONTH_SIN"] == rows["MONTH_COS"] == 0
    assert list(rows.values()) == sorted(rows.values(), reverse=True)


def test_same_seed_same_importances(clean):
    train = jobs.model_rows(clean).filter("MONTH = 5").withColumn("sample_weight", F.lit(1.0))
    one, two = (models.importances(models.fit(
        train, fixed.BASELINE_FEATURES, models.rf_classifier(numTrees=3, maxDepth=3)),
        fixed.BASELINE_FEATURES, train.sparkSession).collect() for _ in range(2))
    assert one == two


def test_assembler_skips_missing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 1.0), (float("nan"), 1.0)], "x double, y double")
    assembled = models.feature_stages(["x"])[0].transform(df)
    assert assembled.count() == 1
    assert tuple(models.trainable_rows(df, ["x"]).first()) == (3, 1)


def test_tuning(clean):
    report = jobs.tune_models(clean, {
        "rf": {"maxDepth": [2, 3], "numTrees": [3]},
        "gbt": {"maxIter": [2], "stepSize": [0.1], "maxDepth": [2]},
        "rf_regressor": {"maxDepth": [3], "numTrees": [3]},
        "gbt_regressor": {"maxIter": [2], "stepSize": [0.1], "maxDepth": [2, 3]}}, folds=2)
    t = report.tables
    rivals = {r.algorithm: r for r in t["classifiers"].collect()}
    assert set(rivals) == {"Random Forest", "GBT"}
    assert t["rf_pivot"].columns == ["maxDepth", "3"] and t["rf_pivot"].count() == 2
    assert t["rf_curve"].count() == 1 and t["gbt_best_by"].count() == 1
    best = t["best_classifier"].first()
    assert best.test_auc == max(r.test_auc for r in rivals.values())
    regressors = {r.algorithm: r for r in t["regressors"].collect()}
    assert t["best_regressor"].first().r2 == max(r.r2 for r in regressors.values())
    scores = t["best_scores"].first()
    assert scores.best_rmse == min(r.rmse for r in regressors.values())
    stamps = [r.DATETIME for r in t["forecast"].collect()]
    assert len(stamps) == 500 and stamps == sorted(stamps)
    assert t["gbt_regressor_grid"].columns == ["maxIter", "stepSize", "maxDepth", "rmse"]
    assert t["clf_importances"].count() == len(fixed.CLF_FEATURES)
    pivot = models.grid_pivot(t["rf_grid"], "maxDepth", "numTrees", [3])
    assert [r.maxDepth for r in pivot.collect()] == [2, 3]


def test_champion_prefers_the_named_rival_on_a_tie(spark):
    table = models.comparison(spark, [{"algorithm": "Random Forest", "auc": 0.9},
                                      {"algorithm": "GBT", "auc": 0.9}])
    assert models.champion(table, "auc", "GBT").first().algorithm == "GBT"
    table = models.comparison(spark, [{"algorithm": "Random Forest", "auc": 0.91},
                                      {"algorithm": "GBT", "auc": 0.9}])
    assert models.champion(table, "auc", "GBT").first().algorithm == "Random Forest"


def test_tilt_and_zenith_are_opposites(clean):
    cell = stats.corr_matrix(clean.filter("GHI > 10"), ["OPTIMAL_TILT", "SOLAR_ZENITH_ANGLE"])
    assert cell.filter("i > j").first().r == pytest.approx(-1, abs=1e-3)


def test_folds_and_bags_follow_the_key_and_not_the_layout(spark):
    from solarspark.operators import models
    rows = spark.range(4000).select(
        F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("x"), F.sin("id").alias("z"),
        (F.rand(3) < 0.2 + F.col("id") % 7 / 20).cast("int").alias("y"), F.lit(1.0).alias("sample_weight"))
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    found = []
    for layout in (rows.repartition(3), rows.orderBy(F.desc("z")).repartition(5, "x"), rows):
        table = models.stage_training(layout, ["x", "z", "y", "sample_weight"], ["k"], 2)
        assert table.count() == 4000 and {r[0] for r in table.select("FOLD").distinct().collect()} == {0, 1}
        search = models.tune(table, ["x", "z"], models.rf_classifier("y"), {"numTrees": [3], "maxDepth": [2, 5]},
                             models.auc_evaluator("y"), 2, fold_col="FOLD", staged=True)
        found.append(search.avgMetrics)
    assert found[0] == found[1] == found[2]
