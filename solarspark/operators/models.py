"""Tree models: estimators, cross-validated search, and their result tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from solarspark.fixed_values import (
    BASELINE_DEPTH,
    BASELINE_TREES,
    CLEANING_LABEL,
    FOLDS,
    POWER_LABEL,
    SEED,
)
from solarspark.session import materialize, stage

FOLD_COLUMN = "FOLD"

# Layout of staged training rows: rows of a file, as long as files are not too many.
ROWS_PER_FILE = 8_192
MOST_FILES = 2_000


def feature_stages(features) -> list:
    """Assemble (rows with NULL or NaN are skipped) and standardise."""
    return [
        VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="skip"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]


def rf_classifier(label: str = CLEANING_LABEL, weight: str | None = "sample_weight",
                  **params) -> RandomForestClassifier:
    """Random forest on cost weights, a square-root share of the features per split."""
    params = {"numTrees": BASELINE_TREES, "maxDepth": BASELINE_DEPTH,
              "featureSubsetStrategy": "sqrt", "seed": SEED, **params}
    if weight:
        params["weightCol"] = weight
    return RandomForestClassifier(featuresCol="features", labelCol=label, **params)


def gbt_classifier(label: str = CLEANING_LABEL, weight: str | None = None,
                   **params) -> GBTClassifier:
    """Boosted trees, unweighted unless a weight column is named."""
    if weight:
        params["weightCol"] = weight
    return GBTClassifier(featuresCol="features", labelCol=label, **{"seed": SEED, **params})


def rf_regressor(label: str = POWER_LABEL, **params) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="features", labelCol=label, **{"seed": SEED, **params})


def gbt_regressor(label: str = POWER_LABEL, **params) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol=label, **{"seed": SEED, **params})


def auc_evaluator(label: str = CLEANING_LABEL) -> BinaryClassificationEvaluator:
    """Exact area under the curve: every distinct score is a cut-off."""
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC",
                                         numBins=0)


def f1_evaluator(label: str = CLEANING_LABEL) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="f1")


def regression_evaluator(metric: str, label: str = POWER_LABEL) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)


def grid(model, values: dict[str, list]) -> list[dict]:
    """Every combination of the named parameters' values."""
    builder = ParamGridBuilder()
    for name, choices in values.items():
        builder = builder.addGrid(model.getParam(name), choices)
    return builder.build()


def _columns_used(train: DataFrame, features, model) -> list[str]:
    columns = [*features, model.getLabelCol()]
    if model.hasParam("weightCol") and model.isDefined(model.getParam("weightCol")):
        weight = model.getOrDefault("weightCol")
        if weight:
            columns.append(weight)
    return [c for c in dict.fromkeys(columns) if c in train.columns]


def training_rows(train: DataFrame, features, model, fold_col: str | None = None) -> DataFrame:
    """The columns a fit reads, computed once.

    Bags and folds are drawn by row position. Rows kept in files come back in the
    same order when work of a lost executor is repeated, so that a row cannot
    change its fold halfway.
    """
    columns = _columns_used(train, features, model) + ([fold_col] if fold_col else [])
    return materialize(train.select(*columns))


def stage_training(train: DataFrame, columns, keys, folds: int) -> DataFrame:
    """A table of ``columns`` and the fold of each row, for all searches that read them.

    Folds follow a hash of the row key, and so does the place of a row: files hold rows in
    the same order however ``train`` is partitioned or repeated, so bags drawn by position
    are the same as well.
    """
    place = F.xxhash64(*keys)
    rows = train.select(*columns, F.pmod(place, F.lit(folds)).cast("int").alias(FOLD_COLUMN), place.alias("__place"))
    files = min(MOST_FILES, max(1, -(-train.count() // ROWS_PER_FILE)))
    return stage(rows.repartition(files, "__place").sortWithinPartitions("__place", *columns).drop("__place"))


def fit(train: DataFrame, features, model) -> PipelineModel:
    """One fit of assembler, scaler and model."""
    stages = [*feature_stages(features), model]
    return Pipeline(stages=stages).fit(training_rows(train, features, model))


def tune(train: DataFrame, features, model, values: dict[str, list], evaluator,
         folds: int = FOLDS, seed: int = SEED, parallelism: int = 2,
         fold_col: str | None = None, staged: bool = False) -> CrossValidatorModel:
    """Search ``values`` by cross-validation of the whole assembler-scaler-model chain.

    ``fold_col`` names a column of fold numbers from 0; folds that follow a key do not
    depend on the order of rows. ``staged`` says that ``train`` is a table in files already
    (see ``stage_training``), which is not copied again.
    """
    search = CrossValidator(
        estimator=Pipeline(stages=[*feature_stages(features), model]),
        estimatorParamMaps=grid(model, values), evaluator=evaluator,
        numFolds=folds, seed=seed, parallelism=parallelism)
    if fold_col:
        search = search.setFoldCol(fold_col)
    if staged:
        columns = _columns_used(train, features, model) + ([fold_col] if fold_col else [])
        return search.fit(train.select(*columns))
    return search.fit(training_rows(train, features, model, fold_col))


def trainable_rows(df: DataFrame, features) -> DataFrame:
    """One row: rows counted and rows a fit keeps after skipping missing features."""
    whole = F.lit(True)
    for c in features:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.agg(F.count("*").alias("counted"), F.count_if(whole).alias("trainable"))


def score(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def grid_table(search: CrossValidatorModel, spark: SparkSession, metric: str = "AUC") -> DataFrame:
    """Parameters and mean metric over the folds, a row per combination."""
    rows = [Row(**{p.name: v for p, v in combination.items()}, **{metric: float(value)})
            for combination, value in zip(search.getEstimatorParamMaps(), search.avgMetrics)]
    return spark.createDataFrame(rows)


def grid_best_by(table: DataFrame, keys, metric: str = "AUC") -> DataFrame:
    """Best metric per combination of ``keys``."""
    return table.groupBy(*keys).agg(F.max(metric).alias(metric))


def grid_pivot(table: DataFrame, index: str, columns: str, choices: list,
               metric: str = "AUC") -> DataFrame:
    """Metric as a table of ``index`` by ``columns``."""
    return table.groupBy(index).pivot(columns, choices).agg(F.first(metric)).orderBy(index)


def grid_slice(table: DataFrame, fixed: str, value, order: str) -> DataFrame:
    """Rows with one parameter fixed, ordered by another."""
    return table.filter(F.col(fixed) == F.lit(value)).orderBy(order)


def importances(model: PipelineModel, features, spark: SparkSession) -> DataFrame:
    """Feature, Importance; greatest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(features, values)]
    return spark.createDataFrame(rows, "Feature string, Importance double").orderBy(
        F.desc("Importance"), F.asc("Feature"))


def top_features(table: DataFrame, n: int = 3) -> DataFrame:
    return table.orderBy(F.desc("Importance"), F.asc("Feature")).limit(n)


def best_params(model: PipelineModel, names) -> dict:
    """Chosen parameter values of a fitted chain's last stage."""
    stage = model.stages[-1]
    return {n: stage.getOrDefault(n) for n in names}


def params_table(search: CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """The winning value of each searched parameter: parameter, value (as text)."""
    names = sorted({p.name for combination in search.getEstimatorParamMaps() for p in combination})
    chosen = best_params(search.bestModel, names)
    return spark.createDataFrame([(n, str(chosen[n])) for n in names], "parameter string, value string")


def comparison(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Scores of the rival models, a row each; the first column names the algorithm."""
    return spark.createDataFrame([Row(**r) for r in rows])


def champion(table: DataFrame, metric: str, prefer: str, name: str = "algorithm") -> DataFrame:
    """The row of greatest ``metric``; among equals the one named ``prefer``."""
    return table.orderBy(F.desc(metric), F.desc(F.col(name) == F.lit(prefer)), name).limit(1)


def best_scores(table: DataFrame) -> DataFrame:
    """Least rmse and greatest r2 of all regressors, which may come from different ones."""
    return table.agg(F.min("rmse").alias("best_rmse"), F.max("r2").alias("best_r2"))
