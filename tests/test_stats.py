import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from solarspark.operators import evaluate, imbalance, quantiles, stats

NAN = float("nan")


def skewed(spark, n=6000):
    """A third of all rows in one value of one group, plus gaps."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.when(hot, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.when(F.col("id") % 6 == 0, 1.25).when(F.col("id") % 11 == 0, NAN)
        .when(F.col("id") % 13 == 0, None).otherwise(F.round(F.rand(3) * 1000, 3)).alias("v"))


@pytest.fixture
def sizes(monkeypatch):
    """Set sizes at which test data count as large."""
    def put(**values):
        for name, value in values.items():
            monkeypatch.setattr(quantiles, name, value)
    return put


@pytest.mark.parametrize("values,bins,local", [(quantiles.INTERVAL_VALUES, 1024, 10_000), (300, 16, 10_000), (0, 4, 3)])
def test_quantiles_match_numpy_at_any_size(spark, sizes, values, bins, local):
    sizes(BINS=bins, LOCAL_ROWS=local)
    df = skewed(spark)
    frame = df.toPandas()
    frame["g"] = frame["g"].astype(object).where(frame["g"].notna(), None)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    rows = quantiles.exact_quantiles(df, "v", probabilities, ["g"], values).collect()
    assert len(rows) == frame["g"].nunique(dropna=False)
    for row in rows:
        group = frame[frame["g"].isna()] if row.g is None else frame[frame["g"] == row.g]
        found = group["v"].dropna().to_numpy()
        assert row.n == len(found)
        assert list(row)[2:] == pytest.approx(list(np.quantile(found, probabilities)), rel=1e-12)
    whole = quantiles.exact_quantiles(df, "v", [0.25, 0.5], (), values).first()
    assert list(whole)[1:] == pytest.approx(
        list(np.quantile(frame["v"].dropna(), [0.25, 0.5])), rel=1e-12)


def test_passes_do_not_change_a_bit(spark, sizes):
    df = skewed(spark)
    one = quantiles.exact_quantiles(df, "v", [0.3, 0.77], ["g"]).collect()
    sizes(BINS=5)
    two = quantiles.exact_quantiles(df, "v", [0.3, 0.77], ["g"], 0).collect()
    assert {tuple(r) for r in one} == {tuple(r) for r in two}


def test_ranks_among_extreme_values(spark, sizes):
    """Clusters of different scale, infinities, the least steps between doubles and signed zeros."""
    sizes(BINS=3)
    inf = float("inf")
    values = ([-inf, inf, 1.7976931348623157e308, -1.7976931348623157e308, 5e-324, 1e-323, -5e-324, 0.0, -0.0]
              + [1 + i * 2.0 ** -52 for i in range(9)] + [10.0 ** e for e in range(-300, 300, 25)])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    steps = [i / (len(values) - 1) for i in range(len(values))]
    found = quantiles.exact_quantiles(df, "v", steps, (), 0).first()
    place = [p * (len(values) - 1) for p in steps]
    for got, at in zip(list(found)[1:], place):
        if at == int(at):
            assert got == sorted(values)[int(at)]


def test_no_values(spark):
    df = spark.createDataFrame([("a", None), ("b", NAN)], "g string, v double")
    assert quantiles.exact_quantiles(df, "v", [0.5], ["g"]).count() == 0
    assert tuple(quantiles.exact_quantiles(df, "v", [0.5]).first()) == (0, None)
    one = quantiles.exact_quantiles(spark.createDataFrame([(3,)], "v int"), "v", [0.0, 0.5, 1.0]).first()
    assert tuple(one) == (1, 3.0, 3.0, 3.0)


def test_bins_are_counted_in_order(spark):
    df = spark.range(50000).select(F.lit(0).alias("__g"), F.rand(9).alias("__v"))
    state = df.groupBy("__g").agg(F.lit(7).alias("below"), F.min("__v").alias("low"), F.max("__v").alias("high"))
    counts = quantiles._bin_counts(df, quantiles._brackets(state, 2), 2, True).orderBy("start").collect()
    assert len(counts) <= quantiles.BINS and sum(r["held"] for r in counts) == 50000
    start = 7
    for before, r in zip([None, *counts], counts):
        assert r["start"] == start and r["low"] <= r["high"] and (before is None or before["high"] < r["low"])
        start += r["held"]


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("v"))
    assert quantiles.approx_quantiles(df, "v", [0.5]).first()["median"] == pytest.approx(5000, abs=2)


def test_quartiles_interpolate(spark):
    df = spark.range(4).select(F.col("id").cast("double").alias("v"))
    row = quantiles.exact_quantiles(df, "v", [0.25, 0.5, 0.75]).first()
    assert tuple(row) == (4, 0.75, 1.5, 2.25)


def test_histogram_edges(spark):
    df = spark.range(5).select(F.col("id").cast("double").alias("v"))
    rows = stats.histogram(df, "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [1, 1, 1, 2]
    assert [r.low for r in rows] == [0, 1, 2, 3] and rows[-1].high == 4


@pytest.mark.parametrize("bins", [7, 50, 80])
def test_histogram_matches_numpy(spark, bins):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.round(rng.exponential(20, 3000), 2), np.linspace(0, 100, bins + 1)])
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    rows = stats.histogram(df, "v", bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins)
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r.low for r in rows] + [rows[-1].high] == pytest.approx(edges.tolist(), rel=1e-13)


def test_histogram_of_a_constant_with_gaps(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (NAN,), (None,)], "v double")
    rows = stats.histogram(df, "v", 2).orderBy("bin").collect()
    assert [(r.low, r.high, r["count"]) for r in rows] == [(1.5, 2.0, 0), (2.0, 2.5, 2)]


def test_density_integrates_to_one_per_class(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("y"), F.rand(2).alias("s"))
    out = stats.density_by_class(df, "s", "y", 10)
    area = out.groupBy("y").agg(F.sum(F.col("density") * (F.col("high") - F.col("low"))), F.count("*"))
    assert [(round(r[1], 9), r[2]) for r in area.collect()] == [(1.0, 10)] * 3


def test_center(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (3.0,), (9.0,), (NAN,), (None,)], "v double")
    row = stats.center(df, "v").first()
    assert (row.n, row["mean"], row["median"], row.zeros, row.zero_share) == (4, 3.0, 1.5, 2, 0.5)


def test_box_whiskers_and_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0, -90.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 5.0), ("b", NAN)],
                               "k string, v double")
    rows = {r.k: r for r in stats.box_summary(df, "v", ["k"]).collect()}
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert (rows["a"].q1, rows["a"].q3) == pytest.approx((q1, q3))
    assert (rows["a"].whisker_low, rows["a"].whisker_high, rows["a"].outliers) == (1, 8, 2)
    assert tuple(rows["b"])[1:] == (1, 5, 5, 5, 5, 5, 0)
    whole = stats.box_summary(df, "v").first()
    assert whole.n == 11 and whole.outliers == 2


def test_correlation_hazards(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (None, 1.0, 5.0), (4.0, NAN, 5.0),
         (5.0, 8.0, 5.0)], "a double, b double, k double")
    cells = {(r.col_i, r.col_j): r for r in stats.corr_matrix(df, ["a", "b", "k"], 2).collect()}
    assert len(cells) == 9
    assert cells["b", "a"].r == cells["a", "b"].r == pytest.approx(0.994007, abs=1e-6)
    assert cells["a", "b"].pairs == 3
    assert cells["a", "k"].r is None and cells["k", "k"].r is None
    assert cells["a", "a"].r == pytest.approx(1)
    assert all(r.r is None for r in stats.corr_matrix(df, ["a", "b"]).collect())
    lower = stats.lower_triangle(stats.corr_matrix(df, ["a", "b", "k"], 2)).collect()
    assert {(r.col_i, r.col_j) for r in lower} == {("b", "a"), ("k", "a"), ("k", "b")}


def test_correlations_match_pandas(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame(rng.normal(size=(300, 5)) * [1, 1e-9, 1e9, 1, 1] + [0, 0, 1e12, 1e6, -3], columns=list("abcde"))
    frame["e"] += frame["a"] * 2
    frame.loc[::4, "b"] = np.nan
    frame.loc[::7, "e"] = np.nan
    df = spark.createDataFrame(frame)
    expected = frame.corr(min_periods=30)
    for row in stats.corr_matrix(df, list("abcde")).collect():
        assert row.r == pytest.approx(expected.loc[row.col_i, row.col_j], rel=1e-6)
        assert row.pairs == (frame[row.col_i].notna() & frame[row.col_j].notna()).sum()


def test_correlation_of_what_is_constant_or_missing(spark):
    rows = [(0.1, float(i), 0.3 if i % 2 else None, 1e9 + 0.1 if i % 3 else float(i), None) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    cells = {(r.col_i, r.col_j): (r.pairs, r.r) for r in stats.corr_matrix(df, list("abcde"), 2).collect()}
    assert cells["a", "b"] == (100, None) and cells["c", "b"] == (50, None) and cells["e", "b"] == (0, None)
    some = df.filter("d > 1e8")
    assert {(r.col_i, r.col_j): r.r for r in stats.corr_matrix(some, ["b", "d"], 2).collect()}["b", "d"] is None
    with_c = spark.createDataFrame([(1e9 + 0.1 if i % 3 else float(i), float(i) if i % 3 else None) for i in range(99)],
                                   "x double, y double")
    assert {(r.col_i, r.col_j): r.r for r in stats.corr_matrix(with_c, ["x", "y"], 2).collect()}["x", "y"] is None
    assert all(r.r is None and r.pairs == 0 for r in stats.corr_matrix(df.limit(0), ["a", "b"], 2).collect())


def test_line_recovers_the_tilt_formula(spark):
    df = spark.range(91).select(F.col("id").cast("double").alias("z"),
                                (90.0 - F.col("id")).alias("t"))
    fit = stats.linear_fit(df, "z", "t")
    row = fit.first()
    assert (row.slope, row.intercept, row.n) == pytest.approx((-1, 90, 91))
    line = stats.fitted_line(fit).orderBy("point").collect()
    assert len(line) == 100
    assert (line[0].x, line[0].y, line[-1].x) == pytest.approx((0, 90, 90))
    assert stats.corr_matrix(df, ["z", "t"], 2).filter("i > j").first().r == pytest.approx(-1)


def test_vif_of_two_columns(spark):
    df = spark.range(500).select(F.randn(1).alias("a"), F.randn(2).alias("e")).select(
        "a", (F.col("a") + F.col("e")).alias("b"))
    r = df.corr("a", "b")
    factors = [x.vif for x in stats.vif(df, ["a", "b"]).collect()]
    assert factors == pytest.approx([1 / (1 - r * r)] * 2)


def test_class_weight(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    assert sorted(r.sample_weight for r in imbalance.with_class_weight(df, "y").collect()) == [
        1, 1, 1, 3]
    row = imbalance.class_ratio(df, "y").first()
    assert (row.n, row.positives, row.negatives, row.positive_rate, row.ratio) == (4, 1, 3, .25, 3)


def test_no_positive_is_a_clear_error(spark):
    df = spark.createDataFrame([(0,), (0,)], "y int")
    with pytest.raises(Exception, match="no row with y = 1"):
        imbalance.with_class_weight(df, "y").collect()
    assert imbalance.class_ratio(df, "y").first().ratio is None


def test_confusion_sums_and_zero_rules(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 0.0), (0, 1.0), (0, 0.0)],
                               "y int, prediction double")
    row = evaluate.confusion(df, "y").first()
    assert (row.tn, row.fp, row.fn, row.tp) == (2, 1, 1, 1)
    assert (row.precision, row.recall) == (0.5, 0.5)
    none = evaluate.confusion(df.filter("y = 0 and prediction = 0"), "y").first()
    assert (none.precision, none.recall) == (0.0, 0.0)


def test_metrics_agree_with_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
    df = spark.range(500).select((F.rand(1) < 0.2).cast("int").alias("y"),
                                 (F.rand(2) < 0.3).cast("double").alias("prediction"))
    row = evaluate.classification_metrics(evaluate.confusion(df, "y")).first()
    for name, metric in (("accuracy", "accuracy"), ("f1", "f1"),
                         ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall")):
        expected = MulticlassClassificationEvaluator(labelCol="y", metricName=metric).evaluate(df)
        assert row[name] == pytest.approx(expected), name
    reg = spark.range(200).select(F.randn(3).alias("y"), F.randn(4).alias("prediction"))
    row = evaluate.regression_metrics(reg, "y").first()
    for name in ("rmse", "r2"):
        expected = RegressionEvaluator(labelCol="y", metricName=name).evaluate(reg)
        assert row[name] == pytest.approx(expected)


def test_threshold_curve_against_brute_force(spark):
    cuts = np.linspace(0.1, 0.9, 80)
    rng = np.random.default_rng(3)
    scores = np.concatenate([rng.random(500), cuts, [0.0, 1.0]])
    labels = (rng.random(len(scores)) < 0.3).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"y": labels, "s": scores}))
    curve = evaluate.threshold_curve(df, "y", "s")
    rows = curve.orderBy("threshold").collect()
    assert [r.threshold for r in rows] == cuts.tolist()
    for r, t in zip(rows, cuts):
        tp, fp = ((scores >= t) & (labels == 1)).sum(), ((scores >= t) & (labels == 0)).sum()
        p, c = (tp / (tp + fp) if tp + fp else 0), tp / labels.sum()
        assert (r.precision, r.recall) == pytest.approx((p, c))
    assert all(a.recall >= b.recall for a, b in zip(rows, rows[1:]))
    best = evaluate.best_threshold(curve).first()
    assert best.threshold == cuts[int(np.argmax([r.f1 for r in rows]))]


def test_auc_against_pair_counting(spark):
    rng = np.random.default_rng(4)
    y, s = (rng.random(300) < 0.4).astype(int), np.round(rng.random(300), 1)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    pairs = [(1.0 if a > b else 0.5 if a == b else 0.0) for a in s[y == 1] for b in s[y == 0]]
    for values in (2_000_000, 3):
        found = evaluate.auc(df, "y", "s", task_values=values).first()["auc"]
        assert found == pytest.approx(math.fsum(pairs) / len(pairs))


def test_evaluator_keeps_every_score(spark):
    from solarspark.operators.models import auc_evaluator
    rng = np.random.default_rng(6)
    s = rng.random(5000)
    y = (rng.random(5000) < s).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "rawPrediction": s}))
    ranks = s.argsort().argsort() + 1
    exact = (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())
    assert auc_evaluator("y").evaluate(df) == pytest.approx(exact, abs=1e-12)
    assert evaluate.auc(df, "y", "rawPrediction").first()["auc"] == pytest.approx(exact, abs=1e-12)


def test_null_groups_and_collinear_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 3.0), ("a", 5.0), ("a", 5.0)], "k string, v double")
    box = {r.k: r for r in stats.box_summary(df, "v", ["k"]).collect()}
    assert box[None].median == 2.0 and box[None].n == 3 and box["a"].outliers == 0
    cells = stats.density_by_class(df, "v", "k", bins=4).collect()
    for k in (None, "a"):
        area = sum(r.density * (r.high - r.low) for r in cells if r.k == k)
        assert area == pytest.approx(1.0)
    rows = [(float(i), 2.0 * i + 1, float(i * i % 7), 4.0) for i in range(30)]
    factors = {r.feature: r.vif for r in stats.vif(
        spark.createDataFrame(rows, "x double, twin double, other double, same double"),
        ["x", "twin", "other", "same"]).collect()}
    assert factors["x"] == factors["twin"] == float("inf") and factors["same"] is None
    assert 1.0 <= factors["other"] < 1.5
