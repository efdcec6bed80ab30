import datetime as dt

import pytest
from pyspark.sql import functions as F

from solarspark.operators import audit, filters, impute, lookup, merge, profiles, resample, sampling, split
from solarspark.operators.calendar import densify_months

NAN = float("nan")


def column(df, name):
    return [r[name] for r in df.collect()]


def test_fill(spark):
    df = spark.createDataFrame([(1.0,), (None,), (NAN,), (4.0,)], "x double").coalesce(1)
    assert column(impute.mean_fill(df, ["x"]), "x") == [1.0, 2.5, 2.5, 4.0]


def test_fill_without_values_and_of_integers(spark):
    df = spark.createDataFrame([(None, 2), (None, None), (None, 3)], "x double, k int").coalesce(1)
    out = impute.mean_fill(df, ["x", "k"])
    assert column(out, "x") == [None, None, None]
    assert column(out, "k") == [2, 2, 3]
    assert out.dtypes == df.dtypes


def test_fill_keeps_the_mean(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.rand(1)).alias("x"))
    filled = impute.mean_fill(df, ["x"])
    assert filled.filter("x is null or isnan(x)").isEmpty()
    assert filled.agg(F.avg("x")).first()[0] == pytest.approx(df.agg(F.avg("x")).first()[0])


def test_null_counts(spark):
    df = spark.createDataFrame([(1.0, 1), (None, None), (NAN, 4)], "x double, k int")
    assert tuple(audit.null_counts(df).first()) == (2, 1)
    assert tuple(audit.null_counts(df, nan=False).first()) == (1, 1)
    assert {tuple(r) for r in audit.null_counts_long(df).collect()} == {("x", 2), ("k", 1)}


def test_null_compare_shows_remaining_gaps_only(spark):
    raw = spark.createDataFrame([(1.0, None), (None, "a")], "x double, s string")
    clean = spark.createDataFrame([(1.0, None), (1.0, "a")], "x double, s string")
    out = {tuple(r) for r in audit.null_compare({"gen": (raw, ["x", "s", "zz"])}, clean).collect()}
    assert out == {("before", "gen", "x", 1), ("before", "gen", "s", 1),
                   ("after", "merged", "s", 1)}


def test_dedupe_and_audit(spark):
    df = spark.createDataFrame([(NAN,), (NAN,), (None,), (None,)], "x double")
    once = merge.dedupe(df)
    assert once.count() == 2 == merge.dedupe(once).count()
    assert tuple(audit.duplicates(df).first()) == (4, 2, 2, 50.0)
    assert tuple(audit.duplicates(df.limit(0)).first()) == (0, 0, 0, 0.0)


def test_describe(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, "c"), (NAN, "d")],
                               "x double, s string")
    rows = audit.describe(df).collect()
    assert [r["column"] for r in rows] == ["x"]
    assert tuple(rows[0])[1:] == pytest.approx((2, 2.0, 2 ** 0.5, 1.0, 3.0))
    with pytest.raises(Exception, match="IRRADIATION"):
        audit.describe(df, ["IRRADIATION"]).collect()


def test_volume_gate(spark):
    sources = {"a": spark.range(3), "b": spark.range(4)}
    rows = {r.source: (r.rows, r.requirement_met) for r in audit.volume(sources, 7).collect()}
    assert rows == {"a": (3, None), "b": (4, None), "TOTAL": (7, True)}
    total = audit.volume(sources, 8).filter("source = 'TOTAL'").first()
    assert total.requirement_met is False


def test_class_distribution_is_ordered(spark):
    df = spark.createDataFrame([(1,), (0,), (0,)], "CLEANING_FLAG int")
    assert [tuple(r) for r in audit.class_distribution(df).collect()] == [(0, 2), (1, 1)]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, k int")
    c = spark.createDataFrame([(3,)], "k int")
    assert {tuple(r) for r in merge.union_all([a, b]).collect()} == {(1, "x"), (2, "y")}
    assert {tuple(r) for r in merge.union_all([a, c], True).collect()} == {(1, "x"), (3, None)}


def test_null_key_dropping(spark):
    df = spark.createDataFrame([("t", 1), (None, 2)], "DATE_TIME string, k int")
    assert column(merge.drop_null_keys(df, "DATE_TIME"), "k") == [1]


@pytest.mark.parametrize("max_rows", [100, 0])
def test_group_mean_by_broadcast_and_by_shuffle(spark, max_rows):
    df = spark.createDataFrame([(1, 0.0), (1, 10.0), (1, 20.0), (2, 5.0), (None, 7.0)],
                               "p int, y double")
    means = df.groupBy("p").agg(F.avg("y").alias("m"))
    out = lookup.join_aggregate(df, means, "p", max_rows=max_rows)
    assert {tuple(r) for r in out.collect()} == {
        (1, 0.0, 10.0), (1, 10.0, 10.0), (1, 20.0, 10.0), (2, 5.0, 5.0), (None, 7.0, None)}
    lazy = lookup.join_aggregate(df, means, "p", keys_from=df, max_rows=max_rows)
    assert {tuple(r) for r in lazy.collect()} == {tuple(r) for r in out.collect()}
    assert {tuple(r) for r in merge.attach_group_mean(df, "p", "y", "m").collect()} == {
        tuple(r) for r in out.collect()}


def test_weather_keeps_every_reading(spark):
    gen = spark.createDataFrame([(1, 1, "i1"), (1, 1, "i2"), (2, 1, "i1")],
                                "DATETIME int, PLANT_ID int, SOURCE_KEY string")
    wx = spark.createDataFrame([(1, 1, "s", 0.5)],
                               "DATETIME int, PLANT_ID int, SOURCE_KEY string, IRRADIATION double")
    out = merge.attach_weather(gen, wx)
    assert sorted(map(tuple, out.collect())) == [
        (1, 1, "i1", 0.5), (1, 1, "i2", 0.5), (2, 1, "i1", None)]


def test_fan_out_is_refused(spark):
    wx = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "t int, p int")
    with pytest.raises(ValueError, match="not unique"):
        merge.assert_unique_key(wx, ["t", "p"])
    merge.assert_unique_key(wx.dropDuplicates(), ["t", "p"])


def hourly_inputs(spark):
    readings = spark.createDataFrame(
        [(dt.datetime(2020, 5, 1, 10, m),) for m in (0, 15, 30, 45)]
        + [(dt.datetime(2020, 5, 1, 11, 0),), (dt.datetime(2021, 5, 1, 10, 0),)], "ts timestamp")
    series = spark.createDataFrame(
        [(dt.datetime(2020, 5, 1, 10, 0), 100.0), (dt.datetime(2020, 5, 1, 10, 30), 300.0)],
        "ts timestamp, GHI double")
    return readings, series


def test_hourly_join(spark):
    readings, series = hourly_inputs(spark)
    out = merge.attach_hourly(readings, series, "ts", values=["GHI"])
    assert out.columns == ["MONTH", "ts", "GHI"]
    assert sorted(column(out, "GHI"), key=str) == [200.0] * 5 + [None]
    strict = merge.attach_hourly(readings, series, "ts", values=["GHI"], include_year=True)
    assert sorted(column(strict, "GHI"), key=str) == [200.0] * 4 + [None] * 2
    profile = resample.hourly_profile(series, "ts", ["GHI"])
    assert [tuple(r) for r in profile.collect()] == [(5, 1, 10, 200.0)]


def test_filters_leave_out_nan(spark):
    df = spark.createDataFrame([(5.0,), (10.0,), (10.5,), (NAN,), (None,)], "GHI double")
    assert column(filters.daylight(df), "GHI") == [10.5]
    assert column(filters.within(df, "GHI", 5, 10), "GHI") == [5.0, 10.0]
    assert filters.present_columns(df, ["x", "GHI"]) == ["GHI"]


def test_densify_and_monthly(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 5, 1), 1.0), (dt.datetime(2021, 5, 9), 3.0),
                                (dt.datetime(2020, 6, 1), NAN)], "ts timestamp, v double")
    rows = profiles.monthly(df, "ts", ["v"]).orderBy("month").collect()
    assert [r.month for r in rows] == list(range(1, 13))
    assert rows[4].v == 2.0 and rows[4].label == "May"
    assert [r.v for r in rows[:4] + rows[5:]] == [None] * 11
    months = spark.createDataFrame([(5, 1.0), (6, 2.0)], "month int, x double")
    assert densify_months(months).filter("x is null").count() == 10


def test_city_tables(spark):
    df = spark.createDataFrame(
        [("A", dt.datetime(2020, 5, 1), 1.0), ("A", dt.datetime(2020, 6, 1), 2.0),
         ("B", dt.datetime(2020, 5, 1), 9.0), ("B", dt.datetime(2020, 5, 2), 7.0)],
        "CITY string, ts timestamp, ghi double")
    assert [tuple(r) for r in profiles.city_ranking(df).collect()] == [
        ("B", 2, 8.0), ("A", 2, 1.5)]
    table = {r.CITY: r for r in profiles.city_month(df, "ts").collect()}
    assert table["A"].m5 == 1.0 and table["A"].m6 == 2.0 and table["B"].m5 == 8.0
    assert len(table["A"]) == 13 and sum(v is None for v in table["A"]) == 10


def test_sample_is_whole_and_repeatable(spark):
    df = spark.range(4)
    assert sampling.hash_sample(df, "id", 10).count() == 4
    big = spark.range(1000)
    one = column(sampling.hash_sample(big, "id", 20), "id")
    two = column(sampling.hash_sample(big.repartition(7), "id", 20), "id")
    assert one == two and len(set(one)) == 20
    assert one != column(sampling.hash_sample(big, "id", 20, seed=7), "id")


def test_head_in_time(spark):
    df = spark.createDataFrame([(2, 1), (1, 2), (1, 1)], "ts int, k int")
    assert [tuple(r) for r in sampling.first_in_time(df, "ts", ["k"], 2).collect()] == [
        (1, 1), (1, 2)]


def test_temporal_split(spark):
    stamps = [dt.datetime(2020, 5, 1), dt.datetime(2020, 6, 1), dt.datetime(2020, 7, 1),
              dt.datetime(2021, 5, 1)]
    df = spark.createDataFrame([(s,) for s in stamps], "DATETIME timestamp")
    train, test = split.by_month(df)
    assert sorted(column(train, "DATETIME")) == [stamps[0], stamps[3]]
    assert column(test, "DATETIME") == [stamps[1]]


def test_profile_counts_every_copy(spark, monkeypatch):
    from solarspark.operators import audit
    monkeypatch.setattr(audit, "LOT", 3)
    rows = [(1, 2.0)] * 10 + [(None, None)] * 4 + [(None, float("nan"))] * 3 + [(2, 5.0)]
    found = audit.profile(spark.createDataFrame(rows, "a int, b double"), ["b"]).first()
    assert (found["total"], found["distinct_rows"], found["missing0"], found["missing1"]) == (18, 4, 7, 7)
    assert (found["n0"], found["min0"], found["max0"]) == (11, 2.0, 5.0)
    assert abs(found["mean0"] - 25 / 11) < 1e-12 and abs(found["sd0"] ** 2 - 90 / 121 * 11 / 10) < 1e-12
    none = audit.profile(spark.createDataFrame([], "a int, b double"), ["b"]).first()
    assert (none["total"], none["distinct_rows"], none["missing1"], none["mean0"]) == (0, 0, 0, None)
