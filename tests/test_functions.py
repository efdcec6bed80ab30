import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from solarspark.functions import features, solar, timeparse
from solarspark.operators.calendar import with_calendar_keys
from solarspark.schemas import locations
from solarspark.session import require_utc

NAN = float("nan")


def column(df, name):
    return [r[name] for r in df.collect()]


def test_two_formats_and_junk(spark):
    df = spark.createDataFrame([("15-05-2020 00:15",), ("2020-05-15 00:15:00",), ("junk",),
                                ("2020-13-45 00:15:00",), (None,)], "DATE_TIME string")
    out = column(timeparse.with_datetime(df), "DATETIME")
    assert out[0] == out[1] == dt.datetime(2020, 5, 15, 0, 15)
    assert out[2:] == [None, None, None]
    assert timeparse.unparseable_count(df).first()[0] == 2


def test_variable_width_format_is_not_guarded_by_length(spark):
    df = spark.createDataFrame([("5/3/2020",), ("15/11/2020",)], "t string")
    out = column(df.select(F.to_date(timeparse.parse_first(F.col("t"), ["d/M/yyyy"])).alias("d")),
                 "d")
    assert out == [dt.date(2020, 3, 5), dt.date(2020, 11, 15)]


def test_zone_shift_of_instants(spark):
    df = spark.sql("select timestamp'2020-01-01 00:00:00Z' ts union all "
                   "select timestamp'2020-12-31 23:00:00Z'")
    out = with_calendar_keys(timeparse.to_local(df, "ts"), "ts").select("MONTH", "DAY", "HOUR")
    assert sorted(map(tuple, out.collect())) == [(1, 1, 4), (1, 1, 5)]


def test_zone_shift_keeps_zoneless_type(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:07' ts")
    out = timeparse.to_local(df, "ts")
    assert out.dtypes == [("ts", "timestamp_ntz")]
    assert out.first()[0] == dt.datetime(2024, 1, 1, 5, 30, 7)


def test_guard_refuses_other_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="must be UTC"):
            require_utc(spark)
        with pytest.raises(ValueError, match="must be UTC"):
            timeparse.to_local(spark.sql("select current_timestamp() ts"), "ts")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_month_labels(spark):
    out = spark.range(1, 13).select(timeparse.month_label(F.col("id").cast("int")).alias("m"))
    assert column(out, "m") == "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def test_clip(spark):
    df = spark.createDataFrame([(None,), (NAN,), (95.0,), (-3.0,)], "x double")
    assert column(df.select(features.clip_col(F.col("x"), 0, 90).alias("c")), "c") == [
        None, None, 90.0, 0.0]
    assert column(df.select(features.clip_col(F.col("x"), 0, 90, strict=True).alias("c")), "c") == [
        90.0, 90.0, 90.0, 0.0]


def test_efficiency(spark):
    df = spark.createDataFrame([(0.0, 0.0), (100.0, 96.0), (100.0, 90.0), (None, 3.0)],
                               "dc double, ac double")
    out = df.select(features.efficiency(F.col("ac"), F.col("dc")).alias("e"))
    assert out.dtypes == [("e", "float")]
    assert column(out, "e") == pytest.approx([0.0, 0.96, 0.90, 0.0], abs=1e-7)


def test_soiling_proxy(spark):
    df = spark.createDataFrame([(0.0, 10.0), (10.0, 10.0), (20.0, 10.0), (5.0, 0.0), (5.0, None)],
                               "y double, m double")
    out = df.select(features.soiling_proxy(F.col("y"), F.col("m")).alias("p"))
    assert out.dtypes == [("p", "float")]
    assert column(out, "p") == [1.0, 0.0, -1.0, 0.0, 0.0]


def test_flag_at_the_float_boundary(spark):
    df = spark.sql("select cast(0.10 as float) p, cast(0.95 as float) e union all "
                   "select cast(0.11 as float), cast(0.96 as float) union all "
                   "select cast(0.09 as float), cast(0.5 as float) union all "
                   "select null, cast(0.5 as float)")
    out = df.select(features.cleaning_flag(F.col("p"), F.col("e")).alias("f"))
    assert out.dtypes == [("f", "int")]
    assert column(out, "f") == [1, 0, 0, 0]


def test_cyclic_identity_and_neighbours(spark):
    df = spark.range(24).select(F.col("id").alias("h"))
    s, c = features.cyclic(F.col("h"), 24)
    rows = df.select(s.alias("s"), c.alias("c")).collect()
    assert all(math.isclose(r.s ** 2 + r.c ** 2, 1.0) for r in rows)
    near = math.dist(rows[23], rows[0])
    assert math.isclose(near, math.dist(rows[0], rows[1]))


def test_ratio_and_difference(spark):
    df = spark.createDataFrame([(50.0, 0.0, 30.0, 20.0), (50.0, 100.0, 30.0, None)],
                               "DC_POWER double, GHI double, MODULE_TEMPERATURE double, "
                               "AMBIENT_TEMPERATURE double")
    out = features.with_power_features(df)
    assert column(out, "DC_PER_GHI") == [0.0, 0.5]
    assert column(out, "TEMP_DIFF") == [10.0, None]


def test_max_scale_skips_nan(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (NAN,)], "x double")
    assert column(features.max_scale(df, ["x"]), "x_SCALED")[:2] == [0.25, 1.0]


def test_sun_over_gandikota_at_solstice(spark):
    df = spark.sql("select explode(sequence(timestamp_ntz'2020-06-21 00:00:00', "
                   "timestamp_ntz'2020-06-21 23:55:00', interval 5 minutes)) ts").withColumns(
                       {"la": F.lit(14.813), "lo": F.lit(78.286)})
    rows = solar.with_solar_position(df, "ts", "la", "lo").collect()
    noon = min(rows, key=lambda r: r.SOLAR_ZENITH_ANGLE)
    # Declination 23.44 minus latitude 14.81; true noon near 06:47 to 06:50 UTC.
    assert noon.SOLAR_ZENITH_ANGLE == pytest.approx(8.63, abs=0.05)
    assert noon.ts.hour == 6 and 45 <= noon.ts.minute <= 50
    assert abs(noon.SOLAR_AZIMUTH - 360) < 8 or noon.SOLAR_AZIMUTH < 8
    morning = [r for r in rows if r.ts.hour == 1][0]
    assert 60 < morning.SOLAR_AZIMUTH < 90
    assert max(r.SOLAR_ZENITH_ANGLE for r in rows) > 120


@pytest.mark.parametrize("ts, lat, lon, zenith, azimuth", [
    # Published worked example of the NREL solar position algorithm, 12:30:30 at UTC-7.
    ("2003-10-17 19:30:30", 39.742476, -105.1786, 50.1279, 194.3402),
])
def test_sun_against_published_example(spark, ts, lat, lon, zenith, azimuth):
    df = spark.createDataFrame([(lat, lon)], "la double, lo double").withColumn(
        "ts", F.lit(ts).cast("timestamp"))
    row = solar.with_solar_position(df, "ts", "la", "lo").first()
    assert row.SOLAR_ZENITH_ANGLE == pytest.approx(zenith, abs=0.03)
    assert row.SOLAR_AZIMUTH == pytest.approx(azimuth, abs=0.03)


def test_equinox_day_is_half_light(spark):
    df = spark.sql("select explode(sequence(timestamp'2021-03-20 00:00:00', "
                   "timestamp'2021-03-20 23:50:00', interval 10 minutes)) ts").crossJoin(
                       locations(spark).filter("CITY = 'Kurnool'"))
    out = solar.with_solar_position(df, "ts", "LATITUDE", "LONGITUDE")
    share = out.agg(F.avg((F.col("SOLAR_ZENITH_ANGLE") < 90).cast("int"))).first()[0]
    assert share == pytest.approx(0.5, abs=0.01)


def test_optimal_tilt(spark):
    df = spark.createDataFrame([(30.0,), (120.0,), (-5.0,), (None,), (NAN,)], "z double")
    assert column(df.select(solar.optimal_tilt(F.col("z")).alias("t")), "t") == [
        60.0, 0.0, 90.0, None, None]
