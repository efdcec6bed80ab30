import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures
from solarspark.operators import quarantine
from solarspark.schemas import locations
from solarspark.sources import ingest, readers, writers


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    return fixtures.write_sources(tmp_path_factory.mktemp("raw"))


def test_generation_and_weather_scans(spark, sources):
    gen = readers.read_generation(spark, sources["generation"])
    assert gen.count() == sources["generation_rows"]
    assert dict(gen.dtypes)["DATE_TIME"] == "string"
    assert gen.select("PLANT_ID").distinct().count() == 2
    wx = readers.read_weather(spark, sources["weather"])
    assert wx.filter("IRRADIATION is null").count() == 1


def test_irradiance_scan(spark, sources):
    df = readers.read_irradiance(spark, sources["irradiance"])
    parts = {tuple(r) for r in df.select("CITY", "YEAR").distinct().collect()}
    assert parts == {("Gandikota", 2020), ("Kadapa", 2020), ("Gandikota", 2019)}
    first = df.filter("CITY = 'Gandikota' and YEAR = 2020").agg(F.min("DATETIME")).first()[0]
    assert first == dt.datetime(2020, 5, 28)


def test_other_header_order_is_refused_or_matched_by_name(spark, tmp_path):
    header = fixtures.IRRADIANCE_HEADER
    rows = fixtures.irradiance_rows("A", 1.0, 2.0, 2020, fixtures.DAYS[:1])
    fixtures.write(tmp_path / "A_2020.csv", header, rows)
    keep = [i for i, c in enumerate(header) if c != "dni"][::-1]
    fixtures.write(tmp_path / "B_2021.csv", [header[i] for i in keep],
                   [[r[i] for i in keep] for r in rows])
    with pytest.raises(Exception, match="CSV header"):
        readers.read_irradiance(spark, str(tmp_path)).select("*").collect()
    df = readers.read_irradiance(spark, str(tmp_path), by_header=True)
    a, b = (df.filter(F.col("CITY") == c).orderBy("DATETIME").collect() for c in "AB")
    assert len(a) == len(b) == 24 and {r.YEAR for r in b} == {2021}
    assert [r.ghi for r in a] == [r.ghi for r in b] and [r.DATETIME for r in a] == [
        r.DATETIME for r in b]
    assert all(r.dni is None for r in b) and any(r.dni for r in a)


def test_malformed_values_are_set_apart_whatever_is_read(spark, tmp_path):
    header = ["DATE_TIME", "PLANT_ID", "SOURCE_KEY", "DC_POWER", "AC_POWER", "DAILY_YIELD", "TOTAL_YIELD"]
    good = ["2020-05-29 00:00:00", 1, "a", 1.5, 2.5, 3.5, 4.5]
    rows = [good, [None, 1, "b", None, 1, 1, 1], [*good[:3], "1,5x".replace(",", ";"), *good[4:]], good[:4],
            [*good[:6], "n/a"], [good[0], "seven", *good[2:]]]
    fixtures.write(tmp_path / "one.csv", header, rows)
    fixtures.write(tmp_path / "two.csv", header, [good] * 3)
    df = readers.read_generation(spark, str(tmp_path), keep_malformed=True)
    counts = {r.file: (r.total, r.malformed) for r in quarantine.malformed_counts(df).collect()}
    assert counts == {"one.csv": (6, 4), "two.csv": (3, 0)}
    kept = quarantine.well_formed(df)
    assert kept.columns == header and kept.count() == 5
    assert kept.select("SOURCE_KEY").count() == 5 and kept.agg(F.sum("TOTAL_YIELD")).first()[0] == 19
    lines = {r.line for r in quarantine.malformed_rows(df).collect()}
    assert lines == {",".join(map(str, r)) for r in rows[2:]}
    assert readers.read_generation(spark, str(tmp_path)).count() == 9
    assert quarantine.well_formed(kept) is kept


def test_malformed_values_by_header(spark, tmp_path):
    rows = fixtures.irradiance_rows("A", 1.0, 2.0, 2020, fixtures.DAYS[:1])
    header = fixtures.IRRADIANCE_HEADER
    fixtures.write(tmp_path / "A_2020.csv", header, [[*rows[0][:1], "bad", *rows[0][2:]], *rows[1:]])
    fixtures.write(tmp_path / "B_2020.csv", header[::-1], [["?", *r[:0:-1], r[0]][:13] if i == 3 else r[::-1]
                                                           for i, r in enumerate(rows)])
    df = readers.read_irradiance(spark, str(tmp_path), by_header=True, keep_malformed=True)
    assert {r.file: (r.total, r.malformed) for r in quarantine.malformed_counts(df).collect()} == {
        "A_2020.csv": (24, 1), "B_2020.csv": (24, 1)}
    assert quarantine.well_formed(df).count() == 46
    plain = readers.read_irradiance(spark, str(tmp_path), by_header=True)
    assert plain.count() == 48 and quarantine.MALFORMED not in plain.columns


def test_city_files_are_named_and_read_back(spark, tmp_path):
    df = spark.range(100).select(F.timestamp_seconds(F.col("id") * 3600).alias("DATETIME"), F.col("id").cast("double").alias("ghi"),
                                 F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("CITY"), F.lit(2020).alias("YEAR"))
    writers.write_city_files(df.filter("CITY = 'A'"), f"{tmp_path}/out")
    writers.write_city_files(df.filter("CITY = 'B'"), f"{tmp_path}/out")
    names = {p.name[:7] for p in (tmp_path / "out").glob("*.csv")}
    assert names == {"A_2020_", "B_2020_"}
    back = readers.read_irradiance(spark, f"{tmp_path}/out", by_header=True)
    assert {tuple(r) for r in back.groupBy("CITY", "YEAR").agg(F.sum("ghi")).collect()} == {("A", 2020, 2450.0), ("B", 2020, 2500.0)}


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    rows = fixtures.irradiance_rows("A", 1.0, 2.0, 2020, fixtures.DAYS[:1])
    jobs = []
    for k, n in enumerate((2, 12)):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            header = fixtures.IRRADIANCE_HEADER
            keep = [c for c in range(len(header)) if header[c] != "dni" or i % 2]
            fixtures.write(folder / f"C{i}_2020.csv", [header[c] for c in keep], [[r[c] for c in keep] for r in rows])
        spark.sparkContext.setJobGroup(f"scan{k}", "scan")
        assert readers.read_irradiance(spark, str(folder), by_header=True).count() == 24 * n
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"scan{k}")))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs[0] == jobs[1]


def test_absent_path_is_none(spark, tmp_path):
    assert readers.read_if_exists(lambda: readers.read_dataset(spark, f"{tmp_path}/no")) is None


def test_missing_and_landed_make_up_expected(spark, tmp_path):
    expected = ingest.expected_partitions(locations(spark))
    assert expected.count() == 45
    landed = spark.createDataFrame([("Kadapa", 2016), ("Tirupati", 2024)], "CITY string, YEAR int")
    writers.land_irradiance(landed.withColumn("ghi", F.lit(1.0)), f"{tmp_path}/land")
    back = readers.read_dataset(spark, f"{tmp_path}/land")
    missing = ingest.missing_partitions(expected, back)
    assert missing.count() == 43
    assert missing.select("CITY", "YEAR").union(back.select("CITY", "YEAR")).distinct().count() == 45


def test_enrichment_adds_place_and_sun(spark):
    df = spark.sql("select timestamp'2020-06-21 06:50:00' DATETIME, 'Gandikota' CITY, 1.0 ghi")
    row = ingest.enrich_irradiance(df, locations(spark)).first()
    assert (row.LATITUDE, row.LONGITUDE) == (14.813, 78.286)
    assert row.OPTIMAL_TILT == pytest.approx(90 - row.SOLAR_ZENITH_ANGLE)
    assert row.OPTIMAL_TILT > 80


def test_partitioned_write_splits_and_packs(spark, tmp_path):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 4))
        .alias("CITY"), F.lit(2020).alias("YEAR"), "id")
    writers.land_irradiance(df, f"{tmp_path}/out")
    back = readers.read_dataset(spark, f"{tmp_path}/out")
    assert back.count() == 3000 and back.agg(F.sum("id")).first()[0] == 3000 * 2999 // 2
    files = len([p for p in (tmp_path / "out").rglob("*.parquet")])
    assert files <= 8


def test_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 0.2), ("a", 0.8)], "Feature string, Importance double")
    writers.write_csv(df, f"{tmp_path}/one")
    files = list((tmp_path / "one").glob("part-*.csv"))
    assert files and all(f.read_text().startswith("Feature,Importance\n") for f in files)
    back = spark.read.option("header", True).csv(f"{tmp_path}/one")
    assert sorted(tuple(r) for r in back.collect()) == [("a", "0.8"), ("b", "0.2")]


def test_loading_again_replaces_a_partition(spark, tmp_path):
    df = spark.createDataFrame([("a", 2020, 1), ("b", 2020, 2)], "CITY string, YEAR int, v int")
    writers.land_irradiance(df, f"{tmp_path}/out")
    writers.land_irradiance(df.filter("CITY = 'a'").withColumn("v", F.lit(9)), f"{tmp_path}/out")
    rows = readers.read_dataset(spark, f"{tmp_path}/out").collect()
    assert sorted((r.CITY, r.v) for r in rows) == [("a", 9), ("b", 2)]
