"""Landing in batches gives what one load gives."""

import os
import re

import pytest
from pyspark.sql import functions as F

import fixtures
from solarspark.plans import driver_queries, incremental, jobs
from solarspark.sources import layout, readers


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    paths = fixtures.write_sources(tmp_path_factory.mktemp("raw"))
    generation = readers.read_generation(spark, paths["generation"])
    odd = spark.sql("select cast(null as string) DATE_TIME, 1 PLANT_ID, 'x' SOURCE_KEY, 9d DC_POWER, 9d AC_POWER,"
                    " 9d DAILY_YIELD, 9d TOTAL_YIELD union all select 'never', null, 'y', 1d, double('nan'), null, 2d")
    return {"generation": generation.unionByName(odd).unionByName(odd),
            "weather": readers.read_weather(spark, paths["weather"]),
            "irradiance": readers.read_irradiance(spark, paths["irradiance"])}


def rows_of(df):
    doubles = [c for c, t in df.dtypes if t in ("double", "float")]
    rounded = df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in doubles})
    return sorted(map(str, rounded.collect()))


def may(df):
    return F.contains("DATE_TIME", F.lit("05-2020")) | F.contains("DATE_TIME", F.lit("2020-05"))


def test_batches_give_what_one_load_gives(spark, raw, tmp_path):
    store, gen, wx = f"{tmp_path}/store", raw["generation"], raw["weather"]
    first, second = gen.filter(may(gen)), gen.filter(~may(gen) | F.col("DATE_TIME").isNull() | F.contains("DATE_TIME", F.lit("31")))
    new = {r.MONTH: r.rows for r in incremental.land_generation(first, store).collect()}
    assert set(new) == {5}
    june = {r.MONTH: r.rows for r in incremental.land_generation(second, store).collect()}
    assert 5 not in june and june[6] > 0 and june[None] == 1
    for lot in (wx.filter("PLANT_ID = 1"), wx):
        incremental.land_weather(lot, store)
    for landed, whole in (
            (incremental.landed_generation(spark, store), jobs.clean_generation(gen)),
            (incremental.landed_weather(spark, store), jobs.clean_weather(wx)),
            (incremental.preprocess_landed(spark, store, raw["irradiance"]),
             jobs.preprocess(gen, wx, raw["irradiance"]))):
        assert landed.columns == whole.columns
        assert rows_of(landed) == rows_of(whole)


def test_landing_again_changes_nothing_and_other_months_are_left_alone(spark, raw, tmp_path):
    store, gen = f"{tmp_path}/store", raw["generation"]
    incremental.land_generation(gen, store)
    folder = tmp_path / "store" / "generation"

    def files(month):
        return {p: p.stat().st_mtime_ns for p in folder.glob(f"*/MONTH={month}/*.parquet")}

    before, may_files = rows_of(incremental.landed_generation(spark, store)), files(5)
    june = gen.filter(F.contains("DATE_TIME", F.lit("2020-06")))
    assert incremental.land_generation(june, store).count() == 0
    more = june.limit(1).withColumns({"SOURCE_KEY": F.lit("new"), "DAILY_YIELD": F.lit(None).cast("double")})
    assert incremental.land_generation(more, store).first().rows == 1
    assert files(5) == may_files and len(may_files) > 0
    after = rows_of(incremental.landed_generation(spark, store))
    assert len(after) == len(before) + 1
    assert after == rows_of(jobs.clean_generation(gen.unionByName(more)))


def test_state_is_renewed_after_a_failure_between_rows_and_state(spark, raw, tmp_path, monkeypatch):
    store, gen = f"{tmp_path}/store", raw["generation"]
    incremental.land_generation(gen.filter("PLANT_ID = 1"), store)
    with monkeypatch.context() as m:
        m.setattr(incremental, "valid", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.land_generation(gen, store)
    incremental.land_generation(gen, store)
    assert rows_of(incremental.landed_generation(spark, store)) == rows_of(jobs.clean_generation(gen))


def test_only_the_batch_is_shuffled_and_the_weather_joins_in_place(spark, raw, tmp_path, monkeypatch):
    store, gen, plans = f"{tmp_path}/store", raw["generation"], []
    real = layout.add_by_month

    def seen(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        real(df, *args, **kwargs)

    monkeypatch.setattr(layout, "add_by_month", seen)
    for lot in (gen.filter("PLANT_ID = 1"), gen, gen):
        incremental.land_generation(lot, store)
    incremental.land_weather(raw["weather"], store)
    assert [p.count("Exchange ") for p in plans] == [1, 1, 1, 1]
    joined = incremental.landed_generation(spark, store).join(
        incremental.landed_weather(spark, store).drop("SOURCE_KEY").hint("merge"), ["DATETIME", "PLANT_ID"], "left")
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and not re.search(r"Exchange hashpartitioning\([^)]*DATETIME", text)


def test_a_landing_without_new_rows_leaves_the_state_alone(spark, raw, tmp_path):
    store, gen = f"{tmp_path}/store", raw["generation"]
    incremental.land_generation(gen, store)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    assert incremental.land_generation(gen, store).isEmpty()
    parts = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("MONTH=*/*.parquet")}
    assert parts == files


def test_a_store_that_has_outgrown_its_buckets_gets_more(spark, raw, tmp_path, monkeypatch):
    store, gen = f"{tmp_path}/store", raw["generation"]
    incremental.land_generation(gen, store)
    whole = rows_of(incremental.landed_generation(spark, store))
    assert layout.newest(spark, f"{store}/generation") == 2
    monkeypatch.setattr(layout, "ROWS_PER_BUCKET", 5)
    more = gen.limit(1).withColumn("SOURCE_KEY", F.lit("new"))
    assert [r.rows for r in incremental.land_generation(more, store).collect()] == [1]
    assert layout.newest(spark, f"{store}/generation") > 4
    assert [p.name for p in (tmp_path / "store" / "generation").glob("rows-2")] == []
    assert rows_of(incremental.landed_generation(spark, store)) == rows_of(jobs.clean_generation(gen.unionByName(more)))
    assert len(whole) + 1 == incremental.landed_generation(spark, store).count()


def test_query_lands_the_same_weather_in_every_batch(spark, tmp_path, monkeypatch):
    # Sums of doubles depend on the order in which tasks hand them on; here they never come out alike.
    ids = spark.range(12)
    ids.select(F.col("id").alias("o_orderkey"), (F.col("id") % 6).alias("o_custkey"), (F.col("id") * 0.1).alias("o_totalprice"),
               F.lit("2020-05-15").cast("timestamp_ntz").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    ids.select(F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 6).alias("l_suppkey"),
               F.lit(2).alias("l_linenumber"), F.lit(5.0).alias("l_quantity"), F.lit(9.0).alias("l_extendedprice"),
               F.lit(0.5).alias("l_discount"), F.lit(0.5).alias("l_tax"),
               F.lit("2020-05-15").cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    ids.select(F.col("id").alias("event_id"), F.lit("2024-05-15").cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"),
               F.lit("view").alias("event_type"), F.lit(1.0).alias("value")).write.parquet(f"{tmp_path}/events.parquet")
    last_bits = F.udf(lambda mean: mean + os.urandom(1)[0] * 1e-9, "double").asNondeterministic()
    real = driver_queries.weather_source
    monkeypatch.setattr(driver_queries, "weather_source",
                        lambda *a: real(*a).withColumn("IRRADIATION", last_bits("IRRADIATION")))
    rows = driver_queries.incremental(spark, str(tmp_path)).collect()
    # Order 0 has no time.
    assert sorted(r.PLANT_ID for r in rows) == sorted(i % 6 for i in range(1, 12))
    assert all(r.IRRADIATION is not None for r in rows)
