"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from solarspark.operators import filters, impute, lookup, merge
from solarspark.operators.resample import hourly_profile
from solarspark.plans.driver_queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
EAGER_MODELS = {"dq_rf_importance", "dq_gbt_importance", "dq_reg_importance", "dq_search_grid",
                "dq_champion", "dq_rf_scores", "dq_best_params", "dq_best_scores", "dq_baseline_job",
                "dq_tuned_job"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = plan(df)
    return text[:text.index("Initial Plan")] if "Initial Plan" in text else text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER_MODELS))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_filter_and_columns_reach_the_scan(spark):
    df = filters.above(spark.read.parquet(f"{SF_DIR}/events.parquet"), "value", 10.0)
    text = plan(df.select("event_id"))
    assert "GreaterThan(value,10.0)" in text
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text


def test_hourly_profile_is_broadcast_and_readings_stay_put(spark):
    ev = spark.read.parquet(f"{SF_DIR}/events.parquet").select(
        "event_id", "ts", F.col("value").alias("GHI"))
    text = plan(merge.attach_hourly(ev.drop("GHI"), ev, "ts", values=["GHI"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    unbounded = merge.attach_hourly(ev.drop("GHI"), ev, "ts", values=["GHI"], include_year=True)
    assert "hint" not in unbounded._jdf.queryExecution().logical().toString().lower()
    assert "partial_avg" in plan(hourly_profile(ev, "ts", ["GHI"]))


def test_mean_fill_shuffles_the_deduplicated_rows_once(spark):
    li = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    text = final_plan(impute.mean_fill(merge.dedupe(li), ["l_tax", "l_quantity"]))
    assert "ReusedExchange" in text and "Join" not in text


@pytest.fixture
def small_thresholds(spark):
    """Sizes at which test data count as large and skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "12",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed(spark, n=60000):
    """A third of all rows under one key."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("p"),
        F.col("id").cast("double").alias("y"))


def test_hot_key_is_split_when_the_lookup_is_too_big_to_broadcast(spark, small_thresholds):
    rows = skewed(spark)
    means = rows.groupBy("p").agg(F.avg("y").alias("m"))
    out = lookup.join_aggregate(rows, means, "p", keys_from=rows, max_rows=10)
    assert "skew=true" in final_plan(out)
    assert out.count() == 60000


def test_hot_key_is_split_in_the_weather_join(spark, small_thresholds):
    readings = skewed(spark).select("p", F.col("p").alias("t"), "y")
    weather = merge.dedupe(spark.range(1000).select(
        F.col("id").alias("p"), F.col("id").alias("t"), F.lit("s").alias("SOURCE_KEY"),
        F.rand(1).alias("w")))
    out = merge.attach_weather(readings, weather, ("t", "p"))
    assert "skew=true" in final_plan(out)
    assert out.count() == 60000 and out.filter("w is null").isEmpty()


def test_group_mean_leaves_the_readings_unshuffled_while_groups_are_few(spark):
    text = plan(merge.attach_group_mean(skewed(spark), "p", "y", "m"))
    big_side = text[:text.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in big_side and "hashpartitioning" not in big_side


def test_model_months_prune_the_written_table(spark, tmp_path):
    from solarspark.operators.split import by_month
    from solarspark.sources.writers import write_dataset
    ev = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select(
        F.col("l_shipdate").alias("DATETIME"), F.month("l_shipdate").alias("MONTH"), "l_quantity")
    write_dataset(ev, f"{tmp_path}/months", partition_by=["MONTH"])
    for side in by_month(spark.read.parquet(f"{tmp_path}/months")):
        text = plan(side)
        filters_at = text[text.index("PartitionFilters: ["):]
        assert "MONTH" in filters_at[:filters_at.index("]")]


def test_quantiles_count_bins_and_do_not_exchange_values(spark, monkeypatch):
    from solarspark.operators import quantiles
    plans, settle = [], quantiles._settle
    monkeypatch.setattr(quantiles, "_settle", lambda df: plans.append(plan(df)) or settle(df))
    quantiles.exact_quantiles(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"), "l_extendedprice", [0.5], (), 100)
    assert any("partial_count" in text and "bin#" in text for text in plans)
    for text in plans:
        assert not [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "__v" in line]


def test_weather_check_shares_the_shuffle_of_the_join(spark):
    left = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    right = merge.with_unique_key(spark.range(100).select(F.col("id").alias("k")), ["k"])
    text = plan(left.hint("merge").join(right, "k", "left"))
    assert text.count("hashpartitioning(k") == 2


def test_an_audit_scans_a_source_once(spark):
    from solarspark.operators import audit
    li = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    text = final_plan(audit.profile(li, ["l_quantity", "l_tax"]))
    assert text.count("FileScan parquet") == 1 and "Expand" not in text
    assert "partial_count" in text and "partial_stddev" in text


def test_tables_laid_out_by_key_join_without_a_shuffle(spark, small_thresholds, tmp_path, monkeypatch):
    from solarspark.sources import layout
    monkeypatch.setattr(layout, "ROWS_PER_BUCKET", 500)
    keys = ("p", "t")
    readings = spark.range(3000).select((F.col("id") % 50).alias("p"), (F.col("id") % 77).cast("int").alias("t"),
                                        F.col("id").cast("double").alias("y"))
    weather = spark.range(50 * 77).select((F.col("id") % 50).alias("p"), (F.col("id") / 50).cast("int").alias("t"),
                                          F.col("id").alias("w"))
    folder = f"{tmp_path}/tables"
    buckets = layout.lay_out_together({"readings": readings, "weather": weather}, folder, keys)
    assert buckets == 8

    def joined():
        left, right = (layout.open_by_key(spark, f"{folder}/{n}", keys, buckets) for n in ("readings", "weather"))
        return left.join(merge.with_unique_key(right, ["t", "p"]), ["t", "p"], "left")

    expected = sorted(map(tuple, readings.join(weather, ["t", "p"], "left").collect()))
    for again in range(2):
        text = final_plan(joined())
        assert "Exchange" not in text and "SortMergeJoin" in text
        assert sorted(map(tuple, joined().select("t", "p", "y", "w").collect())) == expected
        # Another session knows the files only.
        for name in ("readings", "weather"):
            spark.sql(f"DROP TABLE {layout._name(f'{folder}/{name}')}")
    layout.write_by_key(weather.limit(10), f"{folder}/weather", keys, buckets)
    assert layout.open_by_key(spark, f"{folder}/weather", keys, buckets).count() == 10


def test_an_audit_shuffles_rows_without_sums(spark):
    from solarspark.operators import audit
    li = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    text = final_plan(audit.profile(li, ["l_quantity", "l_tax"]))
    assert text.index("partial_stddev") < text.index("Exchange hashpartitioning")


def _readings(spark):
    return spark.createDataFrame(
        [("2020-05-15 00:00:00", i % 2, f"s{i % 7}", 1.0, 2.0, float(i % 7), 3.0) for i in range(20)],
        "DATE_TIME string, PLANT_ID int, SOURCE_KEY string, DC_POWER double, AC_POWER double,"
        " DAILY_YIELD double, TOTAL_YIELD double")


def test_dropping_copies_and_joining_weather_share_a_shuffle(spark):
    from solarspark.plans import jobs
    readings = jobs.clean_generation(_readings(spark))
    weather = spark.range(3).select(F.col("id").cast("int").alias("PLANT_ID"), F.lit("s").alias("SOURCE_KEY"),
                                    F.timestamp_seconds("id").cast("timestamp_ntz").alias("DATETIME"))
    alone, joined = plan(readings), plan(merge.attach_weather(readings, weather.hint("merge")))
    assert readings.count() == 14 and "SortMergeJoin" in joined
    assert joined.count("Exchange hashpartitioning") == alone.count("Exchange hashpartitioning") + 1


def test_laying_out_stages_nothing(spark, tmp_path, monkeypatch):
    from solarspark.plans import jobs
    from solarspark.sources import layout
    monkeypatch.setattr(layout, "stage", None)
    monkeypatch.setattr(layout, "ROWS_PER_BUCKET", 5)
    weather = spark.sql("SELECT '2020-05-15 00:00:00' DATE_TIME, 1 PLANT_ID, 's' SOURCE_KEY, 1.0D AMBIENT_TEMPERATURE,"
                        " 2.0D MODULE_TEMPERATURE, 3.0D IRRADIATION")
    buckets = jobs.lay_out(_readings(spark), weather, f"{tmp_path}/tables")
    assert buckets == 4 and spark.read.parquet(f"{tmp_path}/tables/generation").count() == 14
    for name in ("generation", "weather"):
        spark.sql(f"DROP TABLE {layout._name(f'{tmp_path}/tables/{name}')}")


def test_group_mean_shares_the_shuffle_of_the_rows(spark):
    from solarspark.plans import jobs
    text = final_plan(jobs.clean_generation(_readings(spark).withColumn(
        "PLANT_ID", F.when(F.col("TOTAL_YIELD") > 0, F.col("PLANT_ID")))))
    assert len([line for line in text.splitlines() if "REPARTITION_BY_COL" in line and "Reused" not in line]) == 1
