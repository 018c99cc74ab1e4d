"""Plans that must hold when one key has a third of all rows."""

import pytest
from pyspark.sql import functions as F

from roadlake.operators import features, gold, ids, news, quality, rainfall, serving
from roadlake.session import materialize
from roadlake.sources import events
from tests.conftest import plan, values


@pytest.fixture
def small_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


def hot(n):
    return F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % n))


def test_hot_road_is_split_in_the_priority_join(spark, small_partitions):
    reports = spark.range(0, 60000, 1, 8).select(
        F.col("id").cast("string").alias("report_id"), hot(50).alias("road_name"), F.lit("d").alias("district"),
        F.lit("x").alias("damage_type"), (F.col("id") % 100).cast("int").alias("severity_score"),
    )
    empty = spark.createDataFrame([], "road_name string, district string, vehicle_count int, sentiment_score double")
    scored = gold.priority_score(reports, empty, empty, empty, F.lit("2024-02-01").cast("timestamp"))
    text = final_plan(scored)
    assert "skew=true" in text
    assert scored.count() == 60000 and scored.filter("complaint_score <> 100").count() == 0


def test_hot_district_is_split_in_the_feature_join(spark, small_partitions):
    rows = spark.range(0, 60000, 1, 8).select(
        F.col("id").cast("string").alias("accident_id"), hot(20).alias("district"), F.lit("r").alias("road_name"),
        F.current_timestamp().alias("event_time"), F.lit("High").alias("severity"), F.lit(1).alias("vehicle_count"), F.lit(0).alias("casualties"),
    )
    reports = spark.range(30).select(hot(20).alias("district"), F.lit(5).alias("severity_score"))
    context = features.road_features(reports).withColumns({
        "avg_speed": F.lit(1.0), "avg_vehicle_count": F.lit(1.0), "traffic_event_count": F.lit(1), "rainfall_mm": F.lit(1.0),
        "temperature_c": F.lit(1.0), "humidity": F.lit(1.0), "weather_condition": F.lit("x"),
    })
    joined = features.enrich(rows, materialize(context, "context"))
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60000


def test_aggregates_are_partial_before_the_shuffle(spark):
    rows = spark.range(100).select(
        hot(9).alias("road_name"), hot(5).alias("district"), F.lit("negative").alias("sentiment"), F.lit(1).alias("complaint_count"),
        F.lit("low").alias("severity_level"), F.lit("crack").alias("damage_type"), F.current_timestamp().alias("event_time"),
        F.lit(3).alias("severity_score"), F.col("id").cast("string").alias("event_id"),
    )
    for df in (
        news.road_summary(rows), gold.hotspots(rows), gold.district_health(rows), serving.stats(rows, F.current_date()),
        quality.metrics(rows, "silver", "t", ["road_name"]),
    ):
        text = plan(df)
        below = text[text.rindex("Exchange"):]
        assert "partial_" in below


def test_rolling_rain_has_no_single_task(spark):
    days = spark.range(0, 4000).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int") * 3).alias("date"), F.lit(0.5).alias("precipitation_sum"))
    rolled = rainfall.rolling(days)
    assert "SinglePartition" not in plan(rolled)
    assert rolled.count() == 4000
    tail = values(rolled.orderBy(F.desc("date")).limit(1), "rainfall_7d", "rainfall_30d", "rainfall_90d")
    assert tail == [(1.5, 5.0, 15.0)]


def test_ids_use_a_bounded_offset_table(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("event_id"), F.timestamp_seconds(F.lit(0)).alias("event_time"))
    numbered = ids.assign_report_ids(rows, partitions=5)
    assert numbered.select("report_id").distinct().count() == 1000
    assert "BroadcastHashJoin" in plan(numbered)


def test_partitioned_write_rebalances(spark):
    rows = spark.range(10).withColumn("day", F.lit("a")).hint("rebalance", "day")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(rows)
    assert events.partition_columns("traffic") == ["valid", "date_partition"]
