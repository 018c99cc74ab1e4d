from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadlake import rules, schemas
from roadlake.operators import clean, gold
from roadlake.plans import silver
from tests.conftest import details, plan, values

T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3))
REPORT = "event_id string, event_time timestamp, report_id string, road_name string, district string, latitude double, longitude double"


def test_newest_row_wins(frame):
    df = frame(
        "report_id string, event_time timestamp, event_id string, x int",
        ("a", T1, "e1", 1), ("a", T2, "e2", 2), ("a", T2, "e3", 3), ("b", None, "e4", 4), ("b", T1, "e5", 5), (None, T3, "e6", 6),
    )
    assert sorted(values(clean.latest_per_key(df, ["report_id"]), "report_id", "x")) == [("a", 3), ("b", 5)]


def test_copies_with_equal_order_do_not_depend_on_partitioning(spark, frame):
    rows = [("k", T1, i) for i in range(50)]
    df = frame("event_id string, event_time timestamp, x int", *rows)
    picks = {
        values(clean.latest_per_key(df.repartition(n).sortWithinPartitions(F.rand(n)), ["event_id", "event_time"]), "x")[0]
        for n in (1, 3, 7)
    }
    assert len(picks) == 1


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("report_id"),
        F.col("id").cast("timestamp").alias("event_time"), F.col("id").cast("string").alias("event_id"),
    )
    unique = clean.latest_per_key(df, ["report_id"])
    text = plan(unique)
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")
    assert unique.count() == 67 and values(unique.filter("report_id = 'hot'"), "event_id") == [("99",)]


def test_only_copies_are_sorted(spark, frame):
    schema = "event_id string, event_time timestamp, x int, y int"
    df = frame(schema, ("a", T1, 1, 9), ("a", T2, 2, 8), ("a", T2, 3, 7), ("b", T1, 4, None), (None, T1, 5, 5), (None, T1, 6, 5), (None, None, 7, 5), ("c", None, 8, 5))
    for keys, nulls, few, used in (
        (["event_id"], True, 9, None), (["event_id", "event_time"], False, 9, None), (["event_id"], True, 9, ["y", "event_id"]),
        (["event_id"], True, 0, ["x"]), (["event_id", "x"], True, 9, ["x"]), (["event_id"], True, 9, ["event_id"]),
    ):
        kept = clean.latest_of_repeated(df, keys, null_keys=nulls, used=used, few=few)
        whole = clean.latest_per_key(df, keys, null_keys=nulls).select(*(used or df.columns))
        assert sorted(values(kept), key=str) == sorted(values(whole), key=str)
        assert kept.columns == whole.columns
    text = plan(clean.latest_of_repeated(df, ["event_id"]))
    assert "LeftAnti" in text and "LeftSemi" in text.split("WindowGroupLimit")[-1]
    # no copies: nothing is shuffled
    rows = frame(schemas.EVENT["accidents"], *[(f"e{i}", T1, f"a{i}", "r", "d", None, None, "low", 1, 2, None) for i in range(9)])
    enriched = silver.clean_enriched("accidents", rows)
    assert "Window" not in plan(enriched) and enriched.count() == 9


def test_unused_columns_are_not_shuffled(spark, frame, tmp_path):
    path = str(tmp_path / "raw")
    rows = [(f"e{i % 7}", T1 if i % 2 else T2, f"r{i % 3}", f"road {i}", "gubeng", i / 9, 1.0) for i in range(20)]
    frame(REPORT, *rows).write.parquet(path)
    reports = spark.read.parquet(path)
    used = silver.clean_batch("reports", reports, ["event_id", "event_time"])
    assert sorted(values(used)) == sorted(values(silver.clean_batch("reports", reports), "event_id", "event_time"))
    assert "road_name" not in details(used)


def test_validity_comes_before_deduplication(frame):
    df = frame(
        REPORT,
        ("e1", T1, "r", " jl. RAYA  darmo ", " gubeng", -7.3, 112.7),
        ("e2", T2, "r", "jl. raya", "gubeng", 95.0, 112.7),
        ("e3", T1, "s", "x", "y", None, 112.7),
    )
    assert values(silver.clean_batch("reports", df), "event_id", "road_name", "district") == [("e1", "Jl. Raya  Darmo", "Gubeng")]


def test_deduplication_is_idempotent(frame):
    df = frame(REPORT, ("e1", T1, "r", "a", "b", 0.0, 0.0), ("e2", T2, "r", "a", "b", 0.0, 0.0), ("e3", T1, "s", "a", "b", 0.0, 0.0))
    once = silver.clean_batch("reports", df)
    assert sorted(values(silver.clean_batch("reports", once))) == sorted(values(once))


def test_incremental_equals_full(frame):
    df = frame(REPORT, *[(f"e{i}", datetime(2024, 1, 1 + i % 20), f"r{i % 7}", "a", "b", 95.0 if i % 5 == 0 else 1.0, 1.0) for i in range(60)])
    full = silver.clean_batch("reports", df)
    for day in (5, 12, 18):
        old = silver.clean_batch("reports", df.filter(F.dayofmonth("event_time") < day))
        merged = silver.refresh_batch("reports", old, df.filter(F.dayofmonth("event_time") >= day))
        assert sorted(values(merged, "event_id")) == sorted(values(full, "event_id"))


def test_news_keeps_every_road_of_an_article(frame):
    schema = "event_id string, event_time timestamp, title string, road_name string, district string, sentiment_score double"
    df = frame(schema, ("n", T1, "t", "A", "gubeng", None), ("n", T1, "t", "B", "gubeng", 0.5), ("n", T2, "t", "A", "gubeng", 0.1), ("n", T1, "u", None, None, None))
    rows = silver.clean_enriched("news", df)
    assert sorted(values(rows, "road_name", "sentiment_score"), key=str) == [("A", 0.1), ("B", 0.5), (None, 0.0)]


def test_enriched_rows_without_time_or_id_stay(frame):
    schema = "event_id string, event_time timestamp, road_name string, district string, average_speed_kmh double, congestion_level string, vehicle_count int"
    df = frame(schema, ("a", None, "r", "gubeng", 1.0, "low", 1), ("a", T1, "r", "gubeng", 1.0, "low", 2), (None, T1, "r", "gubeng", 1.0, "low", 3),
               ("a", T1, "r", "gubeng", 1.0, "low", 2))
    assert sorted(values(silver.clean_enriched("traffic", df), "vehicle_count")) == [(1,), (2,), (3,)]
    assert sorted(values(silver.clean_batch("traffic", df), "vehicle_count")) == [(2,)]


def test_fill_mean_and_constants(frame):
    schema = "event_id string, rainfall_mm double, temperature_c double, humidity double"
    df = frame(schema, ("a", None, 20.0, None), ("b", 1.0, None, 0.9), ("c", 2.0, 25.0, 0.1))
    rows = clean.fill_gaps(df, "weather").orderBy("event_id")
    assert values(rows) == [("a", 0.0, 20.0, 0.5), ("b", 1.0, 22.5, 0.9), ("c", 2.0, 25.0, 0.1)]
    assert "rossJoin" not in plan(rows) and "NestedLoop" not in plan(rows)


def test_strategy_table(frame):
    schema = "rainfall_mm double, temperature_c double, humidity double, condition string"
    rows = clean.impute(frame(schema, (None, None, None, None)), rules.FILL_STRATEGY["weather"])
    assert values(rows) == [(0.0, None, None, "Unknown")]


def test_means_take_small_and_large_values_whole(frame):
    weather = frame("district string, rainfall_mm double", ("A", 0.00004), ("A", 0.00003), ("A", 2e14), ("B", 1e-5), ("B", None))
    assert dict(values(gold.district_rainfall(weather))) == {"A": pytest.approx(2e14 / 3), "B": 1e-5}
    filled = clean.fill_mean(frame("temperature_c double", 1e-5, 3e-5, None), "temperature_c")
    assert values(filled)[2] == (pytest.approx(2e-5),)


@pytest.mark.parametrize("feed", sorted(schemas.EVENT))
def test_redelivered_rows_have_one_survivor(spark, feed):
    """Copies with equal times: any order, any partitioning and a refresh give the same row."""
    fields = schemas.EVENT[feed].fields
    numbers = {"double": float, "int": int, "bigint": int}

    def row(n):
        return [
            datetime(2024, 1, 1) if f.dataType.simpleString() == "timestamp" else "k" if f.name.endswith("_id") or f.name == "road_name"
            else numbers[f.dataType.simpleString()](n % 3) if f.dataType.simpleString() in numbers else f"x{n % 2}" for f in fields
        ]

    rows = [row(n) for n in range(12)]
    found = set()
    for order in (rows, rows[::-1], rows[5:] + rows[:5]):
        df = spark.createDataFrame(order, schemas.EVENT[feed]).repartition(3)
        found |= set(values(silver.clean_batch(feed, df)))
        known = silver.clean_batch(feed, spark.createDataFrame(order[:6], schemas.EVENT[feed]))
        found |= set(values(silver.refresh_batch(feed, known, spark.createDataFrame(order[6:], schemas.EVENT[feed]))))
    assert len(found) == 1


def test_partition_columns(frame):
    df = frame("event_time timestamp, district string", (datetime(2024, 3, 5, 23), "Gunung Anyar"), (None, None))
    rows = clean.add_partition_keys(clean.add_date_parts(df))
    assert values(rows, "year", "month", "day", "date_partition", "district_partition") == [
        (2024, 3, 5, "2024-03-05", "gunung_anyar"), (None, None, None, None, None),
    ]
    region = df.limit(1).withColumn("batch_time", F.col("event_time"))
    assert values(region.select(clean.partition_path())) == [
        ("year=2024/month=03/day=05/country=ID/province=JawaTimur/city=Surabaya",)
    ]
    assert values(clean.add_region_parts(region), "year", "city") == [(2024, "Surabaya")]


def test_event_time(frame):
    now = F.lit("2000-01-01").cast("timestamp")
    df = frame("x string", "2024-03-05T10:00:00", "2024-03-05T10:00:00+07:00", "oops", None)
    assert values(df.select(clean.event_time("x", now))) == [
        (datetime(2024, 3, 5, 10),), (datetime(2024, 3, 5, 3),), (datetime(2000, 1, 1),), (datetime(2000, 1, 1),),
    ]


def test_filters_reach_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "raw")
    frame(REPORT + ", unused string", ("e1", T1, "r", "a", "b", 0.0, 0.0, "u")).write.parquet(path)
    text = details(silver.clean_batch("reports", spark.read.parquet(path)).select("report_id", "road_name"))
    pushed = text.split("PushedFilters")[1].split("\n")[0]
    assert "IsNotNull(report_id)" in pushed and "GreaterThanOrEqual(latitude,-90.0)" in pushed
    # the columns of the table decide between copies of one time; nothing else is read
    assert "unused" not in text.split("ReadSchema")[1].split("\n")[0]


def test_data_quality_score(frame):
    schema = REPORT + ", village string, damage_type string, severity_score int, confidence double, status string"
    df = frame(schema, ("e", T1, "r", "a", "gubeng", -7.3, 0.0, "v", "crack", None, 0.5, "Pending"))
    rows = silver.clean_enriched("reports", df)
    assert values(rows, "data_quality_score", "latitude", "longitude", "severity_score", "damage_type") == [
        (0.5, -7.3, 112.795, 0, "Longitudinal Crack")
    ]
