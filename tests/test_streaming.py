import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadlake import schemas
from roadlake.operators import features, gold
from roadlake.sources import events
from roadlake.streaming import jobs
from tests.conftest import values


@pytest.fixture
def feed(spark, tmp_path):
    """feed(lines, lines, …): one input file per micro-batch."""

    def make(*files, name="in"):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        for i, lines in enumerate(files):
            path = folder / f"{i}.txt"
            path.write_text("\n".join(lines) + "\n")
            os.utime(path, (1_700_000_000 + i,) * 2)  # files are read oldest first
        return jobs.read_stream(spark, "text", path=str(folder), maxFilesPerTrigger="1")

    return make


def report(n, when="2024-01-02T00:00:00", **more):
    row = {"event_id": f"e{n}", "event_time": when, "report_id": f"r{n}", "road_name": "A", "district": "Gunung Anyar",
           "damage_type": "D40_Pothole", "severity_score": 10 * n, "confidence": 0.5, **more}
    return json.dumps(row)


def test_raw_table_and_dead_letters(spark, feed, tmp_path):
    messages = feed([report(1), "{broken", report(2, colour="red")], [report(3, when="bad time"), report(4, severity_score="high")])
    as_of = F.lit("2024-02-01").cast("timestamp")
    jobs.finish([jobs.start_bronze(messages, "reports", str(tmp_path), as_of)], timeout=120)
    rows = events.read_raw(spark, str(tmp_path), "reports").orderBy("event_id")
    assert values(rows, "event_id", "event_time", "status") == [
        ("e1", datetime(2024, 1, 2), "Pending"), ("e2", datetime(2024, 1, 2), "Pending"), ("e3", datetime(2024, 2, 1), "Pending"),
    ]
    table = spark.read.parquet(f"{tmp_path}/raw/reports")
    assert sorted(values(jobs.dead_letters(table))) == [(report(4, severity_score="high"),), ("{broken",)]
    stored = jobs.valid_rows(table).filter("event_id = 'e1'")
    assert values(stored, "source", "district_partition", F.col("date_partition").cast("string")) == [
        ("kafka_road_reports", "gunung_anyar", "2024-01-02")
    ]
    # a second run finds nothing new
    jobs.finish([jobs.start_bronze(messages, "reports", str(tmp_path), as_of)], timeout=120)
    assert events.read_raw(spark, str(tmp_path), "reports").count() == 3


def test_all_feeds_start(spark, feed, tmp_path):
    sources = {name: feed(['{"event_id": "x", "district": "A"}'], name=name) for name in schemas.WIRE}
    jobs.finish(jobs.start_all(sources, str(tmp_path)), timeout=120)
    for name in schemas.WIRE:
        assert events.read_raw(spark, str(tmp_path), name).count() == 1
    news = spark.read.parquet(f"{tmp_path}/raw/news")
    assert "source" in news.columns and "district_partition" in news.columns
    assert "district_partition" not in spark.read.parquet(f"{tmp_path}/raw/traffic").columns


def test_dedup_and_late_rows(spark, feed, tmp_path):
    messages = feed(
        [report(1, "2024-01-10T00:00:00"), report(1, "2024-01-10T05:00:00"), report(2, "2024-01-10T06:00:00")],
        [report(2, "2024-01-10T06:00:00"), report(3, "2024-01-20T00:00:00")],
        [report(4, "2024-01-02T00:00:00"), report(5, "2024-01-20T01:00:00")],
    )
    rows = jobs.valid_rows(jobs.parse(messages, "reports"))
    jobs.finish([jobs.start_append(jobs.dedup(rows, ["report_id"], "1 day"), f"{tmp_path}/out", f"{tmp_path}/cp")], timeout=120)
    # r4 is ten days older than what came before it
    assert sorted(values(spark.read.parquet(f"{tmp_path}/out"), "report_id")) == [("r1",), ("r2",), ("r3",), ("r4",), ("r5",)]


def test_dedup_after_an_unreadable_time(spark, feed, tmp_path):
    messages = feed([report(1, "2024-01-10T00:00:00")], [report(2, "soon"), report(3, "2024-01-11T00:00:00")], [report(4), report(5), report(4)])
    rows = jobs.valid_rows(jobs.parse(messages, "reports"))
    jobs.finish([jobs.start_append(jobs.dedup(rows, ["report_id"]), f"{tmp_path}/out", f"{tmp_path}/cp")], timeout=120)
    assert sorted(values(spark.read.parquet(f"{tmp_path}/out"), "report_id")) == [(f"r{n}",) for n in range(1, 6)]


def test_messages_without_an_id_and_daily_rain(spark, feed, tmp_path):
    rain = json.dumps({"date": "2024-01-02", "precipitation_sum": 3.5})
    messages = feed(["{}", '{"city": "x"}', rain, json.dumps({"event_id": "w1", "rainfall_mm": 1.0})])
    root = str(tmp_path)
    jobs.finish([jobs.start_bronze(messages, "weather", root), jobs.start_rain(messages, root)], timeout=120)
    table = spark.read.parquet(f"{root}/raw/weather")
    assert sorted(values(jobs.dead_letters(table))) == [('{"city": "x"}',), ("{}",)]
    assert values(jobs.valid_rows(table), "event_id") == [("w1",)]
    assert values(spark.read.parquet(f"{root}/raw/rain"), F.col("date").cast("string"), "precipitation_sum") == [("2024-01-02", 3.5)]
    null = events.parse_envelope(spark.createDataFrame([(None,)], "value string"), schemas.WIRE["weather"], keep_corrupt=True)
    assert values(null, events.CORRUPT) == [("",)]


def test_files_of_a_raw_table_follow_its_days(spark, feed, tmp_path):
    lines = [report(n, f"2024-01-0{1 + n % 3}T00:00:00", district=f"D{n}") for n in range(60)]
    jobs.finish([jobs.start_bronze(feed(lines), "reports", str(tmp_path))], timeout=120)
    assert len(spark.read.parquet(f"{tmp_path}/raw/reports").inputFiles()) == 3


def test_two_queries_share_a_sink_path(spark, frame, tmp_path):
    for sink in (jobs.dual_sink(f"{tmp_path}/plain"), jobs.regional_sink(f"{tmp_path}/regional")):
        for checkpoint in ("a", "b"):
            jobs.per_batch(sink, checkpoint)(frame("report_id string", checkpoint), 0)
    assert spark.read.parquet(f"{tmp_path}/plain").count() == spark.read.parquet(f"{tmp_path}/regional").count() == 2


def test_a_batch_replayed_after_midnight_is_stored_once(spark, frame, tmp_path):
    for day in ("2024-01-01 23:59:00", "2024-01-02 00:01:00"):
        jobs.regional_sink(f"{tmp_path}/r", as_of=F.lit(day).cast("timestamp"))(frame("report_id string", "a"), 7)
    assert values(spark.read.parquet(f"{tmp_path}/r"), "report_id", "day") == [("a", 2)]


def test_snapshots_have_versions(spark, frame, tmp_path):
    path, schema = f"{tmp_path}/s", "a int"
    assert events.read_snapshot(spark, path, frame(schema).schema).count() == 0
    for n in range(4):
        events.write_version(frame(schema, n), path)
        assert values(events.read_snapshot(spark, path, frame(schema).schema)) == [(n,)]
    assert len(events.versions(spark, path)) == 2
    with pytest.raises(Exception):
        events.write_version(frame(schema, 1).select(F.raise_error(F.lit("no")).cast("int").alias("a")), path)
    assert values(events.read_snapshot(spark, path, frame(schema).schema)) == [(3,)]


def test_a_failure_is_seen_beside_an_endless_stream(spark, feed, tmp_path):
    def broken(batch, batch_id, query):
        raise RuntimeError("sink is down")

    endless = jobs.start_append(jobs.parse(feed([report(1)], name="x"), "reports").drop(events.CORRUPT), f"{tmp_path}/o", f"{tmp_path}/c1",
                                trigger={"processingTime": "1 second"})
    rows = jobs.valid_rows(jobs.parse(feed([report(1)]), "reports"))
    with pytest.raises(Exception, match="sink is down"):
        jobs.finish([endless, jobs.start_scores(rows, gold.simple_priority, broken, f"{tmp_path}/cp")], timeout=120)
    assert not endless.isActive


def test_scores_equal_the_batch_result(spark, feed, tmp_path):
    messages = feed([report(1), report(2)], [report(3), report(9)])
    rows = jobs.valid_rows(jobs.parse(messages, "reports"))
    served = []
    sink = jobs.dual_sink(f"{tmp_path}/scores", serve=lambda df, n: served.append((n, df.count())))
    jobs.finish([jobs.start_scores(rows, gold.simple_priority, sink, f"{tmp_path}/cp")], timeout=120)
    batch = events.parse_envelope(spark.read.text(f"{tmp_path}/in"), schemas.WIRE["reports"])
    stream = spark.read.parquet(f"{tmp_path}/scores").drop("query", "batch_id", "batch_time")
    assert sorted(values(stream)) == sorted(values(gold.simple_priority(batch)))
    assert served == [(0, 2), (1, 2)]


def test_a_repeated_batch_replaces_itself(spark, frame, tmp_path):
    rows = frame("report_id string", "a", "b")
    for sink in (jobs.dual_sink(f"{tmp_path}/plain"), jobs.regional_sink(f"{tmp_path}/regional")):
        for batch_id in (0, 1, 1):
            sink(rows, batch_id)
    assert spark.read.parquet(f"{tmp_path}/plain").count() == 4
    regional = spark.read.parquet(f"{tmp_path}/regional")
    assert regional.count() == 4 and {"year", "country", "province", "city"} <= set(regional.columns)


def test_district_health_covers_all_batches(spark, feed, tmp_path):
    messages = feed([report(1), report(2)], [report(3), report(9, damage_type="Odd_Crack")])
    rows = jobs.valid_rows(jobs.parse(messages, "reports"))
    jobs.finish([jobs.start_district_health(rows, f"{tmp_path}/health", f"{tmp_path}/cp")], timeout=120)
    snapshot = spark.read.parquet(events.versions(spark, f"{tmp_path}/health")[-1])
    assert values(snapshot, "district", "report_count", "average_severity", "pothole_count", "crack_count", "road_health_index", "batch_id") == [
        ("Gunung Anyar", 4, 37.5, 3, 1, 62.5, 1)
    ]


def test_accident_enrichment_reads_fresh_features(spark, feed, frame, tmp_path):
    messages = feed(['{"accident_id": "x", "district": "A", "severity": "High"}'], ['{"accident_id": "y", "district": "A"}', '{"accident_id": "z", "district": "B"}'])
    rows = jobs.valid_rows(jobs.parse(messages, "accidents"))
    calls = []

    def context():
        calls.append(1)
        schema = "district string, severity_score int"
        reports = frame(schema, *[("A", 50)] * len(calls))
        traffic = frame("district string, average_speed_kmh double, vehicle_count int, congestion_level string", ("A", 20.0, 7, None))
        weather = frame("district string, rainfall_mm double, temperature_c double, humidity double, condition string, event_time int, event_id string",
                        ("A", 1.0, 30.0, 0.7, "Rainy", 1, "w1"), ("A", 2.0, None, 0.9, "Clear", 2, "w2"))
        return features.district_context(reports, traffic, weather)

    jobs.finish([jobs.start_accident_enrichment(rows, context, f"{tmp_path}/out", f"{tmp_path}/cp")], timeout=120)
    out = spark.read.parquet(f"{tmp_path}/out").orderBy("accident_id")
    assert values(out, "accident_id", "damage_report_count", "avg_speed", "rainfall_mm", "temperature_c", "weather_condition") == [
        ("x", 1, 20.0, 1.5, 30.0, "Clear"), ("y", 2, 20.0, 1.5, 30.0, "Clear"), ("z", 0, 30.0, 0.0, 25.0, "Clear"),
    ]


def test_failed_stream_raises(feed, tmp_path):
    rows = jobs.valid_rows(jobs.parse(feed([report(1)]), "reports"))

    def broken(batch, batch_id, query):
        raise RuntimeError("serving table is down")

    with pytest.raises(Exception, match="serving table is down"):
        jobs.finish([jobs.start_scores(rows, gold.simple_priority, broken, f"{tmp_path}/cp")], timeout=120)
