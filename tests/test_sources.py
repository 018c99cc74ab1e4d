import json
import os
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from roadlake import schemas, session
from roadlake.operators import gold
from roadlake.plans import gold as gold_plan
from roadlake.plans import silver
from roadlake.sources import events, views
from tests.conftest import details, values

NOW = "2024-02-01"
TABLES = "/root/testdata/sf0.001"


def test_envelope(frame):
    rows = frame("report_id string, event_time timestamp, severity_score int", ("r1", datetime(2024, 1, 2, 3, 4, 5), None))
    (key, value), = values(events.to_envelope(rows, "report_id"))
    assert key == "r1" and json.loads(value) == {"report_id": "r1", "event_time": "2024-01-02T03:04:05"}


def test_parse_drops_unknown_fields_and_keeps_corrupt_text(frame):
    messages = frame(
        "value string", '{"event_id": "t1", "vehicle_count": 7, "colour": "red"}', '{"event_id": "t2", "vehicle_count": "many"}', "{oops", None
    )
    parsed = events.parse_envelope(messages, schemas.WIRE["traffic"], keep_corrupt=True)
    assert values(parsed, "event_id", "vehicle_count", events.CORRUPT) == [
        ("t1", 7, None), ("t2", None, '{"event_id": "t2", "vehicle_count": "many"}'), (None, None, "{oops"), (None, None, ""),
    ]
    assert events.CORRUPT not in schemas.WIRE["traffic"].names
    silent = events.parse_envelope(messages, schemas.WIRE["traffic"])
    assert values(silent, "event_id") == [("t1",), ("t2",), (None,), (None,)]


def test_raw_events_get_time_and_defaults(frame):
    now = F.lit(NOW).cast("timestamp")
    messages = frame("value string", '{"report_id": "a", "event_time": "2024-01-02T00:00:00"}', '{"report_id": "b", "event_time": "x", "status": "Done"}')
    rows = events.raw_events(events.parse_envelope(messages, schemas.WIRE["reports"]), "reports", now)
    assert values(rows, "report_id", "event_time", "status", "image_path") == [
        ("a", datetime(2024, 1, 2), "Pending", ""), ("b", datetime(2024, 2, 1), "Done", ""),
    ]
    assert rows.schema.names == schemas.EVENT["reports"].names


def test_weather_topic_holds_two_kinds(frame):
    messages = frame("value string", '{"event_id": "w", "rainfall_mm": 1.5}', '{"date": "2024-01-02", "rain_sum": 2.0}', '{"x": 1}')
    weather, rain = events.route_weather(messages)
    assert values(weather, "event_id", "rainfall_mm") == [("w", 1.5)]
    assert values(rain.select(F.col("date").cast("string"), "rain_sum")) == [("2024-01-02", 2.0)]


def test_read_or_empty(spark, frame, tmp_path):
    empty = events.read_or_empty(spark, str(tmp_path / "none"), schemas.EVENT["traffic"])
    assert empty.count() == 0 and empty.schema == schemas.EVENT["traffic"]
    (tmp_path / "broken.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        events.read_or_empty(spark, str(tmp_path / "broken.parquet"), schemas.EVENT["traffic"]).count()


def test_bounded_read(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"event_id": "t1"}\n{"event_id": "t2"}\n')
    messages = events.read_events(spark, "text", path=str(tmp_path))
    assert values(events.parse_envelope(messages, schemas.WIRE["traffic"]), "event_id") == [("t1",), ("t2",)]
    assert events.topic_options("traffic", "host:9092") == {"kafka.bootstrap.servers": "host:9092", "subscribe": "traffic_data"}
    with pytest.raises(AnalysisException):
        events.read_events(spark, "kafka", **events.topic_options("traffic", "host:9092"))


def test_publish_to_files(spark, frame, tmp_path):
    events.publish(frame("event_id string, x int", ("a", 1)), "event_id", "json", path=str(tmp_path / "out"))
    assert values(spark.read.json(str(tmp_path / "out")), "key", "value") == [("a", '{"event_id":"a","x":1}')]


def test_partitioned_append_and_snapshot(spark, frame, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, day string"
    events.write_partitioned(frame(schema, (1, "a"), (2, "b")), path, ["day"])
    events.write_partitioned(frame(schema, (3, "a")), path, ["day"])
    assert sorted(values(spark.read.parquet(path), "k")) == [(1,), (2,), (3,)]
    events.write_snapshot(frame(schema, (9, "a")), path, ["day"])
    assert sorted(values(spark.read.parquet(path), "k")) == [(2,), (9,)]
    flat = str(tmp_path / "flat")
    events.write_snapshot(frame(schema, (1, "a")), flat)
    events.write_snapshot(frame(schema, (2, "b")), flat)
    assert values(spark.read.parquet(flat), "k") == [(2,)]


def test_materialize_uses_the_shared_folder(spark, frame, tmp_path):
    stored = session.materialize(frame("a int", 1, 2), "numbers")
    assert sorted(values(stored)) == [(1,), (2,)]
    app = spark.sparkContext.applicationId
    assert all(f"{session.shared_folder(spark)}/roadlake/{app}/numbers-" in f for f in stored.inputFiles())


def test_batch_run(spark, frame, tmp_path):
    root = str(tmp_path)
    now = F.lit(NOW).cast("timestamp")
    days = [datetime(2024, 1, d) for d in (1, 2, 3)]
    reports = frame(
        "event_id string, event_time timestamp, report_id string, road_name string, district string, severity_score int, latitude double, longitude double",
        ("e1", days[0], "r1", "a", "gubeng", 10, -7.0, 112.0), ("e2", days[1], "r1", "a", "gubeng", 90, -7.0, 112.0),
        ("e3", days[2], "r2", "a", "gubeng", None, -7.0, 112.0), ("e4", days[2], "r3", "b", None, 40, -7.0, 112.0),
    )
    raw = schemas.conform(reports, schemas.EVENT["reports"]).withColumns(
        {"valid": F.lit(True), "date_partition": F.date_format("event_time", "yyyy-MM-dd")}
    )
    events.write_partitioned(raw, f"{root}/raw/reports", ["valid", "date_partition"])
    gold_plan.run(spark, root, now)
    def table(name):
        return spark.read.parquet(events.versions(spark, f"{root}/{name}")[-1])

    priority = table("gold/priority_score").orderBy("report_id")
    assert values(priority, "report_id", "severity_score", "complaint_score") == [("r1", 90, 30.0), ("r2", None, 30.0), ("r3", 40, 10.0)]
    for name in schemas.REQUIRED:
        made = gold_plan.damage_table(spark, root) if name == "damage_prediction" else table(f"gold/{name}")
        assert set(schemas.REQUIRED[name]) <= set(made.columns)
    log = spark.read.parquet(f"{root}/logs/run_log")
    assert values(log.filter("job_name = 'silver_reports'"), "status", "record_processed") == [("success", 3)] and log.count() == 25
    # a copy of r1 arrives late, for a day long past
    late = schemas.conform(reports.filter("event_id = 'e2'"), schemas.EVENT["reports"]).withColumns(
        {"event_id": F.lit("e9"), "severity_score": F.lit(55), "valid": F.lit(True), "date_partition": F.lit("2023-12-30"),
         "ingestion_timestamp": F.lit(datetime(2024, 3, 1))}
    )
    events.write_partitioned(late, f"{root}/raw/reports", ["valid", "date_partition"])
    assert "date_partition" in details(events.read_raw(spark, root, "reports", "2024-01-09")).split("PartitionFilters")[1].split("\n")[0]
    # rows without a known arrival count as new, too, but are the known ones
    assert gold_plan.refresh(spark, root, "reports", F.lit("2024-02-20").cast("timestamp")) == ["2024-01"]
    refreshed = gold_plan.clean_tables(spark, root)["reports"]
    rebuilt = silver.clean_batch("reports", events.read_raw(spark, root, "reports"))
    assert sorted(values(refreshed), key=str) == sorted(values(rebuilt), key=str)
    assert values(gold.damage_prediction(refreshed, now).filter("report_id = 'r1'"), "predicted_risk_level") == [("Medium Risk",)]
    # a second run adds nothing
    gold_plan.run(spark, root, now)
    assert table("gold/priority_score").count() == 3


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables are not here")
def test_daily_rain_covers_all_orders(spark):
    assert views.view(spark, TABLES, "rain_lines").count() == views.table(spark, TABLES, "orders").count()
