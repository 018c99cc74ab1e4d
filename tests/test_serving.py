import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadlake.operators import serving
from tests.conftest import plan, values

REPORTS = "report_id string, district string, damage_type string, severity_score int, status string, event_time timestamp"
D1, D2 = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2, 23)


@pytest.fixture
def reports(frame):
    return frame(
        REPORTS,
        ("r1", "B", "D40_Pothole", 100, "Pending", D1), ("r2", "A", "D00_Longitudinal_Crack", 50, "Resolved", D2),
        ("r3", "B", "Unknown", None, "Pending", D2), ("r4", "A", None, 81, "odd", D2), ("r5", None, "Odd Crack", None, None, None),
    )


def test_stats(reports):
    assert values(serving.stats(reports, F.to_date(F.lit("2024-01-02")))) == [(5, 3, "A", 3, 77.0, 1, 1)]
    empty = serving.stats(reports.limit(0), F.to_date(F.lit("2024-01-02")))
    assert values(empty) == [(0, 0, None, 0, 0.0, 0, 0)]


def test_dashboard_counters_count_unknown_severity_as_zero(reports):
    assert values(serving.dashboard_counters(reports)) == [(2, 3, 46, 1, 2)]
    assert values(serving.dashboard_counters(reports.limit(0))) == [(0, 0, 0, 0, 0)]


def test_districts_and_statuses(reports):
    assert values(serving.top_districts(reports, 2)) == [("A", 2), ("B", 2)]
    assert values(serving.status_counts(reports), "status", "report_count") == [
        ("Pending", 2), ("Verified", 0), ("In Progress", 0), ("Resolved", 1),
    ]


def test_newest_first(reports):
    assert [r[0] for r in values(serving.newest_first(reports), "report_id")] == ["r2", "r3", "r4", "r1", "r5"]


def test_latest_health_keeps_ties(frame):
    df = frame(
        "road_name string, district string, road_health_index double, batch_time int",
        ("A", "x", 10.0, 1), ("A", "x", 20.0, 2), ("A", "y", 90.0, 2), ("B", "x", None, 1), (None, "x", 5.0, 9),
    )
    assert values(serving.latest_health(df), "road_name", "district") == [("A", "y"), ("A", "x"), ("B", "x")]


def test_top_priority_reads_the_newest_batch(frame):
    rows = [(f"r{i}", float(i), 1) for i in range(50)] + [(f"s{i:02d}", float(i // 2), 2) for i in range(20)] + [("null", None, 2)]
    df = frame("report_id string, priority_score double, batch_time int", *rows)
    top = serving.top_priority(df, 3)
    assert values(top, "report_id") == [("s18",), ("s19",), ("s16",)]
    assert "TakeOrderedAndProject" in plan(top)


def test_labels(frame):
    df = frame("confidence string", "0.874", "0.5", "", None, "1")
    assert [v for (v,) in values(df.select(serving.confidence_label()))] == ["87%", "50%", "-", "-", "100%"]


def test_images(frame):
    df = frame("urls array<string>", (["/a.jpg", "/b.jpg"],), (["http://x/a.jpg"],))
    rows = df.withColumn("image_path", serving.join_images())
    assert values(rows.select("image_path", serving.first_image(base="http://api"))) == [
        ("/a.jpg,/b.jpg", "http://api/a.jpg"), ("http://x/a.jpg", "http://x/a.jpg"),
    ]
    assert values(frame("image_path string", None).select(serving.first_image(base="http://api"))) == [("",)]
    many = frame("urls array<string>", (["x"] * 6,), (["x"] * 5,), (None,))
    assert values(many.select(serving.too_many_images())) == [(True,), (False,), (False,)]
