import pytest
from pyspark.sql import functions as F

from roadlake import rules, schemas
from roadlake.operators import features, gold, ids, ml
from roadlake.plans import gold as gold_plan
from tests.conftest import plan, values


def now():
    return F.lit("2024-02-01").cast("timestamp")


REPORTS = "report_id string, road_name string, district string, damage_type string, severity_score int"


@pytest.fixture
def feeds(frame):
    reports = frame(
        REPORTS,
        ("r1", "A", "X", "D40_Pothole", 100), ("r2", "A", "X", None, 50), ("r3", "A", "Y", "D00_Longitudinal_Crack", None),
        ("r4", "B", None, "d", 10), ("r5", None, "X", "d", 20), ("r6", "C", "Z", "d", None),
    )
    weather = frame("district string, rainfall_mm double", ("X", 10.0), ("X", 20.0), ("Y", None), (None, 99.0))
    traffic = frame("road_name string, district string, vehicle_count int", ("A", "X", 100), ("A", "X", 300), ("A", "Y", 40), ("B", None, 500))
    accidents = frame("road_name string, district string", ("A", "X"), ("A", "X"), ("A", "Z"), (None, "X"))
    news = frame("district string, sentiment_score double", ("X", 0.5), ("X", -0.1), (None, 0.3))
    return reports, weather, traffic, accidents, news


def test_road_health_index(feeds):
    reports, weather, traffic, _, _ = feeds
    rows = {r[:2]: r[2:] for r in values(gold.road_health_index(reports, weather, traffic, now()),
                                         "road_name", "district", "severity", "rainfall", "traffic", "road_health_index")}
    assert rows[("A", "X")] == (75.0, 15.0, 10.0, 100 - 75 * 0.4 - 15 * 0.2 - 10 * 0.2)
    assert rows[("A", "Y")] == (None, 0.0, 2.0, None)
    assert rows[("B", None)][1:3] == (0.0, 0.0)
    assert len(rows) == 5


def test_road_age_is_optional(feeds, frame):
    reports, weather, traffic, _, _ = feeds
    age = frame("road_name string, district string, road_age_score double", ("A", "X", 50.0))
    with_age = gold.road_health_index(reports, weather, traffic, now(), road_age=age).filter("road_name = 'A' AND district = 'X'")
    assert values(with_age, "road_age_score", "road_health_index") == [(50.0, pytest.approx(100 - 30 - 3 - 2 - 10))]


def test_priority_score(feeds):
    reports, _, traffic, accidents, news = feeds
    scored = gold.priority_score(reports, traffic, accidents, news, now())
    rows = {r[0]: r[1:] for r in values(scored, "report_id", "traffic_score", "accident_score", "complaint_score", "news_score", "priority_score")}
    assert rows["r1"] == (10.0, 20.0, 30.0, 20.0, pytest.approx(30 + 2.5 + 4 + 4.5 + 2))
    assert rows["r3"][:4] == (2.0, 0.0, 30.0, 0.0) and rows["r3"][4] is None
    assert rows["r4"][:4] == (0.0, 0.0, 10.0, 0.0)
    assert rows["r5"][:4] == (0.0, 0.0, 0.0, 20.0)
    assert len(rows) == 6
    text = plan(scored)
    assert text.count("Exchange hashpartitioning") == 0 and "BroadcastHashJoin" in text


def test_priority_without_broadcast(spark, feeds):
    """Beyond the size bound the same result comes from a sort-merge join."""
    reports, _, traffic, accidents, news = feeds
    expected = sorted(values(gold.priority_score(reports, traffic, accidents, news, now())), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = gold.priority_score(reports, traffic, accidents, news, now())
        assert "SortMergeJoin" in plan(scored)
        assert sorted(values(scored), key=str) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_complaint_steps(frame):
    df = frame("report_count int", 0, 1, 2, 4, 5, 9, 10, 500)
    assert [v for (v,) in values(df.select(gold.complaint_score()))] == [0.0, 10.0, 30.0, 30.0, 60.0, 60.0, 100.0, 100.0]


def test_risk_levels(frame):
    df = frame("severity_score int", 49, 50, 80, 81, None)
    assert [v for (v,) in values(df.select(gold.risk_level()))] == ["Low Risk", "Medium Risk", "Medium Risk", "High Risk", "Low Risk"]


def test_accident_prediction(frame):
    schema = "road_name string, district string, road_health_index double, rainfall double, traffic double"
    # raw = 0.05 + rainfall / 100 with full health
    df = frame(schema, *[(f"r{i}", "d", h, r, 0.0) for i, (h, r) in enumerate([(100.0, 24.99), (100.0, 25.1), (100.0, 54.99), (100.0, 55.1), (100.0, 145.0), (None, 1.0)])])
    rows = values(gold.accident_prediction(df, now()).orderBy("road_name"), "predicted_accident_probability", "risk_level")
    assert [r[1] for r in rows] == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "HIGH"]
    assert rows[4][0] == 1.0 and rows[5][0] is None
    assert values(gold.accident_prediction(df, now(), null_level="UNKnow()N").filter("road_name = 'r5'"), "risk_level") == [("UNKnow()N",)]


def test_hotspots_and_district_health(feeds):
    reports = feeds[0]
    rows = {r[0]: r[1:] for r in values(gold.hotspots(reports, now()), "road_id", "report_count", "avg_severity", "hotspot_score")}
    assert rows["A"] == (3, 75.0, 52.5) and rows["C"] == (1, None, None)
    health = {r[0]: r[1:] for r in values(gold.district_health(reports))}
    assert health["X"] == (3, pytest.approx(170 / 3), 1, 0, pytest.approx(100 - 170 / 3))
    assert health["Y"][3] == 1


def test_simple_priority(frame):
    df = frame(REPORTS + ", confidence double", ("r", "A", "X", "t", 80, 0.9), ("s", "A", "X", "t", None, 0.9))
    assert [r[-1] for r in values(gold.simple_priority(df))] == [82.5, None]


def test_best_detection(frame):
    boxes = frame(
        "report_id string, image_no int, box_no long, class_id int, confidence double",
        ("a", 1, 1, 0, 0.501), ("a", 1, 2, 3, 0.504), ("a", 2, 1, 4, 0.3), ("b", 1, 1, 9, 0.99), ("c", 1, 1, 3, 0.2),
    )
    best = gold.best_detection(frame("report_id string", "a", "b", "none"), boxes).orderBy("report_id")
    assert values(best, "report_id", "damage_type", "confidence", "severity_score") == [
        ("a", "D00_Longitudinal_Crack", 0.5, 40), ("b", "Unknown", 0.99, 0), ("none", "Unknown", 0.0, 0),
    ]


def test_split_complete(feeds):
    reports, weather, traffic, _, _ = feeds
    health = gold.road_health_index(reports, weather, traffic, now())
    good, bad = gold.split_complete(health, schemas.REQUIRED["road_health_index"])
    assert (good.count(), bad.count()) == (1, 4)
    assert set(schemas.REQUIRED["road_health_index"]) <= set(health.columns)


def test_sequential_ids(spark):
    # a third of the rows share one time
    df = spark.range(3000).select(
        F.format_string("e%04d", "id").alias("event_id"),
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("event_time"),
    )
    numbered = ids.assign_report_ids(df.repartition(5), start=8, partitions=6)
    got = [r[0] for r in sorted(values(numbered, "report_id", "event_time", "event_id"), key=lambda r: r[1:])]
    assert got == [f"R{i:03d}" for i in range(8, 3008)]


def test_empty_feeds_give_typed_results(spark):
    empty = {feed: spark.createDataFrame([], schema) for feed, schema in schemas.EVENT.items()}
    tables = gold_plan.score_tables(empty, now())
    assert set(tables) == set(schemas.REQUIRED)
    for name, table in tables.items():
        assert table.count() == 0 and set(schemas.REQUIRED[name]) <= set(table.columns)


def test_training_rows(frame):
    df = frame("accident_severity string, rainfall_mm double", ("High", 0.0), ("Low", 80.0), (None, 0.0))
    assert [v for (v,) in values(ml.training_rows(df), "label")] == [1.0, 0.0, 0.0]
    assert values(ml.training_rows(df.drop("accident_severity")), "label", "humidity") == [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    train, test = ml.split(df, "k")
    again, _ = ml.split(df.repartition(7), "k")
    assert sorted(values(train)) == sorted(values(again))
    assert train.count() + test.count() == 2000 and 0.75 < train.count() / 2000 < 0.85


def test_model(spark, tmp_path):
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("accident_id"),
        F.when(F.col("id") % 2 == 0, "Critical").otherwise("Low").alias("severity"),
        F.when(F.col("id") % 2 == 0, 60.0).otherwise(F.when(F.col("id") % 25 == 0, None).otherwise(10.0)).alias("rainfall_mm"),
    )
    path = str(tmp_path / "model")
    metrics = values(gold_plan.train_model(rows, path, forest={"numTrees": 5, "maxDepth": 3, "seed": 1}))[0]
    assert all(m > 0.9 for m in metrics)
    scored = ml.score(ml.training_rows(rows), path)
    assert scored.filter("prediction = label").count() > 380
    with pytest.raises(ValueError):
        ml.train(ml.training_rows(rows.limit(10)))


def test_weights_match_their_columns():
    assert sum(rules.PRIORITY_WEIGHTS.values()) == pytest.approx(1.0)
    assert sum(rules.HEALTH_WEIGHTS.values()) == pytest.approx(1.0)


def test_accident_features_are_rounded_by_district(frame):
    accidents = frame(
        "accident_id string, district string, road_name string, event_time string, severity string, vehicle_count int, casualties int",
        ("a", "X", "r", "t", "High", 1, 0), ("b", "Y", "r", "t", "Low", 1, 0),
    )
    reports = frame("district string, severity_score int", ("X", 1))
    traffic = frame("district string, average_speed_kmh double, vehicle_count int, congestion_level string", ("X", 1 / 3, 1, "low"))
    weather = frame(
        "district string, event_time string, event_id string, rainfall_mm double, temperature_c double, humidity double, condition string",
        ("X", "t", "e", 2 / 3, None, 0.1, "Rain"),
    )
    rounded = features.accident_features(accidents, reports, traffic, weather, lambda c: c.withColumn("avg_speed", F.round("avg_speed", 2)))
    assert sorted(values(rounded, "accident_id", "avg_speed", "rainfall_mm", "temperature_c")) == [("a", 0.33, 2 / 3, 25.0), ("b", 30.0, 0.0, 25.0)]
    assert "round(" not in plan(rounded)
