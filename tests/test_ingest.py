"""Batches of raw tables, streams into clean tables, the article job, numbered runs, quarantine and model figures."""

import hashlib
import json
import math
import os
import random
from datetime import datetime

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from roadlake import rules, schemas
from roadlake.operators import ids, ml, quality
from roadlake.plans import gold as gold_plan
from roadlake.sources import events
from roadlake.streaming import jobs
from tests.conftest import details, plan, values
from tests.test_streaming import feed, report  # noqa: F401  (a fixture)

NOW = "2024-02-01"


def at(text=NOW):
    return F.lit(text).cast("timestamp")


@pytest.fixture
def small_files(spark):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200000", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100000", "spark.sql.shuffle.partitions": "20"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_day_that_fills_a_batch_is_written_by_many_tasks(spark, small_files, tmp_path):
    line = F.format_string('{"event_id": "t%d", "event_time": "2024-01-02T00:00:00", "road_name": "r%d", "vehicle_count": %d}', "id", F.xxhash64("id"), "id")
    spark.range(0, 60_000, 1, 4).select(line.alias("value")).write.text(f"{tmp_path}/in")
    messages = jobs.read_stream(spark, "text", path=f"{tmp_path}/in")
    jobs.finish([jobs.start_bronze(messages, "traffic", str(tmp_path), at())], timeout=120)
    table = spark.read.parquet(f"{tmp_path}/raw/traffic")
    assert table.count() == 60_000 and table.select("date_partition").distinct().count() == 1
    sizes = [os.path.getsize(f.removeprefix("file://")) for f in table.inputFiles()]
    assert 4 <= len(sizes) <= 40 and max(sizes) < sum(sizes) / 2  # files follow bytes


def test_a_repeated_batch_replaces_itself_and_closed_days_are_gathered(spark, frame, tmp_path):
    path, schema = str(tmp_path / "raw"), f"k int, {events.ARRIVAL} string"
    by = [events.ARRIVAL]
    for n, day in enumerate(["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-03"]):
        for _ in range(2):
            events.write_batch(frame(schema, (n, day), (n + 100, day)), path, f"q-{n}", by)
    events.write_batch(frame(schema, (50, "2024-01-01")), path, "other-0", by)

    def table():
        return sorted(r[0] for r in values(spark.read.parquet(path), "k"))

    whole = [0, 1, 2, 3, 50, 100, 101, 102, 103]
    assert table() == whole and len(events.batches(spark, path)) == 5
    assert events.compact_batches(spark, path, "2024-01-03", by) == 3  # the newest batch of each query may come again
    names = {b.rsplit("batch=", 1)[1].split("-")[0] for b in events.batches(spark, path)}
    assert table() == whole and names == {"closed", "q", "other"} and len(events.batches(spark, path)) == 3
    assert len([f for f in spark.read.parquet(path).inputFiles() if "batch=closed" in f]) == 2  # one for each day
    assert events.compact_batches(spark, path, "2024-01-03", by) == 0 and table() == whole
    assert events.compact_batches(spark, str(tmp_path / "none"), "2024-01-03", by) == 0


def test_arrivals_prune_raw_folders(spark, feed, tmp_path):  # noqa: F811
    root = str(tmp_path)
    jobs.finish([jobs.start_bronze(feed([report(1)]), "reports", root, at("2024-01-05"))], timeout=120)
    jobs.finish([jobs.start_bronze(feed([report(1)], [report(2)]), "reports", root, at("2024-01-09"))], timeout=120)
    new = events.read_raw(spark, root, "reports", arrived=at("2024-01-08"))
    assert values(new, "report_id") == [("r2",)]
    assert "arrival_day" in details(new).split("PartitionFilters", 1)[1].split("\n")[0]
    assert all("arrival_day=2024-01-09" in f for f in new.inputFiles()) or len(new.inputFiles()) == 2
    assert events.read_raw(spark, root, "reports").count() == 2


def test_a_stream_into_a_clean_table_finds_copies_however_late(spark, feed, tmp_path):  # noqa: F811
    root = str(tmp_path)
    first, later = report(1, "2024-01-02T00:00:00", severity_score=10), report(1, "2024-01-20T00:00:00", severity_score=90)
    place = {"latitude": -7.0, "longitude": 112.0}

    def placed(line):
        return json.dumps({**json.loads(line), **place})

    stream = feed([placed(first), placed(report(2)), "{broken"], [placed(report(3, "2024-01-30T23:00:00"))], [placed(first), placed(later), placed(report(2))], [placed(first)])
    jobs.finish([jobs.start_silver(stream, "reports", root, as_of=at("2024-01-31"))], timeout=120)
    table = gold_plan.clean_table(spark, root, "reports").orderBy("report_id")
    assert values(table, "report_id", "severity_score") == [("r1", 90), ("r2", 20), ("r3", 30)]
    counts = spark.read.parquet(f"{root}/logs/stream_counts").orderBy("batch")
    assert values(counts, "messages", "stored", "copies", "late") == [(2, 2, 0, 2), (1, 1, 0, 0), (3, 1, 2, 3), (1, 0, 1, 1)]


def article(n, url, title="Jalan Ahmad Yani berlubang parah"):
    return json.dumps({"url": url, "title": title, "content": f"{n} warga melapor", "source": "s", "scraped_at": f"2024-01-0{n} 00:00:00"})


def test_articles_are_handled_once(spark, feed, tmp_path):  # noqa: F811
    root, sent = str(tmp_path), []
    schema = "url string, title string, content string, source string, scraped_at timestamp"
    lines = feed([article(1, "u1"), article(2, "u1"), article(3, "u2", "cuaca cerah")], [article(4, "u1"), article(5, "u3")])
    articles = lines.select(F.from_json("value", schema).alias("a")).select("a.*", F.lit(None).cast("timestamp").alias("published_at"))

    def publish(messages, batch):
        sent.append((batch, sorted(r.key for r in messages.collect())))
        if len(sent) == 2:
            raise RuntimeError("the broker is away")

    with pytest.raises(Exception, match="the broker is away"):
        jobs.finish([jobs.start_articles(articles, root, as_of=at(), publish=publish)], timeout=120)
    jobs.finish([jobs.start_articles(articles, root, as_of=at(), publish=publish)], timeout=120)  # repeats the broken batch
    names = {u: hashlib.sha256(u.encode()).hexdigest()[:16] for u in ("u1", "u2", "u3")}
    assert sorted(r[0] for r in values(spark.read.parquet(f"{root}/articles/ledger"), "article_id")) == sorted(names.values())
    mentions = spark.read.parquet(f"{root}/articles/mentions")
    assert sorted(values(mentions, "event_id", "road_name"), key=str) == sorted([(names["u1"], "Ahmad Yani"), (names["u2"], None), (names["u3"], "Ahmad Yani")], key=str)
    assert [s[1] for s in sent] == [sorted([names["u1"], names["u2"]]), [names["u3"]], [names["u3"]]] and sent[1] == sent[2]


def test_numbers_go_on_from_run_to_run(frame, tmp_path):
    path, schema = str(tmp_path / "numbers"), "event_id string, event_time timestamp"
    rows = [(f"e{n}", datetime(2024, 1, 1 + n)) for n in range(9)]

    def run(name, some):
        return sorted(values(ids.number_new(frame(schema, *some), path, name), "event_id", "report_id"))

    assert run("a", rows[:4]) == [(f"e{n}", f"R00{n + 1}") for n in range(4)]
    second = [(f"e{n}", f"R00{n + 1}") for n in range(4, 7)]
    assert run("b", rows[2:7]) == second
    assert run("b", rows[2:7]) == second  # a repeated run has the same numbers
    assert run("c", rows) == [("e7", "R008"), ("e8", "R009")] and run("d", rows) == []


def test_quarantine_routes_each_row_once(spark, frame, tmp_path):
    rows = frame("event_id string, temperature_c double, humidity double, rainfall_mm double", ("a", 20.0, 0.5, 1.0), ("b", 99.0, 7.0, 1.0), ("c", None, 0.1, -1.0), ("d", None, None, None))
    good, bad = quality.quarantine(rows, rules.RANGE_RULES["weather"], str(tmp_path / "q"))
    assert sorted(values(good)) == sorted(values(rows.filter("event_id IN ('a', 'd')"))) and good.columns == rows.columns
    assert sorted(values(bad, "event_id", F.sort_array("violations"))) == [("b", ["humidity", "temperature_c"]), ("c", ["rainfall_mm"])]
    assert "PartitionFilters: [isnotnull(accepted" in details(good) and "PartitionFilters: [isnotnull(accepted" in details(bad)


def test_auc_and_f1_against_pairs_and_the_evaluators(spark, frame):
    rng = random.Random(8)
    rows = [(round(rng.random(), rng.choice([1, 2, 9])), float(rng.random() < 0.4)) for _ in range(400)]
    rows = [(s, label, float(s + 0.2 * rng.random() > 0.55)) for s, label in rows]
    df = frame("score double, label double, prediction double", *rows)
    yes, no = [s for s, y, _ in rows if y], [s for s, y, _ in rows if not y]
    pairs = sum((a > b) + 0.5 * (a == b) for a in yes for b in no) / (len(yes) * len(no))
    auc = ml.auc_of(df).first()[0]
    assert math.isclose(auc, pairs, abs_tol=1e-12)
    assert math.isclose(auc, BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df), abs_tol=1e-9)
    f1, accuracy = ml.f1_of(ml.confusion(df)).first()
    library = MulticlassClassificationEvaluator()
    assert math.isclose(f1, library.evaluate(df, {library.metricName: "f1"}), abs_tol=1e-12)
    assert math.isclose(accuracy, library.evaluate(df, {library.metricName: "accuracy"}), abs_tol=1e-12)
    assert ml.auc_of(df.filter("label = 1")).first()[0] is None


def test_split_and_medians(spark, frame):
    rows = frame("k string, label double", *((f"k{n}", 0.0) for n in range(500)), (None, 1.0))
    train, test = ml.split(rows, "k")
    place = {f"k{n}": int(hashlib.md5(f"42:k{n}".encode()).hexdigest()[:8], 16) % 1000 for n in range(500)}
    assert sorted(r[0] for r in values(test, "k")) == sorted(k for k, p in place.items() if p >= 800)
    assert train.count() + test.count() == 501
    inputs = schemas.ensure_columns(frame("avg_speed double", 1.0, 2.0, 8.0, 9.0, None), rules.MODEL_FEATURES)
    assert ml.medians(inputs.withColumn("avg_speed", F.col("avg_speed").cast("double"))).first()["avg_speed"] == 2.0


def test_medians_are_counted(spark, monkeypatch):
    """The quantile sketch, whose size is that of its input, sees one row; the medians are those of sorted values."""
    fitted, fit = [], ml.Imputer.fit
    monkeypatch.setattr(ml.Imputer, "fit", lambda self, rows: fitted.append(rows.count()) or fit(self, rows))
    value = F.when(F.col("id") % 9 == 0, None).when(F.col("id") % 11 == 0, float("nan"))
    rows = spark.range(0, 600, 1, 7).withColumns(
        {c: value.otherwise(F.col("id") * 7919 % (601 + i) - 50.0) for i, c in enumerate(rules.MODEL_FEATURES)})
    rows = rows.withColumn("humidity", F.lit(0.5)).withColumn("label", F.col("id") % 2 + 0.0)
    ids = [n for n in range(600) if n % 9 and n % 11]
    found = ml.medians(rows).first()
    for i, c in enumerate(rules.MODEL_FEATURES[:-1]):
        assert found[c] == sorted(n * 7919 % (601 + i) - 50.0 for n in ids)[(len(ids) - 1) // 2]
    assert found["humidity"] == 0.5
    model = ml.train(rows, {"numTrees": 1, "maxDepth": 1, "seed": 1})
    assert model.stages[0].surrogateDF.first()["avg_speed"] == found["avg_speed"] and fitted == [1]


def test_only_texts_that_can_name_a_day_are_parsed(frame):
    texts = ['{"date": "2020-01-01"}', '{"d\\u0061te": "2020-01-01"}', "{'date': '2020-01-01'}", '{"event_id": "date", "date": "2020-01-01"}',
             '{"event_id": "e"}', '{"day": 1}', '{"date": null}', "no date", None]
    rows = frame("value string", *texts)
    kinds = [rain for _, rain in rows.select("value", events.is_rain()).collect()]
    assert kinds == [True, True, True, False, False, False, False, False, False]
    assert "contains(" in plan(rows.withColumn("rain", events.is_rain()).filter("rain")).lower()
