"""Tables in layers: rebuilding, upserts in proportion to what arrives, and scores kept up to date by month."""

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadlake import rules, schemas
from roadlake.operators import gold
from roadlake.plans import gold as gold_plan
from roadlake.plans import silver
from roadlake.sources import events, layers
from tests.conftest import details, values

NOW = "2024-02-01"
SCHEMA = "event_id string, event_time timestamp, vehicle_count int"


def day(n, month=1):
    return datetime(2024, month, n)


def stored(df, root, feed, arrival, mode="append"):
    """Rows of a feed as its raw table."""
    rows = schemas.conform(df, schemas.EVENT[feed]).withColumns({
        "valid": F.lit(True), events.ARRIVAL: F.lit(arrival), "date_partition": F.date_format("event_time", "yyyy-MM-dd"),
        "ingestion_timestamp": F.lit(arrival).cast("timestamp"),
    })
    events.write_batch(rows, f"{root}/raw/{feed}", f"{arrival}-0", events.partition_columns(feed))


def size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


def read_bytes(spark, run):
    """Bytes that tasks read while ``run`` runs."""
    from py4j.java_gateway import is_instance_of  # noqa: F401  (the status store is reached through the gateway)

    store = spark.sparkContext._jsc.sc().statusStore()
    total = lambda: sum(e.totalInputBytes() for e in [store.executorList(False).apply(i) for i in range(store.executorList(False).size())])
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = total()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


@pytest.mark.parametrize("n", [1, 100])
def test_a_rebuilt_table_holds_only_its_rows(spark, frame, tmp_path, n):
    path, keys = str(tmp_path / "t"), ["event_id"]
    first = frame(SCHEMA, *((f"e{i}", day(1 + i % 28, 1 + i % 12), i) for i in range(100)))
    layers.write_whole(first, path)
    layers.write_delta(frame(SCHEMA, ("e1", day(2), 7), ("new", None, 8)), path)
    layers.write_whole(first.limit(n), path)
    assert layers.read(spark, path, first.schema, keys).count() == n
    layers.write_whole(first.limit(0), path)
    assert layers.read(spark, path, first.schema, keys).count() == 0
    assert len(layers.all_layers(spark, path)) == 2  # the one before, which readers may still use


def test_deltas_replace_keys_wherever_they_move(spark, frame, tmp_path):
    path, keys = str(tmp_path / "t"), ["event_id", "road_name"]
    schema = "event_id string, road_name string, event_time timestamp, v int"
    assert layers.read(spark, path, frame(schema).schema, keys).count() == 0
    layers.write_whole(frame(schema, ("a", None, day(1), 1), ("a", "r", day(1), 2), ("b", None, day(1, 2), 3), ("c", "r", None, 4)), path)
    layers.write_delta(frame(schema, ("a", None, day(1, 3), 10), ("d", "r", day(1), 11)), path)
    layers.write_delta(frame(schema, ("a", None, day(1, 4), 20)), path)

    def now(months=None):
        return sorted(values(layers.read(spark, path, frame(schema).schema, keys, months), "event_id", "road_name", "v"), key=str)

    whole = sorted([("a", None, 20), ("a", "r", 2), ("b", None, 3), ("c", "r", 4), ("d", "r", 11)], key=str)
    assert now() == whole and now([]) == []
    assert now(["2024-01"]) == [("a", "r", 2), ("d", "r", 11)] and now(["2024-04"]) == [("a", None, 20)] and now(["2024-03"]) == []
    assert now([layers.UNKNOWN]) == [("c", "r", 4)]
    assert layers.months_with(spark, path, frame(schema).schema, keys, frame("event_id string, road_name string", ("a", None), ("z", "r"))) == ["2024-01", "2024-03", "2024-04"]
    plan = details(layers.read(spark, path, frame(schema).schema, keys, ["2024-01"]))
    assert "PartitionFilters" in plan and "2024-01" in plan.split("PartitionFilters", 1)[1].split("\n")[0]
    assert layers.merge(spark, path, frame(schema).schema, keys, share=100) is False and now() == whole
    assert layers.merge(spark, path, frame(schema).schema, keys, share=0) is True and now() == whole
    assert len(layers.layers(spark, path)) == 1


def test_an_unfinished_layer_is_not_read(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    layers.write_whole(frame(SCHEMA, ("a", day(1), 1)), path)
    layers.write_delta(frame(SCHEMA, ("a", day(1), 2)), path)
    os.remove(f"{layers.all_layers(spark, path)[1].removeprefix('file:')}/_SUCCESS")
    assert values(layers.read(spark, path, frame(SCHEMA).schema, ["event_id"]), "vehicle_count") == [(1,)]
    layers.write_delta(frame(SCHEMA, ("a", day(1), 3)), path)  # takes the unfinished one's place
    assert values(layers.read(spark, path, frame(SCHEMA).schema, ["event_id"]), "vehicle_count") == [(3,)]


def traffic(spark, start, n, month=None):
    """Rows over three years, or of one month."""
    time = F.lit("2021-01-01").cast("timestamp") + F.make_dt_interval(F.col("id") % (3 * 365))
    if month:
        time = F.lit(f"{month}-01").cast("timestamp") + F.make_dt_interval(F.col("id") % 28)
    return spark.range(start, start + n, 1, 4).select(
        F.concat(F.lit("T"), "id").alias("event_id"), time.alias("event_time"), F.concat(F.lit("jl. road "), F.xxhash64("id") % 500).alias("road_name"),
        F.lit("gubeng").alias("district"), (F.xxhash64("id", F.lit(1)) % 100000 / 1e3).alias("average_speed_kmh"), (F.col("id") % 1000).cast("int").alias("vehicle_count"),
    )


def test_a_refresh_reads_and_writes_in_proportion_to_arrivals(spark, tmp_path):
    root = str(tmp_path)
    stored(traffic(spark, 0, 300_000), root, "traffic", "2024-01-01")
    layers.write_whole(silver.clean_batch("traffic", events.read_raw(spark, root, "traffic")), f"{root}/silver/traffic")
    whole = size(f"{root}/silver/traffic")
    # new events of one month and copies of some known ones that stay as they are
    arrivals = traffic(spark, 300_000, 2000, "2024-01").unionByName(traffic(spark, 0, 50))
    stored(arrivals, root, "traffic", "2024-02-01")
    since = F.lit("2024-02-01").cast("timestamp")
    read = read_bytes(spark, lambda: gold_plan.refresh(spark, root, "traffic", since))
    delta = size(layers.layers(spark, f"{root}/silver/traffic")[1].removeprefix("file:"))
    assert delta < whole / 50 and layers.layers(spark, f"{root}/silver/traffic")[1].endswith("-delta")
    raw = details(events.read_raw(spark, root, "traffic", arrived=since))
    assert "arrival_day" in raw.split("PartitionFilters", 1)[1].split("\n")[0]
    assert 0 < read < whole / 2  # keys of all months, rows of the months of those fifty
    table = gold_plan.clean_table(spark, root, "traffic")
    rebuilt = silver.clean_batch("traffic", events.read_raw(spark, root, "traffic"))
    assert table.count() == 302_000 and table.exceptAll(rebuilt).count() == 0


def test_scores_after_refreshes_equal_scores_made_anew(spark, frame, tmp_path):
    root, again = str(tmp_path / "a"), str(tmp_path / "b")
    now = F.lit(NOW).cast("timestamp")
    kinds = {
        "reports": "event_id string, event_time timestamp, report_id string, road_name string, district string, severity_score int, latitude double, longitude double",
        "weather": "event_id string, event_time timestamp, district string, rainfall_mm double",
        "traffic": "event_id string, event_time timestamp, road_name string, district string, vehicle_count int",
    }
    first = {
        "reports": [("e1", day(1), "r1", "a", "x", 10, -7.0, 112.0), ("e2", day(1, 2), "r2", "a", "x", 90, -7.0, 112.0), ("e3", day(1, 3), "r3", "b", None, None, -7.0, 112.0)],
        "weather": [("w1", day(1), "x", 3.5), ("w2", day(1, 2), "x", None)],
        "traffic": [("t1", day(1), "a", "x", 100), ("t2", day(1, 5), "b", "x", 300)],
    }
    # r2 moves to another month and leaves its own empty, r1 gets a later state, a copy comes late, a road is new
    later = {
        "reports": [("e2", day(9, 4), "r2", "a", "x", 50, -7.0, 112.0), ("e9", day(5), "r1", "a", "x", 70, -7.0, 112.0), ("e0", day(1, 1), "r3", "b", None, 5, -7.0, 112.0), ("n", day(2), "r7", "c", "y", 1, -7.0, 112.0)],
        "weather": [("w3", day(3), "y", 8.25)],
        "traffic": [("t2", day(2, 5), "b", "x", None), ("t3", None, "c", "y", 7)],
    }
    for place in (root, again):
        for feed, rows in first.items():
            stored(frame(kinds[feed], *rows), place, feed, "2024-01-10")
    gold_plan.run(spark, root, now)
    for place in (root, again):
        for feed, rows in later.items():
            stored(frame(kinds[feed], *rows), place, feed, "2024-01-20")
    touched = gold_plan.refresh_all(spark, root, F.lit("2024-01-20").cast("timestamp"), now)
    assert touched["reports"] == ["2024-01", "2024-02", "2024-04"] and touched["accidents"] == []
    gold_plan.run(spark, again, now)

    def tables(place):
        names = [n for n in schemas.REQUIRED if n != "damage_prediction"]
        found = {n: spark.read.parquet(events.versions(spark, f"{place}/gold/{n}")[-1]) for n in names}
        found["damage_prediction"] = gold_plan.damage_table(spark, place)
        return {n: sorted(values(t, *sorted(t.columns)), key=str) for n, t in found.items()}

    assert tables(root) == tables(again)
    assert len(tables(root)["damage_prediction"]) == 4
    # a second refresh with the same arrivals changes nothing
    assert not any(gold_plan.refresh_all(spark, root, F.lit("2024-01-20").cast("timestamp"), now).values())


def test_renewed_parts_read_only_their_months(spark, tmp_path):
    root = str(tmp_path)
    layers.write_whole(schemas.conform(traffic(spark, 0, 1000), schemas.EVENT["traffic"]), f"{root}/silver/traffic")
    rows = gold.partial("traffic", gold_plan.clean_table(spark, root, "traffic", ["2022-03"]), layers.month_of())
    assert "2022-03" in details(rows).split("PartitionFilters", 1)[1].split("\n")[0]
    assert {f.split("month=")[1][:7] for f in gold_plan.clean_table(spark, root, "traffic", ["2022-03"]).inputFiles()} >= {"2022-03"}


def test_a_broken_run_goes_on_after_the_jobs_that_ended(spark, frame, tmp_path, monkeypatch):
    root, now = str(tmp_path), F.lit(NOW).cast("timestamp")
    stored(traffic(spark, 0, 20), root, "traffic", "2024-01-01")
    whole = gold_plan.features.district_context

    def broken(*_):
        raise RuntimeError("no context today")

    monkeypatch.setattr(gold_plan.features, "district_context", broken)
    with pytest.raises(RuntimeError):
        gold_plan.run(spark, root, now, run_id="night-7")
    monkeypatch.setattr(gold_plan.features, "district_context", whole)
    silver_layers = layers.all_layers(spark, f"{root}/silver/traffic")
    gold_plan.run(spark, root, now, run_id="night-7")
    log = spark.read.parquet(f"{root}/logs/run_log")
    assert log.groupBy("job_name").count().filter("count > 1").count() == 0 and log.count() == 25
    assert layers.all_layers(spark, f"{root}/silver/traffic") == silver_layers
    gold_plan.run(spark, root, now, run_id="night-8")
    assert spark.read.parquet(f"{root}/logs/run_log").count() == 50 and len(layers.all_layers(spark, f"{root}/silver/traffic")) == 2


def shuffle_written(spark, run):
    """Bytes that tasks write to shuffles while ``run`` runs."""
    store = spark.sparkContext._jsc.sc().statusStore()
    total = lambda: sum(store.executorList(False).apply(i).totalShuffleWrite() for i in range(store.executorList(False).size()))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = total()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


def test_a_refresh_shuffles_its_rows_twice_and_the_table_not_at_all(spark, tmp_path):
    root, since = str(tmp_path), F.lit("2024-02-01").cast("timestamp")
    stored(traffic(spark, 0, 100_000), root, "traffic", "2024-01-01")
    layers.write_whole(silver.clean_batch("traffic", events.read_raw(spark, root, "traffic")), f"{root}/silver/traffic")
    stored(traffic(spark, 100_000, 9_000), root, "traffic", "2024-02-01")
    once = shuffle_written(spark, lambda: silver.clean_batch("traffic", events.read_raw(spark, root, "traffic", arrived=since)).write.format("noop").mode("overwrite").save())
    table = shuffle_written(spark, lambda: gold_plan.clean_table(spark, root, "traffic").repartition(4).write.format("noop").mode("overwrite").save())
    written = shuffle_written(spark, lambda: gold_plan.refresh(spark, root, "traffic", since))
    assert written < 2.5 * once + table / 3  # of the table only the keys pass a shuffle
    assert gold_plan.clean_table(spark, root, "traffic").count() == 109_000


def test_large_changes_become_a_whole_layer_at_once(spark, frame, tmp_path):
    root, path = str(tmp_path), f"{tmp_path}/silver/traffic"
    rows = lambda *r: schemas.conform(frame(SCHEMA, *r), schemas.EVENT["traffic"])
    layers.write_whole(rows(*((f"e{i}", day(1, 1 + i % 3), i) for i in range(30))), path)
    assert gold_plan.upsert(spark, root, "traffic", rows(("e1", day(2, 5), 7))) == (["2024-02", "2024-05"], 1)
    assert [f[-5:] for f in layers.layers(spark, path)] == ["whole", "delta"]
    months, n = gold_plan.upsert(spark, root, "traffic", rows(("e1", day(9, 5), 8), ("e2", day(1, 1), 9), ("new", None, 1), ("new2", day(1), 1)))
    # e2 came with an older time and stays
    assert (months, n) == (["2024-01", "2024-05", layers.UNKNOWN], 3)
    assert [f[-5:] for f in layers.layers(spark, path)] == ["whole"]
    found = dict(values(gold_plan.clean_table(spark, root, "traffic"), "event_id", "vehicle_count"))
    assert len(found) == 32 and (found["e1"], found["e2"], found["new"], found["new2"]) == (8, 2, 1, 1)


def test_a_run_does_only_what_a_table_is_made_from(spark, frame, tmp_path):
    root, now = str(tmp_path), F.lit(NOW).cast("timestamp")
    stored(traffic(spark, 0, 20), root, "traffic", "2024-01-01")
    gold_plan.run(spark, root, now, only=["gold_hotspot_analysis"])
    jobs = sorted(r[0] for r in spark.read.parquet(f"{root}/logs/run_log").select("job_name").collect())
    assert jobs == ["gold_hotspot_analysis", "parts_reports", "silver_reports"]
    assert gold_plan.feeds_of(["features_accidents"]) == [f for f in gold_plan.FEEDS if f != "news"]
    assert gold_plan.feeds_of(["quality_metrics"]) == list(gold_plan.FEEDS)


def codecs(path):
    import pyarrow.parquet as pq

    files = glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True)
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_row_groups}


def test_a_run_makes_clean_tables_of_rare_copies_without_shuffling_them(spark, tmp_path):
    root, now = str(tmp_path), F.lit(NOW).cast("timestamp")
    stored(traffic(spark, 0, 60_000).unionByName(traffic(spark, 0, 50)), root, "traffic", "2024-01-01")
    raw = events.read_raw(spark, root, "traffic")
    whole = shuffle_written(spark, lambda: raw.repartition(4).write.format("noop").mode("overwrite").save())
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    written = shuffle_written(spark, lambda: gold_plan.run(spark, root, now, only=["silver_traffic", "enriched_traffic"]))
    assert written < whole  # hashes of the keys, once for each table; a table would pass whole
    assert (spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"), spark.conf.get("spark.sql.files.maxPartitionBytes")) == before
    table, again = gold_plan.clean_table(spark, root, "traffic"), silver.clean_batch("traffic", raw)
    assert table.count() == 60_000 and table.exceptAll(again).count() == 0
    log = dict(values(spark.read.parquet(f"{root}/logs/run_log"), "job_name", "record_processed"))
    assert log == {"silver_traffic": 60_000, "enriched_traffic": 60_000}
    months = glob.glob(f"{layers.all_layers(spark, f'{root}/silver/traffic')[0].removeprefix('file:')}/{layers.MONTH}=*")
    most = layers.writers(spark, f"{root}/raw/traffic")
    assert len(months) == 36 and all(len(glob.glob(f"{m}/*.parquet")) <= most for m in months)
    assert codecs(f"{root}/silver/traffic") == codecs(f"{root}/enriched/traffic") == {"ZSTD"}


def test_tasks_that_write_a_whole_table(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert layers.writers(spark, path) == 1
    monkeypatch.setattr(layers, "size_of", lambda *_: 3 * layers.CORE_BYTES)
    os.makedirs(path)
    assert layers.writers(spark, path) == 3
    monkeypatch.setattr(layers, "size_of", lambda *_: 90 * layers.TASK_BYTES)
    assert layers.writers(spark, path) == 90
    # more months than are kept open, one of them unknown, and more partitions than tasks
    monkeypatch.setattr(layers, "OPEN_MONTHS", 3)
    rows = frame(SCHEMA, *((f"e{i}", day(1 + i % 28, 1 + i % 12) if i % 13 else None, i) for i in range(300)))
    layers.write_whole(rows.repartition(7), path, tasks=2)
    found = layers.read(spark, path, rows.schema, ["event_id"])
    assert found.count() == 300 and found.exceptAll(rows).count() == 0
    months = glob.glob(f"{layers.all_layers(spark, path)[0].removeprefix('file:')}/{layers.MONTH}=*")
    assert len(months) == 13 and all(len(glob.glob(f"{m}/*.parquet")) <= 2 for m in months)


def test_the_priority_run_shuffles_the_reports_once(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(0, 60_000, 1, 4).select(
        F.concat(F.lit("E"), "id").alias("event_id"), (F.lit("2021-01-01").cast("timestamp") + F.make_dt_interval(F.col("id") % 1095)).alias("event_time"),
        F.concat(F.lit("R"), F.xxhash64("id") % 40_000).alias("report_id"), F.lit("a").alias("road_name"), F.lit("gubeng").alias("district"),
        (F.col("id") % 100).cast("int").alias("severity_score"), F.rand(1).alias("confidence"), F.lit(-7.0).alias("latitude"), F.lit(112.0).alias("longitude"),
    )
    stored(rows, root, "reports", "2024-01-01")
    reports = silver.clean_batch("reports", events.read_raw(spark, root, "reports"))
    once = shuffle_written(spark, lambda: reports.write.format("noop").mode("overwrite").save())
    written = shuffle_written(spark, lambda: gold_plan.run(spark, root, F.lit(NOW).cast("timestamp"), only=["gold_priority_score"]))
    assert written < 1.3 * once  # to find the newest row of each report; not again to lay them out by month
    table = gold_plan.stored(spark, root, "gold/priority_score", spark.read.parquet(events.versions(spark, f"{root}/gold/priority_score")[-1]).schema)
    assert table.count() == reports.count() == table.select("report_id").distinct().count()
    assert codecs(f"{root}/gold/priority_score") == {"ZSTD"}
