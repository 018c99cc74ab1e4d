"""The batch run: raw tables to clean tables to score tables."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from roadlake import rules, schemas
from roadlake.operators import clean, features, gold, ml, news, quality, rainfall
from roadlake.plans import silver
from roadlake.session import materialize, settings
from roadlake.sources import events, layers

FEEDS = tuple(schemas.EVENT)
# what tells the rows of a serving table apart within a batch
SERVING_KEYS = {
    "road_health_index": ["road_name", "district"],
    "priority_score": ["report_id"],
    "damage_prediction": ["report_id"],
    "accident_prediction": ["road_name", "district"],
    "hotspot_analysis": ["road_id"],
}

#: Bytes of a raw table that a task of a run reads at most: its rows may be sorted by key in memory, where they are many times as large.
READ = {"spark.sql.files.maxPartitionBytes": str(16 << 20)}

#: What each job of a batch run is made from, by layer and name; the others need raw tables alone.
NEEDS = {
    "features_district_context": ["enriched_reports", "enriched_traffic", "enriched_weather"],
    "features_accidents": ["enriched_accidents", "features_district_context"],
    "quality_metrics": [f"silver_{feed}" for feed in FEEDS],
    "gold_news_summary": ["silver_news"],
    **{f"parts_{feed}": [f"silver_{feed}"] for feed in FEEDS},
    "gold_road_health_index": ["parts_reports", "parts_weather", "parts_traffic"],
    "gold_accident_prediction": ["parts_reports", "parts_weather", "parts_traffic"],
    "gold_priority_score": ["parts_reports", "parts_traffic", "parts_accidents", "parts_news"],
    "gold_hotspot_analysis": ["parts_reports"],
    "gold_damage_prediction": ["silver_reports"],
}


def needed(jobs) -> set[str]:
    """These jobs and all that they are made from."""
    found, open_jobs = set(), list(jobs)
    while open_jobs:
        job = open_jobs.pop()
        if job not in found:
            found.add(job)
            open_jobs += NEEDS.get(job, [])
    return found


def feeds_of(jobs) -> list[str]:
    """The feeds whose raw tables these jobs are made from."""
    found = needed(jobs)
    return [feed for feed in FEEDS if {f"silver_{feed}", f"enriched_{feed}"} & found]


def priority_from_raw(reports: DataFrame, traffic: DataFrame, accidents: DataFrame, articles: DataFrame,
                      as_of: Column | None = None) -> DataFrame:
    """Priority straight from raw feeds. The clean reports are stored, as two branches read them."""
    used = silver.clean_batch("reports", reports).select(
        "report_id", "road_name", "district", "damage_type", "severity_score"
    )
    return gold.priority_score(
        materialize(used, "clean-reports"),
        silver.clean_batch("traffic", traffic),
        silver.clean_batch("accidents", accidents),
        silver.clean_batch("news", articles),
        as_of,
    )


def score_tables(tables: dict[str, DataFrame], as_of: Column | None = None) -> dict[str, DataFrame]:
    """All score tables from the clean tables."""
    as_of = F.current_timestamp() if as_of is None else as_of
    reports = tables["reports"]
    health = gold.road_health_index(reports, tables["weather"], tables["traffic"], as_of)
    # stored once, as it is published and feeds the accident prediction
    health = materialize(health, "road-health")
    return {
        "road_health_index": health,
        "priority_score": gold.priority_score(
            reports, tables["traffic"], tables["accidents"], tables["news"], as_of
        ),
        "damage_prediction": gold.damage_prediction(reports, as_of),
        "accident_prediction": gold.accident_prediction(health, as_of),
        "hotspot_analysis": gold.hotspots(reports, as_of),
    }


def clean_table(spark: SparkSession, root: str, feed: str, months=None) -> DataFrame:
    """A stored clean table, or some months of it; nothing else is read."""
    return layers.read(spark, f"{root}/silver/{feed}", schemas.EVENT[feed], silver.BATCH_KEYS[feed], months)


def clean_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored clean tables."""
    return {feed: clean_table(spark, root, feed) for feed in FEEDS}


def stored(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    return events.read_snapshot(spark, f"{root}/{name}", schema)


def done_jobs(spark: SparkSession, root: str, run_id: str) -> set[str]:
    """The jobs that ended well under a run's id."""
    log = events.read_or_empty(spark, f"{root}/logs/run_log", schemas.RUN_LOG)
    ended = log.filter((F.col("checkpoint_path") == run_id) & (F.col("status") == "success"))
    return {row[0] for row in ended.select("job_name").distinct().collect()}  # one for each job at most


def run(spark: SparkSession, root: str, as_of: Column | None = None, serving: dict[str, str] | None = None,
        batch_id: int | None = None, run_id: str | None = None, only=None) -> None:
    """One batch over the tables below ``root``: raw/<feed> to silver, enriched, features, quality, parts and gold.

    Each job leaves a row in logs/run_log. With ``serving`` (JDBC options) complete rows are published as well,
    under ``batch_id`` so that a repeated run adds nothing, and the others are kept under ``rejects``.
    A run that is called again with its ``run_id`` goes on after the jobs that ended under it, whose tables it reads; it
    should get the same ``as_of``. With ``only`` (such as "gold_hotspot_analysis") it does these jobs and those they are made from (``NEEDS``).
    """
    now = F.current_timestamp() if as_of is None else as_of
    done = done_jobs(spark, root, run_id) if run_id else set()
    jobs = None if only is None else needed(only)

    def wanted(name: str) -> bool:
        return jobs is None or name in jobs

    def job(df: DataFrame, layer: str, name: str, write=None) -> DataFrame:
        """Store a table as a logged job, if that was not done, and give it back as stored."""
        path = f"{root}/{layer}/{name}"
        if f"{layer}_{name}" not in done:
            with settings(spark, READ if layer in ("silver", "enriched") else {}):
                quality.run_logged(
                    df, f"{layer}_{name}", layer, write or (lambda rows: events.write_version(rows, path)),
                    lambda row: row.coalesce(1).write.mode("append").parquet(f"{root}/logs/run_log"), run_id,
                )
        return df if write else stored(spark, root, f"{layer}/{name}", df.schema)

    raw = {feed: events.read_raw(spark, root, feed) for feed in FEEDS}
    for feed in FEEDS:
        if wanted(f"silver_{feed}"):
            tasks = layers.writers(spark, f"{root}/raw/{feed}")
            job(silver.clean_batch(feed, raw[feed]), "silver", feed, lambda rows, p=f"{root}/silver/{feed}", n=tasks: layers.write_whole(rows, p, tasks=n))
    if "silver_rain" not in done and wanted("silver_rain"):  # reads the table that it replaces
        refresh_rain(spark, root, job)
    tables = clean_tables(spark, root)
    full = {feed: job(silver.clean_enriched(feed, raw[feed], now), "enriched", feed) for feed in FEEDS if wanted(f"enriched_{feed}")}
    if wanted("features_district_context"):
        context = job(features.district_context(full["reports"], full["traffic"], full["weather"]), "features", "district_context")
    if wanted("features_accidents"):
        job(features.enrich(full["accidents"], context), "features", "accidents")
    if wanted("quality_metrics"):
        job(reduce(DataFrame.unionByName, [
            quality.metrics(table[feed], layer, feed, silver.BATCH_KEYS[feed], rules.RANGE_RULES.get(feed), silver.ORDER.get(feed, clean.LATEST))
            for layer, table in (("bronze", raw), ("silver", tables)) for feed in FEEDS
        ]), "quality", "metrics")
    if wanted("gold_news_summary"):
        job(news.road_summary(tables["news"]), "gold", "news_summary")
    for feed in FEEDS:
        if wanted(f"parts_{feed}"):
            parts = gold.partial(feed, tables[feed], layers.month_of())
            job(parts, "parts", feed, lambda rows, p=f"{root}/parts/{feed}": layers.write_whole(rows, p, F.col(layers.MONTH)))
    names = [name for name in PART_SCORES if wanted(f"gold_{name}")]
    for name, scores in scores_of_parts(spark, root, tables["reports"], as_of, names).items():
        table = job(scores, "gold", name)
        if serving:
            publish(table, root, name, serving, batch_id)
    if wanted("gold_damage_prediction"):
        damage = gold.damage_prediction(tables["reports"], as_of, also=["event_time"])
        by_month = layers.is_whole(spark, f"{root}/silver/reports")
        job(damage, "gold", "damage_prediction", lambda rows: write_damage(rows, root, layers.write_whole, by_month))
        if serving:
            publish(damage_table(spark, root), root, "damage_prediction", serving, batch_id)


def publish(table: DataFrame, root: str, name: str, serving: dict[str, str], batch_id: int | None) -> None:
    """Complete rows go to the serving table, the others to ``rejects``."""
    complete, rejected = gold.split_complete(table, schemas.REQUIRED[name])
    events.write_jdbc(complete, name, serving, batch_id, SERVING_KEYS[name])
    events.write_version(rejected, f"{root}/rejects/{name}")


# scores kept up to date: partial aggregates by month, and the months that a refresh touched


def write_damage(rows: DataFrame, root: str, write, by_month: bool = False) -> None:
    """Predicted damage is kept by month, as it follows from each report alone; so it lies as the reports do."""
    kept = rows.withColumn(layers.MONTH, layers.month_of()).drop("event_time")
    write(kept, f"{root}/gold/damage_prediction", F.col(layers.MONTH), by_month=by_month)


def damage_table(spark: SparkSession, root: str) -> DataFrame:
    columns = gold.damage_prediction(spark.createDataFrame([], schemas.EVENT["reports"])).schema
    return layers.read_months(spark, f"{root}/gold/damage_prediction", columns).filter("report_id IS NOT NULL").select(*columns.names)


def parts_of(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """The partial aggregates of a feed, all months."""
    shape = gold.partial(feed, spark.createDataFrame([], schemas.EVENT[feed]), layers.month_of()).drop(layers.MONTH).schema
    return layers.read_months(spark, f"{root}/parts/{feed}", shape)


#: Score tables that are made from partial aggregates.
PART_SCORES = ("road_health_index", "priority_score", "accident_prediction", "hotspot_analysis")


def scores_of_parts(spark: SparkSession, root: str, reports: DataFrame, as_of: Column | None = None, names=PART_SCORES) -> dict[str, DataFrame]:
    """The score tables of roads from stored partial aggregates; only the priority reads ``reports``, for its rows."""
    as_of = F.current_timestamp() if as_of is None else as_of
    sums = {feed: gold.combined(parts_of(spark, root, feed), keys) for feed, (keys, _) in gold.PARTS.items()}
    traffic = sums["traffic"].select(*gold.ROAD, (F.col("mean") / rules.TRAFFIC_DIVISOR).alias("traffic"))
    made = {}
    if {"road_health_index", "accident_prediction"} & set(names):
        severity = sums["reports"].select(*gold.ROAD, F.col("mean").alias("severity"))
        rainfall = sums["weather"].select("district", F.col("mean").alias("rainfall"))
        # stored once, as it is published and feeds the accident prediction
        health = materialize(gold.health_of(severity, rainfall, traffic, as_of), "road-health")
        made = {"road_health_index": health, "accident_prediction": gold.accident_prediction(health, as_of)}
    if "priority_score" in names:
        accidents = sums["accidents"].select(*gold.ROAD, F.col("rows").alias("accident_count"))
        mentions = sums["news"].select("district", F.col("rows").alias("news_count"))
        context = gold.context_of(sums["reports"].select(*gold.ROAD, F.col("rows").alias("n")), traffic, accidents, mentions)
        made["priority_score"] = gold.priority_of(reports, context, as_of)
    if "hotspot_analysis" in names:
        roads = gold.combined(parts_of(spark, root, "reports"), ["road_name"])
        made["hotspot_analysis"] = gold.hotspots_of(roads.select("road_name", F.col("rows").alias("report_count"), F.col("mean").alias("avg_severity")), as_of)
    return {name: made[name] for name in names}


def refresh_parts(spark: SparkSession, root: str, feed: str, months: list[str]) -> None:
    """Bring the partial aggregates of some months up to date: only these months of the clean table are read."""
    rows = gold.partial(feed, clean_table(spark, root, feed, months), layers.month_of())
    # a month whose rows have all moved away still replaces its former state
    keys, _ = gold.PARTS[feed]
    empty = spark.createDataFrame([(m,) for m in months], f"{layers.MONTH} string").select(
        layers.MONTH, *[F.lit(None).cast("string").alias(k) for k in keys],
        F.lit(0).cast("long").alias("rows"), F.lit(0.0).alias("total"), F.lit(0).cast("long").alias("known"), F.lit(None).cast("timestamp").alias("latest"),
    )
    layers.write_delta(rows.unionByName(empty), f"{root}/parts/{feed}", F.col(layers.MONTH))


def refresh_scores(spark: SparkSession, root: str, touched: dict[str, list[str]], as_of: Column | None = None, only=None) -> None:
    """Bring the score tables up to date after a refresh that touched these months of each feed; equals making them anew."""
    jobs = None if only is None else needed(only)

    def wanted(name: str) -> bool:
        return jobs is None or name in jobs

    for feed, months in touched.items():
        if months and wanted(f"parts_{feed}"):
            refresh_parts(spark, root, feed, months)
    if not any(touched.values()):
        return
    names = [name for name in PART_SCORES if wanted(f"gold_{name}")]
    for name, scores in scores_of_parts(spark, root, clean_table(spark, root, "reports"), as_of, names).items():
        events.write_version(scores, f"{root}/gold/{name}")
    if touched.get("reports") and wanted("gold_damage_prediction"):
        months = touched["reports"]
        rows = gold.damage_prediction(clean_table(spark, root, "reports", months), as_of, also=["event_time"])
        kept = rows.withColumn(layers.MONTH, layers.month_of()).drop("event_time")
        # as above; readers leave out rows without a report
        gone = spark.createDataFrame([(m,) for m in months], f"{layers.MONTH} string")
        by_month = layers.is_whole(spark, f"{root}/silver/reports")
        layers.write_delta(kept.unionByName(gone, allowMissingColumns=True), f"{root}/gold/damage_prediction", F.col(layers.MONTH), by_month=by_month)


def refresh_rain(spark: SparkSession, root: str, job) -> None:
    """Daily rain: the last arrival of each day, rolling sums, merged into the stored table."""
    arrived = StructType([*schemas.RAIN_DAY, StructField("ingestion_timestamp", TimestampType())])
    days = events.read_or_empty(spark, f"{root}/raw/rain", arrived).filter("date IS NOT NULL")
    rolled = rainfall.rolling(days, recency="ingestion_timestamp").drop("ingestion_timestamp")
    known = stored(spark, root, "silver/rain", rolled.schema)
    job(rainfall.upsert(known, rolled).drop("action").select(rolled.columns), "silver", "rain")


def upsert(spark: SparkSession, root: str, feed: str, new: DataFrame) -> tuple[list[str], int]:
    """Merge clean rows into a clean table: (months that changed, rows that were stored).

    What is stored are the new rows that win against the known ones (``layers.write_changes``); copies are not. The table's key columns tell
    which arrivals it holds already and in which months. Only these arrivals are compared, with the rows of these months; the others pass
    no shuffle but the one that removes their copies and the one that stores them.
    """
    path, schema, keys = f"{root}/silver/{feed}", schemas.EVENT[feed], silver.BATCH_KEYS[feed]
    # joined by plain equality where a key cannot be NULL: the arrivals then stay where their copies were removed
    optional = silver.OPTIONAL.get(feed, ())
    held = layers.keys_now(spark, path, schema, keys).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(layers.MONTH).alias("_place"))
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(key).eqNullSafe(F.col(f"_{key}")) if key in optional else F.col(key) == F.col(f"_{key}"))
    arrived = materialize(new.join(held, on, "left").select(*new.columns, "_place"), "arrived")
    fresh, again = arrived.filter("_place IS NULL"), arrived.filter("_place IS NOT NULL")
    places = sorted(row[0] for row in again.select("_place").distinct().collect())  # as many as the table has, at most
    won = None
    if places:
        known = clean_table(spark, root, feed, places)
        known = known.join(again.select(*keys), layers.same_keys(known, again, keys), "left_semi")
        # the mark decides last, so an equal row stays the known one; a group holds one known and one new row
        marks = [F.struct(F.col("_known"), F.col("_place")).alias("_mark")]
        both = known.withColumns({"_known": F.lit(True), "_place": F.lit(None).cast("string")}).unionByName(again.withColumn("_known", F.lit(False)))
        both = both.select(*schema.names, *marks)
        won = silver.newest(feed, both).filter("NOT _mark._known").select(*schema.names, F.col("_mark._place").alias("_place"))
        won = materialize(won, "won")
    changed = fresh if won is None else fresh.unionByName(won)
    months = changed.select(F.explode(F.array(layers.month_of(), "_place")).alias("m")).filter("m IS NOT NULL").distinct()
    months = sorted(row.m for row in months.collect())  # as many as the table has, at most
    if not months:
        return [], 0
    gone = (again.limit(0) if won is None else won).select(*keys)
    layers.write_changes(changed.drop("_place"), path, schema, keys, gone)
    return months, changed.count()  # stored tables both


def refresh(spark: SparkSession, root: str, feed: str, arrived: Column) -> list[str]:
    """Bring a clean table up to date with the raw rows that came in since ``arrived``, whatever their day; gives the months that changed.

    Reads the raw days since then, the key columns of the table and the months of these keys; writes the rows that changed. Deltas become part of the
    table once they hold a tenth of it.
    """
    months, _ = upsert(spark, root, feed, silver.clean_batch(feed, events.read_raw(spark, root, feed, arrived=arrived)))
    layers.merge(spark, f"{root}/silver/{feed}", schemas.EVENT[feed], silver.BATCH_KEYS[feed])
    return months


def refresh_all(spark: SparkSession, root: str, arrived: Column, as_of: Column | None = None, only=None) -> dict[str, list[str]]:
    """Refresh all clean tables and what follows from them, or what the jobs ``only`` need; gives the months that changed in each."""
    touched = {feed: refresh(spark, root, feed, arrived) for feed in (FEEDS if only is None else feeds_of(only))}
    refresh_scores(spark, root, touched, as_of, only)
    return touched


def train_model(rows: DataFrame, path: str, key: str = "accident_id", forest=rules.FOREST) -> DataFrame:
    """Train on a hash split of the feature rows, save the model at ``path``, return its metrics.

    The test rows go through the saved model: a model fresh from training drags its session along.
    """
    rows = materialize(ml.training_rows(rows), "training-rows")
    train, test = ml.split(rows, key)
    ml.save(ml.train(train, forest), path)
    scored = ml.score(test, path).select("label", "rawPrediction", "prediction")
    return ml.evaluate(materialize(scored, "predictions"))  # three measures read them
