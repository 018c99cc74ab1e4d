"""Structured Streaming jobs: raw ingest, dead letters, deduplication, clean tables, articles, live scores, enrichment."""

from collections.abc import Callable
from hashlib import md5
from time import monotonic

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from roadlake import rules, schemas
from roadlake.operators import clean, features, gold, news
from roadlake.plans import gold as gold_plan
from roadlake.plans import silver
from roadlake.session import materialize
from roadlake.sources import events, layers

#: The articles that were handled; ``batch`` is the folder of the batch that did.
LEDGER = StructType([
    StructField("article_id", StringType()), StructField("url", StringType()), StructField("seen_at", TimestampType()),
    StructField(events.ARRIVAL, StringType()), StructField("batch", StringType()),
])


def read_stream(spark: SparkSession, fmt: str = "kafka", feed: str | None = None, **options: str) -> DataFrame:
    if fmt == "kafka" and feed:
        options = {"startingOffsets": rules.STARTING_OFFSETS[feed], **options}
    return spark.readStream.format(fmt).options(**options).load()


def parse(messages: DataFrame, feed: str, as_of: Column | None = None) -> DataFrame:
    """Raw rows with ``valid``; a message that does not fit the feed's schema is not, and keeps its text."""
    parsed = events.parse_envelope(messages, schemas.WIRE[feed], keep_corrupt=True)
    return events.raw_events(parsed, feed, as_of).withColumn("valid", F.col(events.CORRUPT).isNull())


def valid_rows(parsed: DataFrame) -> DataFrame:
    """Works on a stream and on a stored raw table, whose partition values read back as text."""
    return parsed.filter(F.col("valid").cast("boolean")).drop("valid", events.CORRUPT)


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("valid").cast("boolean")).select(F.col(events.CORRUPT).alias("value"))


def _start(writer, trigger: dict) -> StreamingQuery:
    return writer.trigger(**trigger).start()


def start_append(df: DataFrame, path: str, checkpoint: str, by=(), trigger=None) -> StreamingQuery:
    """Append to a Parquet table exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*by)
    return _start(writer.option("path", path), trigger or {"availableNow": True})


def start_batches(df: DataFrame, write: Callable[[DataFrame, str], None], checkpoint: str, trigger=None) -> StreamingQuery:
    """``write(rows, batch)`` for each micro-batch; ``batch`` names the query and the batch, so that what a repeated batch stores
    can replace itself."""
    name = named(checkpoint)
    writer = df.writeStream.outputMode("append").foreachBatch(lambda rows, number: write(rows, f"{name}-{number}"))
    return _start(writer.option("checkpointLocation", checkpoint), trigger or {"availableNow": True})


def start_bronze(messages: DataFrame, feed: str, root: str, as_of: Column | None = None, trigger=None) -> StreamingQuery:
    """The raw table of one feed. Dead letters go to its partition ``valid=false``, so each message is parsed once.

    A micro-batch is stored in a folder of its own, its rows rebalanced by their bytes: a day that fills it is written by many
    tasks, small days share a file each. ``events.compact_batches`` gathers closed days. Daily rain, which
    shares the weather topic, has a table of its own (``start_rain``).
    """
    if feed == "weather":
        messages = messages.filter(~events.is_rain())
    rows = events.with_lineage(parse(messages, feed, as_of), feed, as_of)
    path = f"{root}/raw/{feed}"
    by = events.partition_columns(feed)
    return start_batches(rows, lambda batch, name: events.write_batch(batch, path, name, by), f"{root}/checkpoints/raw/{feed}", trigger)


def start_silver(messages: DataFrame, feed: str, root: str, late: str = "1 day", as_of: Column | None = None, trigger=None) -> StreamingQuery:
    """The clean table of one feed, kept up to date by a stream.

    Each micro-batch is cleaned and merged into the stored table, so a copy is found however late it comes; a
    repeated batch finds its own rows and adds nothing. Every batch leaves a row of counts in logs/stream_counts: valid messages, rows stored, copies
    (messages that are not stored, being older or equal states of their keys or without one) and those ``late`` or more behind their arrival.
    """
    now = F.current_timestamp() if as_of is None else as_of
    rows = valid_rows(parse(messages, feed, as_of))

    def write(batch: DataFrame, name: str) -> None:
        batch = materialize(batch, "stream-batch")
        _, stored = gold_plan.upsert(batch.sparkSession, root, feed, silver.clean_batch(feed, batch))
        behind = F.col("event_time") < now - F.expr(f"INTERVAL {late}")
        counts = batch.agg(F.count("*").alias("messages"), F.count_if(F.coalesce(behind, F.lit(False))).alias("late"))
        counts = counts.withColumns({"feed": F.lit(feed), "stored": F.lit(stored).cast("long"), "copies": F.col("messages") - stored})
        events.write_batch(counts, f"{root}/logs/stream_counts", name)
        layers.merge(batch.sparkSession, f"{root}/silver/{feed}", schemas.EVENT[feed], silver.BATCH_KEYS[feed])

    return start_batches(rows, write, f"{root}/checkpoints/silver/{feed}", trigger)


def start_articles(articles: DataFrame, root: str, order: str = "scraped_at", as_of: Column | None = None,
                   min_confidence: float = 0.0, publish: Callable[[DataFrame, str], None] | None = None, trigger=None) -> StreamingQuery:
    """Articles (url, title, content, source, published_at, scraped_at) to road mentions, each article once.

    Of each micro-batch the articles that the stored ledger does not hold are searched, their mentions stored under
    ``articles/mentions`` and handed to ``publish(messages, batch)`` as keyed messages, and only then do the articles enter
    ``articles/ledger``. A repeated batch does not see its own part of the ledger and replaces what it stored.
    """

    def write(batch: DataFrame, name: str) -> None:
        spark = batch.sparkSession
        seen = events.read_or_empty(spark, f"{root}/articles/ledger", LEDGER).filter(F.col("batch") != name).select("article_id")
        batch = materialize(batch.withColumn("article_id", news.article_id()), "articles")
        # only the ledger's rows for these articles: the batch is the small side, which is broadcast below the threshold
        known = seen.join(batch.select("article_id").distinct(), "article_id", "left_semi")
        new = materialize(news.unseen(batch.drop("article_id"), known, order), "unseen")
        mentions = news.messages(news.extract(new.drop("article_id")), min_confidence)
        events.write_batch(mentions, f"{root}/articles/mentions", name)
        if publish:
            stored = spark.read.schema(mentions.schema).parquet(f"{root}/articles/mentions/batch={name}")
            publish(events.to_envelope(stored, events.KEYS["news"]), name)
        arrival = F.current_timestamp() if as_of is None else as_of
        entries = new.select("article_id", "url", arrival.alias("seen_at"), F.date_format(arrival, "yyyy-MM-dd").alias(events.ARRIVAL))
        events.write_batch(entries, f"{root}/articles/ledger", name)

    return start_batches(articles, write, f"{root}/checkpoints/articles", trigger)


def start_rain(messages: DataFrame, root: str, as_of: Column | None = None, trigger=None) -> StreamingQuery:
    """The raw table of the daily rain records on the weather topic."""
    arrival = F.current_timestamp() if as_of is None else as_of
    rows = events.rain_days(messages).withColumn("ingestion_timestamp", arrival)
    return start_append(rows, f"{root}/raw/rain", f"{root}/checkpoints/raw/rain", trigger=trigger)


def start_all(sources: dict[str, DataFrame], root: str, trigger=None) -> list[StreamingQuery]:
    """All raw tables at once, each with its own checkpoint."""
    started = [start_bronze(messages, feed, root, trigger=trigger) for feed, messages in sources.items()]
    if "weather" in sources:
        started.append(start_rain(sources["weather"], root, trigger=trigger))
    return started


def finish(queries: list[StreamingQuery], timeout: int | None = None) -> None:
    """Wait for all queries. The first failure of any of them stops the others and is raised, even while endless
    ones run; one that exceeds ``timeout`` seconds is stopped."""
    end = None if timeout is None else monotonic() + timeout
    running = list(queries)
    try:
        while running:
            running = [query for query in running if not query.awaitTermination(1)]
            if running and end is not None and monotonic() > end:
                raise TimeoutError(f"stream {running[0].name or running[0].id} did not finish in {timeout} s")
    except Exception:
        for query in queries:
            query.stop()
        raise


def dedup(rows: DataFrame, keys, lateness: str = "1 day") -> DataFrame:
    """First arrival of each key among copies that arrive up to ``lateness`` apart.

    The watermark follows the arrival, which only grows: a backfill of old events, or an event
    with a wrong time, loses nothing. The state holds the keys that came within ``lateness``.
    """
    arrived = rows.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", lateness)
    return arrived.dropDuplicatesWithinWatermark(keys).drop("_arrival")


def dual_sink(path: str, serve: Callable[[DataFrame, int], None] | None = None,
              as_of: Column | None = None) -> Callable[[DataFrame, int], None]:
    """A batch function: files under the folder of the query and the batch, then the serving table.

    A repeated batch replaces its folder, whatever the day; a second query has its own; ``serve`` gets the batch id to be as repeatable, e.g.
    ``lambda df, n: events.write_jdbc(df, table, options, n, keys=["report_id"])``.
    """

    def write(batch: DataFrame, batch_id: int, query: str = "one") -> None:
        stamped = batch.withColumn("batch_time", F.current_timestamp() if as_of is None else as_of)
        folder = f"{path}/query={query}/batch_id={batch_id}"
        stamped.write.mode("overwrite").parquet(folder)
        if serve:
            serve(batch.sparkSession.read.schema(stamped.schema).parquet(folder), batch_id)

    return write


def regional_sink(path: str, as_of: Column | None = None, region=rules.REGION) -> Callable[[DataFrame, int], None]:
    """A batch function: files by query and batch, below that by date and region of the batch time. A repeated
    batch replaces its whole folder, also after midnight."""

    def write(batch: DataFrame, batch_id: int, query: str = "one") -> None:
        stamped = batch.withColumn("batch_time", F.current_timestamp() if as_of is None else as_of)
        by = ["year", "month", "day", *region]
        writer = clean.add_region_parts(stamped, region).hint("rebalance", *by).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "static").partitionBy(*by).parquet(f"{path}/query={query}/batch_id={batch_id}")

    return write


def named(checkpoint: str) -> str:
    """A name for the query that owns a checkpoint."""
    return md5(checkpoint.encode()).hexdigest()[:12]


def per_batch(sink: Callable, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that tells the sink which query writes."""
    query = named(checkpoint)
    return lambda batch, batch_id: sink(batch, batch_id, query)


def start_scores(reports: DataFrame, score: Callable[[DataFrame], DataFrame], sink, checkpoint: str,
                 trigger=None) -> StreamingQuery:
    """A stateless score (``gold.simple_priority``, ``gold.damage_records``) of a report stream."""
    writer = score(reports).writeStream.outputMode("append").foreachBatch(per_batch(sink, checkpoint))
    return _start(writer.option("checkpointLocation", checkpoint), trigger or {"availableNow": True})


def start_district_health(reports: DataFrame, path: str, checkpoint: str, trigger=None) -> StreamingQuery:
    """District health of all reports so far; each batch adds a version of the snapshot (``events.read_snapshot``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        snapshot = batch.withColumns({"batch_id": F.lit(batch_id), "batch_time": F.current_timestamp()})
        events.write_version(snapshot, path)

    writer = gold.district_health(reports).writeStream.outputMode("complete").foreachBatch(write)
    return _start(writer.option("checkpointLocation", checkpoint), trigger or {"availableNow": True})


def start_accident_enrichment(accidents: DataFrame, context: Callable[[], DataFrame], path: str, checkpoint: str,
                              as_of: Column | None = None, trigger=None) -> StreamingQuery:
    """Accident stream with district features.

    ``context()`` gives the newest stored features (``district_context``, made by the batch run); it is asked
    anew for every batch and should only read.
    """
    sink = dual_sink(path, as_of=as_of)

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(features.enrich(batch, context()), batch_id, named(checkpoint))

    writer = accidents.writeStream.outputMode("append").foreachBatch(write)
    return _start(writer.option("checkpointLocation", checkpoint), trigger or {"availableNow": True})
