"""Event sources and sinks: keyed JSON messages, raw tables, snapshots, serving tables."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampType

from roadlake import rules, schemas
from roadlake.operators import clean

CORRUPT = "_corrupt_record"
#: Partition of raw tables: the day on which a row came in.
ARRIVAL = "arrival_day"
ISO_SECONDS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
KEYS = rules.MESSAGE_KEYS
#: A message names its event by one of these.
IDS = ("event_id", "report_id", "accident_id")
#: How tables of events are stored: about half the bytes of the default codec, in row groups that one task can sort in memory,
#: without dictionaries of values that hardly repeat.
STORED = {
    "compression": "zstd", "parquet.block.size": str(16 << 20),
    **{f"parquet.enable.dictionary#{c}": "false" for c in IDS},
}


def topic_options(feed: str, servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": rules.TOPICS[feed]}


def read_events(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """All messages a bounded source holds now; a broker is read from its first to its last offset."""
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "endingOffsets": "latest", **options}
    return spark.read.format(fmt).options(**options).load()


def parse_envelope(messages: DataFrame, schema: StructType, keep_corrupt: bool = False) -> DataFrame:
    """The JSON object in ``value`` as columns; unknown fields are dropped, unfit values become NULL.

    With ``keep_corrupt`` the text of a message that does not fit, or names no event, is kept in
    ``_corrupt_record`` (empty for a message without a value).
    """
    if not keep_corrupt:
        # inline keeps later filters above the parser, which then runs once per message
        return messages.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), schema))))
    names = schema.fieldNames()
    schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = F.col("value").cast("string")
    parsed = messages.select(text.alias("_text"), F.inline(F.array(F.from_json(text, schema, options))))
    no_id = F.coalesce(*[F.col(c) for c in IDS if c in names]).isNull()
    broken = F.when(no_id, F.coalesce(CORRUPT, "_text", F.lit(""))).otherwise(F.col(CORRUPT))
    return parsed.withColumn(CORRUPT, broken).drop("_text")


def to_envelope(df: DataFrame, key: str) -> DataFrame:
    """Rows as keyed JSON messages, times as ISO 8601 seconds."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*"), ISO_SECONDS).alias("value"))


def publish(df: DataFrame, key: str, fmt: str = "kafka", **options: str) -> None:
    to_envelope(df, key).write.format(fmt).options(**options).mode("append").save()


def raw_events(parsed: DataFrame, feed: str, as_of: Column | None = None) -> DataFrame:
    """Wire rows as raw-table rows: parsed time (else now), report defaults, the feed's columns."""
    now = F.current_timestamp() if as_of is None else as_of
    timed = parsed.withColumn("event_time", clean.event_time("event_time", now))
    if feed == "reports":
        timed = clean.fill_constants(timed, rules.REPORT_DEFAULTS)
    kept = [CORRUPT] if CORRUPT in parsed.columns else []
    return schemas.conform(timed, StructType([*schemas.EVENT[feed], *[StructField(c, StringType()) for c in kept]]))


def with_lineage(raw: DataFrame, feed: str, as_of: Column | None = None) -> DataFrame:
    """Add ingestion time, source and partition keys. News carries its own source; traffic has no district key."""
    now = F.current_timestamp() if as_of is None else as_of
    source = {} if feed == "news" else {"source": F.lit(f"kafka_{'road_reports' if feed == 'reports' else feed}")}
    arrived = {"ingestion_timestamp": now, ARRIVAL: F.date_format(now, "yyyy-MM-dd")}
    return clean.add_partition_keys(raw.withColumns({**arrived, **source}), district=None if feed == "traffic" else "district")


def partition_columns(feed: str) -> list[str]:
    """By days of arrival and event: district names are free text, and a folder for each would hold a few rows."""
    return ["valid", ARRIVAL, "date_partition"]


def route_weather(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(weather events, daily rain): two kinds of record share a topic, told apart by their key field."""
    event = F.get_json_object(F.col("value").cast("string"), "$.event_id")
    return parse_envelope(messages.filter(event.isNotNull()), schemas.WIRE["weather"]), rain_days(messages)


def is_rain() -> Column:
    """A message of the weather topic that names a day instead of an event. Only texts that can hold the name, spelled out
    or with escapes, are parsed for it."""
    text = F.col("value").cast("string")
    event, day = F.get_json_object(text, "$.event_id"), F.get_json_object(text, "$.date")
    named = F.contains(text, F.lit("date")) | F.contains(text, F.lit("\\"))
    return F.coalesce(named & event.isNull() & day.isNotNull(), F.lit(False))


def rain_days(messages: DataFrame) -> DataFrame:
    return parse_envelope(messages.filter(is_rain()), schemas.RAIN_DAY)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or an empty one where the path does not exist; any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_raw(spark: SparkSession, root: str, feed: str, since: str | None = None, arrived: Column | None = None) -> DataFrame:
    """Valid rows of a raw table; ``since`` (yyyy-MM-dd) reads only the partitions from that day on, ``arrived`` only
    rows that came in at that time or later, whatever their day (or without a known arrival)."""
    stored = StructType([
        *schemas.EVENT[feed], StructField("valid", BooleanType()), StructField("date_partition", StringType()),
        StructField("ingestion_timestamp", TimestampType()), StructField(ARRIVAL, StringType()),
    ])
    rows = read_or_empty(spark, f"{root}/raw/{feed}", stored).filter("valid")
    if since:
        rows = rows.filter(F.col("date_partition") >= since)
    if arrived is not None:
        day = F.col(ARRIVAL)
        rows = rows.filter((day >= F.date_format(arrived, "yyyy-MM-dd")) | day.isNull())  # skips folders
        rows = rows.filter((F.col("ingestion_timestamp") >= arrived) | F.col("ingestion_timestamp").isNull())
    return rows.select(*schemas.EVENT[feed].names)


def write_partitioned(df: DataFrame, path: str, by) -> None:
    """Append to a partitioned table. Rebalancing gathers a partition's rows and splits large ones."""
    df.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)


def write_snapshot(df: DataFrame, path: str, by=None) -> None:
    """Replace the table, or with ``by`` only the partitions that ``df`` holds."""
    if not by:
        df.write.mode("overwrite").parquet(path)
        return
    writer = df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def files_of(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, path: str) -> list[str]:
    """The finished versions of a snapshot, oldest first."""
    files, place = files_of(spark, path)
    if not files.exists(place):
        return []
    found = sorted(s.getPath().toString() for s in files.listStatus(place) if s.getPath().getName().startswith("version="))
    return [v for v in found if files.exists(files_of(spark, f"{v}/_SUCCESS")[1])]


def write_version(df: DataFrame, path: str, keep: int = 2) -> None:
    """Store ``df`` as the newest version of a snapshot. Readers keep the one before until this one is finished, and
    a failed job leaves it; versions older than the ``keep`` newest are deleted."""
    spark = df.sparkSession
    known = versions(spark, path)
    number = int(known[-1].rsplit("=", 1)[1]) + 1 if known else 0
    df.write.mode("overwrite").options(**STORED).parquet(f"{path}/version={number:012d}")
    for old in versions(spark, path)[:-keep]:
        files, place = files_of(spark, old)
        files.delete(place, True)


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest finished version of a snapshot, or an empty table where there is none."""
    known = versions(spark, path)
    return spark.read.schema(schema).parquet(known[-1]) if known else spark.createDataFrame([], schema)


def write_batch(df: DataFrame, path: str, batch: str, by=()) -> None:
    """Store a batch of a table that only grows, in a folder of its own: a repeated batch replaces itself. The rows are
    rebalanced by their bytes, so a partition that fills the batch is written by many tasks and small ones share files."""
    rows = df.hint("rebalance", *by) if by else df.hint("rebalance")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/batch={batch}")


def batches(spark: SparkSession, path: str) -> list[str]:
    """The finished batches of a table, oldest first."""
    files, place = files_of(spark, path)
    if not files.exists(place):
        return []
    found = [s for s in files.listStatus(place) if s.getPath().getName().startswith("batch=")]
    found = [s for s in found if files.exists(files_of(spark, f"{s.getPath().toString()}/_SUCCESS")[1])]
    return [s.getPath().toString() for s in sorted(found, key=lambda s: (s.getModificationTime(), s.getPath().toString()))]


def compact_batches(spark: SparkSession, path: str, before: str, by=()) -> int:
    """Gather the batches that hold only arrivals of days before ``before`` (yyyy-MM-dd) into one; gives how many there were.

    The newest batch of a query may be repeated and stays. The gathered batch is written before the others go, so
    nothing is lost; a job broken in between leaves rows twice, as a repeated delivery would, and the next one gathers them again.
    """
    newest: dict[str, str] = {}
    for batch in batches(spark, path):
        newest[batch.rsplit("batch=", 1)[1].rsplit("-", 1)[0]] = batch
    closed = []
    for batch in batches(spark, path):
        if newest[batch.rsplit("batch=", 1)[1].rsplit("-", 1)[0]] != batch or "batch=closed-" in batch:
            days = {str(r[0]) for r in spark.read.option("basePath", path).parquet(batch).select(ARRIVAL).distinct().collect()}
            if all(day < before for day in days):
                closed.append(batch)
    if len(closed) < 2:
        return 0
    rows = spark.read.option("basePath", path).parquet(*closed).drop("batch")
    write_batch(rows, path, f"closed-{uuid.uuid4().hex}", by)
    for old in closed:
        files, place = files_of(spark, old)
        files.delete(place, True)
    return len(closed)


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], batch_id: int | None = None, keys=()) -> None:
    """Append to a serving table; a failure is raised.

    With ``batch_id`` the rows carry it, and rows of that batch already in the table are left out,
    so that a repeated batch adds nothing.
    """
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        known = df.sparkSession.read.format("jdbc").options(**options).option("dbtable", table).load()
        known = known.filter(F.col("batch_id") == batch_id).select(*keys)
        df = df.join(known, list(keys), "left_anti")
    df.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()
