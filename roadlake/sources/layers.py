"""Clean tables in layers: a whole table by event month, and deltas on top of it that hold only what changed.

A layer is finished when its job ends; readers use the newest whole layer and the deltas after it, and a failed job leaves
none. A whole layer supersedes all before it. In a table with keys, which are unique in a layer, the newest delta row of a key replaces the
others (``read``); the keys that a delta replaces may lie next to it, so that readers need not look for them. In a table kept by month, a
layer's month replaces that month (``read_months``).
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roadlake.session import settings
from roadlake.sources.events import STORED, files_of

MONTH = "month"
#: Month of rows without a time.
UNKNOWN = "unknown"
#: Bytes of deltas, as a share of the whole layer, from which they are merged into a new one.
MERGE_SHARE = 0.1
#: Files of a month, on average, up to which a merge may leave its rows where they lie.
MONTH_FILES = 8
#: Months that a task may hold open while it writes its partitions; rows of further ones are sorted together.
OPEN_MONTHS = 240
#: Bytes of the source from which a core is worth a task that writes a file a month, and those that one task takes on.
CORE_BYTES, TASK_BYTES = 8 << 20, 256 << 20


def month_of(time: str = "event_time") -> Column:
    return F.coalesce(F.date_format(time, "yyyy-MM"), F.lit(UNKNOWN))


def all_layers(spark: SparkSession, path: str) -> list[str]:
    """The finished layers, oldest first."""
    files, place = files_of(spark, path)
    if not files.exists(place):
        return []
    found = sorted(s.getPath().toString() for s in files.listStatus(place) if s.getPath().getName().startswith("layer="))
    return [f for f in found if files.exists(files_of(spark, f"{f}/_SUCCESS")[1])]


def layers(spark: SparkSession, path: str) -> list[str]:
    """The newest whole layer and the deltas after it; only deltas where there is no whole layer."""
    known = all_layers(spark, path)
    whole = max((i for i, f in enumerate(known) if f.endswith("-whole")), default=0)
    return known[whole:]


def _keys_place(layer: str) -> str:
    """Where the keys that a delta replaces are stored."""
    path, name = layer.rsplit("/layer=", 1)
    return f"{path}/replaced={name.split('-')[0]}"


def writers(spark: SparkSession, source: str) -> int:
    """Tasks that write a whole table made from the one at ``source`` without a shuffle: a core each, more where they would write too much."""
    size = size_of(spark, source) if files_of(spark, source)[0].exists(files_of(spark, source)[1]) else 0
    return max(1, min(spark.sparkContext.defaultParallelism, size // CORE_BYTES), size // TASK_BYTES)


def _write(df: DataFrame, path: str, kind: str, by_month: bool, replaced: DataFrame | None = None, tasks: int | None = None) -> None:
    spark = df.sparkSession
    known = all_layers(spark, path)
    number = int(known[-1].rsplit("=", 1)[1].split("-")[0]) + 1 if known else 0
    layer = f"{path}/layer={number:012d}-{kind}"
    files, keys = files_of(spark, _keys_place(layer))
    files.delete(keys, True)  # an unfinished layer may have left them
    if replaced is not None:
        replaced.write.mode("overwrite").parquet(keys.toString())
    rows = df if by_month else df.sortWithinPartitions(MONTH).coalesce(tasks) if tasks else df.hint("rebalance", MONTH)
    writer = rows.write.mode("overwrite").options(**STORED if tasks else {}).option("partitionOverwriteMode", "static")
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_MONTHS)} if tasks else {}):
        writer.partitionBy(MONTH).parquet(layer)
    if kind == "whole":  # readers may still use the whole layer before
        before = max((i for i, f in enumerate(known) if f.endswith("-whole")), default=0)
        for old in known[:before]:
            for place in (files_of(spark, old)[1], files_of(spark, _keys_place(old))[1]):
                files.delete(place, True)


def write_whole(df: DataFrame, path: str, month: Column | None = None, by_month: bool = False, tasks: int | None = None) -> None:
    """Store the table; whatever it held before is superseded. Rows that come straight from files kept by month are said to lie
    ``by_month`` and pass no shuffle: the new table has as many files as these. With ``tasks`` so many tasks at most write the rows
    without a shuffle, each a file a month; a task sorts one of its partitions after the other by month and keeps the files open. These are stored
    as ``events.STORED`` says, as they hold all rows."""
    _write(df.withColumn(MONTH, month_of() if month is None else month), path, "whole", by_month, tasks=tasks)


def write_delta(df: DataFrame, path: str, month: Column | None = None, replaced: DataFrame | None = None, by_month: bool = False) -> None:
    """Store new rows, or new states of months, on top of the table. ``replaced`` names the keys among them that the table holds already;
    without it every key counts as one of these."""
    _write(df.withColumn(MONTH, month_of() if month is None else month), path, "delta", by_month, replaced)


def _rows(spark: SparkSession, layer: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema, StructField(MONTH, StringType())])).parquet(layer)


def same_keys(a: DataFrame, b: DataFrame, keys) -> Column:
    """Equality of keys that may be NULL, which counts as a key."""
    on = F.lit(True)
    for key in keys:
        on = on & a[key].eqNullSafe(b[key])
    return on


def _current(spark: SparkSession, path: str, schema: StructType, keys, months: Iterable[str] | None = None) -> DataFrame | None:
    """The rows as they are now, with their month; None where there is no table."""
    found = layers(spark, path)
    if not found:
        return None
    wanted = F.lit(True) if months is None else F.col(MONTH).isin(*months) if months else F.lit(False)
    rows = replaced = None
    for number, layer in enumerate(found):
        part = _rows(spark, layer, schema).filter(wanted).withColumn("_layer", F.lit(number))
        rows = part if rows is None else rows.unionByName(part)
        if number:
            used = StructType([f for f in schema if f.name in keys])
            files, place = files_of(spark, _keys_place(layer))
            part = spark.read.schema(used).parquet(place.toString()) if files.exists(place) else _rows(spark, layer, used)
            part = part.select(*[F.col(k).alias(f"_{k}") for k in keys], F.lit(number).alias("_by"))
            replaced = part if replaced is None else replaced.unionByName(part)
    if replaced is None:
        return rows
    if len(found) > 2:
        replaced = replaced.groupBy(*[f"_{k}" for k in keys]).agg(F.max("_by").alias("_by"))
    on = F.col("_layer") < F.col("_by")
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return rows.join(replaced, on, "left_anti")


def read(spark: SparkSession, path: str, schema: StructType, keys, months: Iterable[str] | None = None) -> DataFrame:
    """The rows as they are now, or those of some months: all layers without the keys that a later delta replaces. These keys are
    broadcast while they are small; the table is not shuffled for them then."""
    rows = _current(spark, path, schema, keys, months)
    return spark.createDataFrame([], schema) if rows is None else rows.select(*schema.names)


def keys_now(spark: SparkSession, path: str, schema: StructType, keys) -> DataFrame:
    """The keys of the table, each once, with the month of its row; nothing else is read."""
    used = StructType([f for f in schema if f.name in keys])
    rows = _current(spark, path, used, keys)
    if rows is None:
        return spark.createDataFrame([], StructType([*used, StructField(MONTH, StringType())])).select(*keys, MONTH)
    return rows.select(*keys, MONTH)


def months_with(spark: SparkSession, path: str, schema: StructType, keys, wanted: DataFrame) -> list[str]:
    """The months in which some layer holds one of the wanted keys: only the key columns of the table are read."""
    used = StructType([f for f in schema if f.name in keys])
    found = None
    for layer in layers(spark, path):
        rows = _rows(spark, layer, used)
        hit = rows.join(wanted.select(*keys), same_keys(rows, wanted, keys), "left_semi").select(MONTH)
        found = hit if found is None else found.unionByName(hit)
    return [] if found is None else sorted(r[0] for r in found.distinct().collect())  # one for each month at most


def read_months(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table kept by month, with its month: the newest state of each."""
    newest: dict[str, str] = {}
    for layer in layers(spark, path):
        files, place = files_of(spark, layer)
        for found in files.listStatus(place):
            if found.getPath().getName().startswith(f"{MONTH}="):
                newest[found.getPath().getName()] = found.getPath().toString()
    out = None
    for layer in sorted({p.rsplit("/", 1)[0] for p in newest.values()}):
        places = [p for p in newest.values() if p.rsplit("/", 1)[0] == layer]
        whole = StructType([*schema, StructField(MONTH, StringType())])
        part = spark.read.schema(whole).option("basePath", layer).parquet(*places)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], StructType([*schema, StructField(MONTH, StringType())])) if out is None else out


def size_of(spark: SparkSession, path: str) -> int:
    files, place = files_of(spark, path)
    return files.getContentSummary(place).getLength()


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether no delta lies on top of the table: a reader then gets its rows straight from files kept by month."""
    return len(layers(spark, path)) == 1


def _apart(spark: SparkSession, found: list[str]) -> bool:
    """Whether the deltas replace nothing and the layers have few files a month: their rows can be put together without a shuffle."""
    for delta in found[1:]:
        files, place = files_of(spark, _keys_place(delta))
        if not files.exists(place) or not spark.read.parquet(place.toString()).isEmpty():
            return False
    count, months = 0, set()
    for layer in found:
        files, place = files_of(spark, layer)
        for folder in files.listStatus(place):
            if folder.getPath().getName().startswith(f"{MONTH}="):
                months.add(folder.getPath().getName())
                count += len(files.listStatus(folder.getPath()))
    return count <= MONTH_FILES * len(months)


def write_changes(df: DataFrame, path: str, schema: StructType, keys, replaced: DataFrame, share: float = MERGE_SHARE) -> None:
    """Store rows of new states on top of a table with keys: as a delta, or where the deltas would hold ``share`` of its rows, at once
    as part of a new whole layer, instead of as a delta that is merged next. ``replaced`` names the keys among them that the table holds."""
    spark = df.sparkSession
    found = layers(spark, path)
    sizes = [spark.read.parquet(layer).count() for layer in found]  # from the footers of the files
    if not found or sum(sizes[1:]) + df.count() < share * sizes[0]:
        write_delta(df, path, replaced=replaced)
        return
    rows = read(spark, path, schema, keys)
    kept = rows.join(replaced.select(*keys), same_keys(rows, replaced, keys), "left_anti")
    write_whole(kept.unionByName(df.select(*schema.names)), path)


def merge(spark: SparkSession, path: str, schema: StructType, keys, share: float = MERGE_SHARE) -> bool:
    """Make the deltas of a table with keys part of a new whole layer once they hold ``share`` of its bytes; True if it was done."""
    found = layers(spark, path)
    if len(found) < 2 or sum(size_of(spark, f) for f in found[1:]) < share * size_of(spark, found[0]):
        return False
    write_whole(read(spark, path, schema, keys), path, by_month=_apart(spark, found))
    return True
