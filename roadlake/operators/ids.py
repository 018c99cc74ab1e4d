"""Sequential report ids."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from roadlake.session import materialize
from roadlake.sources import events


def assign_report_ids(df: DataFrame, start: int = 1, order=("event_time", "event_id"),
                      partitions: int | None = None) -> DataFrame:
    """Number all rows in one global order as ``R001``, ``R002``, …

    The rows are range-partitioned and sorted once; a row's number is its place in its partition
    plus the sizes of the partitions before. ``order`` must identify a row, which also lets range
    partitioning split rows that share a time.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()  # partition number in the upper bits, place in the lower 33
    placed = materialize(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.shiftright(place, 33), "_place": place.bitwiseAND((1 << 33) - 1)}),
        "report-ids",
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, so at most n rows
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_place") + start
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("report_id", F.format_string("R%03d", number))
        .drop("_part", "_place", "_before")
    )


def number_new(df: DataFrame, path: str, run: str, key: str = "event_id", order=("event_time", "event_id")) -> DataFrame:
    """Number the rows that the table at ``path`` does not hold, after its highest number, and add them to it; gives what this run added.

    The counter is the highest stored number, so runs follow each other without gap or overlap. A run has a name: called again with it, it
    replaces what it stored, and its numbers are the same for the same rows as long as no other run came between.
    """
    spark = df.sparkSession
    shape = StructType([f for f in df.schema if f.name == key] + [StructField("number", LongType()), StructField("batch", StringType())])
    known = events.read_or_empty(spark, path, shape).filter(F.col("batch") != run)
    last = known.agg(F.max("number")).first()[0] or 0
    new = df.join(known.select(key), key, "left_anti")
    numbered = assign_report_ids(new, last + 1, order).withColumn("number", F.substring("report_id", 2, 20).cast("long"))
    events.write_batch(numbered, path, run)
    return spark.read.schema(numbered.schema).parquet(f"{path}/batch={run}")
