"""Range checks, table quality metrics and the run log."""

from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from roadlake import schemas
from roadlake.operators.clean import LATEST


def breaks(column: str, low, high) -> Column:
    """True where a known value lies outside its range."""
    return F.coalesce(~F.col(column).between(low, high), F.lit(False))


def check_ranges(df: DataFrame, ranges: dict) -> DataFrame:
    """Add ``<column>_ok`` per rule and ``violations``, the names of the columns out of range."""
    flags = {f"{c}_ok": ~breaks(c, *bounds) for c, bounds in ranges.items()}
    names = F.array(*[F.when(breaks(c, *bounds), F.lit(c)) for c, bounds in ranges.items()])
    return df.withColumns({**flags, "violations": F.array_compact(names)})


def quarantine(df: DataFrame, ranges: dict, path: str) -> tuple[DataFrame, DataFrame]:
    """Store good rows and rows that break a rule apart, in one pass: (good rows, the others with ``violations``)."""
    checked = check_ranges(df, ranges).drop(*[f"{c}_ok" for c in ranges])
    routed = checked.withColumn("accepted", F.size("violations") == 0)
    routed.hint("rebalance", "accepted").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("accepted").parquet(path)
    stored = df.sparkSession.read.schema(routed.schema).parquet(path)
    return stored.filter("accepted").drop("accepted", "violations"), stored.filter("NOT accepted").drop("accepted")


def row_score(ranges: dict) -> Column:
    """Share of the range rules a row meets; an unknown value meets none.

    This is completeness and range in one figure. ``breaks`` and ``metrics`` ask a different question, whether a
    known value is wrong, so an unknown one counts as good there.
    """
    met = F.lit(0)
    for column, bounds in ranges.items():
        met = met + F.coalesce(F.col(column).between(*bounds), F.lit(False)).cast("int")
    return met / F.lit(float(len(ranges)))


def metrics(df: DataFrame, layer: str, name: str, keys, ranges: dict | None = None, order=LATEST) -> DataFrame:
    """One row of table quality.

    A row is bad when a key is NULL, when a newer row has the same key, or when a measure is out
    of range (of copies with one time, if one of them is); ``quality_score`` is the share of good rows (1.0 for an empty table). Copies of a
    key are folded into one partial result per map task, so a key with many copies stays cheap.
    """
    out_of_range = F.lit(False)
    for column, bounds in (ranges or {}).items():
        out_of_range = out_of_range | breaks(column, *bounds)
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    per_key = (
        df.select(*keys, *[c for c in order if c not in keys], no_key.alias("_no_key"), out_of_range.alias("_out"))
        .groupBy(*keys, "_no_key")
        .agg(F.count("*").alias("n"), F.max(F.struct(*order, "_out"))["_out"].alias("newest_out"))
    )
    good = F.when(~F.col("_no_key") & ~F.col("newest_out"), 1).otherwise(0)
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        F.lit(layer).alias("layer"),
        F.lit(name).alias("dataset_name"),
        total.alias("record_count"),
        F.coalesce(F.sum(F.when(F.col("_no_key"), F.col("n"))), F.lit(0)).alias("null_count"),
        F.coalesce(F.sum(F.when(~F.col("_no_key"), F.col("n") - 1)), F.lit(0)).alias("duplicate_count"),
        F.when(total > 0, F.sum(good) / total).otherwise(1.0).alias("quality_score"),
    )


def _records(seen: Observation) -> int:
    try:
        return seen.get["records"]
    except Py4JJavaError:  # adaptive execution drops the counter along with a plan that turns out to be empty
        return 0


def run_logged(df: DataFrame, job: str, layer: str, write, save_log, checkpoint: str | None = None) -> None:
    """Run ``write(df)`` and pass one log row to ``save_log``, whether the run succeeds or fails.

    The records are counted while they are written, without a second pass.
    """
    seen = Observation()
    start = datetime.now(timezone.utc)
    status, error, records = "success", None, None
    try:
        write(df.observe(seen, F.count(F.lit(1)).alias("records")))
        records = _records(seen)
    except Exception as failure:
        status, error = "failed", str(failure)
        raise
    finally:
        row = (job, layer, status, start, datetime.now(timezone.utc), records, error, checkpoint)
        save_log(df.sparkSession.createDataFrame([row], schemas.RUN_LOG))
