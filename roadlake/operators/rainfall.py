"""Daily rain: payload unpacking, rolling sums, upsert."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlake import rules
from roadlake.operators.clean import first_per_key


def unpack_daily(payloads: DataFrame, day: str = "time",
                 measures=("precipitation_sum", "rain_sum", "precipitation_hours")) -> DataFrame:
    """One row per day from parallel arrays; a measure array that is too short or absent gives NULL."""
    present = payloads.withColumns({m: F.coalesce(m, F.array().cast("array<double>")) for m in measures})
    return (
        present.select(F.inline(F.arrays_zip(day, *measures)))
        .filter(F.col(day).isNotNull())
        .select(F.col(day).cast("date").alias("date"), *measures)
    )


def rolling(df: DataFrame, windows=rules.RAIN_WINDOWS, station: str | None = None,
            recency: str | None = None) -> DataFrame:
    """Add ``rainfall_<n>d``: rain of the last n calendar days, today included, rounded to 2.

    Missing days and unknown amounts count as 0. A date given more than once counts once: the row
    with the highest ``recency``, then with the larger amount.

    Days are cut into blocks as long as the longest window. A row also serves the block after its
    own, so each block has all the days it looks back on and no task needs a whole history.
    """
    places = [station] if station else []
    order = [c for c in (recency, "precipitation_sum") if c]
    df = first_per_key(df, [*places, "date"], [F.desc_nulls_last(c) for c in [*order, *(c for c in df.columns if c not in order)]])
    own = F.floor(F.unix_date("date") / max(windows))
    blocks = df.withColumn("_own", own).withColumn("_block", F.explode(F.array("_own", F.col("_own") + 1)))
    day = Window.partitionBy(*places, "_block").orderBy(F.unix_date("date"))
    amount = F.coalesce(F.col("precipitation_sum").cast("double"), F.lit(0.0))
    sums = {f"rainfall_{n}d": F.round(F.sum(amount).over(day.rangeBetween(1 - n, 0)), 2) for n in windows}
    return blocks.withColumns(sums).filter("_own = _block").drop("_own", "_block")


def upsert(existing: DataFrame, incoming: DataFrame, windows=rules.RAIN_WINDOWS, station: str | None = None) -> DataFrame:
    """Merge by date (and station): a known day takes only the new rolling columns, a new day is added whole.

    ``action`` tells what happened to the row: saved, updated or kept.
    """
    sums = [f"rainfall_{n}d" for n in windows]
    keys = [*([station] if station else []), "date"]
    base = [c for c in existing.columns if c not in keys and c not in sums]
    old = existing.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in base + sums], F.lit(True).alias("_old"))
    new = incoming.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in base + sums], F.lit(True).alias("_new"))
    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    return old.join(new, keys, "full").select(
        *keys,
        *[F.when(is_old, F.col(f"_old_{c}")).otherwise(F.col(f"_new_{c}")).alias(c) for c in base],
        *[F.when(is_new, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c) for c in sums],
        F.when(is_old & is_new, "updated").when(is_new, "saved").otherwise("kept").alias("action"),
    )


def upsert_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(
        F.count_if(F.col("action") == "saved").alias("saved"), F.count_if(F.col("action") == "updated").alias("updated")
    )


def latest(df: DataFrame) -> DataFrame:
    return df.filter(F.col("date") == df.select(F.max("date")).scalar())
