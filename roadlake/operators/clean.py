"""Row cleaning: deduplication, imputation, date and region columns."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlake import rules
from roadlake.session import materialize

LATEST = ("event_time", "event_id")


def newest_first(names=LATEST) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def first_per_key(df: DataFrame, keys, order, n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in the given order.

    The filter on ``row_number`` makes Spark cut every group to ``n`` rows before the shuffle as
    well, so a key that holds a large share of the table costs no more than any other.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def with_keys(df: DataFrame, keys) -> DataFrame:
    """Rows that have all keys; one plain condition per key, which a scan can evaluate."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def latest_per_key(df: DataFrame, keys, order=LATEST, null_keys: bool = False, used=None) -> DataFrame:
    """One row per key, the newest one. NULL keys are dropped, or count as a key with ``null_keys``.

    Where the order leaves a tie, such as a corrected redelivery with the time of the first one, the other
    columns decide, larger values first and NULL last, so that the survivor does not depend on how the rows are
    spread. Call it on cleaned rows: then a refresh gives the same survivor as a rebuild.
    Of the columns in ``used`` the survivor has the same values without those that decide after the last of them, which are left out.
    """
    rows = df if null_keys else with_keys(df, keys)
    named = [c for c in order if c not in keys]
    deciding = [*named, *(c for c in df.columns if c not in named and c not in keys)]
    if used:
        deciding = deciding[:max([i + 1 for i, c in enumerate(deciding) if c in used], default=0)]
        rows = rows.select(*keys, *deciding)
    # a key may be all that is used
    found = first_per_key(rows, keys, newest_first(deciding or keys))
    return found.select(*used) if used else found


def latest_of_repeated(df: DataFrame, keys, order=LATEST, null_keys: bool = False, used=None, few: int = 500_000) -> DataFrame:
    """``latest_per_key`` of a table in which few keys come more than once.

    A narrow aggregate of key hashes finds these keys and is run at once. Only their rows are shuffled and sorted, the others
    stay where they are; rows whose hashes merely meet are told apart by their keys. Where more than ``few`` keys repeat, all rows are
    sorted. The table is read up to three times: it should be stored, or made from a stored one row by row.
    """
    rows = df if null_keys else with_keys(df, keys)
    marked = rows.withColumn("_key", F.xxhash64(*keys))
    repeated = materialize(marked.groupBy("_key").agg(F.count("*").alias("_rows")).filter("_rows > 1").select("_key"), "repeated-keys")
    found = repeated.count()
    if found == 0:
        return rows.select(*used) if used else rows
    if found > few:
        return latest_per_key(rows, keys, order, True, used)
    once = marked.join(F.broadcast(repeated), "_key", "left_anti").drop("_key")
    copies = marked.join(F.broadcast(repeated), "_key", "left_semi").drop("_key")
    return (once.select(*used) if used else once).unionByName(latest_per_key(copies, keys, order, True, used))


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    """Replace NULL by the mean over the table, taken as a scalar subquery."""
    mean = df.select(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def impute(df: DataFrame, strategy: dict) -> DataFrame:
    """Fill per column: a constant, "keep" for NULL, or "district_center" for coordinates."""
    from roadlake.functions import geo

    centers = {c for c, how in strategy.items() if how == "district_center"}
    if centers:
        df = geo.with_centroid(df).withColumns(
            {c: F.coalesce(c, "centroid_lat" if c == "latitude" else "centroid_lon") for c in centers}
        ).drop("centroid_lat", "centroid_lon")
    constants = {c: how for c, how in strategy.items() if how not in ("keep", "district_center")}
    return fill_constants(df, constants)


def fill_gaps(df: DataFrame, feed: str) -> DataFrame:
    """The default constants of a feed; weather also gets the mean temperature."""
    filled = fill_constants(df, rules.FILL_VALUES[feed])
    return fill_mean(filled, "temperature_c") if feed == "weather" else filled


def add_date_parts(df: DataFrame, time: str = "event_time") -> DataFrame:
    return df.withColumns({"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time)})


def add_partition_keys(df: DataFrame, time: str = "event_time", district: str | None = "district") -> DataFrame:
    """``date_partition`` as yyyy-MM-dd, and ``district_partition`` in lower case without blanks."""
    keys = {"date_partition": F.date_format(time, "yyyy-MM-dd")}
    if district:
        keys["district_partition"] = F.lower(F.replace(F.col(district), F.lit(" "), F.lit("_")))
    return df.withColumns(keys)


def add_region_parts(df: DataFrame, region=rules.REGION, time: str = "batch_time") -> DataFrame:
    return add_date_parts(df, time).withColumns({k: F.lit(v) for k, v in region.items()})


def partition_path(time: str = "batch_time", region=rules.REGION) -> Column:
    """The folder of a row, e.g. ``year=2024/month=01/day=31/country=…``."""
    day = F.date_format(time, "'year='yyyy'/month='MM'/day='dd")
    return F.concat_ws("/", day, *[F.lit(f"{k}={v}") for k, v in region.items()])


def event_time(column: str, otherwise: Column) -> Column:
    """Parse ISO text; text that is no timestamp, or no text, gives ``otherwise``."""
    return F.coalesce(F.try_to_timestamp(F.col(column)), otherwise)
