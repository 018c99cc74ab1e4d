"""Queries behind a dashboard."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlake import rules
from roadlake.session import local_table, materialize


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _detected() -> Column:
    return F.col("damage_type").isNotNull() & (F.col("damage_type") != "Unknown")


def stats(reports: DataFrame, today, time: str = "event_time") -> DataFrame:
    """One row: totals, reports of ``today``, the busiest district, damage and severity figures.

    The table is folded to one row per district first; the mean takes known severities only.
    """
    per_district = reports.groupBy("district").agg(
        F.count("*").alias("n"),
        _count(F.to_date(time) == F.lit(today)).alias("today"),
        _count(_detected()).alias("detected"),
        F.sum("severity_score").alias("severity"),
        F.count("severity_score").alias("rated"),
        _count(F.col("damage_type") == rules.POTHOLE).alias("potholes"),
        _count(F.col("damage_type").isin(*rules.CRACKS)).alias("cracks"),
    )
    mean = F.sum("severity") / F.sum("rated")

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return per_district.agg(
        total("n").alias("total_reports"),
        total("today").alias("today_reports"),
        F.min_by("district", F.struct(-F.col("n"), F.col("district").isNull(), "district")).alias("top_district"),
        total("detected").alias("total_detected_damage"),
        F.coalesce(F.round(F.when(F.sum("rated") > 0, mean), 2), F.lit(0.0)).alias("average_severity_score"),
        total("potholes").alias("pothole_count"),
        total("cracks").alias("crack_count"),
    )


def dashboard_counters(reports: DataFrame) -> DataFrame:
    """The counters a client derives itself: an unknown severity counts as 0, the mean is a whole number."""
    severity = F.coalesce("severity_score", F.lit(0))
    mean = F.when(F.count("*") > 0, F.sum(severity) / F.count("*")).otherwise(0.0)
    return reports.agg(
        _count(severity >= rules.HIGH_SEVERITY).alias("high_severity"),
        _count(_detected()).alias("detected"),
        F.floor(mean + 0.5).alias("avg_severity"),
        _count(F.col("damage_type") == rules.POTHOLE).alias("potholes"),
        _count(F.contains(F.col("damage_type"), F.lit("Crack"))).alias("cracks"),
    )


def top_districts(reports: DataFrame, n: int = 5) -> DataFrame:
    return (
        reports.groupBy("district")
        .agg(F.count("*").alias("report_count"))
        .orderBy(F.desc("report_count"), F.asc_nulls_last("district"))
        .limit(n)
    )


def status_counts(reports: DataFrame, statuses=rules.STATUSES) -> DataFrame:
    """One row per known status in fixed order, zero where no report has it."""
    wanted = local_table(reports.sparkSession, position=list(range(len(statuses))), status=list(statuses))
    counts = reports.groupBy("status").agg(F.count("*").alias("report_count"))
    return (
        wanted.join(counts, "status", "left")
        .select(F.col("position").cast("int"), "status", F.coalesce("report_count", F.lit(0)).alias("report_count"))
        .orderBy("position")
    )


def newest_first(reports: DataFrame, time: str = "event_time", key: str = "report_id") -> DataFrame:
    return reports.orderBy(F.desc_nulls_last(time), F.asc(key))


def latest_health(history: DataFrame, batch: str = "batch_time") -> DataFrame:
    """All rows of the newest batch of each road, best health first.

    The newest batch per road is an aggregate, so ties of a busy road never meet in one task.
    """
    newest = (
        history.filter(F.col("road_name").isNotNull())
        .groupBy(F.col("road_name").alias("_road"))
        .agg(F.max(batch).alias("_newest"))
    )
    return (
        history.join(
            materialize(newest, "newest-batch"),
            (F.col("road_name") == F.col("_road")) & (F.col(batch) == F.col("_newest")),
        )
        .drop("_road", "_newest")
        .orderBy(F.desc_nulls_last("road_health_index"), "road_name", "district")
    )


def top_priority(scores: DataFrame, n: int = 10, batch: str = "batch_time") -> DataFrame:
    """The ``n`` most urgent reports of the newest batch."""
    order = [F.desc_nulls_last(batch), F.desc_nulls_last("priority_score"), F.asc("report_id")]
    # the first n by batch hold the n most urgent of the newest batch: one pass, and one task sees n rows
    first = scores.filter(F.col(batch).isNotNull()).orderBy(*order).limit(n)
    newest = F.max(batch).over(Window.partitionBy(F.lit(1)))
    return first.withColumn("_newest", newest).filter(F.col(batch) == F.col("_newest")).drop("_newest").orderBy(*order)


def confidence_label(column: str = "confidence") -> Column:
    """``0.874`` becomes ``87%``, a missing value ``-``."""
    value = F.col(column).try_cast("double")
    percent = F.concat(F.floor(value * 100 + 0.5).cast("string"), F.lit("%"))
    return F.coalesce(percent, F.lit("-"))


def too_many_images(urls: str = "urls", most: int = rules.MOST_IMAGES) -> Column:
    """True for a report that is refused: route it to the rejects."""
    return F.coalesce(F.size(urls) > most, F.lit(False))


def join_images(urls: str = "urls") -> Column:
    """Comma-joined list of all images."""
    return F.concat_ws(",", urls)


def first_image(path: str = "image_path", base: str = "") -> Column:
    """First entry of the list; a path that is no web address is put under ``base``."""
    image = F.coalesce(F.get(F.split(path, ","), F.lit(0)), F.lit(""))
    return F.when((image == "") | image.startswith("http"), image).otherwise(F.concat(F.lit(base), image))
