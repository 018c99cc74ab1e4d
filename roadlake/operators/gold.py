"""Scores over the clean tables.

Join keys of large tables are joined once, to one small table that was aggregated before: the
many left joins of the score formulas run between aggregates.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlake import rules
from roadlake.operators.clean import first_per_key
from roadlake.session import materialize

ROAD = ["road_name", "district"]


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0.0))


def _weighted(weights: dict[str, float]) -> Column:
    total = None
    for column, weight in weights.items():
        part = F.col(column) * F.lit(weight)
        total = part if total is None else total + part
    return total


# aggregates


def road_severity(reports: DataFrame) -> DataFrame:
    return reports.groupBy(*ROAD).agg(F.avg("severity_score").alias("severity"))


def district_rainfall(weather: DataFrame) -> DataFrame:
    return weather.groupBy("district").agg(F.avg("rainfall_mm").alias("rainfall"))


def road_traffic(traffic: DataFrame, divisor: float = rules.TRAFFIC_DIVISOR) -> DataFrame:
    return traffic.groupBy(*ROAD).agg((F.avg("vehicle_count") / divisor).alias("traffic"))


def road_accidents(accidents: DataFrame) -> DataFrame:
    return accidents.groupBy(*ROAD).agg(F.count("*").alias("accident_count"))


def district_news(news: DataFrame) -> DataFrame:
    return news.groupBy("district").agg(
        F.count("*").alias("news_count"), F.avg("sentiment_score").alias("sentiment")
    )


def report_counts(reports: DataFrame) -> DataFrame:
    return reports.groupBy("road_name").agg(F.count("*").alias("report_count"))


# partial aggregates of a month, and the aggregates from those of all months

#: Of each feed: the keys of its partial aggregates and the measure they sum up.
PARTS = {
    "reports": (ROAD, "severity_score"),
    "weather": (["district"], "rainfall_mm"),
    "traffic": (ROAD, "vehicle_count"),
    "accidents": (ROAD, "casualties"),
    "news": (["district"], "sentiment_score"),
}


def partial(feed: str, rows: DataFrame, month: Column) -> DataFrame:
    """Rows, sum and known values of the measure, and the newest time, by month and the feed's keys."""
    keys, measure = PARTS[feed]
    return rows.groupBy(month.alias("month"), *keys).agg(
        F.count("*").alias("rows"), F.sum(measure).cast("double").alias("total"),
        F.count(measure).alias("known"), F.max("event_time").alias("latest"),
    )


def combined(parts: DataFrame, keys) -> DataFrame:
    """Partial aggregates of all months as aggregates by ``keys``; a group without rows is none."""
    sums = parts.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.sum("known").alias("known"), F.max("latest").alias("latest")
    )
    return sums.filter("rows > 0").withColumn("mean", F.col("total") / F.nullif("known", F.lit(0)))


# scores


def road_health_index(reports: DataFrame, weather: DataFrame, traffic: DataFrame, as_of: Column | None = None,
                      road_age: DataFrame | None = None, weights=rules.HEALTH_WEIGHTS) -> DataFrame:
    """100 less the weighted severity, rainfall, traffic and road age, per road and district.

    Unknown rainfall, traffic and age count as 0; an unknown severity makes the index NULL.
    ``road_age`` optionally gives (road_name, district, road_age_score).
    """
    return health_of(road_severity(reports), district_rainfall(weather), road_traffic(traffic), as_of, road_age, weights)


def health_of(severity: DataFrame, rainfall: DataFrame, traffic: DataFrame, as_of: Column | None = None,
              road_age: DataFrame | None = None, weights=rules.HEALTH_WEIGHTS) -> DataFrame:
    """``road_health_index`` from aggregates."""
    # severity and traffic are grouped by the same key, so this join needs no further shuffle
    roads = severity.join(traffic, ROAD, "left")
    roads = roads.join(rainfall, "district", "left")
    if road_age is None:
        roads = roads.withColumn("road_age_score", F.lit(0.0))
    else:
        roads = roads.join(road_age, ROAD, "left")
    roads = roads.withColumns({c: _or_zero(c) for c in ("rainfall", "traffic", "road_age_score")})
    index = F.lit(100.0)
    for column, weight in weights.items():
        index = index - F.col(column) * weight
    return roads.select(
        *ROAD, *weights, index.alias("road_health_index"),
        (F.current_timestamp() if as_of is None else as_of).alias("batch_time"),
    )


def complaint_score(count: str = "report_count", steps=rules.COMPLAINT_SCORES) -> Column:
    score = F.lit(0.0)
    for fewest, points in reversed(steps):
        score = F.when(F.col(count) >= fewest, points).otherwise(score)
    return score


def road_context(reports: DataFrame, traffic: DataFrame, accidents: DataFrame, news: DataFrame) -> DataFrame:
    """The four non-severity components of the priority, one row per (road, district) with a report.

    Complaints are counted per road over all its districts. A NULL road or district matches
    nothing, so its components stay NULL.
    """
    pairs = reports.groupBy(*ROAD).agg(F.count("*").alias("n"))
    news_counts = news.groupBy("district").agg(F.count("*").alias("news_count"))
    return context_of(pairs, road_traffic(traffic), road_accidents(accidents), news_counts)


def context_of(pairs: DataFrame, traffic: DataFrame, accidents: DataFrame, news: DataFrame) -> DataFrame:
    """``road_context`` from aggregates: reports (n), traffic and accidents by road, news by district."""
    per_road = Window.partitionBy("road_name")
    pairs = pairs.withColumn("report_count", F.when(F.col("road_name").isNotNull(), F.sum("n").over(per_road))).select(
        *ROAD, F.when(F.col("report_count").isNotNull(), complaint_score()).alias("complaint_score")
    )
    return (
        pairs.join(traffic.withColumnRenamed("traffic", "traffic_score"), ROAD, "left")
        .join(
            accidents.select(*ROAD, (F.col("accident_count") * rules.ACCIDENT_POINTS).alias("accident_score")), ROAD, "left"
        )
        .join(news.select("district", (F.col("news_count") * rules.NEWS_POINTS).alias("news_score")), "district", "left")
    )


def priority_score(reports: DataFrame, traffic: DataFrame, accidents: DataFrame, news: DataFrame,
                   as_of: Column | None = None, weights=rules.PRIORITY_WEIGHTS) -> DataFrame:
    """Weighted repair priority per report; an unknown component counts as 0, an unknown severity gives NULL.

    ``reports`` is read twice: pass a stored table, not a plan that deduplicates on the fly.
    """
    return priority_of(reports, road_context(reports, traffic, accidents, news), as_of, weights)


def priority_of(reports: DataFrame, context: DataFrame, as_of: Column | None = None, weights=rules.PRIORITY_WEIGHTS) -> DataFrame:
    """``priority_score`` from the reports and the context of their roads."""
    context = materialize(context, "road-context")
    context = context.withColumnsRenamed({"road_name": "_road", "district": "_district"})
    here = F.col("road_name").eqNullSafe(F.col("_road")) & F.col("district").eqNullSafe(F.col("_district"))
    components = [c for c in weights if c != "severity_score"]
    return (
        reports.select("report_id", *ROAD, "damage_type", "severity_score")
        .join(context, here, "left")
        .withColumns({c: _or_zero(c) for c in components})
        .select(
            "report_id", *ROAD, "damage_type", *weights,
            _weighted(weights).alias("priority_score"),
            (F.current_timestamp() if as_of is None else as_of).alias("batch_time"),
        )
    )


def risk_level(severity: str = "severity_score", bounds=rules.RISK_BOUNDS, levels=rules.RISK_LEVELS) -> Column:
    """Low below the first bound and for an unknown severity, medium up to the second, else high."""
    low, medium, high = levels
    score = F.col(severity)
    return F.when(score.between(*bounds), medium).when(score > bounds[1], high).otherwise(low)


def damage_prediction(reports: DataFrame, as_of: Column | None = None, also=()) -> DataFrame:
    return reports.select(
        "report_id", *ROAD, "severity_score", risk_level().alias("predicted_risk_level"),
        (F.current_timestamp() if as_of is None else as_of).alias("batch_time"), *also,
    )


def accident_prediction(health: DataFrame, as_of: Column | None = None, model=rules.ACCIDENT_MODEL,
                        levels=rules.ACCIDENT_LEVELS, null_level: str = "HIGH") -> DataFrame:
    """Accident probability and level from the rows of ``road_health_index``.

    Without a health index the probability is NULL and the level is ``null_level``.
    """
    now = F.current_timestamp() if as_of is None else as_of
    raw = (
        F.lit(model["base"])
        + F.col("rainfall") * model["rainfall"]
        + F.col("traffic") * model["traffic"]
        + (F.lit(100.0) - F.col("road_health_index")) * model["health_gap"]
    )
    scored = health.select(*ROAD, F.when(raw.isNotNull(), F.least(F.lit(1.0), raw)).alias("p"))
    level = F.when(F.col("p").isNull(), null_level)
    for below, name in levels:
        level = level.when(F.col("p") < below, name)
    return scored.select(
        *ROAD,
        F.col("p").alias("predicted_accident_probability"),
        level.otherwise("HIGH").alias("risk_level"),
        now.alias("prediction_date"),
        now.alias("batch_time"),
    )


def hotspots(reports: DataFrame, as_of: Column | None = None, weights=rules.HOTSPOT_WEIGHTS) -> DataFrame:
    roads = reports.groupBy("road_name").agg(
        F.count("*").alias("report_count"), F.avg("severity_score").alias("avg_severity")
    )
    return hotspots_of(roads, as_of, weights)


def hotspots_of(roads: DataFrame, as_of: Column | None = None, weights=rules.HOTSPOT_WEIGHTS) -> DataFrame:
    """``hotspots`` from the aggregates of each road."""
    return roads.select(
        F.col("road_name").alias("road_id"),
        "road_name",
        "report_count",
        "avg_severity",
        (F.col("report_count") * weights["report_count"] + F.col("avg_severity") * weights["avg_severity"]).alias("hotspot_score"),
        (F.current_timestamp() if as_of is None else as_of).alias("batch_time"),
    )


def simple_priority(reports: DataFrame, weights=rules.SIMPLE_PRIORITY_WEIGHTS) -> DataFrame:
    """Priority from one report alone; works on a stream as well."""
    score = (
        F.col("severity_score") * weights["severity_score"] + F.col("confidence") * 100 * weights["confidence"]
    )
    return reports.select(
        "report_id", *ROAD, "damage_type", "severity_score", "confidence", F.round(score, 2).alias("priority_score")
    )


def district_health(reports: DataFrame) -> DataFrame:
    """100 less the mean severity per district, with damage counts; works on a stream as well."""
    damage = F.col("damage_type")
    return (
        reports.groupBy("district")
        .agg(
            F.count("*").alias("report_count"),
            F.avg("severity_score").alias("average_severity"),
            F.count_if(F.coalesce(damage == rules.POTHOLE, F.lit(False))).alias("pothole_count"),
            F.count_if(F.coalesce(F.contains(damage, F.lit("Crack")), F.lit(False))).alias("crack_count"),
        )
        .withColumn("road_health_index", F.lit(100.0) - F.col("average_severity"))
    )


def damage_records(reports: DataFrame) -> DataFrame:
    return reports.select(
        "report_id", *ROAD, "damage_type", "severity_score", "confidence", "status", "event_time"
    )


# image detections


def classify_detections(detections: DataFrame, classes=rules.DAMAGE_CLASSES) -> DataFrame:
    """Damage type and severity of each box; an unknown class is ("Unknown", 0)."""
    known = F.create_map(*[v for k, c in classes.items() for v in (F.lit(k), F.struct(F.lit(c[0]), F.lit(c[1])))])
    hit = F.try_element_at(known, F.col("class_id"))
    return detections.withColumns(
        {
            "damage_type": F.coalesce(hit["col1"], F.lit("Unknown")),
            "severity_score": F.coalesce(hit["col2"], F.lit(0)),
            "confidence": F.round("confidence", 2),
        }
    )


def best_detection(reports: DataFrame, detections: DataFrame) -> DataFrame:
    """Most confident box of each report, the first one on ties; ("Unknown", 0, 0) without a box."""
    best = first_per_key(
        classify_detections(detections), ["report_id"], [F.desc("confidence"), F.asc("image_no"), F.asc("box_no")]
    ).select("report_id", "damage_type", "confidence", "severity_score")
    return reports.join(best, "report_id", "left").withColumns(
        {
            "damage_type": F.coalesce("damage_type", F.lit("Unknown")),
            "confidence": F.coalesce("confidence", F.lit(0.0)),
            "severity_score": F.coalesce("severity_score", F.lit(0)),
        }
    )


# serving contract


def split_complete(df: DataFrame, required) -> tuple[DataFrame, DataFrame]:
    """(rows with all required columns known, the others): the serving tables refuse NULL there."""
    complete = F.lit(True)
    for column in required:
        complete = complete & F.col(column).isNotNull()
    return df.filter(complete), df.filter(~complete)
