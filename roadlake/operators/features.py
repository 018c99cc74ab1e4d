"""District features joined to accidents."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake import rules
from roadlake.operators.clean import fill_constants
from roadlake.session import materialize


def road_features(reports: DataFrame) -> DataFrame:
    return reports.groupBy("district").agg(
        F.count("*").alias("damage_report_count"),
        F.avg("severity_score").alias("avg_severity"),
        F.max("severity_score").cast("double").alias("max_severity"),
    )


def traffic_features(traffic: DataFrame) -> DataFrame:
    return traffic.groupBy("district").agg(
        F.avg("average_speed_kmh").alias("avg_speed"),
        F.avg("vehicle_count").alias("avg_vehicle_count"),
        F.count("congestion_level").alias("traffic_event_count"),
    )


def weather_features(weather: DataFrame) -> DataFrame:
    """Mean measures of each district and the condition of its newest record."""
    return weather.groupBy("district").agg(
        F.avg("rainfall_mm").alias("rainfall_mm"),
        F.avg("temperature_c").alias("temperature_c"),
        F.avg("humidity").alias("humidity"),
        F.max_by("condition", F.struct("event_time", "event_id")).alias("weather_condition"),
    )


def district_context(reports: DataFrame, traffic: DataFrame, weather: DataFrame) -> DataFrame:
    """All district features in one table, one row per district; a NULL district matches nothing."""
    context = road_features(reports).join(traffic_features(traffic), "district", "full")
    return context.join(weather_features(weather), "district", "full").filter(F.col("district").isNotNull())


def enrich(accidents: DataFrame, context: DataFrame, fill=rules.ACCIDENT_FEATURE_FILL) -> DataFrame:
    """Accidents with the features of their district, gaps filled; one join of the large table.

    ``accidents`` may be a stream and ``context`` a stored table.
    """
    return fill_constants(
        accidents.select(
            "accident_id", "district", "road_name", "event_time",
            F.col("severity").alias("accident_severity"),
            F.col("vehicle_count").alias("vehicles_involved"),
            "casualties",
        ).join(context, "district", "left"),
        fill,
    )


def accident_features(accidents: DataFrame, reports: DataFrame, traffic: DataFrame, weather: DataFrame,
                      settle: Callable[[DataFrame], DataFrame] = lambda context: context) -> DataFrame:
    """``settle`` is applied to the district features, of which there are few rows, before they meet the accidents."""
    return enrich(accidents, materialize(settle(district_context(reports, traffic, weather)), "district-context"))
