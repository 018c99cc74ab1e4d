"""Schemas of the five feeds, and helpers that make a frame fit a schema."""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "array<string>": ArrayType(StringType()),
    "array<double>": ArrayType(DoubleType()),
}


def _struct(columns: str) -> StructType:
    """A schema from "name type, name type"; works before a session exists."""
    pairs = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[dtype]) for name, dtype in pairs])


# Columns and types of the messages, the daily rain records and the run log.
WIRE = {
    "reports": _struct(
        "event_id string, event_time string, report_id string, road_name string, district string, "
        "village string, damage_type string, severity_score int, confidence double, status string, "
        "latitude double, longitude double, description string, image_path string"
    ),
    "weather": _struct(
        "event_id string, event_time string, city string, district string, rainfall_mm double, "
        "temperature_c double, humidity double, condition string"
    ),
    "traffic": _struct(
        "event_id string, event_time string, road_name string, district string, "
        "average_speed_kmh double, congestion_level string, vehicle_count int"
    ),
    "news": _struct(
        "event_id string, event_time string, source string, city string, district string, title string, "
        "sentiment_score double, keyword string, road_name string, damage_type string, "
        "severity_level string, severity_score int, complaint_count bigint, road_confidence double, "
        "sentiment string, url string, published_at timestamp, scraped_at timestamp, extraction_confidence double"
    ),
    "accidents": _struct(
        "event_id string, event_time string, accident_id string, road_name string, district string, "
        "latitude double, longitude double, severity string, vehicle_count int, casualties int, "
        "accident_type string"
    ),
}

# The same columns once event_time is parsed: what raw and clean tables hold.
EVENT = {
    feed: StructType([StructField(f.name, _TYPES["timestamp"] if f.name == "event_time" else f.dataType) for f in schema])
    for feed, schema in WIRE.items()
}

# Daily rain records travel on the weather topic as well; they carry no event_id.
RAIN_DAY = _struct(
    "date date, precipitation_sum double, rain_sum double, precipitation_hours double"
)
RAIN_PAYLOAD = _struct(
    "time array<string>, precipitation_sum array<double>, rain_sum array<double>, "
    "precipitation_hours array<double>"
)
RUN_LOG = _struct(
    "job_name string, layer string, status string, start_time timestamp, end_time timestamp, "
    "record_processed bigint, error_message string, checkpoint_path string"
)

# Serving tables refuse NULL in these columns.
REQUIRED = {
    "road_health_index": (
        "road_name", "district", "severity", "rainfall", "traffic", "road_age_score",
        "road_health_index", "batch_time",
    ),
    "priority_score": (
        "report_id", "road_name", "district", "severity_score", "traffic_score", "accident_score",
        "complaint_score", "news_score", "priority_score", "batch_time",
    ),
    "damage_prediction": (
        "report_id", "road_name", "district", "severity_score", "predicted_risk_level", "batch_time",
    ),
    "accident_prediction": (
        "road_name", "district", "predicted_accident_probability", "risk_level", "prediction_date",
        "batch_time",
    ),
    "hotspot_analysis": (
        "road_id", "road_name", "report_count", "avg_severity", "hotspot_score", "batch_time",
    ),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in order; a value that does not fit, or a column that is absent, is NULL."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def ensure_columns(df: DataFrame, names, dtype="float", default=0.0) -> DataFrame:
    """Cast each named column to ``dtype``; add it as a constant where the frame lacks it."""
    return df.withColumns(
        {n: (F.col(n) if n in df.columns else F.lit(default)).cast(dtype) for n in names}
    )


def snake_case(name: str) -> str:
    """``averageSpeedKmh`` becomes ``average_speed_kmh``; an acronym counts as one word."""
    word_start = r"(?<=.)(?=[A-Z][a-z])|(?<=[a-z0-9])(?=[A-Z])"
    return re.sub(word_start, "_", name).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])
