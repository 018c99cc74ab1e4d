"""The column rules as SQL functions, which Catalyst inlines."""

from pyspark.sql import SparkSession

from roadlake.functions import geo, standardize, text

FUNCTIONS = {
    "standardize_district": ("STRING", "STRING", standardize.district_sql),
    "standardize_damage_type": ("STRING", "STRING", standardize.damage_type_sql),
    "standardize_weather_condition": ("STRING", "STRING", standardize.weather_condition_sql),
    "standardize_congestion_level": ("STRING", "STRING", standardize.congestion_level_sql),
    "standardize_severity_text": ("STRING", "STRING", standardize.severity_text_sql),
    "standardize_severity_score": ("DOUBLE", "STRING", standardize.severity_score_sql),
    "geocode_district": ("STRING", "STRUCT<latitude: DOUBLE, longitude: DOUBLE>", geo.centroid_sql),
    "news_road_names": ("STRING", "ARRAY<STRING>", text.road_names),
}


def register(spark: SparkSession) -> None:
    """Create the functions for this session."""
    for name, (takes, returns, rule) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x {takes}) RETURNS {returns} RETURN {rule('x')}")
