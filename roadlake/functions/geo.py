"""Bounding boxes and district geocoding."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake import rules
from roadlake.functions.standardize import quote, strip_sql
from roadlake.session import local_table


def inside(lat: str, lon: str, box=rules.CITY_BOX) -> Column:
    """Inside the box; NULL where a coordinate is. A filter on it reaches the scan."""
    return F.col(lat).between(box["min_lat"], box["max_lat"]) & F.col(lon).between(box["min_lon"], box["max_lon"])


def in_box(lat: str, lon: str, box=rules.CITY_BOX) -> Column:
    """True inside the box, False outside it or where a coordinate is NULL."""
    return F.coalesce(inside(lat, lon, box), F.lit(False))


def on_map(lat: str = "latitude", lon: str = "longitude") -> Column:
    """Filter for rows whose coordinates are both known and not zero."""
    return (F.col(lat) != 0) & (F.col(lon) != 0)


def districts_table(spark: SparkSession, centroids=rules.DISTRICT_CENTROIDS) -> DataFrame:
    return local_table(
        spark,
        district=list(centroids),
        latitude=[lat for lat, _ in centroids.values()],
        longitude=[lon for _, lon in centroids.values()],
    )


def bounds_table(spark: SparkSession, box=rules.CITY_BOX, center=rules.CITY_CENTER) -> DataFrame:
    row = {**box, "center_lat": center[0], "center_lon": center[1]}
    return local_table(spark, **{k: [v] for k, v in row.items()})


def centroid_sql(x: str, centroids=rules.DISTRICT_CENTROIDS, center=rules.CITY_CENTER) -> str:
    """struct(latitude, longitude) of a district, the city centre for an unknown one."""

    def point(lat: float, lon: float) -> str:
        return f"named_struct('latitude', {lat!r}D, 'longitude', {lon!r}D)"

    table = ", ".join(f"{quote(name.lower())}, {point(*place)}" for name, place in centroids.items())
    return f"coalesce(try_element_at(map({table}), lower({strip_sql(x)})), {point(*center)})"


def with_centroid(df: DataFrame, district: str = "district", centroids=rules.DISTRICT_CENTROIDS,
                  center=rules.CITY_CENTER) -> DataFrame:
    """Add ``centroid_lat`` and ``centroid_lon``; an unknown district gets the city centre.

    The broadcast side is the dictionary itself, so its size does not depend on the data.
    """
    dim = F.broadcast(
        districts_table(df.sparkSession, centroids).select(
            F.lower("district").alias("_place"),
            F.col("latitude").alias("centroid_lat"),
            F.col("longitude").alias("centroid_lon"),
        )
    )
    place = F.expr(f"lower({strip_sql(district)})")
    return (
        df.join(dim, place == F.col("_place"), "left")
        .drop("_place")
        .withColumns(
            {
                "centroid_lat": F.coalesce("centroid_lat", F.lit(center[0])),
                "centroid_lon": F.coalesce("centroid_lon", F.lit(center[1])),
            }
        )
    )


def geocode(df: DataFrame, lat: str = "latitude", lon: str = "longitude", **kwargs) -> DataFrame:
    """Keep coordinates that are given as a pair; else take the district's centroid, else the centre."""
    given = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return (
        with_centroid(df, **kwargs)
        .withColumns(
            {
                lat: F.when(given, F.col(lat)).otherwise(F.col("centroid_lat")),
                lon: F.when(given, F.col(lon)).otherwise(F.col("centroid_lon")),
            }
        )
        .drop("centroid_lat", "centroid_lon")
    )


def fill_coordinates(df: DataFrame, zero_is_missing: bool, lat: str = "latitude", lon: str = "longitude",
                     **kwargs) -> DataFrame:
    """Fill each missing coordinate on its own from the district's centroid."""

    def known(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(0.0)) if zero_is_missing else F.col(c)

    return (
        with_centroid(df, **kwargs)
        .withColumns(
            {
                lat: F.coalesce(known(lat), F.col("centroid_lat")),
                lon: F.coalesce(known(lon), F.col("centroid_lon")),
            }
        )
        .drop("centroid_lat", "centroid_lon")
    )
