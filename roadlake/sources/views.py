"""The five feeds and their companions as views over the generic test tables.

The SQL is valid in Spark and in DuckDB; ``{table}`` names a base table.
"""

import re

from pyspark.sql import DataFrame, SparkSession

_BY_SUPPLIER = "l_suppkey"


def _district(key: str) -> str:
    return f"""CASE CAST({key} % 6 AS INT) WHEN 0 THEN ' Wonocolo ' WHEN 1 THEN 'GUNUNG-ANYAR'
      WHEN 2 THEN 'gunung anyar' WHEN 3 THEN 'pabean_cantian' WHEN 4 THEN 'kenjeran' ELSE 'Rungkut' END"""


_KEYWORD = """CASE CAST(event_id % 5 AS INT) WHEN 0 THEN 'pothole' WHEN 1 THEN 'crack' WHEN 2 THEN 'general'
      WHEN 3 THEN 'subsidence' ELSE NULL END"""

SQL = {
    "reports_raw": f"""
SELECT 'E'||l_orderkey||'-'||l_linenumber||'-'||l_partkey AS event_id, l_shipdate AS event_time,
  'R'||l_orderkey||'-'||l_linenumber AS report_id, '  jl. ROAD '||(l_partkey % 200)||' ' AS road_name,
  CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE {_district(_BY_SUPPLIER)} END AS district,
  'village '||(l_suppkey % 9) AS village,
  CASE CAST(l_partkey % 7 AS INT) WHEN 0 THEN 'D00_Longitudinal_Crack' WHEN 1 THEN 'D10_Transverse_Crack'
    WHEN 2 THEN 'D20_Alligator_Crack' WHEN 3 THEN 'D40_Pothole' WHEN 4 THEN 'd40 pothole'
    WHEN 5 THEN 'D50_Other_Damage' ELSE NULL END AS damage_type,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_quantity * 2 AS INT) END AS severity_score,
  CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE l_discount * 10 END AS confidence,
  CASE CAST(l_linenumber % 4 AS INT) WHEN 0 THEN 'Pending' WHEN 1 THEN ' Verified ' WHEN 2 THEN 'In Progress'
    ELSE 'Resolved' END AS status,
  CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_partkey % 37 = 0 THEN 0e0 WHEN l_partkey % 41 = 0 THEN 95e0
    ELSE -7.5e0 + (l_partkey % 500)/1e3 END AS latitude,
  CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_partkey % 37 = 0 THEN 0e0
    ELSE 112.5e0 + (l_suppkey % 500)/1e3 END AS longitude
FROM {{lineitem}}""",
    "weather_raw": f"""
SELECT 'W'||event_id AS event_id, ts AS event_time, 'Surabaya' AS city, {_district("user_id")} AS district,
  CASE WHEN event_id % 20 = 0 THEN NULL ELSE value END AS rainfall_mm,
  CASE WHEN event_id % 15 = 0 THEN NULL ELSE 24e0 + event_id % 12 END AS temperature_c,
  CASE WHEN event_id % 25 = 0 THEN NULL ELSE (event_id % 100)/1e2 END AS humidity,
  CASE event_type WHEN 'click' THEN 'rain' WHEN 'view' THEN 'Clear Sky' WHEN 'signup' THEN 'thunderstorm'
    WHEN 'error' THEN 'fog' ELSE NULL END AS condition
FROM {{events}}""",
    "traffic_raw": f"""
SELECT 'T'||o_orderkey AS event_id, o_orderdate AS event_time, 'jl. road '||(o_custkey % 200) AS road_name,
  {_district("o_custkey")} AS district,
  CASE WHEN o_orderkey % 30 = 0 THEN NULL ELSE o_orderkey % 120 + 0e0 END AS average_speed_kmh,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'SEVERE' WHEN '2-HIGH' THEN 'very high' WHEN '3-MEDIUM' THEN 'medium'
    WHEN '5-LOW' THEN 'low' ELSE NULL END AS congestion_level,
  CASE WHEN o_orderkey % 45 = 0 THEN NULL ELSE CAST(floor(o_totalprice/1e2) AS INT) END AS vehicle_count
FROM {{orders}}""",
    "accidents_raw": f"""
SELECT 'A'||l_orderkey||'-'||l_linenumber||'-'||l_partkey AS event_id, l_shipdate AS event_time,
  'ACC'||l_orderkey AS accident_id, 'jl. road '||(l_partkey % 200) AS road_name,
  {_district(_BY_SUPPLIER)} AS district,
  CASE CAST(l_partkey % 6 AS INT) WHEN 0 THEN 'low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'HIGH'
    WHEN 3 THEN 'very critical' WHEN 4 THEN '' ELSE NULL END AS severity,
  CASE WHEN l_suppkey % 19 = 0 THEN NULL ELSE CAST(l_linenumber AS INT) END AS vehicle_count,
  CASE WHEN l_suppkey % 23 = 0 THEN NULL ELSE CAST(l_linenumber % 3 AS INT) END AS casualties,
  CASE WHEN l_partkey % 4 = 0 THEN NULL WHEN l_partkey % 9 = 0 THEN 0e0
    ELSE -7.4e0 + (l_partkey % 100)/1e3 END AS latitude,
  CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 112.6e0 + (l_suppkey % 100)/1e3 END AS longitude
FROM {{lineitem}}""",
    "news_raw": f"""
SELECT 'N'||(event_id % 4000) AS event_id, ts AS event_time, 'src'||(user_id % 10) AS source, 'Surabaya' AS city,
  {_district("user_id")} AS district, 'title '||event_id AS title,
  CASE WHEN event_id % 18 = 0 THEN NULL ELSE (event_id % 201 - 100)/1e2 END AS sentiment_score,
  {_KEYWORD} AS keyword,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'Jl. Road '||(event_id % 200) END AS road_name,
  {_KEYWORD} AS damage_type,
  CASE CAST(event_id % 6 AS INT) WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' WHEN 3 THEN 'low'
    ELSE NULL END AS severity_level,
  CASE CAST(event_id % 6 AS INT) WHEN 0 THEN 90 WHEN 1 THEN 70 WHEN 2 THEN 45 WHEN 3 THEN 20
    ELSE NULL END AS severity_score,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 60 AS BIGINT) END AS complaint_count,
  (event_id % 11)/1e1 AS road_confidence,
  CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' ELSE 'neutral' END AS sentiment
FROM {{events}}""",
    # a second delivery of every third event, corrected but with the same time; some events without an id
    "weather_redelivered": f"""
SELECT CASE WHEN event_id % 17 = 0 THEN NULL ELSE 'W'||event_id END AS event_id, ts AS event_time, 'Surabaya' AS city,
  {_district("user_id")} AS district, value AS rainfall_mm, 2e1 AS temperature_c, 5e-1 AS humidity, event_type AS condition, 1 AS delivery
FROM {{events}} UNION ALL
SELECT CASE WHEN event_id % 17 = 0 THEN NULL ELSE 'W'||event_id END, ts, 'Surabaya', {_district("user_id")},
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE value + (event_id % 5 - 2) END, 2e1, 5e-1, CASE WHEN event_id % 6 = 0 THEN event_type ELSE ' hail ' END, 2
FROM {{events}} WHERE event_id % 3 = 0""",
    "rain_lines": """
SELECT CAST(o_orderkey AS STRING) AS key,
  '{{"date": "2020-01-01", "precipitation_sum": '||o_orderkey||', "rain_sum": 1.5, "precipitation_hours": 2.0}}' AS value
FROM {orders}""",
    "camel_lines": """
SELECT l_orderkey AS lineOrderKey, l_linenumber AS LineNumber, l_quantity AS quantityABCTotal FROM {lineitem}""",
    "detections": """
SELECT 'R'||l_orderkey AS report_id, l_linenumber AS image_no, l_partkey * 100000 + l_suppkey AS box_no,
  CAST(l_partkey % 7 AS INT) AS class_id, l_discount * 10 AS confidence
FROM {lineitem}""",
    "photo_reports": """
SELECT 'R'||o_orderkey AS report_id, o_orderdate AS event_time FROM {orders}""",
    "rhi_history": """
SELECT 'Road '||(o_custkey % 200) AS road_name, 'D'||(o_custkey % 25) AS district,
  (o_orderkey % 1000)/1e1 AS road_health_index, CAST(o_orderdate AS DATE) AS batch_date
FROM {orders}""",
    "rain_daily": """
SELECT CAST(o_orderdate AS DATE) AS date,
  CASE WHEN count(*) % 9 = 0 THEN NULL ELSE count(*) * 0.5e0 END AS precipitation_sum
FROM {orders} GROUP BY CAST(o_orderdate AS DATE)""",
    "rain_known": """
SELECT CAST(l_shipdate AS DATE) AS date, count(*) * 0.5e0 AS precipitation_sum
FROM {lineitem} GROUP BY CAST(l_shipdate AS DATE)""",
    "feed_entries": """
SELECT source AS search, doc_id AS place, text AS title FROM {documents}""",
    "feed_dates": """
SELECT o_orderkey AS entry_no, o_orderdate AS published,
  CASE WHEN o_orderkey % 10 = 0 THEN 'not a date' WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS kind
FROM {orders}""",
    "photos": """
SELECT o_orderkey AS report_no, o_orderstatus AS kind, o_totalprice AS price FROM {orders}""",
    # copies of a document share a URL
    "news_articles": """
SELECT doc_id AS article_no, source,
  'Warga '||CASE CAST(doc_id % 4 AS INT) WHEN 0 THEN 'Wonokromo' WHEN 1 THEN 'Gubeng' WHEN 2 THEN 'Pabean Cantian'
    ELSE 'kota' END||' mengeluh' AS title,
  CASE CAST(doc_id % 5 AS INT)
    WHEN 0 THEN 'Jalan Ahmad Yani berlubang parah, '||(doc_id % 50)||' warga melapor. '
    WHEN 1 THEN 'Jalan Kertajaya Indah bergelombang dan retak buaya, sangat parah. Selain itu Jalan Diponegoro juga rusak ringan. '
    WHEN 2 THEN 'Perbaikan Jalan Mayjend Sungkono akhirnya selesai, warga apresiasi, tidak rusak. '
    WHEN 3 THEN 'rusak tanpa nama, puluhan laporan. '
    ELSE '' END||text AS content,
  'http://news.example/'||md5(text) AS url
FROM {documents}""",
    "news_ledger": """
SELECT DISTINCT 'http://news.example/'||md5(text) AS url
FROM {documents} JOIN {labels} USING (doc_id)""",
}


def tables_of(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    sql = SQL[name]
    return spark.sql(sql, **{t: table(spark, folder, t) for t in tables_of(sql)})


def stream_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same view over the base tables read as file streams."""
    sql = SQL[name]

    def source(t: str) -> DataFrame:
        schema = table(spark, folder, t).schema
        # a pattern may name one file as well as a folder of files; a plain path must be a folder
        return spark.readStream.schema(schema).parquet(f"{folder}/{t}.parque[t]")

    return spark.sql(sql, **{t: source(t) for t in tables_of(sql)})
