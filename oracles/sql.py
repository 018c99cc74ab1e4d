"""DuckDB counterparts of the named queries, written on their own from the rules.

Each statement starts from the domain views and builds up named steps (``STEPS``); ``statements``
puts the steps that a query needs in front of it.
"""

import re

from roadlake import rules
from roadlake.sources import views


def _q(text):
    return "'" + text.replace("'", "''") + "'"


def _initcap(x):
    return f"array_to_string(list_transform(string_split(lower(trim({x})),' '), lambda w: upper(w[1:1])||w[2:]),' ')"


def _mean(x):
    return f"avg({x})"


def _settled(source, *columns):
    """Means of doubles to ten places, as in the compared queries."""
    return f"SELECT * REPLACE ({', '.join(f'round({c}, 10) AS {c}' for c in columns)}) FROM {source}"


_FEATURE_MEANS = ("avg_speed", "rainfall_mm", "temperature_c", "humidity")


def _newest(feed, keys, order, where="TRUE", columns="*"):
    """One row per key of a raw view, the newest one."""
    by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (
        f"SELECT * EXCLUDE (rn_) FROM (SELECT {columns}, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {by}) rn_ "
        f"FROM {feed}_raw WHERE {where}) WHERE rn_ = 1"
    )


# categories


def _match(key, entries, fallback):
    exact = " ".join(f"WHEN {key} = {_q(k)} THEN {_q(v)}" for k, v in entries.items())
    part = " ".join(f"WHEN contains({key}, {_q(k)}) OR contains({_q(k)}, {key}) THEN {_q(v)}" for k, v in entries.items())
    return f"CASE {exact} {part} ELSE {fallback} END"


def _std_district(x):
    key = f"regexp_replace(lower(trim({x})), '[_\\-\\s]+', '_', 'g')"
    known = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in rules.DISTRICTS.items())
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE coalesce(CASE {key} {known} END, {_initcap(x)}) END"


def _std_damage(x):
    key = f"replace(replace(lower(trim({x})), ' ', '_'), '-', '_')"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'Unknown' ELSE {_match(key, rules.DAMAGE_TYPES, _q('Unknown'))} END"


def _std_named(x, entries):
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'Unknown' ELSE {_match(f'lower(trim({x}))', entries, _initcap(x))} END"


def _std_severity_text(x):
    return f"CASE WHEN {x} IS NULL THEN 'Unknown' ELSE {_match(f'lower(trim({x}))', rules.SEVERITY_LEVELS, _q('Unknown'))} END"


_CENTROIDS = "(VALUES " + ", ".join(
    f"({_q(n.lower())}, CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))" for n, (lat, lon) in rules.DISTRICT_CENTROIDS.items()
) + ") AS c(place, clat, clon)"
_LAT0, _LON0 = f"CAST({rules.CITY_CENTER[0]} AS DOUBLE)", f"CAST({rules.CITY_CENTER[1]} AS DOUBLE)"


def _filled(source, columns, zero):
    """Coordinates of ``source`` filled from the district's centroid."""
    lat, lon = ("nullif(latitude, 0)", "nullif(longitude, 0)") if zero else ("latitude", "longitude")
    return (
        f"SELECT {columns}, coalesce({lat}, clat, {_LAT0}) AS latitude, coalesce({lon}, clon, {_LON0}) AS longitude "
        f"FROM {source} LEFT JOIN {_CENTROIDS} ON lower(trim(district)) = place"
    )


_REPORT_RULES = ["latitude BETWEEN -7.5 AND -7.0", "longitude BETWEEN 112.5 AND 113.0",
                 "severity_score BETWEEN 0 AND 100", "confidence BETWEEN 0 AND 1"]
_ROW_SCORE = "(" + "+".join(f"CAST(coalesce({r}, FALSE) AS INT)" for r in _REPORT_RULES) + ")/4e0"

_RANGES = {
    "reports": [("latitude", -7.5, -7.0), ("longitude", 112.5, 113.0), ("severity_score", 0, 100), ("confidence", 0, 1)],
    "weather": [("temperature_c", 15, 45), ("humidity", 0, 1), ("rainfall_mm", 0, 500)],
    "traffic": [("average_speed_kmh", 0, 120), ("vehicle_count", 0, 10000)],
}


def _out(feed):
    parts = [f"coalesce({c} NOT BETWEEN {a} AND {b}, FALSE)" for c, a, b in _RANGES.get(feed, [])]
    return "(" + " OR ".join(parts or ["FALSE"]) + ")"


def _violations(feed):
    names = ", ".join(f"CASE WHEN {c} NOT BETWEEN {a} AND {b} THEN {_q(c)} END" for c, a, b in _RANGES[feed])
    return f"concat_ws(',', {names})"


def _metrics(feed, keys, order):
    nokey = " OR ".join(f"{k} IS NULL" for k in keys)
    by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return f"""SELECT 'bronze' AS layer, '{feed}' AS dataset_name, count(*) AS record_count,
      count(*) FILTER ({nokey}) AS null_count, count(*) FILTER (NOT ({nokey}) AND rn > 1) AS duplicate_count,
      CASE WHEN count(*) = 0 THEN 1e0 ELSE CAST(count(*) FILTER (NOT ({nokey}) AND rn = 1 AND NOT {_out(feed)}) AS DOUBLE)/count(*) END AS quality_score
      FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {by}) AS rn FROM {feed}_raw)"""


# news text


def _hits(text, words):
    return "(" + "+".join(f"CAST(contains({text}, {_q(w)}) AS INT)" for w in words) + ")"


def _damage_columns(text):
    names = [f"hd_{t}" for t in rules.DAMAGE_KEYWORDS]
    return ", ".join(f"{_hits(text, w)} AS hd_{t}" for t, w in rules.DAMAGE_KEYWORDS.items()), names


def _severity_columns(text):
    return ", ".join(f"{_hits(text, w)} AS hs_{lv}" for lv, (_, w) in rules.SEVERITY_KEYWORDS.items())


_DAMAGE_SQL, _DAMAGE_HITS = _damage_columns("low")
_TOP_HIT = f"greatest({', '.join(_DAMAGE_HITS)})"
_DAMAGE_TYPE = f"CASE WHEN {_TOP_HIT} = 0 THEN NULL " + " ".join(
    f"WHEN hd_{t} = {_TOP_HIT} THEN '{t}'" for t in rules.DAMAGE_KEYWORDS) + " END"
_DAMAGE_CONF = f"CASE WHEN {_TOP_HIT} = 0 THEN 0e0 ELSE least(1e0, 0.4e0 + 0.2e0*{_TOP_HIT}) END"
_WEAK = "contains(low, 'rusak') OR contains(low, 'berlubang')"
_SEV_LEVEL = "CASE " + " ".join(f"WHEN hs_{lv} > 0 THEN '{lv}'" for lv in rules.SEVERITY_KEYWORDS) + f" WHEN {_WEAK} THEN 'medium' END"
_SEV_SCORE = "CASE " + " ".join(f"WHEN hs_{lv} > 0 THEN {s}" for lv, (s, _) in rules.SEVERITY_KEYWORDS.items()) + f" WHEN {_WEAK} THEN 45 END"
_SEV_CONF = "CASE " + " ".join(
    f"WHEN hs_{lv} > 0 THEN least(1e0, 0.5e0 + 0.25e0*hs_{lv})" for lv in rules.SEVERITY_KEYWORDS) + f" WHEN {_WEAK} THEN 0.3e0 ELSE 0e0 END"
_BY_LENGTH = sorted(rules.NEWS_DISTRICTS, key=len, reverse=True)


def _find_district(text):
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, '\\b{n.lower()}\\b') THEN {_q(n)}" for n in _BY_LENGTH) + " END"


def _occurrences(keyword, negated):
    parts = f"string_split(low, {_q(keyword)})"
    before = f"list_transform(range(1, len({parts})), lambda i: right(array_to_string({parts}[1:i], {_q(keyword)}), 15))"
    said = " OR ".join(f"contains(s, {_q(n)})" for n in rules.NEGATION_WORDS)
    count = f"len(list_filter({before}, lambda s: {'' if negated else 'NOT '}({said})))"
    return f"(CASE WHEN contains(low, {_q(keyword)}) THEN {count} ELSE 0 END)"


_GOOD = "+".join([_occurrences(k, False) for k in rules.POSITIVE_KEYWORDS]
                 + [f"0.5e0*{_occurrences(k, True)}" for k in rules.NEGATIVE_KEYWORDS])
_BAD = "+".join([_occurrences(k, True) for k in rules.POSITIVE_KEYWORDS]
                + [_occurrences(k, False) for k in rules.NEGATIVE_KEYWORDS])

STEPS = {name: (sql, ()) for name, sql in views.SQL.items()}


def step(name, sql, *needs):
    STEPS[name] = (sql, needs)


_EARTH = "report_id IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"
step("reports", f"SELECT event_id, event_time, report_id, {_initcap('road_name')} AS road_name, {_initcap('district')} AS district, "
     f"{_initcap('village')} AS village, damage_type, severity_score, confidence, trim(status) AS status, latitude, longitude "
     f"FROM ({_newest('reports', ['report_id'], ['event_time', 'event_id'], _EARTH)})", "reports_raw")
step("weather", f"SELECT event_id, event_time, {_initcap('city')} AS city, {_initcap('district')} AS district, rainfall_mm, "
     f"temperature_c, humidity, trim(condition) AS condition FROM ({_newest('weather', ['event_id'], ['event_time'])})", "weather_raw")
step("traffic", f"SELECT event_id, event_time, {_initcap('road_name')} AS road_name, {_initcap('district')} AS district, "
     f"average_speed_kmh, trim(congestion_level) AS congestion_level, vehicle_count "
     f"FROM ({_newest('traffic', ['event_id'], ['event_time'])})", "traffic_raw")
step("news", f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id, road_name ORDER BY event_time DESC NULLS LAST, title DESC NULLS LAST) AS rn
     FROM (SELECT event_id, event_time, trim(source) AS source, {_initcap('city')} AS city, {_initcap('district')} AS district,
     title, sentiment_score, keyword, {_initcap('road_name')} AS road_name, damage_type, severity_level, severity_score,
     complaint_count, road_confidence, sentiment FROM news_raw WHERE event_id IS NOT NULL)) WHERE rn = 1""", "news_raw")
step("accidents", f"SELECT event_id, event_time, accident_id, {_initcap('road_name')} AS road_name, {_initcap('district')} AS district, "
     f"latitude, longitude, severity, vehicle_count, casualties "
     f"FROM ({_newest('accidents', ['event_id'], ['event_time'])})", "accidents_raw")

step("e_reports", "SELECT * FROM (" + _filled(
    "(SELECT * REPLACE (" + _std_district("district") + " AS district, " + _std_damage("damage_type") + " AS damage_type), "
    + _ROW_SCORE + " AS data_quality_score FROM (" + _newest("reports", ["report_id", "event_time"], ["event_id"]) + "))",
    "event_id, event_time, report_id, road_name, district, village, damage_type, coalesce(severity_score, 0) AS severity_score, "
    "coalesce(confidence, 0e0) AS confidence, status, data_quality_score", True) + ")", "reports_raw")
step("e_weather", "SELECT * REPLACE (coalesce(temperature_c, (SELECT " + _mean("temperature_c") + " FROM d_weather)) AS temperature_c, "
     "coalesce(rainfall_mm, 0e0) AS rainfall_mm, coalesce(humidity, 0.5e0) AS humidity, "
     + _std_district("district") + " AS district, " + _std_named("condition", rules.WEATHER_CONDITIONS) + " AS condition) FROM d_weather", "d_weather")
step("d_weather", _newest("weather", ["event_id", "event_time"], ["city"]), "weather_raw")
step("e_traffic", "SELECT * REPLACE (coalesce(average_speed_kmh, 0e0) AS average_speed_kmh, coalesce(vehicle_count, 0) AS vehicle_count, "
     + _std_district("district") + " AS district, " + _std_named("congestion_level", rules.CONGESTION_LEVELS) + " AS congestion_level) FROM ("
     + _newest("traffic", ["event_id", "event_time"], ["road_name"]) + ")", "traffic_raw")
step("e_news", "SELECT * REPLACE (coalesce(sentiment_score, 0e0) AS sentiment_score, " + _std_district("district") + " AS district) FROM ("
     + _newest("news", ["event_id", "road_name"], ["event_time", "title"]) + ")", "news_raw")
step("e_accidents", "SELECT * FROM (" + _filled(
    "(SELECT * REPLACE (" + _std_district("district") + " AS district, " + _std_severity_text("severity") + " AS severity) FROM ("
    + _newest("accidents", ["accident_id", "event_time"], ["event_id"]) + "))",
    "event_id, event_time, accident_id, road_name, district, severity, coalesce(vehicle_count, 0) AS vehicle_count, "
    "coalesce(casualties, 0) AS casualties", False) + ")", "accidents_raw")

step("road_severity", "SELECT road_name, district, avg(severity_score) AS severity FROM reports GROUP BY ALL", "reports")
step("district_rainfall", f"SELECT district, {_mean('rainfall_mm')} AS rainfall FROM weather GROUP BY ALL", "weather")
step("road_traffic", "SELECT road_name, district, avg(vehicle_count)/20e0 AS traffic FROM traffic GROUP BY ALL", "traffic")
step("road_accidents", "SELECT road_name, district, count(*) AS accident_count FROM accidents GROUP BY ALL", "accidents")
step("district_news", f"SELECT district, count(*) AS news_count, {_mean('sentiment_score')} AS sentiment FROM news GROUP BY ALL", "news")
step("report_counts", "SELECT road_name, count(*) AS report_count FROM reports GROUP BY ALL", "reports")
step("rhi", """SELECT *, 100e0 - severity*0.4e0 - rainfall*0.2e0 - traffic*0.2e0 - road_age_score*0.2e0 AS road_health_index FROM (
  SELECT s.road_name, s.district, severity, coalesce(rainfall, 0e0) AS rainfall, coalesce(traffic, 0e0) AS traffic, 0e0 AS road_age_score
  FROM road_severity s LEFT JOIN district_rainfall w ON s.district = w.district
  LEFT JOIN road_traffic t ON s.road_name = t.road_name AND s.district = t.district)""",
     "road_severity", "district_rainfall", "road_traffic")
step("complaints", """SELECT road_name, report_count, CASE WHEN report_count = 1 THEN 10e0 WHEN report_count BETWEEN 2 AND 4 THEN 30e0
  WHEN report_count BETWEEN 5 AND 9 THEN 60e0 WHEN report_count >= 10 THEN 100e0 ELSE 0e0 END AS complaint_score FROM report_counts""",
     "report_counts")
step("simple", """SELECT report_id, road_name, district, damage_type, severity_score, confidence,
  round(severity_score*0.75e0 + confidence*100*0.25e0, 2) AS priority_score FROM reports_raw""", "reports_raw")


def _health(source):
    return f"""SELECT district, count(*) AS report_count, avg(severity_score) AS average_severity,
  count(*) FILTER (damage_type = 'D40_Pothole') AS pothole_count, count(*) FILTER (damage_type LIKE '%Crack%') AS crack_count,
  100e0 - avg(severity_score) AS road_health_index FROM {source} GROUP BY district"""


_CLASSES = [(k, t, s) for k, (t, s) in rules.DAMAGE_CLASSES.items()]
_CLASS_TYPE = "CASE class_id " + " ".join(f"WHEN {k} THEN '{t}'" for k, t, _ in _CLASSES) + " ELSE 'Unknown' END"
_CLASS_SCORE = "CASE class_id " + " ".join(f"WHEN {k} THEN {s}" for k, _, s in _CLASSES) + " ELSE 0 END"
step("classified", f"SELECT report_id, image_no, box_no, class_id, round(confidence, 2) AS confidence, {_CLASS_TYPE} AS damage_type, "
     f"{_CLASS_SCORE} AS severity_score FROM detections", "detections")


def _rolling(source):
    sums = ", ".join(
        f"round(CAST(sum(coalesce(precipitation_sum, 0e0)) OVER (ORDER BY date RANGE BETWEEN INTERVAL {n - 1} DAYS PRECEDING AND CURRENT ROW) AS DOUBLE), 2) AS rainfall_{n}d"
        for n in rules.RAIN_WINDOWS)
    return f"SELECT date, precipitation_sum, {sums} FROM {source}"


step("rolled", _rolling("rain_daily"), "rain_daily")
step("known", _rolling("rain_known"), "rain_known")
_PICK = ", ".join(f"CASE WHEN n.date IS NOT NULL THEN n.rainfall_{d}d ELSE o.rainfall_{d}d END AS rainfall_{d}d" for d in rules.RAIN_WINDOWS)
step("merged", f"""SELECT coalesce(o.date, n.date) AS date, CASE WHEN o.date IS NOT NULL THEN o.precipitation_sum ELSE n.precipitation_sum END AS precipitation_sum,
  {_PICK}, CASE WHEN o.date IS NOT NULL AND n.date IS NOT NULL THEN 'updated' WHEN n.date IS NOT NULL THEN 'saved' ELSE 'kept' END AS action
  FROM known o FULL JOIN rolled n ON o.date = n.date""", "known", "rolled")

# The road names are those of the text templates; everything around them is computed.
step("art", r"""SELECT *, lower(txt) AS low FROM (SELECT article_no, source, title, url, content,
  regexp_replace(regexp_replace(title||' '||content, '^\s+', ''), '\s+$', '') AS txt,
  CASE article_no % 5 WHEN 0 THEN ['Ahmad Yani'] WHEN 1 THEN ['Kertajaya Indah', 'Diponegoro']
    WHEN 2 THEN ['Mayjend Sungkono'] ELSE []::VARCHAR[] END AS names FROM news_articles)""", "news_articles")
step("parts", f"""SELECT article_no, 0 AS pos, NULL AS name, NULL AS near, low, {_find_district('low')} AS gdist FROM art""", "art")
step("near", f"""SELECT article_no, generate_subscripts(names, 1) AS pos, unnest(names) AS name, txt, {_find_district('low')} AS gdist FROM art""", "art")
step("local", """SELECT article_no, pos, name, gdist, lower(txt[greatest(instr(txt, name) - 80, 1) : instr(txt, name) + length(name) + 79]) AS low FROM near""", "near")
step("mentions", f"""SELECT article_no, pos, name AS road_name, coalesce({_find_district('low')}, gdist) AS district, damage_type, severity_level, severity_score,
    round(CASE WHEN dc > 0 AND sc > 0 THEN (dc + sc)/2 WHEN dc > 0 OR sc > 0 THEN dc + sc ELSE 0.2e0 END, 2) AS confidence FROM (
  SELECT *, {_DAMAGE_TYPE} AS damage_type, {_DAMAGE_CONF} AS dc, {_SEV_LEVEL} AS severity_level, {_SEV_SCORE} AS severity_score, {_SEV_CONF} AS sc
  FROM (SELECT *, {_DAMAGE_SQL}, {_severity_columns('low')} FROM local))
  UNION ALL
  SELECT article_no, 1, 'UNKNOWN', gdist, damage_type, severity_level, severity_score,
    round(CASE WHEN dc > 0 AND sc > 0 THEN least(dc, sc) ELSE greatest(dc, sc) END, 2) FROM (
  SELECT *, {_DAMAGE_TYPE} AS damage_type, {_DAMAGE_CONF} AS dc, {_SEV_LEVEL} AS severity_level, {_SEV_SCORE} AS severity_score, {_SEV_CONF} AS sc
  FROM (SELECT article_no, low, {_find_district('low')} AS gdist, {_DAMAGE_SQL}, {_severity_columns('low')} FROM art WHERE len(names) = 0))
  WHERE damage_type IS NOT NULL OR severity_level IS NOT NULL""", "local", "art")
_NOUNS = "|".join(rules.COMPLAINT_NOUNS)
_APPROX = "CASE " + " ".join(f"WHEN contains(low, {_q(w)}) THEN {n}" for w, n in rules.COMPLAINT_APPROX.items()) + " END"
step("toned", f"""SELECT article_no, source, coalesce(stated, estimate) AS complaint_count,
    CASE WHEN stated IS NOT NULL THEN 0.9e0 WHEN estimate IS NOT NULL THEN 0.4e0 ELSE 0e0 END AS cc,
    CASE WHEN net > 0.15 THEN 'positive' WHEN net < -0.15 THEN 'negative' ELSE 'neutral' END AS sentiment, round(net, 2) AS sentiment_score FROM (
  SELECT *, CASE WHEN good + bad = 0 THEN 0e0 ELSE (good - bad)/(good + bad) END AS net FROM (
  SELECT article_no, source, low, TRY_CAST(regexp_extract(low, '([0-9]+)\\s*(?:{_NOUNS})', 1) AS BIGINT) AS stated, {_APPROX} AS estimate,
    {_GOOD} AS good, {_BAD} AS bad FROM art))""", "art")
step("articles", """SELECT article_no, source, complaint_count, sentiment, sentiment_score, count(pos) AS mentions,
    CASE WHEN count(pos) + CAST(any_value(cc) > 0 AS INT) = 0 THEN 0e0
      ELSE round((coalesce(sum(confidence), 0e0) + any_value(cc))/(count(pos) + CAST(any_value(cc) > 0 AS INT)), 2) END AS extraction_confidence
  FROM toned LEFT JOIN mentions USING (article_no) GROUP BY ALL""", "toned", "mentions")
step("ledger", "SELECT left(sha256(url), 16) AS article_id, url FROM news_ledger", "news_ledger")


def _context(reports, traffic, weather):
    return f"""SELECT coalesce(r.district, t.district, w.district) AS district, * EXCLUDE (district) FROM
   (SELECT district, count(*) AS damage_report_count, avg(severity_score) AS avg_severity, CAST(max(severity_score) AS DOUBLE) AS max_severity
    FROM {reports} WHERE district IS NOT NULL GROUP BY district) r FULL JOIN
   (SELECT district, {_mean('average_speed_kmh')} AS avg_speed, avg(vehicle_count) AS avg_vehicle_count, count(congestion_level) AS traffic_event_count
    FROM {traffic} WHERE district IS NOT NULL GROUP BY district) t ON r.district = t.district FULL JOIN
   (SELECT a.*, condition AS weather_condition FROM
     (SELECT district, {_mean('rainfall_mm')} AS rainfall_mm, {_mean('temperature_c')} AS temperature_c, {_mean('humidity')} AS humidity
      FROM {weather} WHERE district IS NOT NULL GROUP BY district) a
     JOIN (SELECT district, condition, row_number() OVER (PARTITION BY district ORDER BY event_time DESC, event_id DESC) AS rn FROM {weather}) b
     ON a.district = b.district AND rn = 1) w ON coalesce(r.district, t.district) = w.district"""


def _enriched_accidents(source, district="district"):
    return f"""SELECT accident_id, a.district, road_name, event_time, severity AS accident_severity, vehicle_count AS vehicles_involved, casualties,
  coalesce(damage_report_count, 0) AS damage_report_count, coalesce(avg_severity, 0e0) AS avg_severity, coalesce(max_severity, 0e0) AS max_severity,
  coalesce(avg_speed, 30e0) AS avg_speed, coalesce(avg_vehicle_count, 0e0) AS avg_vehicle_count, coalesce(traffic_event_count, 0) AS traffic_event_count,
  coalesce(rainfall_mm, 0e0) AS rainfall_mm, coalesce(temperature_c, 25e0) AS temperature_c, coalesce(humidity, 0.5e0) AS humidity,
  coalesce(weather_condition, 'Clear') AS weather_condition
  FROM (SELECT * REPLACE ({district} AS district) FROM {source}) a LEFT JOIN ctx c ON a.district = c.district"""


step("e_ctx", _context("e_reports", "e_traffic", "e_weather"), "e_reports", "e_traffic", "e_weather")
step("b_ctx", _context("reports", "traffic", "weather"), "reports", "traffic", "weather")
step("accident_rows", _enriched_accidents("e_accidents").replace("ctx c", "e_ctx c"), "e_accidents", "e_ctx")

_DAY = "CAST({} AS VARCHAR)"
_DATE_PARTS = "CAST(year(event_time) AS INT) AS year, CAST(month(event_time) AS INT) AS month, CAST(day(event_time) AS INT) AS day"
_REPORTS_OUT = "SELECT * FROM reports"
_ISO = "strftime(event_time, '%Y-%m-%d')"

_SUMMARY = """SELECT road_name, district, count(*) AS news_count, count(*) FILTER (sentiment = 'negative') AS negative_count,
        count(*) FILTER (sentiment = 'positive') AS positive_count, CAST(coalesce(sum(complaint_count), 0) AS BIGINT) AS total_complaints,
        max(event_time) AS latest_news, avg(CASE severity_level WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END) AS avg_severity_score,
        mode(damage_type ORDER BY damage_type) AS dominant_damage_type FROM {} WHERE road_name IS NOT NULL GROUP BY road_name, district"""

# equal times: the larger values of the cleaned columns win, from left to right, NULL last
_REDELIVERED = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_time DESC NULLS LAST, city DESC NULLS LAST,
  district DESC NULLS LAST, rainfall_mm DESC NULLS LAST, temperature_c DESC NULLS LAST, humidity DESC NULLS LAST, condition DESC NULLS LAST) AS rn
  FROM (SELECT event_id, event_time, {_initcap('city')} AS city, {_initcap('district')} AS district, rainfall_mm, temperature_c, humidity,
    trim(condition) AS condition FROM weather_redelivered WHERE event_id IS NOT NULL)) WHERE rn = 1"""

# query: (statement, steps it reads)
ORACLES = {
    "envelope_roundtrip": ("SELECT * FROM reports_raw", "reports_raw"),
    "bronze_reports": (
        f"""SELECT *, {_DATE_PARTS} FROM (SELECT event_id,
        CASE WHEN damage_type IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE event_time END AS event_time,
        '{rules.REPORT_DEFAULTS['description']}' AS description, '' AS image_path, status FROM reports_raw)""", "reports_raw"),
    "route_weather": (
        """SELECT 'weather' AS kind, event_id AS key, rainfall_mm AS mm FROM weather_raw
        UNION ALL SELECT 'rain', CAST(date AS VARCHAR), precipitation_sum FROM rain_daily""", "weather_raw", "rain_daily"),
    "message_keys": (
        """SELECT feed, key, count(*) AS messages FROM (
        SELECT 'reports' AS feed, report_id AS key FROM reports_raw UNION ALL SELECT 'weather', district FROM weather_raw
        UNION ALL SELECT 'traffic', road_name FROM traffic_raw UNION ALL SELECT 'news', event_id FROM news_raw
        UNION ALL SELECT 'accidents', accident_id FROM accidents_raw) GROUP BY ALL""",
        "reports_raw", "weather_raw", "traffic_raw", "news_raw", "accidents_raw"),
    "partition_columns": (
        f"SELECT event_id, {_DATE_PARTS}, {_ISO} AS date_partition, lower(replace(district, ' ', '_')) AS district_partition FROM reports_raw",
        "reports_raw"),
    "region_partitions": (
        f"""SELECT event_id, {_DATE_PARTS}, 'ID' AS country, 'JawaTimur' AS province, 'Surabaya' AS city,
        strftime(event_time, 'year=%Y/month=%m/day=%d')||'/country=ID/province=JawaTimur/city=Surabaya' AS folder FROM traffic_raw""", "traffic_raw"),
    "partitioned_table": (
        "SELECT event_id, coalesce(congestion_level, 'none') AS congestion, vehicle_count, 2024 AS year, 2 AS month, 1 AS day FROM traffic_raw",
        "traffic_raw"),
    "silver_reports": (_REPORTS_OUT, "reports"),
    "silver_weather": ("SELECT * FROM weather", "weather"),
    "silver_traffic": ("SELECT * FROM traffic", "traffic"),
    "silver_news": ("SELECT * FROM news", "news"),
    "silver_accidents": ("SELECT * FROM accidents", "accidents"),
    "silver_incremental": (_REPORTS_OUT, "reports"),
    "silver_redelivered": (_REDELIVERED, "weather_redelivered"),
    "silver_redelivered_refresh": (_REDELIVERED, "weather_redelivered"),
    "enriched_reports": ("SELECT * FROM e_reports", "e_reports"),
    "enriched_weather": (_settled("e_weather", "temperature_c"), "e_weather"),
    "enriched_traffic": ("SELECT * FROM e_traffic", "e_traffic"),
    "enriched_news": ("SELECT * FROM e_news", "e_news"),
    "enriched_accidents": ("SELECT * FROM e_accidents", "e_accidents"),
    "impute_strategy": (_filled("reports_raw", "event_id, coalesce(severity_score, 0) AS severity_score, coalesce(confidence, 0e0) AS confidence", False),
                        "reports_raw"),
    "impute_weather": (
        f"""SELECT event_id, coalesce(rainfall_mm, 0e0) AS rainfall_mm, coalesce(humidity, 0.5e0) AS humidity,
        round(coalesce(temperature_c, (SELECT {_mean('temperature_c')} FROM weather_raw)), 10) AS temperature_c FROM weather_raw""", "weather_raw"),
    "std_district": (f"SELECT event_id, {_std_district('district')} AS district FROM reports_raw", "reports_raw"),
    "std_damage": (f"SELECT event_id, {_std_damage('damage_type')} AS damage_type FROM reports_raw", "reports_raw"),
    "std_severity": (
        """SELECT event_id, severity_score, CASE WHEN severity_score IS NULL THEN 'Unknown' WHEN severity_score <= 25 THEN 'Low'
        WHEN severity_score <= 50 THEN 'Medium' WHEN severity_score <= 75 THEN 'High' ELSE 'Critical' END AS level FROM reports_raw""", "reports_raw"),
    "std_severity_text": (f"SELECT event_id, {_std_severity_text('severity')} AS level FROM accidents_raw", "accidents_raw"),
    "std_weather": (f"SELECT event_id, {_std_named('condition', rules.WEATHER_CONDITIONS)} AS condition FROM weather_raw", "weather_raw"),
    "std_congestion": (f"SELECT event_id, {_std_named('congestion_level', rules.CONGESTION_LEVELS)} AS level FROM traffic_raw", "traffic_raw"),
    "geocode_fill": (_filled(f"(SELECT * REPLACE ({_std_district('district')} AS district) FROM reports_raw)", "event_id, district", True), "reports_raw"),
    "geocode_pair": (
        f"""SELECT event_id, district, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN latitude ELSE coalesce(clat, {_LAT0}) END AS latitude,
        CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN longitude ELSE coalesce(clon, {_LON0}) END AS longitude
        FROM (SELECT * REPLACE ({_std_district('district')} AS district) FROM accidents_raw) LEFT JOIN {_CENTROIDS} ON lower(trim(district)) = place""",
        "accidents_raw"),
    "bounds_check": (
        """SELECT event_id, coalesce(latitude BETWEEN -7.5 AND -7.0 AND longitude BETWEEN 112.5 AND 113.0, FALSE) AS in_city,
        coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, FALSE) AS on_earth FROM reports_raw""", "reports_raw"),
    "map_ready": ("SELECT event_id, latitude, longitude FROM reports_raw WHERE latitude <> 0 AND longitude <> 0", "reports_raw"),
    "refresh_reports": (_REPORTS_OUT, "reports"),
    "refresh_weather": ("SELECT * FROM weather", "weather"),
    "refresh_traffic": ("SELECT * FROM traffic", "traffic"),
    "refresh_news": ("SELECT * FROM news", "news"),
    "rebuilt_from_fewer": ("SELECT * FROM traffic WHERE vehicle_count > 2000", "traffic"),
    "refresh_accidents": ("SELECT * FROM accidents", "accidents"),
    "run_log_of_batch": (
        " UNION ALL ".join(
            f"SELECT '{layer}_{f}' AS job_name, '{layer}' AS layer, 'success' AS status, count(*) AS record_processed FROM {mark}{f}"
            for layer, mark in (("silver", ""), ("enriched", "e_")) for f in ("reports", "weather", "traffic", "news", "accidents"))
        + " UNION ALL SELECT 'silver_rain', 'silver', 'success', count(*) FROM rolled",
        "reports", "weather", "traffic", "news", "accidents", "e_reports", "e_weather", "e_traffic", "e_news", "e_accidents", "rolled"),
    "run_news_summary": (_SUMMARY.format("news"), "news"),
    "run_rain": ("SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM rolled", "rolled"),
    "run_accident_features": (_settled("accident_rows", *_FEATURE_MEANS), "accident_rows"),
    "sql_functions": (f"SELECT event_id, {_std_district('district')} AS district, {_std_damage('damage_type')} AS damage_type FROM reports_raw", "reports_raw"),
    "district_reports": (
        "SELECT p.district, p.latitude, coalesce(n, 0) AS reports FROM (VALUES "
        + ", ".join(f"({_q(n)}, CAST({lat} AS DOUBLE))" for n, (lat, _) in rules.DISTRICT_CENTROIDS.items())
        + f") p(district, latitude) LEFT JOIN (SELECT {_std_district('district')} AS district, count(*) AS n FROM reports_raw GROUP BY 1) c ON p.district = c.district",
        "reports_raw"),
    "stored_messages": ("SELECT event_id, road_name, vehicle_count FROM traffic_raw", "traffic_raw"),
    "scores_without_weather": (
        """SELECT s.road_name, s.district, 0e0 AS rainfall, round(100e0 - severity*0.4e0 - coalesce(traffic, 0e0)*0.2e0, 10) AS road_health_index
        FROM road_severity s LEFT JOIN road_traffic t ON s.road_name = t.road_name AND s.district = t.district""", "road_severity", "road_traffic"),
    "sure_mentions": (
        """SELECT left(sha256(url), 16) AS event_id, nullif(road_name, 'UNKNOWN') AS road_name, coalesce(confidence, 0e0) AS road_confidence
        FROM articles x JOIN art USING (article_no) LEFT JOIN mentions m USING (article_no) WHERE confidence >= 0.5 OR x.mentions = 0""",
        "articles", "art", "mentions"),
    "snake_case_lineitem": (
        "SELECT lineOrderKey AS line_order_key, LineNumber AS line_number, quantityABCTotal AS quantity_abc_total FROM camel_lines", "camel_lines"),
    "saved_model": ("SELECT district, count(*) AS accidents, 0 AS differ FROM accident_rows GROUP BY district", "accident_rows"),
    "road_severity": ("SELECT * FROM road_severity", "road_severity"),
    "district_rainfall": (_settled("district_rainfall", "rainfall"), "district_rainfall"),
    "road_traffic": ("SELECT * FROM road_traffic", "road_traffic"),
    "road_accidents": ("SELECT * FROM road_accidents", "road_accidents"),
    "district_news": (_settled("district_news", "sentiment"), "district_news"),
    "road_health_index": (_settled("rhi", "rainfall", "road_health_index"), "rhi"),
    "complaint_score": ("SELECT * FROM complaints", "complaints"),
    "priority_score": (
        """SELECT *, severity_score*0.30e0 + traffic_score*0.25e0 + accident_score*0.20e0 + complaint_score*0.15e0 + news_score*0.10e0 AS priority_score FROM (
        SELECT r.report_id, r.road_name, r.district, r.damage_type, r.severity_score, coalesce(traffic, 0e0) AS traffic_score,
          coalesce(accident_count*10e0, 0e0) AS accident_score, coalesce(complaint_score, 0e0) AS complaint_score, coalesce(news_count*10e0, 0e0) AS news_score
        FROM reports r LEFT JOIN complaints c ON r.road_name = c.road_name
        LEFT JOIN road_traffic t ON r.road_name = t.road_name AND r.district = t.district
        LEFT JOIN road_accidents a ON r.road_name = a.road_name AND r.district = a.district
        LEFT JOIN district_news n ON r.district = n.district)""",
        "reports", "complaints", "road_traffic", "road_accidents", "district_news"),
    "damage_risk": (
        """SELECT report_id, road_name, district, severity_score, CASE WHEN severity_score > 80 THEN 'High Risk' WHEN severity_score >= 50 THEN 'Medium Risk'
        ELSE 'Low Risk' END AS predicted_risk_level FROM reports""", "reports"),
    "accident_prediction": (
        """SELECT road_name, district, round(p, 10) AS predicted_accident_probability, CASE WHEN p < 0.3 THEN 'LOW' WHEN p < 0.6 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level FROM (
        SELECT road_name, district, CASE WHEN raw > 1 THEN 1e0 ELSE raw END AS p FROM (
        SELECT *, 0.05e0 + rainfall*0.01e0 + traffic*0.0001e0 + (100e0 - road_health_index)*0.005e0 AS raw FROM rhi))""", "rhi"),
    "hotspots": (
        """SELECT road_name AS road_id, road_name, report_count, avg_severity, report_count*5e0 + avg_severity*0.5e0 AS hotspot_score FROM (
        SELECT road_name, count(*) AS report_count, avg(severity_score) AS avg_severity FROM reports GROUP BY road_name)""", "reports"),
    "district_health": (_health("reports_raw"), "reports_raw"),
    "simple_priority": ("SELECT * FROM simple", "simple"),
    "damage_records": ("SELECT report_id, road_name, district, damage_type, severity_score, confidence, status, event_time FROM reports_raw", "reports_raw"),
    "detections_classified": ("SELECT * FROM classified", "classified"),
    "best_detection": (
        """SELECT p.report_id, coalesce(damage_type, 'Unknown') AS damage_type, coalesce(confidence, 0e0) AS confidence, coalesce(severity_score, 0) AS severity_score
        FROM photo_reports p LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY confidence DESC, image_no, box_no) AS rn FROM classified) b
        ON p.report_id = b.report_id AND rn = 1""", "photo_reports", "classified"),
    "publishable": (
        "SELECT road_name, district, round(road_health_index, 10) AS road_health_index, road_name IS NOT NULL AND district IS NOT NULL AND severity IS NOT NULL AS accepted FROM rhi", "rhi"),
    "numbered_runs": (
        """SELECT event_id, printf('R%03d', row_number() OVER (ORDER BY event_time IS NULL OR event_time >= TIMESTAMP '1995-01-01', event_time NULLS FIRST, event_id)) AS report_id
        FROM reports""", "reports"),
    "sequential_ids": ("SELECT event_id, printf('R%03d', row_number() OVER (ORDER BY event_time, event_id)) AS report_id FROM reports", "reports"),
    "stats": (
        """SELECT count(*) AS total_reports, count(*) FILTER (CAST(event_time AS DATE) = DATE '1996-03-13') AS today_reports,
        (SELECT district FROM reports_raw GROUP BY district ORDER BY count(*) DESC, district LIMIT 1) AS top_district,
        count(*) FILTER (damage_type <> 'Unknown') AS total_detected_damage, round(coalesce(avg(severity_score), 0), 2) AS average_severity_score,
        count(*) FILTER (damage_type = 'D40_Pothole') AS pothole_count,
        count(*) FILTER (damage_type IN ('D00_Longitudinal_Crack', 'D10_Transverse_Crack', 'D20_Alligator_Crack')) AS crack_count FROM reports_raw""",
        "reports_raw"),
    "dashboard_counters": (
        """SELECT count(*) FILTER (severity_score >= 80) AS high_severity, count(*) FILTER (damage_type <> 'Unknown') AS detected,
        CAST(floor(avg(coalesce(severity_score, 0)) + 0.5) AS BIGINT) AS avg_severity, count(*) FILTER (damage_type = 'D40_Pothole') AS potholes,
        count(*) FILTER (contains(damage_type, 'Crack')) AS cracks FROM reports_raw""", "reports_raw"),
    "top_districts": ("SELECT district, count(*) AS report_count FROM reports_raw GROUP BY district ORDER BY report_count DESC, district NULLS LAST LIMIT 5",
                      "reports_raw"),
    "status_counts": (
        """SELECT CAST(position AS INT) AS position, s.status, coalesce(n, 0) AS report_count FROM
        (VALUES (0, 'Pending'), (1, 'Verified'), (2, 'In Progress'), (3, 'Resolved')) s(position, status)
        LEFT JOIN (SELECT status, count(*) AS n FROM reports_raw GROUP BY status) c ON s.status = c.status ORDER BY position""", "reports_raw"),
    "recent_reports": ("SELECT report_id, event_time, road_name, status FROM reports ORDER BY event_time DESC, report_id", "reports"),
    "latest_rhi": (
        """SELECT h.road_name, district, road_health_index, CAST(batch_date AS VARCHAR) AS batch_time FROM rhi_history h JOIN
        (SELECT road_name, max(batch_date) AS newest FROM rhi_history GROUP BY road_name) m ON h.road_name = m.road_name AND batch_date = newest""", "rhi_history"),
    "top_priority": (
        """SELECT report_id, road_name, district, round(severity_score*0.75e0 + confidence*100*0.25e0, 2) AS priority_score FROM reports
        ORDER BY priority_score DESC NULLS LAST, report_id LIMIT 10""", "reports"),
    "confidence_labels": (
        "SELECT event_id, coalesce(CAST(CAST(floor(confidence*100 + 0.5) AS BIGINT) AS VARCHAR)||'%', '-') AS label FROM reports_raw", "reports_raw"),
    "image_lists": (
        """SELECT report_no, array_to_string(u, ',') AS image_path, CASE WHEN u[1] LIKE 'http%' THEN u[1] ELSE 'http://api.example'||u[1] END AS first_image FROM (
        SELECT report_no, CASE WHEN kind = 'F' THEN ['http://img.example/x.jpg', p] ELSE [p, 'http://img.example/x.jpg'] END AS u FROM (
        SELECT *, '/uploads/R'||report_no||'_'||kind AS p FROM photos))""", "photos"),
    "unpack_daily": ("SELECT CAST(date AS VARCHAR) AS date, precipitation_sum, precipitation_sum AS rain_sum FROM rain_daily", "rain_daily"),
    "rolling_rain": ("SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM rolled", "rolled"),
    "rain_upsert": ("SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM merged", "merged"),
    "rain_upsert_counts": ("SELECT count(*) FILTER (action = 'saved') AS saved, count(*) FILTER (action = 'updated') AS updated FROM merged", "merged"),
    "latest_rain": ("SELECT CAST(date AS VARCHAR) AS date, precipitation_sum FROM rain_daily WHERE date = (SELECT max(date) FROM rain_daily)", "rain_daily"),
    "news_extract": ("SELECT article_no, mentions, complaint_count, sentiment, sentiment_score, extraction_confidence FROM articles", "articles"),
    "news_primary_road": (
        """SELECT a.article_no, road_name, damage_type, confidence FROM art a LEFT JOIN
        (SELECT *, row_number() OVER (PARTITION BY article_no ORDER BY confidence DESC, pos) AS rn FROM mentions) m
        ON a.article_no = m.article_no AND rn = 1""", "art", "mentions"),
    "news_messages": (
        """SELECT left(sha256(url), 16) AS event_id, TIMESTAMP '2024-02-01 00:00:00' AS event_time, 'Surabaya' AS city, district, sentiment_score,
        x.source, complaint_count, sentiment, extraction_confidence, nullif(road_name, 'UNKNOWN') AS road_name, damage_type, severity_level,
        severity_score, damage_type AS keyword, coalesce(confidence, 0e0) AS road_confidence
        FROM articles x JOIN art USING (article_no) LEFT JOIN mentions m USING (article_no)""", "articles", "art", "mentions"),
    "news_unseen": (
        """SELECT article_no, article_id, title, length(content) AS length FROM (SELECT *, left(sha256(url), 16) AS article_id,
        row_number() OVER (PARTITION BY url ORDER BY article_no) AS rn FROM news_articles) WHERE rn = 1
        AND article_id NOT IN (SELECT article_id FROM ledger)""", "news_articles", "ledger"),
    "news_mark_seen": ("SELECT * FROM ledger UNION SELECT left(sha256(url), 16), url FROM news_articles", "ledger", "news_articles"),
    "articles_mentions": (
        """SELECT left(sha256(url), 16) AS event_id, TIMESTAMP '2024-02-01 00:00:00' AS event_time, 'Surabaya' AS city, district, sentiment_score,
        x.source, complaint_count, sentiment, extraction_confidence, nullif(road_name, 'UNKNOWN') AS road_name, damage_type, severity_level,
        severity_score, damage_type AS keyword, coalesce(confidence, 0e0) AS road_confidence
        FROM articles x JOIN art USING (article_no) LEFT JOIN mentions m USING (article_no) WHERE article_no IN (
          SELECT min(article_no) FROM news_articles WHERE left(sha256(url), 16) NOT IN (SELECT article_id FROM ledger) GROUP BY url)""",
        "articles", "art", "mentions", "news_articles", "ledger"),
    "articles_ledger": ("SELECT * FROM ledger UNION SELECT left(sha256(url), 16), url FROM news_articles", "ledger", "news_articles"),
    "news_topn": ("SELECT search, place FROM (SELECT *, row_number() OVER (PARTITION BY search ORDER BY place) AS rn FROM feed_entries) WHERE rn <= 15",
                  "feed_entries"),
    "news_summary": (_SUMMARY.format("news_raw"), "news_raw"),
    "feed_dates": ("SELECT entry_no, CASE WHEN kind IS NOT NULL AND kind <> 'not a date' THEN published END AS published_at FROM feed_dates", "feed_dates"),
    "quarantine_reports": (
        f"SELECT event_id, violations = '' AS accepted, violations FROM (SELECT event_id, {_violations('reports')} AS violations FROM reports_raw)", "reports_raw"),
    "rules_of_damage": (
        """SELECT CASE lower(trim(damage_type)) WHEN 'd00_longitudinal_crack' THEN 'Longitudinal Crack' WHEN 'd10_transverse_crack' THEN 'Transverse Crack'
        WHEN 'd20_alligator_crack' THEN 'Alligator Crack' WHEN 'd40_pothole' THEN 'Pothole' WHEN 'd50_other_damage' THEN 'Other Damage' END AS damage_type,
        count(*) AS n FROM reports_raw GROUP BY ALL HAVING damage_type IS NOT NULL""", "reports_raw"),
    "reports_in_bounds": (
        """SELECT event_id, -7.2575e0 AS center_lat, 112.7521e0 AS center_lon FROM reports_raw
        WHERE latitude BETWEEN -7.5 AND -7.0 AND longitude BETWEEN 112.5 AND 113.0""", "reports_raw"),
    "range_violations": (
        " UNION ALL ".join(f"SELECT '{f}' AS feed, event_id, {_violations(f)} AS violations FROM {f}_raw" for f in _RANGES),
        "reports_raw", "weather_raw", "traffic_raw"),
    "quality_metrics": (
        " UNION ALL ".join([
            _metrics("reports", ["report_id"], ["event_time", "event_id"]), _metrics("weather", ["event_id"], ["event_time"]),
            _metrics("traffic", ["event_id"], ["event_time"]), _metrics("news", ["event_id", "road_name"], ["event_time", "title"]),
            _metrics("accidents", ["event_id"], ["event_time"])]),
        "reports_raw", "weather_raw", "traffic_raw", "news_raw", "accidents_raw"),
    "run_log": ("SELECT 'clean_traffic' AS job_name, 'silver' AS layer, 'success' AS status, count(*) AS record_processed FROM traffic", "traffic"),
    "accident_features": (_settled("accident_rows", *_FEATURE_MEANS), "accident_rows"),
    "ml_split": (
        """SELECT district, count(*) FILTER (place < 800) AS training_rows, count(*) FILTER (place >= 800) AS test_rows FROM (
        SELECT district, CAST('0x' || left(md5('42:' || accident_id), 8) AS BIGINT) % 1000 AS place FROM accident_rows) GROUP BY district""", "accident_rows"),
    "ml_medians": (
        "SELECT " + ", ".join(f"round(CAST(quantile_disc(CAST({c} AS FLOAT), 0.5) AS DOUBLE), 3) AS {c}" for c in (
            "damage_report_count", "avg_severity", "max_severity", "avg_speed", "traffic_event_count", "rainfall_mm", "temperature_c", "humidity"))
        + " FROM accident_rows WHERE CAST('0x' || left(md5('42:' || accident_id), 8) AS BIGINT) % 1000 < 800", "accident_rows"),
    "training_rows": (
        """SELECT accident_id, event_time, CAST(damage_report_count AS FLOAT) AS damage_report_count, CAST(max_severity AS FLOAT) AS max_severity,
        CAST(traffic_event_count AS FLOAT) AS traffic_event_count, CASE WHEN accident_severity IN ('High', 'Critical') THEN 1e0 ELSE 0e0 END AS label
        FROM accident_rows""", "accident_rows"),
    "stream_bronze": (
        f"""SELECT event_id, date_trunc('second', event_time) AS event_time, rainfall_mm, condition, 'kafka_weather' AS source, {_ISO} AS date_partition,
        lower(replace(district, ' ', '_')) AS district_partition FROM weather_raw""", "weather_raw"),
    "stream_feeds": (
        " UNION ALL ".join(f"SELECT '{f}' AS feed, count(*) AS n FROM {t}" for f, t in (
            *((f, f"{f}_raw") for f in ("reports", "weather", "traffic", "news", "accidents")), ("rain", "rain_lines"))),
        "reports_raw", "weather_raw", "traffic_raw", "news_raw", "accidents_raw", "rain_lines"),
    "stream_dedup_odd_times": ("SELECT DISTINCT event_id, vehicle_count FROM traffic_raw", "traffic_raw"),
    "stream_read": ("SELECT event_id, road_name, vehicle_count FROM traffic_raw", "traffic_raw"),
    "stream_silver": ("SELECT * FROM traffic", "traffic"),
    "stream_counts": (
        """SELECT 'traffic' AS feed, 2 * count(*) AS messages, (SELECT count(*) FROM traffic) AS stored,
        2 * count(*) - (SELECT count(*) FROM traffic) AS copies, 2 * count(*) AS late FROM traffic_raw""", "traffic", "traffic_raw"),
    "stream_dead_letter": ("SELECT event_id, condition IS NULL AS dead FROM weather_raw", "weather_raw"),
    "stream_dedup": ("SELECT DISTINCT event_id, road_name, vehicle_count FROM traffic_raw", "traffic_raw"),
    "stream_simple_priority": ("SELECT * FROM simple", "simple"),
    "stream_damage_records": ("SELECT report_id, road_name, district, damage_type, severity_score, confidence, status, event_time FROM reports_raw", "reports_raw"),
    "stream_district_health": (_health("reports_raw"), "reports_raw"),
    "stream_accident_enrich": (_settled("(" + _enriched_accidents("accidents_raw", _initcap("district")).replace("ctx c", "b_ctx c") + ")", *_FEATURE_MEANS), "accidents_raw", "b_ctx"),
}


ORACLES["run_priority_score"] = ORACLES["priority_score"]
for _scores in ("road_health_index", "priority_score", "hotspots", "accident_prediction", "damage_risk"):
    ORACLES[f"refresh_{_scores}"] = ORACLES[_scores]
ORACLES["run_quality"] = ORACLES["quality_metrics"]


def _ordered(names, seen):
    for name in names:
        if name in seen:
            continue
        _ordered(STEPS[name][1], seen)
        seen.append(name)
    return seen


def statements() -> dict[str, str]:
    result = {}
    for query, (body, *needs) in ORACLES.items():
        steps = [f"{name} AS ({re.sub(r'[{](\w+)[}]', r'\1', STEPS[name][0])})" for name in _ordered(needs, [])]
        result[query] = f"WITH {', '.join(steps)} {body}"
    return result
