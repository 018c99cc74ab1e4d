"""Clean tables from raw tables: validity first, then one row per key, then names, types and gaps."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake import rules, schemas
from roadlake.functions import geo, standardize
from roadlake.operators import clean, quality
from roadlake.session import materialize

BATCH_KEYS = {
    "reports": ["report_id"],
    "weather": ["event_id"],
    "traffic": ["event_id"],
    # all roads of an article share its event_id, so news needs the road in the key; an article may name none
    "news": ["event_id", "road_name"],
    "accidents": ["event_id"],
}
# keys that may be NULL: an unknown road is one more road of its article
OPTIONAL = {"news": ["road_name"]}
ENRICHED_KEYS = {
    "reports": ["report_id", "event_time"],
    "weather": ["event_id", "event_time"],
    "traffic": ["event_id", "event_time"],
    "news": ["event_id", "road_name"],
    "accidents": ["accident_id", "event_time"],
}
# keys that come again and again by nature: the states of a report, the deliveries of an article; copies of other keys are rare
RECURRING = {"reports": "report_id", "news": "event_id"}
# order of the copies of a key; the news order is total because titles differ between copies
ORDER = {"news": ("event_time", "event_id", "title")}

_NAMES = ("road_name", "district", "village", "city")
_TRIMMED = ("status", "condition", "congestion_level", "source")


def _latest(feed: str, keys):
    """How copies are found. A time in the key tells the states of an event apart."""
    return clean.latest_per_key if RECURRING.get(feed) in keys and "event_time" not in keys else clean.latest_of_repeated


def clean_batch(feed: str, raw: DataFrame, used=None) -> DataFrame:
    """Drop rows without a key or, for reports, without a place on earth; keep the newest row per key, or its columns ``used``."""
    if feed == "reports":
        raw = raw.filter(geo.inside("latitude", "longitude", rules.WORLD_BOX))
    names = {c: standardize.clean_name(c) for c in _NAMES if c in raw.columns}
    trimmed = {c: F.trim(c) for c in _TRIMMED if c in raw.columns}
    rows = schemas.conform(raw.withColumns({**names, **trimmed}), schemas.EVENT[feed])
    return newest(feed, rows, _latest(feed, BATCH_KEYS[feed]), used)


def newest(feed: str, rows: DataFrame, latest=clean.latest_per_key, used=None) -> DataFrame:
    """One row per key of a feed, from clean rows."""
    needed = [k for k in BATCH_KEYS[feed] if k not in OPTIONAL.get(feed, ())]
    return latest(clean.with_keys(rows, needed), BATCH_KEYS[feed], ORDER.get(feed, clean.LATEST), True, used)


def refresh_batch(feed: str, clean_rows: DataFrame, new_raw: DataFrame) -> DataFrame:
    """Merge new raw rows into a clean table; equals cleaning everything from the start."""
    return newest(feed, clean_rows.unionByName(clean_batch(feed, new_raw)))


def clean_enriched(feed: str, raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per key and time with standard categories, filled gaps and, for places, coordinates."""
    now = F.current_timestamp() if as_of is None else as_of
    keys = ENRICHED_KEYS[feed]
    # an unknown time or road is one more key of its event, not a missing key
    rows = _latest(feed, keys)(raw, keys, ORDER.get(feed, clean.LATEST), null_keys=True)
    rows = rows.withColumn("district", standardize.district("district"))
    if feed == "reports":
        rows = rows.withColumns(
            {
                "data_quality_score": quality.row_score(rules.RANGE_RULES["reports"]),
                "damage_type": standardize.damage_type("damage_type"),
            }
        )
        rows = geo.fill_coordinates(rows, zero_is_missing=True)
    elif feed == "weather":
        # stored once: the rows and the mean temperature that fills them both read it
        rows = materialize(rows, "weather").withColumn("condition", standardize.weather_condition("condition"))
    elif feed == "traffic":
        rows = rows.withColumn("congestion_level", standardize.congestion_level("congestion_level"))
    elif feed == "accidents":
        rows = rows.withColumn("severity", standardize.severity_text("severity"))
        rows = geo.fill_coordinates(rows, zero_is_missing=False)
    return clean.fill_gaps(rows, feed).withColumn("processed_timestamp", now)
