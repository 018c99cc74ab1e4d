from datetime import date

from roadlake import schemas
from roadlake.operators import rainfall
from tests.conftest import values


def day(n):
    return date(2024, 1, n)


def test_unpack_pads_short_arrays(spark):
    days = ["2024-01-01", None, "2024-01-02"]
    payload = spark.createDataFrame([(days, [1.0, 2.0, 3.0], [0.5], None)], schemas.RAIN_PAYLOAD)
    assert values(rainfall.unpack_daily(payload)) == [(day(1), 1.0, 0.5, None), (day(2), 3.0, None, None)]
    assert values(rainfall.unpack_daily(spark.createDataFrame([(None, [1.0], [], [])], schemas.RAIN_PAYLOAD))) == []


def test_rolling_counts_calendar_days(frame):
    df = frame("date date, precipitation_sum double", (day(1), 1.0), (day(7), 2.0), (day(8), None), (day(14), 4.25))
    rows = rainfall.rolling(df).orderBy("date")
    assert values(rows, "rainfall_7d", "rainfall_30d") == [(1.0, 1.0), (3.0, 3.0), (2.0, 3.0), (4.25, 7.25)]


def test_rolling_by_station_takes_the_last_copy(frame):
    df = frame("station string, date date, precipitation_sum double, seq int",
               ("a", day(1), 1.0, 1), ("a", day(1), 5.0, 2), ("a", day(2), 1.0, 3), ("b", day(2), 9.0, 1))
    rows = rainfall.rolling(df, station="station", recency="seq").orderBy("station", "date")
    assert values(rows, "rainfall_7d") == [(5.0,), (6.0,), (9.0,)]


def test_upsert(frame):
    schema = "date date, precipitation_sum double, rain_sum double, rainfall_7d double, rainfall_30d double, rainfall_90d double"
    old = frame(schema, (day(1), 1.0, 1.0, 1.0, 1.0, 1.0), (day(2), 2.0, 2.0, 2.0, 2.0, 2.0))
    new = frame(schema, (day(2), 9.0, 9.0, 9.0, 9.0, None), (day(3), 3.0, 3.0, 3.0, 3.0, 3.0))
    merged = rainfall.upsert(old, new)
    assert values(merged.orderBy("date"), "precipitation_sum", "rain_sum", "rainfall_7d", "rainfall_90d", "action") == [
        (1.0, 1.0, 1.0, 1.0, "kept"), (2.0, 2.0, 9.0, None, "updated"), (3.0, 3.0, 3.0, 3.0, "saved"),
    ]
    assert values(rainfall.upsert_counts(merged)) == [(1, 1)]
    assert values(rainfall.latest(merged), "date") == [(day(3),)]
