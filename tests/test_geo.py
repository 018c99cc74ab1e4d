from roadlake import rules
from roadlake.functions import geo
from tests.conftest import plan, values

SCHEMA = "id int, district string, latitude double, longitude double"


def test_bounds(frame):
    df = frame(
        SCHEMA, (1, "", -7.5, 112.5), (2, "", -7.0, 113.0), (3, "", -7.51, 112.6), (4, "", None, 112.6), (5, "", 90.0, -180.0),
        (6, "", 90.01, 0.0),
    )
    city = geo.in_box("latitude", "longitude").alias("c")
    earth = geo.in_box("latitude", "longitude", rules.WORLD_BOX).alias("e")
    assert values(df.orderBy("id").select(city, earth)) == [
        (True, True), (True, True), (False, True), (False, False), (False, True), (False, False),
    ]


def test_on_map(frame):
    df = frame(SCHEMA, (1, "", -7.3, 112.7), (2, "", 0.0, 112.7), (3, "", -7.3, None))
    assert values(df.filter(geo.on_map()), "id") == [(1,)]


def test_fill_coordinates(frame):
    df = frame(SCHEMA, (1, "Rungkut", None, None), (2, "rungkut ", 0.0, 112.7), (3, "Rungkut", -7.3, 0.0), (4, "Mars", None, 112.0),
               (5, None, None, None))
    reports = geo.fill_coordinates(df, zero_is_missing=True).orderBy("id")
    assert values(reports, "latitude", "longitude") == [
        (-7.3, 112.8), (-7.3, 112.7), (-7.3, 112.8), (-7.2575, 112.0), rules.CITY_CENTER,
    ]
    accidents = geo.fill_coordinates(df, zero_is_missing=False).orderBy("id")
    assert values(accidents, "latitude", "longitude")[1:3] == [(0.0, 112.7), (-7.3, 0.0)]


def test_geocode_needs_a_pair(frame):
    df = frame(SCHEMA, (1, "Rungkut", -7.1, 112.1), (2, "Rungkut", -7.1, None), (3, "Mars", None, 112.1))
    assert values(geo.geocode(df).orderBy("id"), "latitude", "longitude") == [
        (-7.1, 112.1), (-7.3, 112.8), rules.CITY_CENTER,
    ]


def test_dimension_is_broadcast(frame, spark):
    assert "BroadcastHashJoin" in plan(geo.with_centroid(frame(SCHEMA, (1, "Rungkut", None, None))))
    assert geo.districts_table(spark).count() == 26
    assert geo.bounds_table(spark).count() == 1
