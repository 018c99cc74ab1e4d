import pytest

from roadlake import rules, schemas
from roadlake.functions import sql, standardize
from tests.conftest import plan, values


def apply(frame, function, inputs, dtype="string"):
    df = frame(f"n int, x {dtype}", *enumerate(inputs)).orderBy("n")
    return [v for (v,) in values(df.select("n", function("x").alias("y")).orderBy("n"), "y")]


def test_district(frame):
    inputs = [" Wonocolo ", "GUNUNG-ANYAR", "gunung  anyar", "pabean_cantian", "karang_-pilang", "kenjeran", "o'neil st.a",
              "\tRungkut\n", "", None]
    assert apply(frame, standardize.district, inputs) == [
        "Wonocolo", "Gunung Anyar", "Gunung Anyar", "Pabean Cantian", "Karang Pilang", "Kenjeran", "O'Neil St.A",
        "Rungkut", None, None,
    ]


def test_damage_type(frame):
    inputs = ["D40_Pothole", "d40 pothole", "D20-Alligator Crack", "crack", "  ", "", None, "xyz", "pothole"]
    assert apply(frame, standardize.damage_type, inputs) == [
        "Pothole", "Pothole", "Alligator Crack", "Longitudinal Crack", "Longitudinal Crack", "Unknown", "Unknown",
        "Unknown", "Pothole",
    ]


def test_severity_score(frame):
    assert apply(frame, standardize.severity_score, [0, 25, 26, 50, 51, 75, 76, 100, None], "int") == [
        "Low", "Low", "Medium", "Medium", "High", "High", "Critical", "Critical", "Unknown",
    ]


def test_severity_text(frame):
    assert apply(frame, standardize.severity_text, ["HIGH ", "very high", "", "none", "crit", None]) == [
        "High", "High", "Low", "Unknown", "Critical", "Unknown",
    ]


def test_weather_and_congestion(frame):
    assert apply(frame, standardize.weather_condition, ["rain", "thunderstorm", "Clear Sky", "fog", "light FOG", "", None]) == [
        "Rainy", "Stormy", "Clear", "Fog", "Light Fog", "Unknown", "Unknown",
    ]
    assert apply(frame, standardize.congestion_level, ["SEVERE", "very high", "jam", None]) == [
        "Severe", "High", "Jam", "Unknown",
    ]


def test_first_entry_in_order_wins(frame):
    entries = {"abc": "first", "bcd": "second"}
    df = frame("x string", "xabcd", "bcd", "b").selectExpr(f"{standardize.match_sql('x', entries, 'NULL')} AS y")
    assert sorted(values(df)) == [("first",), ("first",), ("second",)]


def test_sql_functions(spark, frame):
    sql.register(spark)
    frame("d string, s int", ("gunung anyar", 80)).createOrReplaceTempView("places")
    df = spark.sql(
        "SELECT standardize_district(d) AS d, standardize_severity_score(s) AS s, geocode_district(d).longitude AS x, "
        "geocode_district('mars').latitude AS y, news_road_names('Jalan Pemuda rusak') AS roads FROM places"
    )
    assert values(df) == [("Gunung Anyar", "Critical", 112.82, -7.2575, ["Pemuda"])]
    assert "Python" not in plan(df)


def test_rules_table(spark):
    table = standardize.rules_table(spark)
    assert table.count() == 26 + 6 + 6 + 4 + 4
    assert values(table.filter("domain = 'districts' AND key = 'gunung_anyar'"), "value") == [("Gunung Anyar",)]
    assert len(rules.DISTRICTS) == 26


@pytest.mark.parametrize(
    "name, expected",
    [("averageSpeedKmh", "average_speed_kmh"), ("HTTPServer", "http_server"), ("road_name", "road_name"),
     ("eventID", "event_id"), ("rain7Day", "rain7_day")],
)
def test_snake_case(name, expected):
    assert schemas.snake_case(name) == expected


def test_schema_helpers(frame):
    df = frame("eventTime string, vehicleCount string", ("2024-01-01", "12"), ("oops", "many"))
    renamed = schemas.snake_case_columns(df)
    assert renamed.columns == ["event_time", "vehicle_count"]
    fitted = schemas.conform(renamed, schemas.EVENT["traffic"])
    assert fitted.columns == schemas.EVENT["traffic"].names
    rows = values(fitted.orderBy("vehicle_count"), "vehicle_count", "event_id", "event_time")
    assert rows[0] == (None, None, None) and rows[1][0] == 12
    assert values(schemas.ensure_columns(frame("a int", 3), ["a", "b"])) == [(3.0, 0.0)]
