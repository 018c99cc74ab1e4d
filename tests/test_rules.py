"""The fixed values, spelled out: the SQL counterparts read them from the same module, so they are pinned here."""

from roadlake import rules


def test_weights_and_bounds():
    assert rules.HEALTH_WEIGHTS == {"severity": 0.4, "rainfall": 0.2, "traffic": 0.2, "road_age_score": 0.2}
    assert rules.PRIORITY_WEIGHTS == {
        "severity_score": 0.30, "traffic_score": 0.25, "accident_score": 0.20, "complaint_score": 0.15, "news_score": 0.10}
    assert rules.SIMPLE_PRIORITY_WEIGHTS == {"severity_score": 0.75, "confidence": 0.25}
    assert (rules.TRAFFIC_DIVISOR, rules.ACCIDENT_POINTS, rules.NEWS_POINTS) == (20.0, 10.0, 10.0)
    assert rules.COMPLAINT_SCORES == ((10, 100.0), (5, 60.0), (2, 30.0), (1, 10.0))
    assert rules.ACCIDENT_MODEL == {"base": 0.05, "rainfall": 0.01, "traffic": 0.0001, "health_gap": 0.005}
    assert rules.ACCIDENT_LEVELS == ((0.3, "LOW"), (0.6, "MEDIUM"))
    assert rules.SEVERITY_BOUNDS == ((25, "Low"), (50, "Medium"), (75, "High"), (None, "Critical"))
    assert rules.RISK_BOUNDS == (50, 80) and rules.RISK_LEVELS == ("Low Risk", "Medium Risk", "High Risk")
    assert rules.HOTSPOT_WEIGHTS == {"report_count": 5.0, "avg_severity": 0.5}
    assert rules.RAIN_WINDOWS == (7, 30, 90) and rules.HIGH_SEVERITY == 80 and rules.HEAVY_RAIN == 50


def test_places_and_categories():
    assert rules.CITY_CENTER == (-7.2575, 112.7521) and len(rules.DISTRICT_CENTROIDS) == 26
    assert rules.CITY_BOX == {"min_lat": -7.5, "max_lat": -7.0, "min_lon": 112.5, "max_lon": 113.0}
    assert rules.DISTRICTS["gunung_anyar"] == "Gunung Anyar" and rules.DISTRICTS["pabean_cantian"] == "Pabean Cantian"
    assert rules.SEVERITY_LEVELS == {"low": "Low", "medium": "Medium", "high": "High", "critical": "Critical"}
    assert rules.CONGESTION_LEVELS == {"low": "Low", "medium": "Medium", "high": "High", "severe": "Severe"}
    assert rules.POTHOLE == "D40_Pothole" and rules.CRACKS == ("D00_Longitudinal_Crack", "D10_Transverse_Crack", "D20_Alligator_Crack")
    assert rules.STATUSES == ("Pending", "Verified", "In Progress", "Resolved")
    assert rules.REGION == {"country": "ID", "province": "JawaTimur", "city": "Surabaya"}


def test_words():
    assert rules.COMPLAINT_APPROX == {"ratusan": 150, "puluhan": 30, "banyak": 20, "sejumlah": 10, "beberapa": 5}
    assert rules.COMPLAINT_NOUNS == ("warga", "masyarakat", "orang", "laporan", "pengaduan")
    assert rules.NEGATION_WORDS == ("tidak", "belum", "bukan", "tanpa")
    assert rules.WEAK_SEVERITY == ("medium", 45, 0.3, ("rusak", "berlubang"))
    assert [(level, score) for level, (score, _) in rules.SEVERITY_KEYWORDS.items()] == [("critical", 90), ("high", 70), ("medium", 45), ("low", 20)]
    assert (rules.NEGATION_WINDOW, rules.LOCAL_WINDOW, rules.ARTICLES_PER_QUERY, rules.NEUTRAL) == (15, 80, 15, 0.15)


def test_model():
    assert rules.FOREST == {"numTrees": 50, "maxDepth": 5, "seed": 42} and rules.TRAIN_SHARE == 0.8 and rules.MIN_TRAINING_ROWS == 50
    assert rules.SEVERE_LEVELS == ("High", "Critical")
