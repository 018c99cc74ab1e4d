"""Dictionaries, weights, thresholds and keyword banks.

Every operator takes these as default arguments, so a caller can pass its own.
"""

# --- Fixed values: districts and their centroids (latitude, longitude) ---
DISTRICT_CENTROIDS = {
    "Wonocolo": (-7.335, 112.734),
    "Wonokromo": (-7.315, 112.725),
    "Tegalsari": (-7.265, 112.745),
    "Simokerto": (-7.255, 112.750),
    "Jambangan": (-7.315, 112.800),
    "Tandes": (-7.210, 112.720),
    "Rungkut": (-7.300, 112.800),
    "Gunung Anyar": (-7.280, 112.820),
    "Sukolilo": (-7.245, 112.815),
    "Bulak": (-7.210, 112.745),
    "Krembangan": (-7.230, 112.700),
    "Sampang": (-7.210, 112.760),
    "Pabean Cantian": (-7.225, 112.705),
    "Semampir": (-7.245, 112.710),
    "Genteng": (-7.270, 112.720),
    "Usaha Jaya": (-7.210, 112.650),
    "Karang Pilang": (-7.340, 112.750),
    "Dukuh": (-7.310, 112.760),
    "Mulyorejo": (-7.290, 112.790),
    "Gubeng": (-7.315, 112.795),
    "Benowo": (-7.235, 112.650),
    "Pakal": (-7.210, 112.620),
    "Lakarsantri": (-7.240, 112.680),
    "Wiyung": (-7.300, 112.690),
    "Asemrowo": (-7.340, 112.710),
    "Sukomanunggal": (-7.270, 112.750),
}
CITY_CENTER = (-7.2575, 112.7521)
CITY_BOX = {"min_lat": -7.5, "max_lat": -7.0, "min_lon": 112.5, "max_lon": 113.0}
WORLD_BOX = {"min_lat": -90.0, "max_lat": 90.0, "min_lon": -180.0, "max_lon": 180.0}

# The spelling a district name is looked up by: lower case, words joined by "_".
DISTRICTS = {name.lower().replace(" ", "_"): name for name in DISTRICT_CENTROIDS}

# --- Fixed values: category dictionaries, in matching order ---
DAMAGE_TYPES = {
    "d00_longitudinal_crack": "Longitudinal Crack",
    "d10_transverse_crack": "Transverse Crack",
    "d20_alligator_crack": "Alligator Crack",
    "d40_pothole": "Pothole",
    "d50_other_damage": "Other Damage",
    "unknown": "Unknown",
}
WEATHER_CONDITIONS = {
    "rain": "Rainy",
    "sunny": "Sunny",
    "cloudy": "Cloudy",
    "storm": "Stormy",
    "clear": "Clear",
    "overcast": "Overcast",
}
SEVERITY_LEVELS = {"low": "Low", "medium": "Medium", "high": "High", "critical": "Critical"}
CONGESTION_LEVELS = {"low": "Low", "medium": "Medium", "high": "High", "severe": "Severe"}
# (upper bound of the score, level); scores above the last bound take the last level
SEVERITY_BOUNDS = ((25, "Low"), (50, "Medium"), (75, "High"), (None, "Critical"))

# --- Fixed values: defaults for missing measures ---
FILL_VALUES = {
    "reports": {"severity_score": 0, "confidence": 0.0},
    "weather": {"rainfall_mm": 0.0, "humidity": 0.5},
    "traffic": {"average_speed_kmh": 0.0, "vehicle_count": 0},
    "news": {"sentiment_score": 0.0},
    "accidents": {"vehicle_count": 0, "casualties": 0},
}
# Alternative strategy per column: a constant, "keep" (stay NULL) or "district_center".
FILL_STRATEGY = {
    "reports": {
        "latitude": "district_center",
        "longitude": "district_center",
        "severity_score": 0,
        "confidence": 0.0,
    },
    "weather": {"rainfall_mm": 0.0, "temperature_c": "keep", "humidity": "keep", "condition": "Unknown"},
    "traffic": {"average_speed_kmh": 0.0, "vehicle_count": 0, "congestion_level": "Low"},
}
ACCIDENT_FEATURE_FILL = {
    "damage_report_count": 0,
    "avg_severity": 0.0,
    "max_severity": 0.0,
    "avg_speed": 30.0,
    "avg_vehicle_count": 0.0,
    "traffic_event_count": 0,
    "rainfall_mm": 0.0,
    "temperature_c": 25.0,
    "humidity": 0.5,
    "weather_condition": "Clear",
}
REPORT_DEFAULTS = {
    "description": "Kerusakan jalan dilaporkan oleh YOLO/Crowdsourcing.",
    "image_path": "",
    "status": "Pending",
}

# --- Fixed values: allowed range (low, high) per measure ---
RANGE_RULES = {
    "reports": {
        "latitude": (-7.5, -7.0),
        "longitude": (112.5, 113.0),
        "severity_score": (0, 100),
        "confidence": (0.0, 1.0),
    },
    "weather": {"temperature_c": (15, 45), "humidity": (0.0, 1.0), "rainfall_mm": (0, 500)},
    "traffic": {"average_speed_kmh": (0, 120), "vehicle_count": (0, 10000)},
}

# --- Fixed values: scores ---
HEALTH_WEIGHTS = {"severity": 0.4, "rainfall": 0.2, "traffic": 0.2, "road_age_score": 0.2}
PRIORITY_WEIGHTS = {
    "severity_score": 0.30,
    "traffic_score": 0.25,
    "accident_score": 0.20,
    "complaint_score": 0.15,
    "news_score": 0.10,
}
TRAFFIC_DIVISOR = 20.0
ACCIDENT_POINTS = 10.0
NEWS_POINTS = 10.0
# (fewest reports on the road, score), highest first
COMPLAINT_SCORES = ((10, 100.0), (5, 60.0), (2, 30.0), (1, 10.0))
SIMPLE_PRIORITY_WEIGHTS = {"severity_score": 0.75, "confidence": 0.25}
ACCIDENT_MODEL = {"base": 0.05, "rainfall": 0.01, "traffic": 0.0001, "health_gap": 0.005}
ACCIDENT_LEVELS = ((0.3, "LOW"), (0.6, "MEDIUM"))
DAMAGE_CLASSES = {
    0: ("D00_Longitudinal_Crack", 40),
    1: ("D10_Transverse_Crack", 50),
    2: ("D20_Alligator_Crack", 75),
    3: ("D40_Pothole", 100),
    4: ("D50_Other_Damage", 30),
}
POTHOLE = "D40_Pothole"
CRACKS = ("D00_Longitudinal_Crack", "D10_Transverse_Crack", "D20_Alligator_Crack")
STATUSES = ("Pending", "Verified", "In Progress", "Resolved")
RAIN_WINDOWS = (7, 30, 90)

HIGH_SEVERITY = 80
# severities from 50 to 80 are a medium risk, higher ones a high risk
RISK_BOUNDS = (50, 80)
RISK_LEVELS = ("Low Risk", "Medium Risk", "High Risk")

# --- Fixed values: severity model ---
MODEL_FEATURES = (
    "damage_report_count", "avg_severity", "max_severity", "avg_speed", "traffic_event_count",
    "rainfall_mm", "temperature_c", "humidity",
)
SEVERE_LEVELS = ("High", "Critical")
HEAVY_RAIN = 50
FOREST = {"numTrees": 50, "maxDepth": 5, "seed": 42}
TRAIN_SHARE = 0.8
MIN_TRAINING_ROWS = 50

# --- Fixed values: event topics, message keys, first offsets, and the region the feeds come from ---
TOPICS = {
    "reports": "road_reports",
    "weather": "weather_data",
    "traffic": "traffic_data",
    "news": "news_data",
    "accidents": "accident_data",
}
MESSAGE_KEYS = {
    "reports": "report_id",
    "weather": "district",
    "traffic": "road_name",
    "news": "event_id",
    "accidents": "accident_id",
    "rain": "date",
}
STARTING_OFFSETS = {
    "reports": "latest",
    "weather": "latest",
    "traffic": "earliest",
    "news": "earliest",
    "accidents": "earliest",
}
REGION = {"country": "ID", "province": "JawaTimur", "city": "Surabaya"}

# --- Fixed values: keyword banks and patterns for news text (keywords in lower case) ---
NEWS_DISTRICTS = (
    "Wonokromo", "Wonocolo", "Wiyung", "Wage", "Tandes", "Tegalsari",
    "Tambaksari", "Sukolilo", "Sukomanunggal", "Simokerto", "Semampir",
    "Sawahan", "Rungkut", "Pakal", "Pabean Cantian", "Mulyorejo",
    "Lakarsantri", "Krembangan", "Kenjeran", "Karang Pilang", "Jambangan",
    "Gunung Anyar", "Gayungan", "Genteng", "Gubeng", "Dukuh Pakis",
    "Bubutan", "Bulak", "Benowo", "Asemrowo", "Waru", "Warugunung",
    "Menanggal", "Medokan Ayu", "Klampis Ngasem",
)
ROAD_STOP_WORDS = (
    "rusak", "berlubang", "hancur", "parah", "ambles", "amblas", "bergelombang",
    "akhirnya", "selesai", "di", "yang", "dan", "kawasan", "warga", "sudah",
    "telah", "masih", "kembali", "menjadi", "terjadi", "akibat", "karena",
    "sejak", "hingga", "serta", "juga",
)
# one to four capitalised words after the prefix; "{stop_words}" is filled in by the caller
ROAD_PATTERN = (
    r"(?:Jalan|Jl\.)\s+((?!Jalan\b|Jl\.)[A-Z][A-Za-z\.]+"
    r"(?:\s+(?!Jalan\b|Jl\.)[A-Z][A-Za-z\.]+){0,3})"
    r"(?=\s+(?:{stop_words})|[,\.]|$)"
)
DAMAGE_KEYWORDS = {
    "pothole": ("berlubang", "lubang", "jalan bolong", "lobang"),
    "crack": ("retak", "retakan", "pecah", "terbelah"),
    "alligator_crack": ("bergelombang", "retak buaya", "kulit buaya"),
    "subsidence": ("ambles", "amblas", "turun", "terbenam"),
    "erosion": ("tergerus", "erosi", "longsor", "terkikis"),
    "general": ("rusak", "hancur", "tidak layak"),
}
# level -> (score, keywords), worst level first
SEVERITY_KEYWORDS = {
    "critical": (90, ("parah sekali", "sangat parah", "hancur total", "tidak bisa dilalui",
                      "berbahaya", "maut", "fatal", "memakan korban")),
    "high": (70, ("parah", "rusak berat", "berlubang besar", "cukup parah", "dalam dan besar")),
    "medium": (45, ("rusak sedang", "berlubang", "cukup rusak", "mulai rusak", "bergelombang")),
    "low": (20, ("rusak ringan", "sedikit rusak", "retak kecil", "agak rusak", "retak halus")),
}
WEAK_SEVERITY = ("medium", 45, 0.3, ("rusak", "berlubang"))
COMPLAINT_NOUNS = ("warga", "masyarakat", "orang", "laporan", "pengaduan")
COMPLAINT_APPROX = {"ratusan": 150, "puluhan": 30, "banyak": 20, "sejumlah": 10, "beberapa": 5}
POSITIVE_KEYWORDS = (
    "diperbaiki", "sudah ditangani", "selesai diperbaiki", "telah direnovasi",
    "sudah bagus", "mulus", "baik", "terima kasih", "apresiasi",
    "ditambal", "pengaspalan selesai",
)
NEGATIVE_KEYWORDS = (
    "rusak", "berlubang", "berbahaya", "parah", "keluhan", "protes",
    "mengeluh", "minta perbaikan", "belum ditangani", "dibiarkan",
    "tidak aman", "menelan korban", "kecelakaan",
)
NEGATION_WORDS = ("tidak", "belum", "bukan", "tanpa")
NEGATION_WINDOW = 15
LOCAL_WINDOW = 80
ARTICLES_PER_QUERY = 15

# A report takes so many images at most.
MOST_IMAGES = 5

# Points of a hotspot: for each report, and for each point of mean severity.
HOTSPOT_WEIGHTS = {"report_count": 5.0, "avg_severity": 0.5}
# Confidence of a signal in a text: (without, for each keyword). A stated count and an estimated one.
DAMAGE_CONFIDENCE = (0.4, 0.2)
SEVERITY_CONFIDENCE = (0.5, 0.25)
COMPLAINT_CONFIDENCE = {"stated": 0.9, "estimate": 0.4}
ROAD_CONFIDENCE = 0.2
# A tone is neutral up to this balance of keywords.
NEUTRAL = 0.15
# Ranks of the severity levels in a road summary, from 1.
NEWS_LEVELS = ("low", "medium", "high", "critical")
