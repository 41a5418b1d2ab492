"""Table schemas and the fixed values that define results."""

from pyspark.sql import types as T

_NTZ = T.TimestampNTZType()
_STR = T.StringType()
_DBL = T.DoubleType()
_INT = T.IntegerType()
_BIG = T.LongType()


def _schema(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# ---- source tables -------------------------------------------------------

WEARABLE = _schema(
    ("timestamp", _NTZ), ("user_id", _STR), ("heart_rate", _DBL), ("steps", _INT),
    ("cumulative_steps", _BIG), ("spo2", _DBL), ("sleep_status", _INT), ("sleep_quality", _DBL),
)

# second wearable layout: numeric users, carries its location, no sleep quality
WEARABLE_ALT = _schema(
    ("timestamp", _NTZ), ("user_id", _BIG), ("location", _STR), ("heart_rate", _DBL), ("spo2", _DBL),
    ("steps", _INT), ("sleep_status", _INT), ("cumulative_steps", _BIG),
)

AIR_QUALITY = _schema(
    ("timestamp", _NTZ), ("location", _STR), ("pm25", _DBL), ("pm10", _DBL), ("aqi", _DBL), ("co2", _DBL),
)

WEATHER = _schema(
    ("timestamp", _NTZ), ("location", _STR), ("temperature", _DBL), ("humidity", _DBL),
    ("wind_speed", _DBL), ("pressure", _DBL), ("precipitation", _INT), ("rainfall", _DBL),
)

# ---- merged hourly table -------------------------------------------------

VITALS_COLUMNS = (
    "heart_rate_mean", "heart_rate_std", "heart_rate_max", "steps_total", "cumulative_steps_max",
    "spo2_mean", "spo2_min", "sleeping_users_count", "sleep_quality_mean", "active_users_count",
)
AIR_COLUMNS = ("pm25", "pm10", "aqi", "co2")
WEATHER_COLUMNS = ("temperature", "humidity", "wind_speed", "pressure", "precipitation", "rainfall")
CALENDAR_COLUMNS = ("hour", "day_of_week", "month", "is_weekend")
CATEGORY_COLUMNS = ("aqi_category", "temp_category")
FLAG_COLUMNS = ("high_heart_rate", "low_spo2", "high_pollution")

MERGED_COLUMNS = (
    "timestamp", *VITALS_COLUMNS, *AIR_COLUMNS, *WEATHER_COLUMNS, "location",
    *CALENDAR_COLUMNS, *CATEGORY_COLUMNS, *FLAG_COLUMNS,
)

# columns that never become features
NON_FEATURES = ("timestamp", "location", "health_risk", "risk_category", "user_id", "node", "date")

# columns the risk score cannot do without
SCORE_INPUTS = ("aqi", "heart_rate_mean", "spo2_mean", "pm25", "temperature", "humidity")

# ---- fixed values --------------------------------------------------------

DEFAULT_NODES = ("hospital_A", "hospital_B", "hospital_C")

# right-closed category bins: (lower, upper, label)
AQI_BINS = (
    (0, 50, "Good"),
    (50, 100, "Moderate"),
    (100, 150, "Sensitive"),
    (150, 200, "Unhealthy"),
    (200, 300, "Very_Unhealthy"),
    (300, 500, "Hazardous"),
)
TEMPERATURE_BINS = (
    (-999, 10, "Cold"),
    (10, 20, "Mild"),
    (20, 30, "Warm"),
    (30, 999, "Hot"),
)
RISK_BINS = (
    (0, 0.3, "Low"),
    (0.3, 0.6, "Medium"),
    (0.6, 1, "High"),
)

# one vocabulary for the bins above and for the model indicators
CATEGORY_VOCABULARY = {
    "aqi_category": tuple(label for _, _, label in AQI_BINS),
    "temp_category": tuple(label for _, _, label in TEMPERATURE_BINS),
}

# air-quality index: (concentration low, concentration high, index low, index high);
# the last line of each pollutant also covers everything above it
PM25_INDEX = (
    (0, 12, 0, 50),
    (12, 35.4, 50, 100),
    (35.4, 55.4, 100, 150),
    (55.4, 150.4, 150, 250),
    (150.4, 250.4, 250, 400),
)
PM10_INDEX = (
    (0, 54, 0, 50),
    (54, 154, 50, 100),
    (154, 254, 100, 150),
    (254, 354, 150, 250),
    (354, 424, 250, 400),
)
INDEX_RANGE = (0, 500)

# risk score weights
RISK_WEIGHTS = {
    "aqi_risk": 0.25,
    "heart_rate_risk": 0.15,
    "spo2_risk": 0.20,
    "pm25_risk": 0.15,
    "weather_risk": 0.10,
    "combined_risk": 0.15,
}
LABEL_QUANTILE = 0.70

# expected air pollution per location: (pm25 base, pm10 base)
POLLUTION_BASE = {
    "hospital_A": (35, 50),
    "hospital_B": (25, 40),
    "hospital_C": (45, 65),
}
POLLUTION_DEFAULT = (30, 45)

# expected temperature per location: (base, daily range)
CLIMATE_BASE = {
    "hospital_A": (22, 8),
    "hospital_B": (18, 6),
    "hospital_C": (28, 10),
}
CLIMATE_DEFAULT = (20, 8)

# valid sensor ranges, both ends included
SENSOR_RANGES = {
    "heart_rate": (50, 180),
    "spo2": (90, 100),
    "sleep_quality": (0, 100),
    "aqi": (0, 500),
    "co2": (400, 1000),
    "humidity": (20, 100),
    "wind_speed": (0, 50),
    "pressure": (980, 1050),
    "rainfall": (0, 50),
}
