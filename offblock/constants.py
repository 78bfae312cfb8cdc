"""Names and fixed values used across the engine.

Fixed values: these must equal what the reference uses for results to match.
"""

# --- fixed values -----------------------------------------------------------
# airline prefixes counted as private flights
PRIVATE_CODES = ["NJE", "VJT", "PVT", "SIG"]
PRIVATE_PREFIX_PATTERN = r"^([A-Z]{2,3})"

# aircraft model names counted as helicopters (exact, case-sensitive)
HELICOPTER_MODELS = [
    "A109",
    "AW139",
    "S-76",
    "407",
    "214 ST",
    "EC 120",
    "EC 135T",
    "EC 155B",
    "SA 365 DAUPHIN 2",
    "AEROSPATIALE AS355 ECUREUIL 2 (TWIN SQ.)",
    "AS 350 ECUREUIL (SQUIRREL)",
    "Helicopter",
]

# weather columns dropped before the weather join
WEATHER_DROP_COLUMNS = [
    "Aircraft Span",
    "Airport Arrival/Departure",
    "Movement Type",
    "Distance_proxy_m",
    "Log_distance_m",
    "Year",
    "Month",
    "Weekday",
    "Hour",
    "Q_dep_arr",
    "time_hourly",
    "apparentTemperature",
    "dewPoint",
    "windGust",
]

# weather columns dropped for the clean (imputed) gold variant
HIGH_MISSING_COLUMNS = [
    "precipIntensity",
    "precipProbability",
    "pressure",
    "windBearing",
    "cloudCover",
    "uvIndex",
]

# feature groups used to sum attributions
CATEGORY_ORDER = ["Weather", "Traffic", "Distance", "Aircraft"]
WEATHER_PATTERNS = [
    "temperature",
    "humidity",
    "windSpeed",
    "visibility",
    "precipAccumulation",
    "ozone",
    "summary_",
    "icon_",
    "precipType_",
]
TRAFFIC_FEATURES = ["N_dep_dep", "N_dep_arr", "Q_dep_dep", "planes_30min", "planes_10min", "delay_seconds"]
TRAFFIC_SUBSTRINGS_LOWER = ["hour", "day_of_week", "month"]
DISTANCE_FEATURES = ["stand", "runway", "distance", "log_distance"]
AIRCRAFT_FEATURES = ["Aircraft Length", "No. Engines"]

# taxi-time range kept (seconds, both ends open)
TAXI_MIN_EXCLUSIVE = 0
TAXI_MAX_EXCLUSIVE = 7200

# traffic windows in minutes
TRAFFIC_WINDOWS_MIN = (30, 10)

# share of the latest rows held out for validation
VALIDATION_SHARE = 0.2

# earth radius in metres for the haversine distance
EARTH_RADIUS_M = 6371000.0

# dashboard: base minutes per runway, default 18
RUNWAY_BASE_MINUTES = {"RUNWAY_1": 14, "RUNWAY_2": 17, "RUNWAY_3": 19, "RUNWAY_4": 21}
RUNWAY_BASE_DEFAULT = 18

# gold dataset per model family
MODEL_DATASET = {
    "linear_regression": "clean",
    "random_forest": "clean",
    "xgboost": "default",
    "lightgbm": "default",
    "catboost": "default",
}

# dashboard column names
DASH_STAND = "Stand"
DASH_RUNWAY = "Runway"
DASH_LENGTH = "Aircraft Length (m)"
DASH_ENGINES = "No. Engines"
DASH_ACTUAL = "Actual Taxi Time (s)"
DASH_PREDICTED = "Predicted Taxi Time (s)"
# --- end fixed values -------------------------------------------------------

# column names of the silver/gold data model
RUNWAY = "runway"
STAND = "stand"
FLIGHT_NUMBER = "Flight Number"
AIRCRAFT_MODEL = "Aircraft Model"
FLIGHT_DATETIME = "Flight Datetime"
AOBT = "AOBT"
ATOT = "ATOT"
TARGET = "actual_taxi_out_sec"
LAT_RUNWAY, LNG_RUNWAY = "Lat_runway", "Lng_runway"
LAT_STAND, LNG_STAND = "Lat_stand", "Lng_stand"
DISTANCE, LOG_DISTANCE = "distance", "log_distance"
DELAY_SECONDS = "delay_seconds"
PLANES_30MIN, PLANES_10MIN = "planes_30min", "planes_10min"
PRIVATE_FLIGHT, HELICOPTER = "private_flight", "helicopter"
AIRCRAFT_LENGTH, NO_ENGINES = "Aircraft Length", "No. Engines"
CATEGORICAL_COLUMNS = ["summary", "icon", "precipType"]

# non-feature columns gold carries so row order survives (Spark has no row position)
ROW_ID = "flight_id"
ORDER_TS = "aobt_ts"

# --- fixed values: search spaces --------------------------------------------
# list: choice; low and high: range, whole numbers for "int", log: drawn on the logarithm
SEARCH_SPACES = {
    "linear_regression": {"fit_intercept": [True, False]},
    "random_forest": {
        "n_estimators": {"type": "int", "low": 100, "high": 500},
        "max_depth": {"type": "int", "low": 5, "high": 30},
        "min_samples_split": {"type": "int", "low": 2, "high": 20},
        "min_samples_leaf": {"type": "int", "low": 1, "high": 10},
        "max_features": ["sqrt", "log2", None],
    },
    "xgboost": {
        "n_estimators": {"type": "int", "low": 100, "high": 1000},
        "max_depth": {"type": "int", "low": 3, "high": 10},
        "learning_rate": {"type": "float", "low": 0.01, "high": 0.3, "log": True},
        "subsample": {"type": "float", "low": 0.6, "high": 1.0},
        "colsample_bytree": {"type": "float", "low": 0.6, "high": 1.0},
        "min_child_weight": {"type": "int", "low": 1, "high": 10},
        "gamma": {"type": "float", "low": 0.0, "high": 5.0},
        "reg_alpha": {"type": "float", "low": 1e-8, "high": 10.0, "log": True},
        "reg_lambda": {"type": "float", "low": 1e-8, "high": 10.0, "log": True},
    },
    "lightgbm": {
        "n_estimators": {"type": "int", "low": 100, "high": 1000},
        "max_depth": {"type": "int", "low": 3, "high": 12},
        "learning_rate": {"type": "float", "low": 0.01, "high": 0.3, "log": True},
        "num_leaves": {"type": "int", "low": 20, "high": 150},
        "subsample": {"type": "float", "low": 0.6, "high": 1.0},
        "colsample_bytree": {"type": "float", "low": 0.6, "high": 1.0},
        "min_child_samples": {"type": "int", "low": 5, "high": 100},
        "reg_alpha": {"type": "float", "low": 1e-8, "high": 10.0, "log": True},
        "reg_lambda": {"type": "float", "low": 1e-8, "high": 10.0, "log": True},
    },
    "catboost": {
        "iterations": {"type": "int", "low": 100, "high": 1000},
        "depth": {"type": "int", "low": 4, "high": 10},
        "learning_rate": {"type": "float", "low": 0.01, "high": 0.3, "log": True},
        "l2_leaf_reg": {"type": "float", "low": 1e-8, "high": 10.0, "log": True},
        "bagging_temperature": {"type": "float", "low": 0.0, "high": 1.0},
        "random_strength": {"type": "float", "low": 0.0, "high": 10.0},
        "border_count": {"type": "int", "low": 32, "high": 255},
    },
}
