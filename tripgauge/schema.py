"""Names, thresholds and labels shared by every operator.

FIXED VALUES: the constants in this module must equal the evaluated
pipeline's for results to agree (column spellings, quality thresholds,
bucket edges and labels, weekday labels, coordinate scaling).
"""

from __future__ import annotations

# --- FIXED VALUES: accepted spellings per standard column, first present wins.
COLUMN_SPELLINGS: dict[str, list[str]] = {
    "pickup_datetime": [
        "pickup_datetime", "tpep_pickup_datetime", "lpep_pickup_datetime",
        "pickup_time", "trip_pickup_datetime",
    ],
    "dropoff_datetime": [
        "dropoff_datetime", "tpep_dropoff_datetime", "lpep_dropoff_datetime",
        "dropoff_time", "trip_dropoff_datetime",
    ],
    "pickup_latitude": ["pickup_latitude", "start_lat", "pickup_lat"],
    "pickup_longitude": ["pickup_longitude", "start_lon", "pickup_lon"],
    "dropoff_latitude": ["dropoff_latitude", "end_lat", "dropoff_lat"],
    "dropoff_longitude": ["dropoff_longitude", "end_lon", "dropoff_lon"],
    "trip_distance": ["trip_distance", "distance", "trip_distance_miles", "distance_miles"],
}
REQUIRED_COLUMNS: list[str] = list(COLUMN_SPELLINGS)

# --- FIXED VALUES: data-quality thresholds.
MIN_DURATION_SEC = 30        # exclusive lower bound
MAX_DURATION_SEC = 7200      # inclusive upper bound
MIN_DISTANCE_KM = 0.1        # inclusive
MAX_DISTANCE_KM = 100.0      # inclusive
LAT_RANGE = (-90.0, 90.0)    # inclusive
LON_RANGE = (-180.0, 180.0)  # inclusive
CITY_LAT_RANGE = (40.4, 40.9)     # optional bounding-box rule, off by default
CITY_LON_RANGE = (-74.3, -73.7)

EARTH_RADIUS_KM = 6371.0

# --- FIXED VALUES: distance buckets, half-open [lo, hi) in km, in business order.
BUCKET_EDGES_KM: list[float] = [1.609, 4.828, 8.047, 16.093]
BUCKET_LABELS: list[str] = ["<1mi", "1-3mi", "3-5mi", "5-10mi", "10+mi"]

# --- FIXED VALUES: weekday labels for day_of_week 0..6.
WEEKDAY_LABELS: list[str] = [
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
]

# --- FIXED VALUES: evaluation settings.
SPLIT_QUANTILE = 0.7           # training = pickup <= 70th percentile of pickup time
MIN_SEGMENT_TRIPS = 10         # median_speeds HAVING COUNT(*) >= 10
METRIC_QUANTILES = (0.5, 0.9)
WITHIN_THRESHOLDS = (0.10, 0.20)
MIN_PREDICTION_SEC = 30.0
BIAS_THRESHOLD_SEC = 5.0
HISTOGRAM_BINS = 50
CALIBRATION_EDGES = 20         # 20 edges from 0 to P95 -> 19 right-closed bins
CALIBRATION_QUANTILE = 0.95
VALIDATION_FRACTION = 0.2

# --- FIXED VALUES: coordinate scaling of the feature set.
LAT_CENTER, LON_CENTER, COORD_SCALE = 40.7, -74.0, 0.5

FEATURE_COLUMNS: list[str] = [
    "haversine_distance_km", "hour_of_day", "day_of_week",
    "hour_sin", "hour_cos", "day_sin", "day_cos",
    "dist_<1mi", "dist_1-3mi", "dist_3-5mi", "dist_5-10mi", "dist_10+mi",
    "pickup_lat_norm", "pickup_lon_norm", "dropoff_lat_norm", "dropoff_lon_norm",
]

# Standard derived column names.
DURATION = "trip_duration_sec"
DISTANCE = "haversine_distance_km"
TRIP_ID = "trip_id"
HOUR = "hour_of_day"
DOW = "day_of_week"
BUCKET = "distance_bucket"
ESTIMATE = "estimated_duration_sec"

METRIC_COLUMNS: list[str] = [
    "segment_type", "segment_value", "trip_count", "mae_sec", "medae_sec",
    "p90_abs_error_sec", "mae_pct", "medae_pct", "p90_abs_error_pct",
    "pct_within_10pct", "pct_within_20pct",
]
