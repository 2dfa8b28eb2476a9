"""Constants of the observation domain.

The values below are fixed: results depend on them, so they are stated as they
are and passed to the operators as default arguments.
"""

from __future__ import annotations

# --- fixed values: plausibility bounds --------------------------------------
TEMP_BOUNDS_K = (200.0, 330.0)
RAIN_MAX_MM = 9000.0
KELVIN_OFFSET = 273.15

# --- fixed values: analysis thresholds --------------------------------------
CONGESTION_THRESHOLD = 5500
RARE_CATEGORY_MIN = 100
SMALL_SAMPLE = 100
FALLBACK_MIN_ROWS = 200
LOW_COVERAGE_ROWS = 200
SMALL_WINDOW_ROWS = 500
IMBALANCE_RATE = 0.05
PSI_WARN = 0.10
PSI_ALERT = 0.25
ERROR_ALERT_RATIO = 1.25
HISTORY_STEPS = 24
SEED = 42

# --- fixed values: category lists -------------------------------------------
SEVERE_WEATHER = ["Rain", "Snow", "Thunderstorm", "Squall"]
LOW_VISIBILITY_WEATHER = ["Fog", "Mist", "Haze", "Smoke"]
FAIR_WEATHER = ["Clear", "Clouds"]
WEATHER_LEVELS = [
    "Clear", "Clouds", "Drizzle", "Fog", "Haze",
    "Mist", "Other", "Rain", "Snow", "Thunderstorm",
]
CONGESTION_LEVELS = ["Low", "Moderate", "High", "Severe"]
HIGH_LEVELS = ["High", "Severe"]

# --- fixed values: severity ranking used to pick one row per hour -----------
DEDUP_SEVERITY = {
    "Squall": 10, "Thunderstorm": 9, "Snow": 8, "Rain": 7, "Drizzle": 6,
    "Fog": 5, "Smoke": 4, "Haze": 3, "Mist": 2, "Clouds": 1, "Clear": 0,
}

# --- fixed values: severity ranking used as a clustering feature ------------
CLUSTER_SEVERITY = {
    "Clear": 0, "Clouds": 1, "Mist": 2, "Haze": 2, "Smoke": 2, "Fog": 3,
    "Drizzle": 3, "Rain": 4, "Snow": 5, "Thunderstorm": 6, "Squall": 7,
}

# --- fixed values: right-closed bands (edges, labels) -----------------------
TIME_BANDS = ([-1, 5, 9, 15, 19, 23],
              ["night", "morning_peak", "midday", "evening_peak", "late_evening"])
TEMP_BANDS = ([-40, 0, 15, 50], ["freezing", "cool", "warm"])
VOLUME_BANDS = ([4500, 5500], ["Low", "Medium", "High"])

# --- fixed values: bounds of a scoring request (column -> low, high) --------
REQUEST_BOUNDS = {
    "temp_celsius": (-45.0, 50.0),
    "clouds_all": (0.0, 100.0),
    "rain_1h": (0.0, 100.0),
    "snow_1h": (0.0, 100.0),
}

# --- fixed values: model inputs, in training order --------------------------
FEATURE_COLUMNS = [
    "hour", "day_of_week", "month", "is_weekend", "is_holiday",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "temp", "rain_1h", "snow_1h", "clouds_all",
    "is_precipitation", "is_low_visibility", "has_rain", "has_snow",
    "weather_Clear", "weather_Clouds", "weather_Drizzle", "weather_Fog",
    "weather_Haze", "weather_Mist", "weather_Other", "weather_Rain",
    "weather_Snow", "weather_Thunderstorm",
]

# --- fixed values: note attached to a proxy score ---------------------------
PROXY_NOTE = (
    "This is a PROXY risk score derived from congestion and weather. "
    "No accident data was used. It must not be read as an accident "
    "probability or used for safety-critical decisions."
)
