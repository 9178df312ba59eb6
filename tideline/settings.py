"""Names, policies and thresholds shared by every operator."""
from __future__ import annotations

from decimal import Decimal

# ---- fixed values -----------------------------------------------------------
# Hourly measures and how a six-hour slot combines them.
STATE_MEASURES = [  # averaged inside a slot
    "temperature_2m",
    "relative_humidity_2m",
    "wind_speed_10m",
    "soil_moisture_0_to_7cm",
    "soil_moisture_7_to_28cm",
    "soil_temperature_0_to_7cm",
]
FLUX_MEASURES = ["precipitation", "et0_fao_evapotranspiration"]  # added up inside a slot
MEASURES = [
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "wind_speed_10m",
    "soil_moisture_0_to_7cm",
    "soil_moisture_7_to_28cm",
    "soil_temperature_0_to_7cm",
    "et0_fao_evapotranspiration",
]
DISCHARGE = "river_discharge"

# Valid sensor range per measure, both ends included.
SENSOR_BOUNDS = {
    "temperature_2m": (-50.0, 60.0),
    "relative_humidity_2m": (0.0, 100.0),
    "precipitation": (0.0, 500.0),
    "wind_speed_10m": (0.0, 250.0),
    "soil_moisture_0_to_7cm": (0.0, 1.0),
    "soil_moisture_7_to_28cm": (0.0, 1.0),
}

# Label rule: all comparisons are strict.
DISCHARGE_LIMIT = 1.0
RAIN_LIMIT = 1.0
HUMIDITY_LIMIT = 85.0

RISK_MEDIUM = 0.30
RISK_HIGH = 0.60
MAX_MISSING_PCT = 5.0
LIVE_DAYS = 15
HORIZON_DAYS = 30
REPLAY_SLOTS = 120

SOURCE_ZONE = "High Relief"
# Share of the upstream 24 h rain that reaches a zone; other zones get all of it.
CASCADE_SHARE = {"High Relief": 1.0 / 3.0, "Moderate Relief": 1.0 / 1.5}
CASCADE_DEFAULT = 1.0

ZONES = [  # zone, latitude, longitude
    ("High Relief", 40.34376, 49.55835),
    ("Low Relief", 40.29215, 49.83208),
    ("Moderate Relief", 40.35038, 49.65975),
]
ZONE_META = [  # zone, zone_id, elevation_mean, slope_mean, impervious_ratio, watershed_area
    ("High Relief", "C", 150.0, 12.0, 0.15, 45.0),
    ("Moderate Relief", "B", 40.0, 6.0, 0.40, 120.0),
    ("Low Relief", "A", 3.0, 1.5, 0.70, 280.0),
]
DISTRICTS = [  # name, zone
    ("Sabail", "Low Relief"),
    ("Binəqədi", "Low Relief"),
    ("Suraxanı", "Low Relief"),
    ("Yasamal", "Moderate Relief"),
    ("Nəsimi", "Moderate Relief"),
    ("Xətai", "Moderate Relief"),
    ("Nərimanov", "High Relief"),
    ("Sabunçu", "High Relief"),
    ("Abşeron", "High Relief"),
]

# Antecedent index: slots back -> power of the decay.
DECAY = Decimal("0.85")
DECAY_POWERS = {1: 1, 2: 2, 4: 4}

# Columns the learner never sees, next to keys, quality score and label.
EXCLUDED_FROM_MODEL = [
    "river_discharge",
    "humidity_precip_product",
    "precip_roll_max_24h",
    "zone_cascade_risk",
    "soil_temperature_0_to_7cm",
    "soil_saturation_index",
    "discharge_roll_max_24h",
    "temp_lag_24h",
    "discharge_lag_24h",
    "precip_roll_sum_24h",
    "frozen_ground_flag",
    "discharge_trend_6h",
    "soil_moisture_change_6h",
    "temp_trend_24h",
]
# Learner settings of the production model.
MODEL_ROUNDS = 511
MODEL_STEP = 0.056542201075504325
MODEL_DEPTH = 3
MODEL_MIN_ROWS = 10
MODEL_ROW_SHARE = 0.502314474212375
MODEL_COLUMN_SHARE = "0.43903095579116774"
MODEL_L1 = 6.6928770111304505
MODEL_L2 = 9.580154309406538
MODEL_GAMMA = 4.041986740582305
MODEL_SEED = 42

RECORD_COLUMNS = [  # forecast record, in output order
    "zone", "time", "temperature_2m", "relative_humidity_2m", "precipitation",
    "wind_speed_10m", "soil_moisture_0_to_7cm", "soil_moisture_7_to_28cm",
    "et0_fao_evapotranspiration", "river_discharge", "risk_score", "flood_pred", "risk_level",
]
PREDICTION_COLUMNS = [
    "zone", "time_6h", "temperature_2m", "relative_humidity_2m", "precipitation",
    "wind_speed_10m", "soil_moisture_0_to_7cm", "soil_moisture_7_to_28cm",
    "et0_fao_evapotranspiration", "is_flood", "risk_score", "flood_pred", "risk_level",
]
# ---- end of fixed values ----------------------------------------------------

TARGET = "is_flood"
SLOT_HOURS = 6

GOLD_FEATURES = MEASURES + [
    "precip_lag_6h", "precip_lag_12h", "precip_lag_24h", "precip_lag_48h", "temp_lag_24h",
    "precip_roll_sum_24h", "precip_roll_sum_48h", "precip_roll_sum_72h",
    "precip_roll_max_24h", "humidity_roll_max_24h", "et0_roll_sum_24h",
    "api_7d", "soil_saturation_index", "soil_moisture_change_6h", "soil_moisture_deficit",
    "frozen_ground_flag", "temp_trend_24h", "et_deficit_6h", "et_deficit_24h",
    "humidity_precip_product", "highland_precip_24h", "zone_cascade_risk",
    "hour_sin", "hour_cos", "doy_sin", "doy_cos", "is_winter",
]
