"""Column names and fixed values of the measurement data model.

Everything under "Fixed values" must equal what the analysed application
uses, otherwise results differ; they are stated once, here, in natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Header of the measurement table, in file order (41 columns).
MEASUREMENT_COLUMNS = [
    "id", "timestamp", "device",
    "PCell_RSRP_max", "PCell_RSRQ_max", "PCell_RSSI_max", "PCell_SNR_max",
    "PCell_Downlink_Num_RBs", "PCell_Downlink_Average_MCS", "PCell_Downlink_bandwidth_MHz",
    "PCell_Cell_Identity", "PCell_freq_MHz",
    "SCell_RSRP_max", "SCell_RSRQ_max", "SCell_RSSI_max", "SCell_SNR_max",
    "SCell_Downlink_Num_RBs", "SCell_Downlink_Average_MCS", "SCell_Downlink_bandwidth_MHz",
    "SCell_Cell_Identity", "SCell_freq_MHz",
    "operator", "Latitude", "Longitude", "Altitude", "speed_kmh", "COG",
    "precipIntensity", "precipProbability", "temperature", "apparentTemperature",
    "dewPoint", "humidity", "pressure", "windSpeed", "cloudCover", "uvIndex",
    "visibility", "Traffic Jam Factor", "area", "target",
]

# Line prefix that marks a (repeated) header line in the positional text input.
HEADER_PREFIX = "id,timestamp"

# Positions read by the positional text parser: timestamp, area and the six
# averaged metrics (RSRP, SNR, speed, traffic jam factor, humidity, rain probability).
TEXT_POS_TIMESTAMP = 1
TEXT_POS_AREA = 39
TEXT_METRIC_POSITIONS = {
    "PCell_RSRP_max": 3,
    "PCell_SNR_max": 6,
    "speed_kmh": 25,
    "Traffic Jam Factor": 38,
    "humidity": 32,
    "precipProbability": 28,
}

# The six metrics of the area-hour averages, in output order.
AREA_HOUR_METRICS = [
    "PCell_RSRP_max", "PCell_SNR_max", "speed_kmh",
    "Traffic Jam Factor", "humidity", "precipProbability",
]

# Cleaning: presence flag source, zero-filled prefix, mode-imputed columns.
SCELL_PRESENCE_COLUMN = "SCell_RSRP_max"
SCELL_PREFIX = "SCell_"
PCELL_MODE_COLUMNS = ["PCell_Downlink_bandwidth_MHz", "PCell_Cell_Identity", "PCell_freq_MHz"]

# Category columns counted in the EDA, and the box-plot groupings.
CATEGORY_COLUMNS = ["device", "operator", "area", "day_of_week", "has_scell"]
BOX_GROUP_COLUMNS = ["area", "operator", "has_scell"]

# Columns left out of the correlation matrix.
CORR_EXCLUDE = ["timestamp", "COG", "id"]

# Predictors of the scatter dataset.
SCATTER_PREDICTORS = ["PCell_Downlink_Average_MCS", "PCell_SNR_max", "PCell_RSRP_max"]

# Histogram bin counts: target and log1p(target); signal columns; score.
TARGET_BINS = 50
SIGNAL_BINS = 40
SCORE_BINS = 30
SIGNAL_HIST_COLUMNS = ["PCell_RSRP_max", "PCell_RSRQ_max", "PCell_SNR_max", "PCell_Downlink_Average_MCS"]

# Density curve: number of evaluation points.
KDE_GRID_POINTS = 200

# Box-plot whisker reach in IQRs.
WHISKER_IQR = 1.5

# Map colour bands on min-max-normalised log1p(target).
COLOR_LOW_CUT = 0.33
COLOR_MID_CUT = 0.66
COLOR_EPSILON = 1e-6
COLOR_LOW, COLOR_MID, COLOR_HIGH, COLOR_MISSING = "red", "orange", "green", "gray"

# Scoring: columns scaled to [0, 1], in order.
SCORE_INPUT_COLUMNS = [
    "PCell_RSRP_max", "PCell_SNR_max", "speed_kmh",
    "temperature", "pressure", "Traffic Jam Factor",
]
SCORE_REQUIRED_COLUMNS = ["id", *SCORE_INPUT_COLUMNS, "target"]
# Component coefficients: Signal = 0.6 RSRP + 0.4 SNR; Env = 0.5 temperature + 0.5 pressure.
SIGNAL_RSRP_COEF = 0.6
SIGNAL_SNR_COEF = 0.4
ENV_TEMPERATURE_COEF = 0.5
ENV_PRESSURE_COEF = 0.5
COMPONENT_COLUMNS = ["SignalScore", "MobilityScore", "EnvScore", "CongestionPenalty"]
SCORE_COLUMN = "QoS_Score"
# Default weights (signal, mobility, env, congestion).
DEFAULT_WEIGHTS = {"w_signal": 0.4, "w_mobility": 0.2, "w_env": 0.1, "w_congestion": 0.3}
WEIGHT_NAMES = ["w_signal", "w_mobility", "w_env", "w_congestion"]
# Weight normalisation: a sum below this gives 0.25 each.
WEIGHT_SUM_EPSILON = 1e-6
# Grid search: n_points values evenly from 0.1 to 0.9; n in 3..10, default 5.
GRID_LOW, GRID_HIGH = 0.1, 0.9
GRID_POINTS_DEFAULT, GRID_POINTS_MIN, GRID_POINTS_MAX = 5, 3, 10
# Random search: default 100 candidates, 10..1000.
RANDOM_ITER_DEFAULT, RANDOM_ITER_MIN, RANDOM_ITER_MAX = 100, 10, 1000
# Missing-column defaults: numbers 0.0, target 1.
MISSING_NUMBER_DEFAULT = 0.0
MISSING_TARGET_DEFAULT = 1.0

# Result sizes: preview rows, top-k report, head.
PREVIEW_ROWS = 1000
TOP_K = 10
HEAD_ROWS = 5

# Sampling: seed, fractions, fixed sizes.
SAMPLE_SEED = 42
