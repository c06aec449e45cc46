"""Column contracts, label vocabulary and tuning constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

# --- fixed values: label vocabulary ---------------------------------------
OUTAGE = "outage"
CLIPPING = "clipping"
SOILING = "soiling"
WEATHER = "weather"
SNOW = "snow"
SNOW_SHEDDING = "snow_shedding"
CLOUD_INTERMITTENT = "cloud_intermittent"
THERMAL = "thermal"
DATA_GAP = "data_gap"
UNCLASSIFIED = "unclassified"
CURTAILMENT = "curtailment"
HEALTHY = "healthy"
LABELS = [
    OUTAGE, CLIPPING, SOILING, WEATHER, SNOW, SNOW_SHEDDING,
    CLOUD_INTERMITTENT, THERMAL, DATA_GAP, UNCLASSIFIED, CURTAILMENT,
]
GOLD_VERDICTS = ["confirmed", "refuted", "attributed"]

# --- fixed values: thresholds ----------------------------------------------
LIT_FRAC = 0.20          # of dc capacity, expected power
BRIGHT_FRAC = 0.50       # of ac capacity, expected power
PLATEAU_FRAC = 0.97      # of the day's peak
DEAD_FRAC = 0.05         # of expected power
CEILING_FRAC = 0.95      # of ac capacity
CSR_WEATHER, CSR_RAINY, CSR_DIM, CSR_BRIGHT = 0.75, 0.65, 0.50, 0.90
CHOP_BROKEN_SKY = 0.10
RAIN_MM = 1.0
QUANT_TOL = 0.15
DEAD_RUN_H, PARTIAL_PLATEAU_H, CLIP_PLATEAU_H = 1.0, 1.75, 2.0
SNOW_3D_CM, SNOW_7D_CM, SNOW_30D_CM = 1.0, 5.0, 10.0
SNOW_TMAX_C, SNOW_SHED_TMAX_C = 5.0, 12.0
SNOW_PI, SHED_PI, CLOUD_PI = 0.6, 0.95, 0.7
TMAX_HOT_C, TEMP_CORR, MIN_RATIO_HOURS = 32.0, -0.6, 5
MORNING_MIN, MIDDAY_MAX = 1.15, 0.92
CLIP_EXPECTED = 1.05
TREND_DAYS, TREND_MIN, TREND_SLOPE = 14, 10, -0.003
TREND_DROP1, TREND_DROP2 = 0.5, 0.6
MORNING_WINDOW = (7 * 60, 10 * 60)
LATE_WINDOW = (11 * 60, 14 * 60)
MIDDAY_WINDOW = (10 * 60, 14 * 60)
DIVERGENCE_MARGIN, FLEET_HEALTHY, SHARE_DOMINANT = 0.10, 0.5, 0.5
TRAIL_DAYS, CURTAIL_PLATEAU_H = 30, 1.5
POA_MIN_WM2, POA_CSI_MAX, POA_JUDGE_WM2 = -10.0, 1.5, 200.0
CLIP_EXEMPT_FRAC = 0.9
TEMP_LIMITS_C = (-35.0, 50.0)
SENTINELS = (-999.0, -9999.0)
CSV_SENTINELS = (-1000000.0, -999.0, -9999.0)
FLAG_PASSES = 12
GOLD_WEIGHT = 5.0
BASELINE_WINDOW, BASELINE_MIN = 30, 5

# --- fixed values: training columns, in export order ------------------------
FEATURE_COLUMNS = [
    "pi_rel", "csr", "model_csr", "chop",
    "plateau_run_h", "peak_frac", "expected_peak_frac", "dead_run_h",
    "morning_ratio", "midday_ratio", "tmax_c", "temp_corr",
    "snow_3d", "snow_7d", "snow_30d",
    "pi_slope_14d", "pi_drop_share",
    "unit_count", "unit_dist",
    "doy_sin", "doy_cos",
]
DAILY_FEATURES = ["pi", "coverage", "rain_mm"]
MODEL_FEATURES = FEATURE_COLUMNS + DAILY_FEATURES
TRAINING_COLUMNS = [
    "site", "actual_kwh", "expected_kwh", "pi", "pi_baseline", "coverage",
    "rain_mm", "snow_cm", "flagged", *FEATURE_COLUMNS, "rule_label",
    "final_label", "final_label_2", "verdict", "provenance", "evidence",
]
# ----------------------------------------------------------------------------

INTERVAL = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("ts_utc", T.TimestampType()),
    T.StructField("local_ts", T.TimestampNTZType()),
    T.StructField("local_date", T.DateType()),
    T.StructField("ac_power_kw", T.DoubleType()),
    T.StructField("poa_wm2", T.DoubleType()),
    T.StructField("temp_c", T.DoubleType()),
])
MODELLED = ["expected_kw", "clearsky_kw", "rain_mm", "snow_cm"]

INVERTER = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("ts_utc", T.TimestampType()),
    T.StructField("local_ts", T.TimestampNTZType()),
    T.StructField("local_date", T.DateType()),
    T.StructField("inverter", T.StringType()),
    T.StructField("kw", T.DoubleType()),
])

LAKE = T.StructType([
    T.StructField("measured_on", T.TimestampNTZType()),
    T.StructField("metric_id", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
])

TRAINING = T.StructType(
    [T.StructField("date", T.DateType())]
    + [
        T.StructField(
            c,
            T.BooleanType() if c == "flagged"
            else T.StringType()
            if c in ("site", "rule_label", "final_label", "final_label_2",
                     "verdict", "provenance", "evidence")
            else T.DoubleType(),
        )
        for c in TRAINING_COLUMNS
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: casts, and pads absent columns with NULL.

    NaN becomes NULL here, so nothing downstream ever sees NaN (P23, P27).
    """
    have = set(df.columns)
    out = []
    for field in schema:
        if field.name not in have:
            col = F.lit(None).cast(field.dataType)
        else:
            col = F.col(field.name).cast(field.dataType)
            if isinstance(field.dataType, T.DoubleType):
                col = nan_to_null(col)
        out.append(col.alias(field.name))
    return df.select(*out)


def nan_to_null(col):
    return F.when(~F.isnan(col), col)
