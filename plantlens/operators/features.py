"""Feature vector and training table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.physics import per_hour, unit_count, unit_distance
from ..schema import (
    BRIGHT_FRAC, FEATURE_COLUMNS, GOLD_VERDICTS, HEALTHY, MIN_RATIO_HOURS,
    TRAINING_COLUMNS,
)


def day_features(days: DataFrame) -> DataFrame:
    """The 21 feature columns from the day table; NULL means not measurable."""
    c = F.col
    angle = F.lit(2 * math.pi / 365.25) * F.dayofyear("local_date")
    seen = F.coalesce(c("n_rows") > 0, F.lit(False))
    on = lambda col: F.when(seen, col)
    per = per_hour(c("interval_min"))
    units = F.when(
        (c("n_units") > 1) & (c("bright_rows") > 0),
        unit_count(c("bright_deficit"), c("ac_kw"), c("n_units")),
    )
    features = {
        "doy_sin": F.sin(angle),
        "doy_cos": F.cos(angle),
        "pi_rel": F.when(c("pi_baseline") > 0, c("pi") / c("pi_baseline")),
        "pi_slope_14d": c("trend_slope"),
        "pi_drop_share": F.when(
            c("trend_total") > 0, F.try_divide("trend_drop1", "trend_total")
        ),
        "plateau_run_h": on(c("plateau_run") / per),
        "peak_frac": on(c("peak") / c("ac_kw")),
        "expected_peak_frac": on(c("midday_expected") / c("ac_kw")),
        "dead_run_h": on(c("dead_run") / per),
        "tmax_c": on(c("tmax")),
        "unit_count": on(units),
        "unit_dist": on(unit_distance(units)),
    }
    return days.withColumns(features)


def training_frame(days: DataFrame) -> DataFrame:
    """Resolved day table -> the fixed export schema, every day included."""
    gold = F.coalesce(F.col("verdict").isin(*GOLD_VERDICTS), F.lit(False))
    blank = lambda name: F.coalesce(F.col(name), F.lit(""))
    out = day_features(days).withColumns({
        "site": F.col("site_id"),
        "date": F.col("local_date"),
        "rule_label": F.coalesce("label", F.lit(HEALTHY)),
        "final_label": F.coalesce("final_label", F.lit(HEALTHY)),
        "final_label_2": blank("final_label_2"),
        "provenance": F.when(gold, F.lit("referee")).otherwise(F.lit("rule")),
        "verdict": blank("verdict"),
        "evidence": blank("final_evidence"),
    })
    return out.select("date", *TRAINING_COLUMNS)
