"""Day roll-up, rolling baseline and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FLAG_PASSES
from .align import attach_sites, fill_days
from .history import column, medians, over_history, past


def daily_aggregates() -> list[Column]:
    """Per-day sums, before scaling to energy (A4a-A4d)."""
    both = F.col("ac_power_kw").isNotNull() & F.col("expected_kw").isNotNull()
    return [
        F.sum("ac_power_kw").alias("_ac"),
        F.sum("expected_kw").alias("_expected"),
        F.count_if(both).alias("_seen"),
        F.sum("rain_mm").alias("rain_mm"),
        F.sum("snow_cm").alias("snow_cm"),
        F.sum(F.when(both, F.col("ac_power_kw"))).alias("_both_ac"),
        F.sum(F.when(both, F.col("expected_kw"))).alias("_both_expected"),
    ]


def finish_daily(daily: DataFrame) -> DataFrame:
    """Dense calendar, then energy, coverage and performance index.

    Needs ``interval_min``. The coverage denominator is the nominal day length,
    also on the two clock-change days.
    """
    hours = F.col("interval_min") / 60.0
    shaped = daily.withColumns({
        "actual_kwh": F.col("_ac") * hours,
        "expected_kwh": F.col("_expected") * hours,
        "coverage": F.col("_seen") / (1440.0 / F.col("interval_min")),
        "pi": F.when(
            F.col("_both_expected") > 0, F.try_divide("_both_ac", "_both_expected")
        ),
    }).drop("_ac", "_expected", "_seen", "_both_ac", "_both_expected", "interval_min")
    return fill_days(shaped).withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))


def build_daily(interval: DataFrame, sites: DataFrame) -> DataFrame:
    """Interval frame -> one row per site and calendar day (A4)."""
    sums = interval.groupBy("site_id", "local_date").agg(*daily_aggregates())
    return finish_daily(attach_sites(sums, sites, ["interval_min"]))


def clamp_stamps(interval: DataFrame, sites: DataFrame) -> DataFrame:
    """Drop rows outside a site's known span, before any spine is built."""
    bound = attach_sites(interval, sites, ["stamp_start", "stamp_end"], spread="local_date")
    return bound.where(_inside("local_date", "stamp_start", "stamp_end")).drop(
        "stamp_start", "stamp_end"
    )


def report_window(daily: DataFrame, sites: DataFrame) -> DataFrame:
    """Restrict to the reporting span; the baseline starts cold there."""
    bound = attach_sites(daily, sites, ["report_start", "report_end"])
    return bound.where(_inside("local_date", "report_start", "report_end")).drop(
        "report_start", "report_end"
    )


def _inside(day: str, lo: str, hi: str) -> Column:
    return (F.col(lo).isNull() | (F.col(day) >= F.col(lo))) & (
        F.col(hi).isNull() | (F.col(day) <= F.col(hi))
    )


def add_flags(daily: DataFrame, windows: tuple[int, ...] = (30,), passes: int = FLAG_PASSES) -> DataFrame:
    """Self-excluding rolling baseline and the flags derived from it.

    Needs ``coverage_min, flag_threshold, pi_ceiling, window_days``. ``windows``
    are the lengths in use: each has its window, of which a row takes the one of
    its ``window_days``; any other length is an error. All passes
    go over one plant's days in a task, so the whole fixpoint is a single
    shuffle of day rows; a pass after convergence changes nothing, so they end
    there. One row per site and calendar day bounds a plant's days by the length
    of its history.
    """
    lengths = sorted(set(windows))
    known = F.col("window_days").isin(lengths) | F.raise_error(
        F.concat(F.lit("window_days not among the windows in use: "), F.col("window_days"))
    ).cast("boolean")

    def baseline(rows):
        import numpy as np

        pi, threshold, own = (column(rows, c) for c in ("pi", "flag_threshold", "window_days"))
        low, days = np.zeros(len(pi), bool), np.arange(len(pi))
        for _ in range(passes):
            usable, median = np.where(low, np.nan, pi), np.full(len(pi), np.nan)
            for n in lengths:
                # days without a value count as days of the window
                middle, seen = medians(past(usable, n))
                mine = own == n if len(lengths) > 1 else True
                median = np.where(mine & (seen >= n // 2), middle, median)
            last = np.maximum.accumulate(np.where(np.isnan(median), -1, days))
            base = np.where(last >= 0, median[np.maximum(last, 0)], np.nan)
            was, low = low, pi < threshold * base
            if (was == low).all():
                break
        return np.ma.masked_invalid(base), low

    out = over_history(
        daily.withColumn("pi", F.when(known & (F.col("coverage") >= F.col("coverage_min")), F.col("pi"))),
        ["site_id"], "pi_baseline double, _low boolean", baseline)
    flagged = (F.col("_low") & (F.col("pi") < F.col("pi_ceiling"))) | (
        F.col("coverage") < F.col("coverage_min")
    )
    return out.withColumn("flagged", F.coalesce(flagged, F.lit(False))).drop("_low")
