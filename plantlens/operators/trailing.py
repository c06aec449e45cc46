"""Trailing context of a day (W4-W6, L2, L3), in one pass over a plant's days."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schema import TREND_DAYS, TREND_MIN
from .history import column, medians, over_history, past

SNOW_DAYS = (3, 7, 30)


def snow_trails(rows) -> list:
    """Snowfall of the last 3, 7 and 30 days, today included; NULL days count 0.

    Needs ``has_met``: a plant without weather data keeps NULL.
    """
    import numpy as np

    snow, met = np.nan_to_num(column(rows, "snow_cm")), column(rows, "has_met") == 1
    out = []
    for n in SNOW_DAYS:
        total = np.zeros(len(snow))
        for back in range(min(n, len(snow)) - 1, -1, -1):
            total[back:] += snow[: len(snow) - back]
        out.append(np.ma.MaskedArray(total, ~met))
    return out


def pi_step(rows) -> list:
    """Three days in a row below today's own baseline threshold (W5), and their median."""
    import numpy as np

    pi = column(rows, "pi")
    last3 = np.c_[past(pi, 2), pi]
    # the highest of three is NaN where one is unknown, and below nothing
    below = last3.max(axis=1) < column(rows, "flag_threshold") * column(rows, "pi_baseline")
    return [below, np.ma.masked_invalid(medians(last3)[0])]


def pi_trend(rows) -> list:
    """Number, slope and falls of the last 14 measured PIs strictly before today."""
    import numpy as np

    pi = column(rows, "pi")
    seen = ~np.isnan(pi)
    measured, before = pi[seen], np.cumsum(seen) - seen
    n = np.minimum(before, TREND_DAYS)
    slope, total, drop1, drop2 = (np.full(len(pi), np.nan) for _ in range(4))
    for k in range(max(TREND_MIN, 1), TREND_DAYS + 1):
        at = np.flatnonzero(n == k)
        if not len(at):
            continue
        trail = measured[before[at][:, None] - k + np.arange(k)]
        mid = (k - 1) / 2
        slope[at] = sum((i - mid) * trail[:, i] for i in range(k)) / (k * (k * k - 1) / 12)
        total[at] = trail[:, 0] - trail[:, -1]
        falls = np.sort(np.diff(trail, axis=1), axis=1)
        drop1[at], drop2[at] = -falls[:, 0], -(falls[:, 0] + falls[:, 1])
    return [n, *map(np.ma.masked_invalid, (slope, total, drop1, drop2))]


def trailing_context(daily: DataFrame) -> DataFrame:
    added = [f"snow_{n}d double" for n in SNOW_DAYS] + ["step3 boolean", "step3_median double", "trend_n int"]
    added += [f"trend_{c} double" for c in ("slope", "total", "drop1", "drop2")]
    measure = lambda rows: [*snow_trails(rows), *pi_step(rows), *pi_trend(rows)]
    return over_history(daily, ["site_id"], ", ".join(added), measure)
