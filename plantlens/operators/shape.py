"""Day-shape measurements over the interval curve.

Everything the rules, the referee and the feature vector read about a day's
curve is computed once here. The interval rows are sorted once, by (site, day,
stamp), and shuffled only if they are not dealt by site and day already; tasks go
through their sorted rows batch by batch, whole days at a time, and measure all
days of a batch together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import within
from ..schema import (
    BRIGHT_FRAC, DEAD_FRAC, LATE_WINDOW, LIT_FRAC, MIDDAY_WINDOW,
    MIN_RATIO_HOURS, MORNING_WINDOW, PLATEAU_FRAC,
)
from .align import attach_sites
from .history import by_day, whole_days

_MEASURES = ["_ac", "_expected", "rain_mm", "snow_cm", "_both_ac", "_both_expected", "_clear",
             "peak", "midday_expected", "tmax", "chop", "morning_ratio", "midday_ratio",
             "bright_deficit", "_corr"]
_COUNTS = ["_seen", "n_rows", "bright_rows", "ratio_hours"]
_RUNS = ["plateau_run", "dead_run"]
_FLAGS = ["lit", "bright", "midday", "dead", "morning", "late"]


def _measure(day, hour, col, flag) -> dict:
    """Measurements of the days numbered by ``day`` (ascending, from 0), by name.

    ``col`` has (values, known) of each reading, ``flag`` its booleans, both in
    the order of stamps. An unknown measurement is a masked entry.
    """
    import numpy as np

    n = int(day[-1]) + 1
    first = np.flatnonzero(np.r_[True, day[1:] != day[:-1]])
    out = {}

    def total(values, known, seg=day, size=n):
        return np.bincount(seg, np.where(known, values, 0.0), size), np.bincount(seg, known, size)

    def masked(values, known):
        return np.ma.MaskedArray(values, ~known)

    def over(a, b, known):
        known = known & (b != 0)
        return np.divide(a, b, out=np.zeros(len(a)), where=known), known

    def top(values, known):
        most = np.maximum.reduceat(np.where(known, values, -np.inf), first)
        return masked(most, np.add.reduceat(known.astype(int), first) > 0)

    def median(values, seg):
        values = values[np.lexsort((values, seg))]
        size = np.bincount(seg, minlength=n)
        start, some = np.cumsum(size) - size, size > 0
        mid = np.zeros(n)
        mid[some] = (values[(start + (size - 1) // 2)[some]] + values[(start + size // 2)[some]]) / 2.0
        return masked(mid, some)

    def longest(seg, test):
        most, at = np.zeros(n, int), np.arange(len(seg))
        if len(seg):
            opens = np.r_[True, seg[1:] != seg[:-1]]
            before = np.maximum.accumulate(np.where(test, np.where(opens, at - 1, -1), at))
            heads = np.flatnonzero(opens)
            most[seg[heads]] = np.maximum.reduceat(at - before, heads)
        return most

    ac, expected = col["ac"], col["expected"]
    both = ac[1] & expected[1]
    for name, (values, known) in {
        "_ac": ac, "_expected": expected, "rain_mm": col["rain"], "snow_cm": col["snow"], "_clear": col["clear"],
        "_both_ac": (ac[0], both), "_both_expected": (expected[0], both),
    }.items():
        sums, seen = total(values, known)
        out[name] = masked(sums, seen > 0)
    for name, known in {"_seen": both, "n_rows": np.ones(len(day), bool), "bright_rows": flag["bright"]}.items():
        out[name] = np.bincount(day[known], minlength=n)
    out["peak"], out["tmax"] = top(*ac), top(*col["temp"])
    out["midday_expected"] = top(expected[0], expected[1] & flag["midday"])

    # hours of a day: mean power over mean expected power, and mean temperature
    order = np.lexsort((hour, day))
    opens = np.r_[True, (day[order][1:] != day[order][:-1]) | (hour[order][1:] != hour[order][:-1])]
    slot = np.empty(len(day), int)
    slot[order] = np.cumsum(opens) - 1
    of, m = day[order][opens], int(opens.sum())
    mean = lambda pair, also: over(*(lambda t: (t[0], t[1], t[1] > 0))(total(pair[0], pair[1] & also, slot, m)))
    (power, lit), (model, due) = mean(ac, flag["lit"]), mean(expected, flag["lit"])
    temp, warm = mean(col["temp"], True)
    ratio, known = over(power, model, lit & due)
    out["ratio_hours"] = np.bincount(of[known], minlength=n)
    r, seg = ratio[known], of[known]
    step, same = np.abs(np.diff(r)), seg[1:] == seg[:-1]
    out["chop"] = median(step[same], seg[1:][same]).filled(0.0)

    # moments about the day's first pair, so that a constant series has none
    pair = known & warm
    x, y, seg = ratio[pair], temp[pair], of[pair]
    size = np.bincount(seg, minlength=n)
    start = np.minimum(np.cumsum(size) - size, max(len(seg) - 1, 0))
    mean_of = lambda v: np.bincount(seg, v, n) / np.maximum(size, 1)
    if len(seg):
        x, y = x - x[start][seg], y - y[start][seg]
    x, y = x - mean_of(x)[seg], y - mean_of(y)[seg]
    spread = np.sqrt(mean_of(x * x)) * np.sqrt(mean_of(y * y))
    out["_corr"] = masked(*over(mean_of(x * y), spread, size > 0))

    noon = flag["midday"]
    bar = PLATEAU_FRAC * out["peak"].filled(0.0)[day]
    out["plateau_run"] = longest(day[noon], (ac[1] & ((ac[0] > bar) | (np.isnan(ac[0]) & ~np.isnan(bar))))[noon])
    out["dead_run"] = longest(day, flag["dead"])
    share, seen = over(ac[0], expected[0], both & flag["lit"])
    for name, test in (("morning_ratio", "morning"), ("midday_ratio", "late")):
        out[name] = median(share[seen & flag[test]], day[seen & flag[test]])
    bright = both & flag["bright"]
    out["bright_deficit"] = median((expected[0] - ac[0])[bright], day[bright])
    return out


def _measure_days(batches):
    """Sorted interval rows -> day rows."""
    import numpy as np
    import pyarrow as pa

    def done(rows, heads):
        plain = {c: rows[c].combine_chunks() for c in rows.column_names}
        bits = np.asarray(plain["flags"])
        flag = {c: (bits >> k) & 1 == 1 for k, c in enumerate(_FLAGS)}
        col = {c: (np.asarray(plain[c].fill_null(0.0)), np.asarray(plain[c].is_valid()))
               for c in ("ac", "expected", "clear", "temp", "rain", "snow")}
        day = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, rows.num_rows]))
        out = _measure(day, np.asarray(plain["hour"].fill_null(np.iinfo(np.int64).min)), col, flag)
        arrays = [plain["site_id"].take(pa.array(heads)), plain["local_date"].take(pa.array(heads))]
        for name in _MEASURES:
            values = np.ma.MaskedArray(out[name])
            arrays.append(pa.array(values.data, pa.float64(), mask=np.ma.getmaskarray(values)))
        arrays += [pa.array(out[c], pa.int64()) for c in _COUNTS] + [pa.array(out[c], pa.int32()) for c in _RUNS]
        return pa.RecordBatch.from_arrays(arrays, ["site_id", "local_date", *_MEASURES, *_COUNTS, *_RUNS])

    for rows, heads in whole_days(batches):
        yield done(rows, heads)


def day_shape(interval: DataFrame, sites: DataFrame) -> DataFrame:
    """One row per (site, day) with rows: daily sums and shape measurements."""
    no = F.lit(False)
    number = lambda name: F.col(name).cast("double")
    ac, expected, local = number("ac_power_kw"), number("expected_kw"), F.col("local_ts")
    df = attach_sites(interval, sites, ["dc_kw", "ac_kw"], spread="local_date").withColumns({
        "_lit": F.coalesce(expected > LIT_FRAC * F.col("dc_kw"), no),
        "_bright": F.coalesce(expected > BRIGHT_FRAC * F.col("ac_kw"), no),
        "midday": within(local, MIDDAY_WINDOW),
    }).withColumn("dead", F.coalesce(ac < DEAD_FRAC * expected, no) & F.col("_lit"))
    points = df.select(
        "site_id", "local_date", "ts_utc",
        (F.unix_timestamp("ts_utc") - F.minute("local_ts") * 60 - F.second("local_ts")).alias("hour"),
        ac.alias("ac"), expected.alias("expected"), number("clearsky_kw").alias("clear"), number("temp_c").alias("temp"),
        number("rain_mm").alias("rain"), number("snow_cm").alias("snow"),
        sum(F.coalesce(test, no).cast("int") * 2**k for k, test in enumerate([
            F.col("_lit"), F.col("_bright"), F.col("midday"), F.col("dead"), within(local, MORNING_WINDOW), within(local, LATE_WINDOW),
        ])).alias("flags"),
        "midday", "dead",
    )
    # readings of one stamp stand in the order of what the runs see of them
    tie = [F.col("midday"), F.when(F.col("midday"), F.col("ac")), F.col("dead")]
    points = by_day(points, tie)
    kinds = {c: "double" for c in _MEASURES} | {c: "long" for c in _COUNTS} | {c: "int" for c in _RUNS}
    keys = ", ".join(f"{c} {points.schema[c].dataType.simpleString()}" for c in ("site_id", "local_date"))
    days = points.drop("ts_utc", "midday", "dead").mapInArrow(_measure_days, ", ".join([keys, *(f"{c} {kinds[c]}" for c in kinds)]))
    zero = F.lit(0.0)
    ceiling = F.when(F.col("_clear") > 0, F.col("_clear"))
    return days.select(
        "site_id", "local_date", "_ac", "_expected", "_seen", "rain_mm", "snow_cm", "_both_ac", "_both_expected",
        "n_rows", "bright_rows", "peak", "midday_expected", "tmax", "ratio_hours",
        (F.coalesce("_ac", zero) / ceiling).alias("csr"), (F.coalesce("_expected", zero) / ceiling).alias("model_csr"),
        "chop", "plateau_run", "dead_run", "morning_ratio", "midday_ratio", "bright_deficit",
        F.when(F.col("ratio_hours") >= MIN_RATIO_HOURS, F.col("_corr")).alias("temp_corr"),
    )


SHAPE_COLUMNS = [
    "csr", "model_csr", "chop", "plateau_run", "dead_run", "morning_ratio", "midday_ratio",
    "bright_deficit", "bright_rows", "ratio_hours", "temp_corr", "n_rows", "peak",
    "midday_expected", "tmax",
]
