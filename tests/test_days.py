from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from plantlens.functions.physics import clearsky_poa, expected_kw
from plantlens.operators import quality
from plantlens.operators.daily import add_flags, build_daily, report_window
from plantlens.operators.shape import day_shape
from plantlens.operators.trailing import trailing_context
from plantlens.plans.canonical import build_dataset
from plantlens.schema import INTERVAL, conform
from helpers import DAY0, daily, interval, site, with_facts


def _flags(spark, pis, coverage=None, **over):
    sites = site(spark, **over)
    return add_flags(with_facts(daily(spark, pis, coverage), sites)).orderBy("local_date").collect()


@pytest.mark.parametrize("step", [60, 15])
def test_daily_energy_and_coverage(spark, step):
    rows = [(0, m, {"ac_power_kw": 100.0, "expected_kw": 100.0}) for m in range(0, 1440, step)]
    got = build_daily(interval(spark, rows), site(spark, interval_min=step)).first()
    assert (got["actual_kwh"], got["coverage"], got["pi"]) == (2400.0, 1.0, 1.0)


def test_silent_days_are_rows(spark):
    rows = [(d, 60 * h, {"ac_power_kw": 1.0, "expected_kw": 2.0}) for d in (0, 3) for h in range(24)]
    got = build_daily(interval(spark, rows), site(spark)).orderBy("local_date").collect()
    assert [r["coverage"] for r in got] == [1.0, 0.0, 0.0, 1.0]
    assert got[1]["actual_kwh"] is None and got[1]["pi"] is None


def test_pi_uses_common_intervals(spark):
    rows = [(0, 60 * h, {"ac_power_kw": 10.0, "expected_kw": 10.0 if h < 12 else None}) for h in range(24)]
    got = build_daily(interval(spark, rows), site(spark)).first()
    assert got["pi"] == 1.0 and got["actual_kwh"] == 240.0 and got["coverage"] == 0.5


def test_long_outage_stays_flagged_and_baseline_holds(spark):
    got = _flags(spark, [1.0] * 60 + [0.0] * 45)
    assert not any(r["flagged"] for r in got[:60]) and all(r["flagged"] for r in got[60:])
    assert got[-1]["pi_baseline"] == 1.0


def test_low_coverage_is_flagged_and_masked(spark):
    got = _flags(spark, [1.0] * 40, [1.0] * 35 + [0.5] + [1.0] * 4)
    assert got[35]["flagged"] and got[35]["pi"] is None and sum(r["flagged"] for r in got) == 1


def test_absolute_ceiling_silences_model_bias(spark):
    assert not any(r["flagged"] for r in _flags(spark, [1.3] * 40 + [1.0] * 10))


def test_sites_together_equal_sites_alone(spark):
    a = daily(spark, [1.0] * 30 + [0.5] * 10)
    b = daily(spark, [0.9] * 20 + [0.8] * 20, site_id="t")
    sites = site(spark).unionByName(site(spark).withColumn("site_id", F.lit("t")))
    together = add_flags(with_facts(a.unionByName(b), sites)).where("site_id = 't'")
    alone = add_flags(with_facts(b, sites))
    assert sorted(together.collect()) == sorted(alone.collect())


def test_report_window(spark):
    sites = site(spark, report_start=date(2024, 1, 5), report_end=date(2024, 1, 8))
    assert report_window(daily(spark, [1.0] * 20), sites).count() == 4


def test_trailing_context_matches_plain_python(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    pis = [None if rng.random() < 0.3 else float(v) for v in 1 - 0.01 * np.arange(60) + rng.normal(0, 0.01, 60)]
    df = with_facts(daily(spark, pis, snow_cm=[float(i % 5 == 0) for i in range(60)]), site(spark, has_met=True))
    got = trailing_context(df.withColumn("pi_baseline", F.lit(1.0))).orderBy("local_date").collect()
    for i, r in enumerate(got):
        trail = [p for p in pis[:i] if p is not None][-14:]
        assert r["trend_n"] == len(trail)
        if len(trail) >= 10:
            d = np.diff(trail)
            assert r["trend_slope"] == pytest.approx(np.polyfit(range(len(trail)), trail, 1)[0])
            assert r["trend_drop2"] == pytest.approx(-np.sort(d)[:2].sum())
        assert r["snow_7d"] == sum(1.0 for j in range(max(0, i - 6), i + 1) if j % 5 == 0)


def test_physics(spark):
    k = lambda p, k: spark.range(1).select(expected_kw(F.lit(p), F.lit(100.0), F.lit(0.8), F.lit(k))).first()[0]
    assert [k(p, 0.0) for p in (0.0, 500.0, 1000.0)] == [0.0, 40.0, 80.0]
    assert k(1000.0, 55.0) == pytest.approx(80.0) and k(50.0, 55.0) < 0.6 * k(50.0, 0.0)
    hours = spark.sql("select explode(sequence(timestamp'2024-06-21', timestamp'2024-06-21 23:00:00', interval 1 hour)) t")
    sun = [r[0] for r in hours.select(clearsky_poa(F.col("t"), F.lit(40.0), F.lit(0.0), F.lit(30.0), F.lit(180.0))).collect()]
    assert sun[0] == 0.0 and 850 < max(sun) < 1150 and sun.index(max(sun)) == 12


def _sensor(spark, values, col="ac_power_kw"):
    rows = [(i // 96, 15 * (i % 96), {col: v}) for i, v in enumerate(values)]
    df = conform(interval(spark, rows), INTERVAL)
    return df.withColumns({"ac_kw": F.lit(200.0), "clearsky_wm2": F.lit(500.0)})


def _brute(x, window=6, diff=False):
    idx = [i for i, v in enumerate(x) if v is not None]
    s = [x[i] for i in idx]
    base = [None] + [b - a for a, b in zip(s, s[1:])] if diff else s
    n = window - 1 if diff else window
    marked = set()
    for e in range(n - 1, len(base)):
        run = base[e - n + 1:e + 1]
        if run[0] is not None and all(abs(v - run[0]) <= 1e-8 + 1e-5 * abs(run[0]) for v in run):
            marked.update(idx[e - window + 2:e + 1])
    return marked


def test_runs_cross_days_like_one_series(spark):
    import random
    rng = random.Random(5)
    x = [None if rng.random() < 0.2 else float(rng.choice([5, 5, 5, 5, 9])) for _ in range(96 * 3)]
    x[90:110] = [7.0] * 20
    x[96 + 40:96 + 60] = [None] * 20
    x[200:210] = [float(i) for i in range(10)]
    out = quality.mark_runs(_sensor(spark, x), "ac_power_kw", "st", "li").orderBy("ts_utc").collect()
    assert {i for i, r in enumerate(out) if r["st"]} == _brute(x)
    assert {i for i, r in enumerate(out) if r["li"]} == _brute(x, diff=True)


def test_gate_spares_zeros_and_the_ceiling(spark):
    import math
    x = [100 + 50 * math.sin(i / 7) for i in range(96)]
    x[10:20], x[40:60], x[70:80] = [0.0] * 10, [55.5] * 20, [199.5] * 10
    marked = quality.quality_marks(_sensor(spark, x), has_poa=False)
    out = quality.apply_gate(marked).orderBy("ts_utc").collect()
    assert all(r["ac_power_kw"] is None for r in out[45:59])
    assert all(r["ac_power_kw"] == 0.0 for r in out[10:20]) and out[75]["ac_power_kw"] == 199.5
    counts = {r["check_name"]: r["n"] for r in quality.quality_counts(marked).collect()}
    assert counts["meter stale"] > 10


def test_irradiance_and_temperature_checks(spark):
    poa = [-296.0] * 2 + [900.0, 100.0, 120.0]
    out = quality.apply_gate(quality.quality_marks(_sensor(spark, poa, "poa_wm2"))).orderBy("ts_utc").collect()
    assert [r["poa_wm2"] for r in out] == [None, None, None, 100.0, 120.0]
    hot = quality.apply_gate(quality.quality_marks(_sensor(spark, [20.0, 87.0], "temp_c"), False)).orderBy("ts_utc")
    assert [r["temp_c"] for r in hot.collect()] == [20.0, None]


def test_night_gaps_become_zero_and_day_gaps_stay(spark):
    sites = site(spark, tz="US/Eastern", lat=39.5, lon=-76.7, tilt=20.0, azimuth=180.0, interval_min=60)
    rows = [(160, 60 * h, {"ac_power_kw": 10.0 + h if 13 <= h <= 21 and h not in (15, 16) else None}) for h in range(24)]
    df, _ = build_dataset(conform(interval(spark, rows), INTERVAL), sites, has_poa=False)
    got = [r["ac_power_kw"] for r in df.orderBy("ts_utc").collect()]
    assert got[5] == 0.0 and got[15] is None and got[14] == 24.0


def test_sensor_ladder_is_per_plant(spark):
    sites = site(spark, lat=39.5, lon=0.0, tilt=20.0, azimuth=180.0, has_poa=True)
    rows = [(160, 60 * h, {"ac_power_kw": 1.0 + h, "poa_wm2": 100.0 + h if h < 12 else None}) for h in range(24)]
    df, _ = build_dataset(conform(interval(spark, rows), INTERVAL), sites, materialize=True)
    got = [r["expected_kw"] for r in df.orderBy("ts_utc").collect()]
    assert got[11] is not None and got[13] is None


def test_shape_of_a_day(spark):
    import math
    rows = []
    for i in range(96):
        bell = max(0.0, math.sin(math.pi * (i / 4 - 6) / 12))
        rows.append((0, 15 * i, {"ac_power_kw": 72 * bell, "expected_kw": 80 * bell, "clearsky_kw": 88 * bell, "temp_c": 20.0}))
    got = day_shape(interval(spark, rows), site(spark, interval_min=15)).first()
    assert got["csr"] == pytest.approx(72 / 88) and got["model_csr"] == pytest.approx(80 / 88)
    assert got["chop"] < 0.02 and got["dead_run"] == 0 and got["temp_corr"] is None
    assert got["morning_ratio"] == pytest.approx(0.9) and got["bright_deficit"] > 0


def test_dead_run_and_plateau(spark):
    rows = [(0, 60 * h, {"ac_power_kw": 0.0 if 9 <= h <= 11 else 50.0, "expected_kw": 80.0}) for h in range(6, 19)]
    got = day_shape(interval(spark, rows), site(spark)).first()
    assert got["dead_run"] == 3 and got["plateau_run"] == 3


def test_each_plant_has_its_own_baseline_window(spark):
    """A plant of window 10 gets its baseline after 5 days, beside one of 30, after 15."""
    days = daily(spark, [1.0] * 40, site_id="t").unionByName(daily(spark, [1.0] * 40, site_id="u"))
    sites = site(spark, site_id="t", window_days=30).unionByName(site(spark, site_id="u", window_days=10))
    both = with_facts(days, sites)
    out = add_flags(both, (10, 30)).where("pi_baseline is null")
    first = {r["site_id"]: r["n"] for r in out.groupBy("site_id").agg(F.count("*").alias("n")).collect()}
    assert first == {"u": 5, "t": 15}
    with pytest.raises(Exception, match="window_days"):
        add_flags(both, (10,)).collect()
