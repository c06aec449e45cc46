"""Days and histories measured batch by batch: same results, and no per-element work in the plan."""

import random
import statistics

import pytest
from helpers import daily, interval, site, with_facts
from pyspark.sql import functions as F

from plantlens.operators.daily import add_flags
from plantlens.operators.referee import daily_divergence
from plantlens.operators.shape import day_shape
from plantlens.operators.trailing import trailing_context


def plan_of(df):
    return df._jdf.queryExecution().toString()


def readings(spark):
    rnd = random.Random(3)
    rows = []
    for d in range(12):
        for h in range(24):
            for minute in (0, 30):
                lit = 6 <= h <= 18
                values = {"ac_power_kw": rnd.uniform(1, 70) if lit and rnd.random() > 0.1 else None,
                          "expected_kw": rnd.uniform(30, 80) if lit else 0.0, "clearsky_kw": 85.0 if lit else 0.0,
                          "temp_c": rnd.uniform(0, 40) if d % 3 else 7.3, "rain_mm": 0.1 if d % 2 else None}
                rows.append((d, 60 * h + minute, values))
    rows += rows[30:34]  # readings that come twice
    return rows


def test_days_do_not_depend_on_where_batches_end(spark):
    rows = readings(spark)
    both = interval(spark, rows).unionByName(interval(spark, rows, site_id="u"))
    both = both.unionByName(interval(spark, rows[:5]).withColumn("site_id", F.lit(None).cast("string")))
    sites = site(spark).unionByName(site(spark, site_id="u", ac_kw=60.0))
    take = lambda: day_shape(both, sites).orderBy("site_id", "local_date").collect()
    whole, size = take(), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        assert take() == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert len(whole) == 25 and whole[0]["site_id"] is None and whole[0]["n_rows"] == 5


def test_shape_matches_plain_python(spark):
    rows = readings(spark)
    got = {r["local_date"].day - 1: r for r in day_shape(interval(spark, rows), site(spark)).collect()}
    for d in range(12):
        day = sorted(((m, v) for n, m, v in rows if n == d), key=lambda x: x[0])
        known = [(v["ac_power_kw"], v["expected_kw"]) for _, v in day if v["ac_power_kw"] is not None]
        assert got[d]["_ac"] == pytest.approx(sum(a for a, _ in known)) and got[d]["_seen"] == len(known)
        assert got[d]["peak"] == max(a for a, _ in known) and got[d]["n_rows"] == len(day)
        noon = [v["ac_power_kw"] / v["expected_kw"] for m, v in day if 660 <= m <= 840 and v["ac_power_kw"] is not None]
        assert got[d]["midday_ratio"] == pytest.approx(statistics.median(noon))
        deficit = [v["expected_kw"] - v["ac_power_kw"] for _, v in day if v["expected_kw"] > 40 and v["ac_power_kw"] is not None]
        assert got[d]["bright_deficit"] == pytest.approx(statistics.median(deficit))
        hours = {}
        for m, v in day:
            hours.setdefault(m // 60, []).append(v)
        ratio = []
        for h in sorted(hours):
            lit = [v for v in hours[h] if v["expected_kw"] > 20]
            power = [v["ac_power_kw"] for v in lit if v["ac_power_kw"] is not None]
            if power:
                ratio.append(statistics.fmean(power) / statistics.fmean(v["expected_kw"] for v in lit))
        assert got[d]["ratio_hours"] == len(ratio)
        assert got[d]["chop"] == pytest.approx(statistics.median(abs(b - a) for a, b in zip(ratio, ratio[1:])))
        # a constant temperature correlates with nothing
        assert (got[d]["temp_corr"] is None) == (d % 3 == 0) and got[d]["rain_mm"] == (pytest.approx(0.1 * len(day)) if d % 2 else None)


def test_plans_hold_no_window_pass_and_no_array_per_row(spark):
    """Each of 12 passes was a window over arrays, each day a chain of array functions."""
    sites = site(spark)
    flags = add_flags(with_facts(daily(spark, [1.0] * 40, snow_cm=[0.0] * 40), sites))
    assert "Window" not in plan_of(flags) and "Window" not in plan_of(trailing_context(flags))
    shape = plan_of(day_shape(interval(spark, readings(spark)), sites))
    assert "collect_list" not in shape and "lambdafunction" not in shape


def test_trailing_norm_of_an_inverter(spark):
    from datetime import date, timedelta

    rnd = random.Random(1)
    kwh = {f"inv_{k}": [rnd.choice([0.0, 5.0, 7.0, None, 9.0]) for _ in range(45)] for k in range(3)}
    rows = [("s", k, date(2024, 1, 1) + timedelta(days=i), v) for k, day in kwh.items() for i, v in enumerate(day)]
    df = spark.createDataFrame(rows, "site_id string, inverter string, local_date date, kwh double")
    got = [r["fleet_median"] for r in daily_divergence(df).orderBy("local_date").collect()]
    for i in range(45):
        norms = []
        for day in kwh.values():
            past = [v for v in day[max(0, i - 30):i] if v is not None]
            trail = statistics.median(past) if len(past) >= 10 else None
            if day[i] is not None and trail is not None and (trail or day[i]):
                norms.append(day[i] / trail if trail else float("inf"))
        assert got[i] == (pytest.approx(statistics.median(norms)) if norms else None)
