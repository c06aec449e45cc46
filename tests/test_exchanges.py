"""What large inputs rest on: exchanges of readings, and methods that the JVM compiles."""

import re
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from helpers import interval, site
from plantlens.functions.physics import _sky
from plantlens.operators import quality
from plantlens.operators.referee import inverter_daily
from plantlens.operators.shape import day_shape
from plantlens.plans import catalog, views
from plantlens.plans.canonical import with_clearsky


def _plan(df, mode="formatted"):
    spark = df.sparkSession
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        return spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(again._jdf.queryExecution(), mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)


def _exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning\(site_id#\d+, local_date#\d+", _plan(df, "simple")))


def _readings(spark, days=3):
    return interval(spark, [(d, h * 60, {"ac_power_kw": 5.0 + (h * 7 + d) % 11, "expected_kw": 20.0, "temp_c": 10.0 + h})
                            for d in range(days) for h in range(24)])


def test_dealt_readings_are_not_shuffled_again(spark):
    dealt = _readings(spark).repartition("site_id", "local_date")
    assert _exchanges(day_shape(dealt, site(spark))) == 1
    kwh = dealt.select("site_id", "local_date", F.lit("inv_01").alias("inverter"), F.col("ac_power_kw").alias("kw"))
    plan = _plan(inverter_daily(kwh, site(spark)), "simple")
    assert len(re.findall(r"Exchange hashpartitioning\(site_id", plan)) <= 3  # readings, sites, day rows


def test_undealt_readings_meet_by_day(spark):
    rows = _readings(spark, 40).repartition(4)
    shape = day_shape(rows, site(spark))
    assert shape.count() == 40
    assert [r["n_rows"] for r in shape.select("n_rows").collect()] == [24] * 40


def test_calendar_ends_of_inverters(spark):
    d = lambda n: date(2024, 1, 1) + timedelta(days=n)
    rows = [("s", "a", d(0), 4.0), ("s", "a", d(4), 8.0), ("s", "b", d(2), 6.0), (None, "c", d(1), 1.0), (None, "d", d(3), 1.0)]
    kwh = inverter_daily(spark.createDataFrame(rows, "site_id string, inverter string, local_date date, kw double"), site(spark))
    found = {(r["site_id"], r["inverter"], (r["local_date"] - d(0)).days): r["kwh"] for r in kwh.collect()}
    assert {k: v for k, v in found.items() if k[0]} == {
        **{("s", "a", n): {0: 4.0, 4: 8.0}.get(n, 0.0) for n in range(5)},
        **{("s", "b", n): 6.0 if n == 2 else 0.0 for n in range(5)}}
    assert sorted(k[1:] for k in found if not k[0]) == [("c", 1), ("d", 3)]


def test_runs_over_short_and_silent_days(spark):
    # flat from the last readings of one day, over a day of two and a silent one, to the first of the next
    values = [(0, 22, 3.0), (0, 23, 7.0), (1, 5, 7.0), (1, 6, 7.0), (3, 1, 7.0), (3, 2, 7.0), (3, 3, None), (3, 4, 9.0), (3, 5, 1.0)]
    rows = interval(spark, [(d, h * 60, {"ac_power_kw": v}) for d, h, v in values])
    of = lambda: [r["st"] for r in quality.mark_runs(rows, "ac_power_kw", "st").orderBy("ts_utc").collect()]
    assert of() == [False] * 9  # five in a row
    rows = interval(spark, [(d, h * 60, {"ac_power_kw": 7.0 if h == 22 else v}) for d, h, v in values])
    assert of() == [False, True, True, True, True, True, False, False, False]


def test_long_days_do_not_join_over_their_middle(spark):
    hours = [7.0] * 3 + [float(h * h) for h in range(18)] + [7.0] * 3
    rows = interval(spark, [(0, h * 60, {"ac_power_kw": v}) for h, v in enumerate(hours)] +
                    [(1, h * 60, {"ac_power_kw": v}) for h, v in enumerate(hours)])
    marked = quality.mark_runs(rows, "ac_power_kw", "st").where("st").orderBy("ts_utc").collect()
    assert [r["ts_utc"] for r in marked] == [datetime(2024, 1, 1, 22), datetime(2024, 1, 1, 23), *(datetime(2024, 1, 2, h) for h in range(3))]


def test_clear_sky_is_compiled_and_null_safe(spark):
    rows = _readings(spark)
    df = with_clearsky(rows, site(spark, lat=35.0, lon=0.0, tilt=25.0, azimuth=180.0))
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", _plan(df, "codegen"))]
    assert max(sizes) < 8000  # longer methods are interpreted
    noon = df.where(F.hour("ts_utc") == 12).first()["clearsky_wm2"]
    assert abs(noon - float(_sky(1.0, 720.0, 35.0, 0.0, 25.0, 180.0, 0.12, 0.25))) < 50  # the first days of a year
    bare = with_clearsky(rows, site(spark, lat=None, lon=0.0, tilt=25.0, azimuth=180.0))
    assert bare.where("clearsky_wm2 is not null").count() == 0


def test_channel_lake_is_summed_before_it_meets_names(spark, tmp_path, monkeypatch):
    path = tmp_path / "wide"
    path.mkdir()
    (path / "a.csv").write_text("measured_on,meter,temp\n2024-01-01 01:00:00,1,2\n2024-01-01 02:00:00,3,4\n")
    monkeypatch.setattr(views, "land_channel_csvs", lambda spark, sf, root: [f"file:{path}/a.csv"])
    out = catalog.csv_lake(spark, "")
    plan = _plan(out, "simple")
    assert re.search(r"Join[^\n]*metric_id", plan) and plan.index("Join") < plan.index("HashAggregate")
    assert sorted((r["name"], r["year"], r["n"], r["total"]) for r in out.collect()) == [
        ("meter", 2024, 2, 4.0), ("temp", 2024, 2, 6.0)]
