"""Literal fixtures shared by the tests."""

from datetime import date, datetime, timedelta

from plantlens.operators.rules import label_days
from plantlens.plans.diagnose import DAY_FACTS, attach_sites
from plantlens.sites import site_dim

DAY0 = date(2024, 1, 1)
INTERVAL_SCHEMA = (
    "site_id string, ts_utc timestamp, local_ts timestamp_ntz, local_date date, ac_power_kw double, "
    "poa_wm2 double, temp_c double, expected_kw double, clearsky_kw double, rain_mm double, snow_cm double"
)


def site(spark, **over):
    return site_dim(spark, [{"site_id": "s", "dc_kw": 100.0, "ac_kw": 80.0, "interval_min": 60, **over}])


def interval(spark, rows, site_id="s", step=60):
    """rows: list of (day number, minute of the label, {column: value})."""
    names = ("ac_power_kw", "poa_wm2", "temp_c", "expected_kw", "clearsky_kw", "rain_mm", "snow_cm")
    out = []
    for day, minute, values in rows:
        ts = datetime(2024, 1, 1) + timedelta(days=day, minutes=minute)
        out.append((site_id, ts, ts, ts.date(), *[values.get(n) for n in names]))
    return spark.createDataFrame(out, INTERVAL_SCHEMA)


def daily(spark, pis, coverage=None, site_id="s", **cols):
    """Dense daily rows from a list of PIs."""
    rows = []
    for i, pi in enumerate(pis):
        cov = 1.0 if coverage is None else coverage[i]
        rows.append((site_id, DAY0 + timedelta(days=i), pi, cov, 8.0, 8.0 * (pi or 0.0),
                     *[cols[c][i] for c in ("rain_mm", "snow_cm") if c in cols]))
    extra = "".join(f", {c} double" for c in ("rain_mm", "snow_cm") if c in cols)
    df = spark.createDataFrame(
        rows, "site_id string, local_date date, pi double, coverage double, expected_kwh double, "
        "actual_kwh double" + extra)
    from pyspark.sql import functions as F
    for c in ("rain_mm", "snow_cm"):
        if c not in cols:
            df = df.withColumn(c, F.lit(None).cast("double"))
    return df


def with_facts(df, sites):
    return attach_sites(df, sites, DAY_FACTS)


BASE_DAY = {
    "coverage": 1.0, "pi": 0.8, "pi_baseline": 1.0, "flagged": True, "rain_mm": None, "snow_cm": None,
    "snow_3d": None, "snow_7d": None, "snow_30d": None, "step3": False, "step3_median": None,
    "trend_n": 0, "trend_slope": None, "trend_total": None, "trend_drop1": None, "trend_drop2": None,
    "csr": None, "model_csr": None, "chop": 0.0, "plateau_run": 0, "dead_run": 0, "morning_ratio": None,
    "midday_ratio": None, "bright_deficit": None, "bright_rows": 0, "ratio_hours": 0, "temp_corr": None,
    "n_rows": 24, "peak": 50.0, "midday_expected": 60.0, "tmax": None,
}
DAY_SCHEMA = (
    "site_id string, local_date date, coverage double, pi double, pi_baseline double, flagged boolean, "
    "rain_mm double, snow_cm double, snow_3d double, snow_7d double, snow_30d double, step3 boolean, "
    "step3_median double, trend_n int, trend_slope double, trend_total double, trend_drop1 double, "
    "trend_drop2 double, csr double, model_csr double, chop double, plateau_run int, dead_run int, "
    "morning_ratio double, midday_ratio double, bright_deficit double, bright_rows bigint, "
    "ratio_hours bigint, temp_corr double, n_rows bigint, peak double, midday_expected double, tmax double"
)


def judge(spark, days, **facts):
    """Labels of synthetic day rows, one per dict of overrides."""
    rows = [
        ("s", DAY0 + timedelta(days=i), *[{**BASE_DAY, **d}[k] for k in BASE_DAY])
        for i, d in enumerate(days)
    ]
    df = with_facts(spark.createDataFrame(rows, DAY_SCHEMA), site(spark, **facts))
    return label_days(df).orderBy("local_date").collect()
