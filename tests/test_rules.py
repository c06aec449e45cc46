from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from plantlens.operators.events import assign_events, events
from plantlens.operators.referee import daily_divergence, inverter_daily, resolve
from plantlens.operators.rules import Rule, day_rules, label_days, precedence
from plantlens.operators.splits import event_split, hash_bucket
from helpers import BASE_DAY, DAY0, daily, judge, site, with_facts

CASES = [
    ({"coverage": 0.5}, {}, "data_gap"),
    ({"snow_3d": 4.0, "snow_7d": 4.0, "snow_30d": 4.0, "pi": 0.1}, {"has_met": True}, "snow"),
    ({"snow_3d": 4.0, "snow_7d": 4.0, "snow_30d": 4.0, "pi": 0.1, "tmax": 20.0}, {"has_met": True}, "unclassified"),
    ({"snow_3d": 0.0, "snow_7d": 2.0, "snow_30d": 2.0, "pi": 0.8, "tmax": 8.0}, {"has_met": True}, "snow_shedding"),
    ({"snow_3d": 4.0, "snow_7d": 4.0, "snow_30d": 4.0, "pi": 0.1}, {"has_met": False}, "unclassified"),
    ({"dead_run": 1}, {}, "outage"),
    ({"dead_run": 3}, {"interval_min": 15}, "unclassified"),
    ({"dead_run": 4}, {"interval_min": 15}, "outage"),
    ({"tmax": 37.0, "ratio_hours": 8, "temp_corr": -0.9, "bright_rows": 5, "bright_deficit": 4.0}, {"n_units": 8}, "thermal"),
    ({"tmax": 37.0, "ratio_hours": 8, "temp_corr": -0.9, "bright_rows": 5, "bright_deficit": 20.0}, {"n_units": 8}, "unclassified"),
    ({"tmax": 37.0, "ratio_hours": 8, "temp_corr": None, "bright_rows": 5}, {}, "unclassified"),
    ({"plateau_run": 2, "peak": 60.0, "midday_expected": 79.0}, {}, "outage"),
    ({"plateau_run": 2, "peak": 60.0, "midday_expected": 70.0}, {}, "unclassified"),
    ({"morning_ratio": 1.2, "midday_ratio": 0.8}, {}, "outage"),
    ({"plateau_run": 3, "peak": 78.0, "midday_expected": 90.0}, {}, "clipping"),
    ({"csr": 0.6, "chop": 0.3}, {}, "weather"),
    ({"csr": 0.6, "chop": 0.3}, {"has_poa": True}, "unclassified"),
    ({"csr": 0.6, "chop": 0.01, "rain_mm": 3.0}, {}, "weather"),
    ({"csr": 0.4, "chop": 0.01, "model_csr": 0.6}, {}, "weather"),
    ({"csr": 0.4, "chop": 0.01, "model_csr": 0.9}, {}, "unclassified"),
    ({"csr": 0.8, "chop": 0.2, "pi": 0.8}, {}, "cloud_intermittent"),
    ({"csr": 0.8, "chop": 0.2, "pi": 0.5}, {}, "unclassified"),
    ({"step3": True, "step3_median": 0.8}, {}, "unclassified"),
    ({"trend_n": 14, "trend_slope": -0.004, "trend_total": 0.052, "trend_drop1": 0.004, "trend_drop2": 0.008}, {}, "soiling"),
    ({"trend_n": 14, "trend_slope": -0.004, "trend_total": 0.052, "trend_drop1": 0.05, "trend_drop2": 0.05}, {}, "unclassified"),
    ({"trend_n": 14, "trend_slope": -0.004, "trend_total": 0.052, "trend_drop1": 0.02, "trend_drop2": 0.04}, {}, "unclassified"),
    ({"flagged": False}, {}, None),
    ({"flagged": False, "plateau_run": 3, "peak": 78.0, "midday_expected": 90.0}, {}, "clipping"),
]


def test_each_rule(spark):
    by_facts = {}
    for day, facts, want in CASES:
        by_facts.setdefault(tuple(sorted(facts.items())), []).append((day, want))
    for facts, cases in by_facts.items():
        got = judge(spark, [d for d, _ in cases], **dict(facts))
        assert [r["label"] for r in got] == [w for _, w in cases], facts


def test_precedence_and_evidence(spark):
    dead_in_rain = {"dead_run": 5, "csr": 0.4, "chop": 0.3, "rain_mm": 9.0}
    got = judge(spark, [dead_in_rain, {"morning_ratio": 1.2, "midday_ratio": 0.8}, {}], n_units=8)
    assert got[0]["label"] == "outage" and "5 consecutive intervals (~5.0h)" in got[0]["evidence"]
    assert got[1]["evidence"].endswith(" ≈ 2 of 8 units out (deficit 1.6 units)")
    assert got[2]["evidence"] == "no rule matched"
    assert precedence(day_rules())[:3] == ["data_gap", "snow", "outage"]


def test_user_rule_is_a_list_entry(spark):
    rows = judge(spark, [{}])
    assert rows[0]["label"] == "unclassified"
    mine = [Rule("custom", F.col("pi") < 0.9, F.lit("mine"))] + day_rules()
    df = spark.createDataFrame([("s", DAY0, *BASE_DAY.values())], __import__("helpers").DAY_SCHEMA)
    assert label_days(with_facts(df, site(spark)), mine).first()["label"] == "custom"


def _events(spark, labels):
    rows = [("s", DAY0 + timedelta(days=i), x, 0.0, f"e{i}") for i, x in enumerate(labels) if x]
    lab = spark.createDataFrame(rows, "site_id string, local_date date, label string, pi double, evidence string")
    cov = [0.1 if x == "data_gap" else 1.0 for x in labels]
    days = with_facts(daily(spark, [0.5] * len(labels), cov), site(spark))
    return [(r["label"], r["days"], r["energy_deficit_kwh"], r["evidence"]) for r in
            events(lab, days).orderBy("event_seq").collect()]


def test_events_merge_split_and_bridge(spark):
    assert _events(spark, ["outage"] * 3) == [("outage", 3, 12.0, "e0")]
    assert _events(spark, ["outage", "data_gap", "outage"]) == [("outage", 3, 8.0, "e0")]
    assert [e[:2] for e in _events(spark, ["outage", None, "outage"])] == [("outage", 1), ("outage", 1)]
    assert [e[:2] for e in _events(spark, ["outage", "data_gap", "soiling"])] == [("outage", 1), ("data_gap", 1), ("soiling", 1)]
    chain = ["outage", "data_gap", "outage", "data_gap", "outage", "snow"]
    assert [e[:2] for e in _events(spark, chain)] == [("outage", 5), ("snow", 1)]


def _fleet(spark, change):
    rows = []
    for d in range(40):
        for k in range(1, 5):
            rows.append(("s", f"inv_{k:02d}", DAY0 + timedelta(days=d), 9.0 * change(d, k)))
    return daily_divergence(spark.createDataFrame(rows, "site_id string, inverter string, local_date date, kwh double"))


def test_divergence(spark):
    got = {r["local_date"]: r for r in _fleet(spark, lambda d, k: 0.0 if (d, k) == (35, 2) else 0.4 if d == 37 else 1.0).collect()}
    day = lambda d: got[DAY0 + timedelta(days=d)]
    assert day(35)["divergent"] == ["inv_02"] and day(35)["div_share"] == pytest.approx(1.0)
    assert day(36)["n_divergent"] == 0 and day(36)["div_share"] is None
    assert day(37)["fleet_median"] == pytest.approx(0.4) and day(37)["n_divergent"] == 0
    assert day(5)["fleet_median"] is None


def test_inverter_calendar_is_the_plants(spark):
    rows = [("s", "a", DAY0, 1.0), ("s", "a", DAY0 + timedelta(days=3), 1.0), ("s", "b", DAY0 + timedelta(days=1), 1.0)]
    inv = spark.createDataFrame(rows, "site_id string, inverter string, local_date date, kw double")
    out = inverter_daily(inv, site(spark))
    assert out.count() == 8 and out.agg(F.sum("kwh")).first()[0] == 3.0


def test_verdict_matrix(spark):
    cases = [  # label, n, share, fleet, extra -> label, label_2, verdict
        ("outage", 1, 0.9, 0.95, {}, ("outage", None, "confirmed")),
        ("outage", 0, 0.0, 0.95, {}, ("outage", None, "refuted")),
        ("outage", 0, None, 0.3, {}, ("outage", None, "confirmed")),
        ("weather", 1, 0.8, 0.9, {}, ("weather", None, "refuted")),
        ("thermal", 1, None, 0.9, {}, ("thermal", None, "confirmed")),
        ("unclassified", 1, 0.8, 0.9, {}, ("outage", None, "attributed")),
        ("unclassified", 0, 0.0, 0.4, {}, ("outage", None, "attributed")),
        ("unclassified", 1, 0.2, 0.9, {"csr": 0.6}, ("weather", "outage", "attributed")),
        ("unclassified", 1, 0.2, 0.9, {"csr": 0.9, "plateau_run": 3, "peak": 60.0}, ("curtailment", "outage", "attributed")),
        ("unclassified", 1, None, 0.9, {}, ("unclassified", None, "uncheckable")),
        ("unclassified", 0, None, 1.0, {"csr": 0.9, "plateau_run": 3, "peak": 60.0}, ("curtailment", None, "attributed")),
        ("soiling", 1, 0.9, 0.9, {}, ("soiling", None, "uncheckable")),
        ("data_gap", None, None, None, {}, ("data_gap", None, "uncheckable")),
    ]
    from helpers import DAY_SCHEMA
    days, refs = [], []
    for i, (label, n, share, fleet, extra, _) in enumerate(cases):
        d = DAY0 + timedelta(days=i)
        days.append(("s", d, *{**BASE_DAY, **extra}.values(), label, "why"))
        refs.append(("s", d, n, share, fleet))
    df = spark.createDataFrame(days, DAY_SCHEMA + ", label string, evidence string")
    ref = spark.createDataFrame(refs, "site_id string, local_date date, n_divergent int, div_share double, fleet_median double")
    got = resolve(with_facts(df, site(spark, has_submeter=True)), ref).orderBy("local_date").collect()
    assert [(r["final_label"], r["final_label_2"], r["verdict"]) for r in got] == [c[-1] for c in cases]
    assert got[10]["final_evidence"] == "bright day clamped flat at 60 kW with zero divergent inverters — was: why"
    plain = resolve(with_facts(df, site(spark)), ref)
    assert plain.where("verdict is not null").count() == 0


def test_event_ids_count_over_sites(spark):
    rows = []
    for s in ("b", "a", "abc", "abd"):
        for i, label in enumerate(["healthy", "healthy", "outage", "healthy"]):
            rows.append((s, DAY0 + timedelta(days=i + (i == 3)), label))
    df = spark.createDataFrame(rows, "site string, date date, final_label string")
    ids = {(r["site"], r["date"]): r["event_id"] for r in assign_events(df).collect()}
    assert ids[("a", DAY0)] == ids[("a", DAY0 + timedelta(days=1))] == "a:healthy:1"
    assert ids[("abc", DAY0)] == "abc:healthy:4" and ids[("abd", DAY0)] == "abd:healthy:7"
    assert ids[("b", DAY0 + timedelta(days=4))] == "b:healthy:12"
    one = event_split(df, 0.5, "x").groupBy("event_id").agg(F.count_distinct("is_test").alias("n"))
    assert one.where("n > 1").count() == 0


def test_hash_bucket_is_bit_exact(spark):
    import hashlib
    ids = [f"s:{i}" for i in range(50)]
    got = spark.createDataFrame([(i,) for i in ids], "id string").select("id", hash_bucket(F.col("id"), "dev").alias("b"))
    for r in got.collect():
        assert r["b"] == int.from_bytes(hashlib.sha256(("dev" + r["id"]).encode()).digest()[:8], "big") / 2**64
