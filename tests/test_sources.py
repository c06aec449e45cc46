import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plantlens.functions.timeparts import localized
from plantlens.plans import views
from plantlens.sites import channel_map, read_sites, site_dim, CONFIG
from plantlens.sources import datums, headers, lake, tables, weather, widecsv
from helpers import interval, site


def _epochs(df, col="ts_utc"):
    return [r[0] for r in df.orderBy(col).select(F.date_format(col, "yyyy-MM-dd HH:mm")).collect()]


def test_localize_clock_changes(spark):
    stamps = ["2024-11-03 01:15:00", "2024-11-03 12:00:00", "2024-03-10 02:30:00", "2024-07-01 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(
        "s", localized(F.col("s").cast("timestamp_ntz"), F.lit("US/Pacific")).alias("t"))
    got = {r["s"]: r["t"] for r in df.collect()}
    assert got[stamps[0]] is None
    assert got[stamps[1]] == datetime(2024, 11, 3, 20)
    assert got[stamps[2]] == datetime(2024, 3, 10, 10)
    assert got[stamps[3]] == datetime(2024, 7, 1, 7)


def _csv(path, header, rows):
    path.write_text("\n".join([",".join(header)] + [",".join(map(str, r)) for r in rows]))
    return str(path)


@pytest.mark.parametrize("keep,want", [("last", 2.0), ("first", 1.0)])
def test_vintage_precedence(spark, tmp_path, keep, want):
    a = _csv(tmp_path / "a.csv", ["measured_on", "power"], [("2024-01-01 12:00:00", 1.0)])
    b = _csv(tmp_path / "b.csv", ["measured_on", "power"], [("2024-01-01 12:00:00", 2.0)])
    spec = widecsv.StreamSpec([a, b], "power", keep=keep)
    out = widecsv.load_stream(spark, "s", spec, "ac_power_kw", site(spark, tz="US/Pacific"))
    assert [r["ac_power_kw"] for r in out.collect()] == [want]


def test_plant_files_utc_resample_fahrenheit(spark, tmp_path):
    m = _csv(tmp_path / "m.csv", ["measured_on", "power"], [("2024-06-01 12:15:00", 5.0), ("2024-11-03 01:15:00", 9.0)])
    p = _csv(tmp_path / "p.csv", ["utc_measured_on", "poa"],
             [("2024-06-01 19:05:00", 100.0), ("2024-06-01 19:15:00", 300.0), ("2024-06-01 19:40:00", 50.0)])
    t = _csv(tmp_path / "t.csv", ["measured_on", "temp"], [("2024-06-01 12:15:00", 77.0)])
    plant = widecsv.PlantFiles(
        "s", widecsv.StreamSpec([m], "power"),
        widecsv.StreamSpec([widecsv.File(p, "utc_measured_on", "UTC")], "poa", resample=True),
        widecsv.StreamSpec([t], "temp", fahrenheit=True))
    out = widecsv.load_plant(spark, plant, site(spark, tz="US/Pacific", interval_min=15))
    rows = {str(r["local_ts"]): r for r in out.collect()}
    assert set(rows) == {"2024-06-01 12:15:00", "2024-06-01 12:30:00", "2024-06-01 12:45:00"}
    noon = rows["2024-06-01 12:15:00"]
    assert (noon["ac_power_kw"], noon["poa_wm2"], noon["temp_c"]) == (5.0, 200.0, 25.0)
    assert rows["2024-06-01 12:30:00"]["poa_wm2"] is None  # an empty bin is still a row


def test_wide_inverters(spark, tmp_path):
    f = _csv(tmp_path / "e.csv", ["measured_on", "inv_01_ac_power_inv_1", "inverter_02_ac_power_(kw)_inv_2", "other"],
             [("2024-01-01 00:05:00", 1, 2, 9), ("2024-01-01 00:10:00", 3, 4, 9)])
    plant = widecsv.PlantFiles("s", widecsv.StreamSpec([f], "x"), inverters=[f])
    out = widecsv.load_inverters(spark, plant, site(spark, interval_min=15))
    assert {(r["inverter"], r["kw"]) for r in out.collect()} == {("inv_01", 2.0), ("inv_02", 3.0)}


def _lake(spark, tmp_path, change=lambda m, t, v: v):
    rows = []
    for day in (1, 2):
        for minute in range(0, 1440, 5):
            t = datetime(2021, 6, day) + timedelta(minutes=minute)
            for metric, v in ((1, 5000.0), (2, 800.0), (3, 77.0), (11, 2500.0), (12, 2500.0)):
                rows.append((t, metric, change(metric, t, v), 2021, 6, day))
    path = str(tmp_path / "lake")
    spark.createDataFrame(
        rows, "measured_on timestamp_ntz, metric_id int, value double, year int, month int, day int"
    ).write.partitionBy("year", "month", "day").parquet(path)
    return path


def _channels(spark, **meter):
    return channel_map(spark, [
        {"site_id": "s", "canonical": "ac_power_kw", "metric_id": 1, "scale": 0.001, **meter},
        {"site_id": "s", "canonical": "poa_wm2", "metric_id": 2},
        {"site_id": "s", "canonical": "temp_c", "metric_id": 3, "offset": -32.0, "scale": 5 / 9},
        {"site_id": "s", "canonical": "inverter", "metric_id": 11, "part_no": 1, "scale": 0.001},
        {"site_id": "s", "canonical": "inverter", "metric_id": 12, "part_no": 2, "scale": 0.001},
    ])


def test_lake_labels_units_and_inverters(spark, tmp_path):
    path, sites = _lake(spark, tmp_path), site(spark, interval_min=15)
    out = lake.load_lake(spark, path, sites, _channels(spark), [1, 2, 3], "s").collect()
    assert min(r["local_ts"] for r in out) == datetime(2021, 6, 1)
    assert {(r["ac_power_kw"], r["poa_wm2"], round(r["temp_c"], 6)) for r in out} == {(5.0, 800.0, 25.0)}
    inv = lake.load_lake_inverters(spark, path, sites, _channels(spark), [11, 12], "s")
    assert {r["inverter"] for r in inv.select("inverter").distinct().collect()} == {"inv_01", "inv_02"}


def test_lake_sentinels_leave_gaps_and_eras_switch(spark, tmp_path):
    def change(metric, t, v):
        if metric == 1 and t.day == 1 and t.hour == 12:
            return -999.0
        return v / 1000 if metric == 1 and t.day == 2 else v
    path, sites = _lake(spark, tmp_path, change), site(spark, interval_min=60)
    from datetime import date
    ch = _channels(spark, breaks=[(date(2021, 6, 2), 0.0, 1.0)])
    rows = {r["local_ts"]: r for r in lake.load_lake(spark, path, sites, ch, [1, 2, 3], "s").collect()}
    # 12:00 itself is masked, but the bin ending 12:00 holds eleven good readings
    assert rows[datetime(2021, 6, 1, 12)]["ac_power_kw"] == 5.0
    assert rows[datetime(2021, 6, 1, 13)]["ac_power_kw"] == 5.0  # only its END stamp is left
    assert rows[datetime(2021, 6, 2, 12)]["ac_power_kw"] == 5.0


def test_lake_meter_of_two_parts_is_poisoned(spark, tmp_path):
    path = _lake(spark, tmp_path, lambda m, t, v: None if m == 11 and t.hour >= 12 else v)
    ch = channel_map(spark, [
        {"site_id": "s", "canonical": "ac_power_kw", "metric_id": 11, "scale": 0.001},
        {"site_id": "s", "canonical": "ac_power_kw", "metric_id": 12, "scale": 0.001, "part_no": 1}])
    rows = {r["local_ts"]: r["ac_power_kw"] for r in
            lake.load_lake(spark, path, site(spark), ch, [11, 12], "s").collect()}
    assert rows[datetime(2021, 6, 1, 10)] == 5.0
    assert rows[datetime(2021, 6, 1, 15)] is None


def test_lake_scan_pushes_filters(spark, tmp_path):
    df = lake.scan_lake(spark, _lake(spark, tmp_path), [1, 2], "s", (2021, 2021))
    plan = df._jdf.queryExecution().toString()
    assert "In(metric_id, [1,2])" in plan and "PartitionFilters" in plan


def test_corrected_files_win():
    files = ["/d/1_ac_2016.csv", "/d/1_ac_2016_corrected.csv", "/d/1_env_2016.csv"]
    assert lake.preferred_files(files) == ["/d/1_ac_2016_corrected.csv", "/d/1_env_2016.csv"]


def test_csv_lake_conversion(spark, tmp_path):
    _csv(tmp_path / "a_corrected.csv", ["measured_on", "b", "a"], [("2020-01-01 00:00:00", 1, -1000000), ("2021-01-01 00:00:00", -999, 4)])
    manifest = lake.convert_csv_lake(spark, [str(tmp_path / "a_corrected.csv")], str(tmp_path / "out"))
    assert {r["name"]: r["metric_id"] for r in manifest.collect()} == {"a": 1, "b": 2}
    got = {(r["metric_id"], r["value"], r["year"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(2, 1.0, 2020), (1, 4.0, 2021)}


def test_datum_pages(spark, tmp_path):
    page = {"data": {"totalResults": 2, "startingOffset": 0, "returnedResultCount": 2, "results": [
        {"created": "2026-07-28 00:00:00Z", "sourceId": "x", "watts": 27375.8},
        {"created": "2026-07-28 00:15:00Z", "sourceId": "x", "watts": 1000.0}]}}
    (tmp_path / "p.json").write_text(json.dumps(page))
    sites = site(spark, tz="Pacific/Auckland", interval_min=15)
    rows = datums.load_pages(spark, str(tmp_path), sites, "s").orderBy("ts_utc").collect()
    assert str(rows[0]["local_ts"]) == "2026-07-28 12:15:00"
    assert rows[0]["ac_power_kw"] == pytest.approx(27.3758)
    back = datums.as_datums(datums.load_pages(spark, str(tmp_path), sites, "s"), sites, "x")
    assert back.agg(F.min("timestamp")).first()[0] == 1785196800
    fixed = datums.in_window(datums.load_pages(spark, str(tmp_path), sites, "s"), sites, "2026-07-28", "2026-07-29")
    assert fixed.count() == 2


def test_weather_hours_never_borrow(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"site_id": "s", "hourly": {
        "time": ["2026-07-28T00:00", "2026-07-28T01:00", "2026-07-28T02:00"],
        "global_tilted_irradiance": [0.0, 120.0, None], "precipitation": [0.0, 2.0, None]}}))
    hourly = weather.load_hourly(spark, str(tmp_path))
    base = (datetime(2026, 7, 28) - datetime(2024, 1, 1)).days
    grid = interval(spark, [(base, 15 * i, {}) for i in range(1, 9)])
    out = weather.to_grid(grid, hourly, site(spark, interval_min=15)).orderBy("ts_utc").collect()
    assert [r["poa_model"] for r in out] == [120.0] * 4 + [None] * 4
    assert sum(r["rain_model"] or 0 for r in out) == 2.0


def test_coarse_grid_is_refused(spark):
    hourly = spark.createDataFrame([("s", datetime(2024, 1, 1), 1.0)], "site_id string, hour_utc timestamp, poa_model double")
    with pytest.raises(Exception, match="coarser"):
        weather.to_grid(interval(spark, [(0, 0, {})]), hourly, site(spark, interval_min=120)).collect()


def test_latest_training_run(spark, tmp_path):
    from plantlens.schema import TRAINING, conform
    path = str(tmp_path / "t")
    for run, label in (("20240101-000000", "outage"), ("20240201-000000", "healthy")):
        rows = spark.createDataFrame([("007", label)], "site string, final_label string")
        tables.write_training(conform(rows, TRAINING), path, run)
    out = tables.load_training(spark, path)
    assert [(r["site"], r["final_label"]) for r in out.collect()] == [("007", "healthy")]


def test_plant_registry(spark):
    sites = read_sites(spark, str(CONFIG))
    assert sites.count() == 33
    assert sites.where("site_id = '2107'").first()["pi_ceiling"] == 0.98


def test_one_scan_a_header_for_many_files(spark, tmp_path):
    """60 plants, 200 files, three headers: three scans; empty files and hidden ones are no matter."""
    stamp = lambda h: f"2024-06-01 {h:02d}:00:00"
    plants = []
    for n in range(60):
        column = "power" if n % 2 else "kw"
        a = _csv(tmp_path / f"{n}a.csv", ["measured_on", column], [(stamp(h), n + h) for h in range(1, 4)])
        b = _csv(tmp_path / f"{n}b.csv", ["measured_on", column], [(stamp(2), -n)])
        t = _csv(tmp_path / f"{n}t.csv", ["measured_on", "note", "temp"], [(stamp(1), '"a,b"', 20.5)])
        plants.append(widecsv.PlantFiles(
            f"p{n}", widecsv.StreamSpec([a, b], column, keep="first" if n % 3 else "last"),
            temperature=widecsv.StreamSpec([t], "temp")))
    for n in range(20):
        (tmp_path / f"empty{n}.csv").write_text("")
    empty = [str(tmp_path / f"empty{n}.csv") for n in range(20)]
    plants.append(widecsv.PlantFiles("none", widecsv.StreamSpec(empty, "power")))
    sites = site_dim(spark, [{"site_id": p.site_id, "tz": "UTC", "interval_min": 60} for p in plants])
    out = widecsv.load_plants(spark, plants, sites)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan csv") == 3
    got = {(r["site_id"], r["local_ts"].hour): (r["ac_power_kw"], r["temp_c"]) for r in out.collect()}
    assert len(got) == 180
    for n in range(60):
        assert got[f"p{n}", 1] == (n + 1.0, 20.5)
        assert got[f"p{n}", 2] == (n + 2.0 if n % 3 else -float(n), None)
    assert len(headers.find_files(spark, str(tmp_path))) == 180  # empty ones have nothing to read


def test_headers_that_lack_or_repeat_a_column(spark, tmp_path):
    a = _csv(tmp_path / "a.csv", ["measured_on", "x", "X", ""], [("2024-06-01 01:00:00", 1, 2, 3)])
    assert list(headers.header_groups(spark, headers.files_of(spark, a))) == [("measured_on", "x", "X#2", "#3")]
    sites = site(spark)
    with pytest.raises(ValueError, match="no column power"):
        widecsv.load_stream(spark, "s", widecsv.StreamSpec([a], "power"), "ac_power_kw", sites)
    assert widecsv.load_plants(spark, [], sites).count() == 0
    assert widecsv.load_inverters(spark, [], sites).count() == 0
    # a file of two streams, and a folder as a file
    both = widecsv.PlantFiles("s", widecsv.StreamSpec([str(tmp_path)], "x"), widecsv.StreamSpec([a], "X#2"))
    row = widecsv.load_plant(spark, both, sites).first()
    assert (row["ac_power_kw"], row["poa_wm2"], row["temp_c"]) == (1.0, 2.0, None)


def test_headers_of_many_small_files_take_few_tasks(spark, tmp_path, monkeypatch):
    """Small files share tasks; first lines are those of the reader that opens a file a task."""
    for k in range(20):
        end = "\r\n" if k % 2 else "\n"
        (tmp_path / f"f{k:02d}.csv").write_bytes(f"measured_on,{'a' if k % 3 else 'b'}{end}1,2{end}".encode())
    (tmp_path / "f20.csv").write_bytes(b"")
    (tmp_path / "f21.csv").write_bytes(b"measured_on,only")
    paths = headers.files_of(spark, str(tmp_path))
    sc = spark.sparkContext
    sc.setJobGroup("headers", "headers")
    found = headers.header_groups(spark, paths)
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("headers")]
    assert 0 < sum(sc.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds) < 20
    assert {h: len(p) for h, p in found.items()} == {
        ("measured_on", "a"): 13, ("measured_on", "b"): 7, ("measured_on", "only"): 1}
    monkeypatch.setattr(headers, "LARGE_FILE", 0)
    assert headers.header_groups(spark, paths) == found


def test_channel_files_are_one_a_plant_and_year_and_packed(spark, tmp_path):
    lines = [(k, 20 * (k % 3), k % 7 + 1, datetime(1994 + k % 4, 1 + k % 12, 5), 10.0 + k, 0.01 * (k % 9)) for k in range(200)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_linenumber long, l_shipdate timestamp, l_quantity double, "
                          "l_discount double").write.parquet(str(tmp_path / "lineitem.parquet"))
    files = views.land_channel_csvs(spark, str(tmp_path), str(tmp_path / "wide"))
    kinds = {f.rsplit("/part-", 1)[0] for f in files}
    assert len(files) == len(kinds) == 12 and all(f.endswith(".csv.gz") for f in files)
    lake.convert_csv_lake(spark, files, str(tmp_path / "lake"))
    assert spark.read.parquet(str(tmp_path / "lake")).where("metric_id = 1").count() == views.plant_interval(
        spark, str(tmp_path)).where("ac_power_kw is not null").count()
