"""Plant-shaped views over the driver's tables, the inputs of the registered queries.

``lineitem`` becomes hourly plant curves: suppliers form plants of twenty, ship
dates form days, and order and line numbers pick the hour. A fixed calendar of
conditions (outage, plateau, clipping, overcast, soiling, snow, missing data) is
laid over the readings so that every rule has days to judge. ``events`` becomes a
raw channel lake and a datum feed. The number of plants grows with the tables.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import INTERVAL, conform
from ..sites import with_defaults
from ..sources.datums import as_datums
from ..sources.headers import find_files
from ..sources.widecsv import File, PlantFiles, StreamSpec

SUPPLIERS_PER_PLANT = 20
USERS_PER_PLANT = 75
#: Noon of the day in the middle of the plants' calendar, 1998-04-01, in unix seconds.
BOOT_AT = 891432000
#: Stream time of a replayed chunk, 720 days.
CHUNK = 720 * 86400
CHANNELS = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plant_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    no = F.expr(f"s_suppkey div {SUPPLIERS_PER_PLANT}")
    nos = table(spark, sf_dir, "supplier").select(no.alias("no")).distinct()
    return with_defaults(nos.select(
        _plant_name(F.col("no")).alias("site_id"),
        F.lit("UTC").alias("tz"),
        F.lit(100.0).alias("dc_kw"), F.lit(80.0).alias("ac_kw"),
        F.lit(4).alias("n_units"), F.lit(60).alias("interval_min"),
        (F.col("no") % 3 == 2).alias("has_poa"),
        F.lit(True).alias("has_temp"), F.lit(True).alias("has_met"),
        (F.col("no") % 2 == 0).alias("has_submeter"),
    ))


def _plant_name(no: Column) -> Column:
    return F.concat(F.lit("P"), no.cast("string"))


def _phase(spark: SparkSession, sf_dir: str, by_year: bool = False) -> DataFrame:
    """The hour grid of all plant-days, dealt by (site, day) with one exchange of the lines,
    which what follows per site and day stands on; or by (site, year), for files of a year."""
    c = F.col
    no = F.expr(f"l_suppkey div {SUPPLIERS_PER_PLANT}")
    lines = table(spark, sf_dir, "lineitem").select(
        _plant_name(no).alias("site_id"), no.alias("no"),
        F.to_date("l_shipdate").alias("local_date"),
        (6 + (c("l_orderkey") + c("l_linenumber")) % 13).cast("int").alias("h"),
        c("l_quantity").alias("q"),
        (c("l_quantity") * (1 - c("l_discount"))).alias("good"),
    )
    span = ["year"] if by_year else []
    if by_year:
        lines = lines.withColumn("year", F.year("local_date"))
    lines = lines.repartition("site_id", *(span or ["local_date"]))
    # 24 partial sums per plant-day in one aggregate, so the hour grid needs no join
    hour = F.struct((c("good") / c("q")).alias("ratio"), c("n"))
    days = (
        lines.groupBy("site_id", "no", *span, "local_date", "h")
        .agg(F.sum("good").alias("good"), F.sum("q").alias("q"), F.count(F.lit(1)).alias("n"))
        .groupBy("site_id", "no", *span, "local_date")
        .agg(
            F.map_from_entries(F.collect_list(F.struct(c("h"), hour))).alias("by_hour"),
            (F.sum("good") / F.sum("q")).alias("day_ratio"),
            F.sum("n").alias("day_n"),
        )
    )
    grid = days.withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(23)))).withColumn(
        "cell", F.try_element_at("by_hour", F.col("h"))
    )
    e = F.datediff("local_date", F.lit("1995-01-01").cast("date"))
    return grid.select(
        # an hour without lines takes the day's ratio; a day of one line loses its afternoon
        "site_id", "no", "local_date", "h", c("cell.n").alias("n"),
        F.when(
            ~((c("day_n") <= 1) & (c("h") >= 11)),
            # a small hourly ripple keeps curves off exact thresholds and constants
            F.coalesce("cell.ratio", "day_ratio") * (1 - 0.0013717 * ((c("h") * 7) % 5 + 1.3731)),
        ).alias("ratio"),
        e.alias("e"), ((e + 41 * c("no")) % 120).alias("phase"),
        F.when(
            c("h").between(6, 18), F.sin(math.pi * (c("h") - 5) / 14.0)
        ).otherwise(F.lit(0.0)).alias("bell"),
        F.month("local_date").isin(12, 1, 2).alias("winter"),
    )


def plant_interval(spark: SparkSession, sf_dir: str, by_year: bool = False) -> DataFrame:
    """Hourly canonical frame with modelled columns; ``by_year`` deals it by (site, year)."""
    c = F.col
    p = c("phase")
    sky = (
        F.when(p.between(55, 59), 0.6)
        .when((c("e") * 7 + c("no") * 3) % 11 < 2, 0.75).otherwise(1.0)
    )
    gain = F.when(p.between(40, 42), 1.25).otherwise(1.0)
    fault = (
        F.when(c("winter") & (c("e") % 9 <= 1), 0.3)
        .when((p <= 4) & c("h").between(9, 15), 0.02)
        .when(p.between(30, 33), 1 - 0.15 * c("bell"))
        .when(p.between(55, 59), 0.6)
        .when(p.between(70, 85), 1 - 0.012 * (p - 69))
        .when(p.between(95, 99), F.when(c("h") % 2 == 0, 0.4).otherwise(0.95))
        .otherwise(1.0)
    )
    cap = F.when(p.between(20, 25), 50.0).when(p.between(40, 42), 78.0).otherwise(1e9)
    expected = 80.0 * c("bell") * sky * gain
    ts = (c("local_date").cast("timestamp") + F.make_dt_interval(hours=c("h")))
    return _phase(spark, sf_dir, by_year).select(
        "site_id", ts.alias("ts_utc"), ts.cast("timestamp_ntz").alias("local_ts"), "local_date",
        F.when(c("bell") == 0, F.lit(0.0))
        .when(c("ratio").isNull() | (p.between(105, 107) & (c("h") >= 11)), F.lit(None))
        .otherwise(F.least(cap, expected * c("ratio") * fault)).alias("ac_power_kw"),
        F.when(c("no") % 3 == 2, 1000.0 * c("bell") * sky).alias("poa_wm2"),
        (
            12 + 14 * F.cos(2 * math.pi * (F.dayofyear("local_date") - 200) / 365.25)
            + 6 * c("bell") + F.when(p.between(30, 33), 14.0).otherwise(0.0)
        ).alias("temp_c"),
        expected.alias("expected_kw"),
        (92.0 * c("bell") * gain).alias("clearsky_kw"),
        F.when(p.between(55, 57), 0.5).when(c("n") >= 2, 0.4).otherwise(0.0).alias("rain_mm"),
        F.when(c("winter") & (c("e") % 9 == 0), 0.3).otherwise(0.0).alias("snow_cm"),
        p.cast("int").alias("phase"),
    )


def _inverter_kw(k: Column) -> Column:
    """Power of the plant's inverter ``k``, from 1."""
    p = F.col("phase")
    factor = (
        F.when(p.between(20, 25) & (k == 3), 0.2)
        .when(p.between(70, 74) & (k == 1), 0.7)
        .when(p.between(12, 14) & (k == 2), 0.5).otherwise(1.0)
    )
    return F.col("ac_power_kw") / 4.0 * (1 + 0.02 * k) * factor


def plant_inverters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four inverters per plant, long."""
    k = F.col("k")
    return (
        plant_interval(spark, sf_dir)
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(4))))
        .select(
            "site_id", "ts_utc", "local_ts", "local_date",
            F.get(F.array(*[F.lit(f"inv_{n:02d}") for n in range(1, 5)]), k - 1).alias("inverter"),
            _inverter_kw(k).alias("kw"),
        )
    )


def event_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    no = F.expr(f"user_id div {USERS_PER_PLANT}")
    nos = table(spark, sf_dir, "events").select(no.alias("no")).distinct()
    return with_defaults(nos.select(
        F.concat(F.lit("E"), F.col("no").cast("string")).alias("site_id"),
        F.lit(100.0).alias("dc_kw"), F.lit(80.0).alias("ac_kw"),
        F.lit(60).alias("interval_min"), F.lit(4).alias("n_units"),
        F.lit(True).alias("has_poa"), F.lit(True).alias("has_temp"),
    ))


def channel_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as raw readings, with sentinels where ``k`` says so."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("E"), F.expr(f"user_id div {USERS_PER_PLANT}").cast("string")).alias("site_id"),
        F.col("ts").cast("timestamp_ntz").alias("measured_on"),
        F.array_position(F.array(*[F.lit(x) for x in CHANNELS]), F.col("event_type"))
        .cast("int").alias("metric_id"),
        F.when(k % 25 == 0, F.lit(-999.0)).when(k % 25 == 1, F.lit(-9999.0))
        .otherwise(F.col("value")).alias("value"),
        k.alias("k"),
        F.lit("events").alias("_file"), F.col("event_id").alias("_row"),
    )


def raw_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as readings with an instant, ready for resampling."""
    lake = channel_lake(spark, sf_dir)
    ts = F.col("measured_on").cast("timestamp")
    return lake.select(
        "site_id", ts.alias("ts_utc"), F.col("measured_on").alias("local_ts"),
        F.to_date("measured_on").alias("local_date"), "value", "k", "metric_id", "_row",
        F.lit(60).alias("interval_min"),
    )


def sensor_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly sensor readings coarse enough to hold flat runs, for the quality gate."""
    hour = F.date_trunc("hour", F.col("measured_on").cast("timestamp"))
    return (
        channel_lake(spark, sf_dir)
        .where((F.col("k") % 25) > 1)
        .groupBy("site_id", hour.alias("ts_utc"))
        .agg(F.avg("value").alias("v"), F.avg("k").alias("m"))
        .select(
            "site_id", "ts_utc", F.col("ts_utc").cast("timestamp_ntz").alias("local_ts"),
            F.to_date("ts_utc").alias("local_date"),
            (10 + F.floor(F.col("v") / 60) * 60.0).alias("ac_power_kw"),
            (F.floor(F.col("m") / 20) * 200.0 - 200.0).alias("poa_wm2"),
            (F.col("m") * 1.2 - 40.0).alias("temp_c"),
        )
    )


def datum_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as posted JSON lines, a tenth each broken in one of four ways:
    text instead of a stamp, no node, a boolean stamp, watts missing."""
    k = F.get_json_object("props", "$.k").cast("int") % 10
    tsec = F.unix_seconds(F.col("ts").cast("timestamp"))
    line = F.to_json(
        F.struct(
            F.when(k != 1, F.col("user_id") % 4).alias("nodeId"),
            F.col("event_type").alias("sourceId"),
            F.struct(
                F.when((k != 3) | (F.col("event_type") != "view"), F.col("value")).alias("watts")
            ).alias("i"),
        )
    )
    text = F.when(k == 0, F.concat(F.lit('"'), tsec.cast("string"), F.lit('"'))).when(
        k == 2, F.lit("true")
    ).otherwise(tsec.cast("string"))
    body = F.concat(F.lit('{"timestamp":'), text, F.lit(","), F.substring(line, 2, 1_000_000))
    return table(spark, sf_dir, "events").select(
        body.alias("value"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts_utc")
    )


def geometry_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same plants with a location and weather data, but no sensors of their own."""
    return plant_sites(spark, sf_dir).withColumns({
        "lat": F.lit(35.0), "lon": F.lit(0.0), "tilt": F.lit(25.0), "azimuth": F.lit(180.0),
        "has_poa": F.lit(False), "has_temp": F.lit(False), "has_submeter": F.lit(False),
    })


def sensor_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plants with a location for every rung of the trust ladder: a third with an
    irradiance sensor, which is broken in every second one, a quarter without weather."""
    no = F.substring("site_id", 2, 20).cast("int")
    return plant_sites(spark, sf_dir).withColumns({
        "lat": F.lit(35.0), "lon": F.lit(0.0), "tilt": F.lit(25.0), "azimuth": F.lit(180.0),
        "has_met": no % 4 != 3,
    })


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter, irradiance and temperature, with flat, negative and impossible irradiance."""
    c, p, h = F.col, F.col("phase"), F.hour("local_ts")
    no = F.substring("site_id", 2, 20).cast("int")
    poa = (
        F.when(c("poa_wm2").isNull(), F.lit(None)).when(no % 6 == 5, F.lit(-50.0))
        .when(p.between(10, 12) & h.between(9, 15), F.lit(640.0))
        .when((p == 13) & (h == 8), F.lit(-20.0))
        .when(p.between(14, 15), c("poa_wm2") * 2.2).otherwise(c("poa_wm2"))
    )
    return conform(
        plant_interval(spark, sf_dir).withColumn("poa_wm2", poa).select(
            "site_id", "ts_utc", "local_ts", "local_date", "ac_power_kw", "poa_wm2", "temp_c"),
        INTERVAL,
    )


def meter_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant meters without modelled columns."""
    return conform(
        plant_interval(spark, sf_dir).select("site_id", "ts_utc", "local_ts", "local_date", "ac_power_kw"),
        INTERVAL,
    )


def plant_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather of the plants, in the columns of landed payloads."""
    c = F.col
    return plant_interval(spark, sf_dir).select(
        "site_id", c("ts_utc").alias("hour_utc"),
        (c("expected_kw") / 0.08).alias("poa_model"), c("temp_c").alias("temp_model"),
        c("rain_mm").alias("rain_model"), c("snow_cm").alias("snow_model"),
    )


def posted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant meters as the JSON lines the plants' nodes would post."""
    datums = as_datums(meter_only(spark, sf_dir), geometry_sites(spark, sf_dir), "Solar")
    return datums.select(F.to_json(F.struct("nodeId", "sourceId", "timestamp", "i")).alias("value"))


def posted_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant meters as lines posted at their time (``at``), those of a chunk's last
    quarter again a chunk later, and wrong ones, a chunk late, for its first half."""
    datums = as_datums(meter_only(spark, sf_dir), geometry_sites(spark, sf_dir), "Solar")
    ts, n = F.col("timestamp"), F.pmod(F.col("timestamp"), F.lit(CHUNK))
    wrong = F.struct(F.lit(9e9).alias("watts"))
    again = F.when(n >= CHUNK * 3 / 4, F.array(F.lit(0), F.lit(1))).when(n < CHUNK / 2, F.array(F.lit(0), F.lit(2))).otherwise(
        F.array(F.lit(0)))
    rows = datums.withColumn("k", F.explode(again)).withColumn("i", F.when(F.col("k") == 2, wrong).otherwise(F.col("i")))
    return rows.select(
        F.to_json(F.struct("nodeId", "sourceId", "timestamp", "i")).alias("value"), F.col("nodeId").alias("node_id"),
        (ts + F.when(F.col("k") > 0, F.lit(CHUNK)).otherwise(F.lit(0))).alias("at"))


def _land_csv(df: DataFrame, path: str, **options) -> None:
    """One file with a header for each plant and year, of rows dealt by them."""
    df = df.withColumns({"plant": F.col("site_id"), "year": F.year("ts_utc")}).drop("site_id", "ts_utc")
    df.write.partitionBy("plant", "year").csv(path, header=True, **options)


def _landed(spark: SparkSession, root: str) -> dict[str, dict[str, list[str]]]:
    """Files below ``root`` by plant and kind, oldest year first."""
    out: dict[str, dict[str, list[str]]] = {}
    for path in find_files(spark, root):
        kind, plant = re.search(r"/(\w+)/plant=([^/]+)/", path).groups()
        out.setdefault(plant, {}).setdefault(kind, []).append(path)
    return out


def land_plant_csvs(spark: SparkSession, sf_dir: str, root: str) -> list[PlantFiles]:
    """Yearly meter files in two layouts, a later vintage of every fifth day that
    reads one kW more, and half-hourly Fahrenheit on the UTC clock."""
    c = F.col
    df = plant_interval(spark, sf_dir, by_year=True).withColumn("odd", F.substring("site_id", 2, 20).cast("int") % 2 == 1)
    text = lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    naive = text(c("ts_utc")).alias("measured_on")
    keys = ["site_id", "ts_utc"]
    _land_csv(df.where(~c("odd")).select(*keys, naive, c("ac_power_kw").alias("power")), f"{root}/meter")
    _land_csv(df.where("odd").select(*keys, naive, F.lit("x").alias("flag"), c("ac_power_kw").alias("site_power")),
              f"{root}/site_meter")
    fifth = F.datediff("local_date", F.lit("1995-01-01").cast("date")) % 5 == 0
    _land_csv(df.where(fifth & ~c("odd")).select(*keys, naive, (c("ac_power_kw") + 1).alias("power")), f"{root}/corrected")
    back = F.explode(F.array(F.lit(0), F.lit(20)))
    warm = df.withColumn("back", back).select(
        *keys, text(c("ts_utc") - F.make_dt_interval(mins=c("back"))).alias("utc_measured_on"),
        (c("temp_c") * 9 / 5 + 32 + c("back") / 10).alias("temp_f"))
    _land_csv(warm, f"{root}/temperature")
    plants = []
    for plant, kinds in _landed(spark, root).items():
        if "meter" in kinds:
            meter = StreamSpec([*kinds["meter"], *kinds.get("corrected", [])], "power")
        else:
            meter = StreamSpec(kinds["site_meter"], "site_power")
        warm = [File(f, "utc_measured_on", "UTC") for f in kinds["temperature"]]
        plants.append(PlantFiles(plant, meter, temperature=StreamSpec(warm, "temp_f", resample=True, fahrenheit=True)))
    return plants


def land_inverter_csvs(spark: SparkSession, sf_dir: str, root: str) -> list[PlantFiles]:
    """Yearly inverter files in both vintages' layouts; those of 1996 of every second
    plant come again, without the fourth inverter."""
    wide = plant_interval(spark, sf_dir, by_year=True).select(
        "site_id", "ts_utc", (F.substring("site_id", 2, 20).cast("int") % 2 == 1).alias("odd"),
        *[_inverter_kw(F.lit(k)).alias(f"inv_{k:02d}") for k in range(1, 5)])
    naive = F.date_format("ts_utc", "yyyy-MM-dd HH:mm:ss").alias("measured_on")
    keys = ["site_id", "ts_utc", naive]
    old = [F.col(f"inv_{k:02d}").alias(f"inv_{k:02d}_ac_power_inv_{k}") for k in range(1, 5)]
    new = [F.col(f"inv_{k:02d}").alias(f"inverter_{k}_ac_power_(kw)_inv_{k}") for k in range(1, 5)]
    _land_csv(wide.where(~F.col("odd")).select(*keys, *old, F.lit("1").alias("other")), f"{root}/old")
    _land_csv(wide.where("odd").select(*keys, *new), f"{root}/new")
    _land_csv(wide.where(~F.col("odd") & (F.year("ts_utc") == 1996)).select(*keys, *new[:3]), f"{root}/again")
    meter = StreamSpec([], "")
    return [
        PlantFiles(plant, meter, inverters=[*kinds.get("old", []), *kinds.get("new", []), *kinds.get("again", [])])
        for plant, kinds in _landed(spark, root).items()
    ]


def land_channel_csvs(spark: SparkSession, sf_dir: str, root: str) -> list[str]:
    """Wide yearly CSVs of channels, rain among them from 1995 on, compressed."""
    c = F.col
    df = plant_interval(spark, sf_dir, by_year=True)
    naive = F.date_format("ts_utc", "yyyy-MM-dd HH:mm:ss").alias("measured_on")
    base = ["site_id", "ts_utc", naive, c("ac_power_kw").alias("meter"), c("temp_c").alias("temp")]
    early = F.year("ts_utc") < 1995
    _land_csv(df.where(early).select(*base), f"{root}/dry", compression="gzip")
    _land_csv(df.where(~early).select(*base, c("rain_mm").alias("rain")), f"{root}/wet", compression="gzip")
    return find_files(spark, root, "*.csv.gz")


def land_weather(hourly: DataFrame, path: str) -> None:
    """Hourly weather as landed payloads, one file for each plant and year."""
    c = F.col
    hour = F.struct(
        F.date_format("hour_utc", "yyyy-MM-dd HH:mm:ss").alias("time"), c("poa_model").alias("poa"),
        c("temp_model").alias("temp"), c("rain_model").alias("rain"), c("snow_model").alias("snow"))
    years = hourly.groupBy("site_id", F.trunc(F.to_date("hour_utc"), "year").alias("since")).agg(
        F.sort_array(F.collect_list(hour)).alias("h"))
    series = F.struct(
        c("h.time").alias("time"), c("h.poa").alias("global_tilted_irradiance"), c("h.temp").alias("temperature_2m"),
        c("h.rain").alias("precipitation"), c("h.snow").alias("snowfall"))
    body = F.to_json(F.struct("site_id", series.alias("hourly")), {"ignoreNullFields": "false"})
    years.select(body.alias("value"), c("site_id").alias("plant"), "since").write.mode("append").partitionBy(
        "plant", "since").text(path)
