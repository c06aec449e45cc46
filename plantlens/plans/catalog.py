"""The registered queries: each operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.physics import clearsky_poa, expected_kw
from ..functions.units import convert, mask_sentinels
from ..operators import evaluation, events as ev, quality, splits, trend
from ..operators.align import dedupe, last_value_per_channel, resample_mean
from ..operators.daily import add_flags, build_daily
from ..operators.numbering import shuffled
from ..operators.referee import daily_divergence, inverter_daily
from ..operators.rules import classify
from ..operators.shape import day_shape
from ..operators.trailing import trailing_context
from ..schema import TRAINING_COLUMNS
from ..sites import CHANNEL, channel_map
from ..sources import lake as lake_src, tables, widecsv
from ..sources.lake import melt
from ..sources.weather import landed, to_grid
from ..learning import evaluate, models
from ..learning.scorers import RatioScorer, linear_scorer
from ..session import cut_lineage, work_dir
from ..streaming import boot, dayclose, delivery, intake, replay
from . import views
from .canonical import build_dataset, model_power, with_clearsky
from .diagnose import Diagnosis, day_table, diagnose, event_table, flagged_days

Query = Callable[[SparkSession, str], DataFrame]


def r(name: str, digits: int = 6, as_: str | None = None) -> Column:
    return F.round(F.col(name), digits).alias(as_ or name)


def stamp(col: str, as_: str = "label") -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(as_)


def i(name: str) -> Column:
    return F.col(name).cast("int").alias(name)


def big(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


# --- raw readings ------------------------------------------------------------
def sentinel_mask(spark, sf):
    lake = views.channel_lake(spark, sf)
    return lake.select(
        F.col("_row").alias("event_id"), "metric_id", mask_sentinels(F.col("value")).alias("value")
    )


def channel_last_value(spark, sf):
    lake = views.channel_lake(spark, sf).withColumn("value", mask_sentinels(F.col("value")))
    lake = lake.withColumn("hour", stamp(F.date_trunc("hour", F.col("measured_on").cast("timestamp")), "hour"))
    return last_value_per_channel(lake, ["site_id", "metric_id", "hour"], ["_row"])


def unit_eras(spark, sf):
    eras = F.array(*[
        F.struct(
            F.lit(day).cast("date").alias("from"), F.lit(off).alias("offset"), F.lit(scale).alias("scale")
        )
        for day, off, scale in (("2024-01-10", 5.0, 1.0), ("2024-01-20", 0.0, 0.1))
    ])
    kw = convert(mask_sentinels(F.col("value")), F.col("measured_on"), F.lit(-32.0), F.lit(0.5), eras)
    return views.channel_lake(spark, sf).select(
        F.col("_row").alias("event_id"), F.round(kw, 6).alias("kw")
    )


def _resample(closed):
    def run(spark, sf):
        df = views.raw_interval(spark, sf).withColumn("value", mask_sentinels(F.col("value")))
        return resample_mean(df, ["value"], ["site_id"], closed).select(
            "site_id", stamp("ts_utc"), r("value")
        )
    return run


def dedupe_precedence(spark, sf):
    lake = views.channel_lake(spark, sf)
    micros = F.unix_micros(F.col("measured_on").cast("timestamp"))
    bucket = F.timestamp_micros(micros - F.pmod(micros, F.lit(900_000_000)))
    df = lake.select("site_id", stamp(bucket, "stamp"), "value", "_row")
    newest = dedupe(df, ["site_id", "stamp"], ["_row"], "last").withColumnRenamed("value", "newest")
    oldest = dedupe(df, ["site_id", "stamp"], ["_row"], "first").withColumnRenamed("value", "oldest")
    return newest.join(oldest, ["site_id", "stamp"])


def _eras(breaks) -> Column:
    eras = [
        F.struct(F.lit(b["from"]).cast("date").alias("from"), F.lit(b["offset"]).alias("offset"),
                 F.lit(b["scale"]).alias("scale"))
        for b in breaks
    ]
    return F.array(*eras).cast(CHANNEL["breaks"].dataType)


def _lake_channels(spark, sites):
    from datetime import date

    rows = [
        {"site_id": "*", "canonical": "ac_power_kw", "metric_id": 1, "part_no": 0, "scale": 0.1},
        {"site_id": "*", "canonical": "ac_power_kw", "metric_id": 2, "part_no": 1, "scale": 0.1},
        {"site_id": "*", "canonical": "poa_wm2", "metric_id": 3},
        {"site_id": "*", "canonical": "temp_c", "metric_id": 4, "offset": -32.0, "scale": 5.0 / 9,
         "breaks": [(date(2024, 1, 15), 0.0, 1.0)]},
    ]
    fields = [f.name for f in CHANNEL][1:]
    spec = [row.asDict() for row in channel_map(spark, rows).collect()]
    one = lambda row: F.struct(*[F.lit(row[f]).cast(CHANNEL[f].dataType).alias(f) if f != "breaks"
                                 else _eras(row[f]).alias(f) for f in fields])
    return sites.select("site_id", F.explode(F.array(*[one(row) for row in spec])).alias("c")).select(
        "site_id", "c.*"
    )


def lake_canonical(spark, sf):
    sites = views.event_sites(spark, sf)
    channels = _lake_channels(spark, sites)
    grid = lake_src.channel_grid(views.channel_lake(spark, sf), sites, channels)
    return lake_src.canonical_from_grid(grid, sites, channels).select(
        "site_id", stamp("ts_utc"), r("ac_power_kw"), r("poa_wm2"), r("temp_c")
    )


def csv_plants(spark, sf):
    """Canonical frame of a fleet's yearly wide CSVs, one scan for each of their headers."""
    plants = views.land_plant_csvs(spark, sf, work_dir(spark, "csv"))
    df = widecsv.load_plants(spark, plants, views.plant_sites(spark, sf))
    return df.select("site_id", stamp("ts_utc"), r("ac_power_kw"), r("temp_c"))


def csv_inverters(spark, sf):
    """Inverter readings of a fleet's yearly wide CSVs in both vintages' layouts."""
    plants = views.land_inverter_csvs(spark, sf, work_dir(spark, "csv"))
    df = widecsv.load_inverters(spark, plants, views.plant_sites(spark, sf))
    return df.select("site_id", stamp("ts_utc"), "inverter", r("kw"))


def csv_lake(spark, sf):
    """Wide yearly CSVs as a long lake: readings by channel and year."""
    path = work_dir(spark, "csv")
    manifest = lake_src.convert_csv_lake(spark, views.land_channel_csvs(spark, sf, f"{path}/wide"), f"{path}/lake")
    long = spark.read.schema("measured_on timestamp_ntz, metric_id int, value double, year int").parquet(f"{path}/lake")
    # summed before they meet their names: dealt by channel, all readings would lie in a few tasks
    sums = long.groupBy("metric_id", "year").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))
    return sums.join(manifest, "metric_id").select("name", "metric_id", "year", "n", "total")


def hour_to_grid(spark, sf):
    raw = views.raw_interval(spark, sf).withColumn("value", mask_sentinels(F.col("value")))
    hourly = (
        raw.where(F.col("metric_id").isin(1, 2) & F.col("value").isNotNull())
        .groupBy(
            "site_id", (F.date_trunc("hour", "ts_utc") + F.expr("interval 1 hour")).alias("hour_utc")
        )
        .agg(F.avg("value").alias("poa_model"), (F.sum("k") * 0.1).alias("rain_model"))
    )
    spans = raw.groupBy("site_id").agg(
        F.date_trunc("day", F.min("ts_utc")).alias("first_ts"), F.max("ts_utc").alias("last_ts")
    )
    from ..operators.align import interval_spine

    grid = interval_spine(spans.withColumn("interval_min", F.lit(15)), ["site_id"]).drop("interval_min")
    sites = views.event_sites(spark, sf).withColumn("interval_min", F.lit(15))
    out = to_grid(grid.withColumn("local_date", F.to_date("ts_utc")), hourly, sites)
    return out.select("site_id", stamp("ts_utc"), r("poa_model"), r("rain_model"))


def localized_stamps(spark, sf):
    """Order stamps read as US/Pacific wall clock, over both kinds of clock change."""
    from ..functions.timeparts import localized

    t = views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_shipdate").cast("timestamp")
         + F.make_dt_interval(hours=F.pmod(F.col("l_orderkey"), F.lit(4)).cast("int"), mins=F.lit(30))
         ).cast("timestamp_ntz").alias("measured_on"),
    )
    return t.select(
        "l_orderkey", "l_linenumber",
        F.unix_timestamp(localized(F.col("measured_on"), F.lit("US/Pacific"))).alias("epoch"),
    )


# --- physics and quality ------------------------------------------------------
def expected_power(spark, sf):
    x = views.plant_interval(spark, sf).withColumn("g", F.col("clearsky_kw") / 0.092 - 20)
    power = lambda k: F.round(expected_kw(F.col("g"), F.lit(100.0), F.lit(0.8), F.lit(k)), 6)
    return x.select(
        "site_id", "local_date", F.hour("local_ts").cast("long").alias("hour"),
        power(55.0).alias("expected_kw"), power(0.0).alias("flat_kw"),
    )


def clearsky_curve(spark, sf):
    days = views.table(spark, sf, "events").select(
        (F.col("user_id") % 25).alias("site"), F.to_date("ts").alias("d")
    ).distinct()
    grid = days.withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(23)))).withColumn(
        "lat", F.col("site") * 2.0 - 25
    )
    ts = F.col("d").cast("timestamp") + F.make_dt_interval(hours=F.col("h"))
    poa = clearsky_poa(ts, F.col("lat"), F.lit(0.0), F.lit(25.0), F.lit(180.0))
    return grid.select(
        "site", F.date_format("d", "yyyy-MM-dd").alias("day"),
        F.col("h").cast("long").alias("hour"), F.round(poa, 5).alias("poa"),
    )


def _sensor(spark, sf):
    df = views.sensor_interval(spark, sf)
    return df.join(views.event_sites(spark, sf).select("site_id", "ac_kw"), "site_id").withColumn(
        "clearsky_wm2", F.lit(None).cast("double")
    )


def _runs(kind):
    def run(spark, sf):
        marked = quality.mark_runs(_sensor(spark, sf), "ac_power_kw", "stale", "interp")
        return marked.select("site_id", stamp("ts_utc"), i(kind))
    return run


def quality_counts(spark, sf):
    return quality.quality_counts(quality.quality_marks(_sensor(spark, sf)))


def quality_gate(spark, sf):
    clean = quality.apply_gate(quality.quality_marks(_sensor(spark, sf)))
    return clean.select("site_id", stamp("ts_utc"), "ac_power_kw", "poa_wm2", r("temp_c"))


# --- days ---------------------------------------------------------------------
def _plant(spark, sf):
    return views.plant_interval(spark, sf), views.plant_sites(spark, sf)


def _daily(spark, sf):
    interval, sites = _plant(spark, sf)
    return build_daily(interval, sites), sites


def daily_build(spark, sf):
    daily, _ = _daily(spark, sf)
    return daily.select(
        "site_id", "local_date", r("actual_kwh", 4), r("expected_kwh", 4), r("coverage"),
        r("rain_mm"), r("snow_cm"), r("pi"),
    )


def _flags(spark, sf, windows=(30,), window_days=None):
    daily, sites = _daily(spark, sf)
    if window_days is not None:
        sites = sites.withColumn("window_days", window_days)
    facts = sites.select(
        "site_id", "coverage_min", "flag_threshold", "pi_ceiling", "window_days", "has_met"
    )
    return add_flags(daily.join(facts, "site_id"), windows)


def baseline_flags(spark, sf):
    return _flags(spark, sf).select("site_id", "local_date", r("pi"), r("pi_baseline"), i("flagged"))


def baseline_windows(spark, sf):
    """Every second plant has a baseline of 45 days instead of 30."""
    even = F.substring("site_id", 2, 20).cast("int") % 2 == 0
    out = _flags(spark, sf, (30, 45), F.when(even, F.lit(30)).otherwise(F.lit(45)))
    return out.select("site_id", "local_date", r("pi"), r("pi_baseline"), i("flagged"))


def shape(spark, sf):
    out = day_shape(*_plant(spark, sf))
    six = ["peak", "tmax", "midday_expected", "csr", "model_csr", "chop", "morning_ratio",
           "midday_ratio", "bright_deficit"]
    return out.select(
        "site_id", "local_date", *[r(c) for c in six], big("plateau_run"), big("dead_run"),
        "bright_rows", "ratio_hours", r("temp_corr", 5),
    )


def _context(spark, sf):
    return trailing_context(_flags(spark, sf))


def snow_trails(spark, sf):
    return _context(spark, sf).select(
        "site_id", "local_date", r("snow_3d"), r("snow_7d"), r("snow_30d")
    )


def pi_step(spark, sf):
    return _context(spark, sf).select("site_id", "local_date", i("step3"), r("step3_median"))


def pi_trend14(spark, sf):
    return _context(spark, sf).select(
        "site_id", "local_date", big("trend_n"),
        *[r(c) for c in ("trend_slope", "trend_total", "trend_drop1", "trend_drop2")],
    )


def _days(spark, sf):
    interval, sites = _plant(spark, sf)
    return flagged_days(day_table(interval, sites), sites)


def rule_labels(spark, sf):
    return classify(_days(spark, sf)).select("site_id", "local_date", "label", r("pi"))


def rule_evidence(spark, sf):
    """Labels with their evidence text."""
    return classify(_days(spark, sf))


def clipping_census(spark, sf):
    from ..operators.rules import label_days

    out = label_days(_days(spark, sf))
    return out.where((F.col("label") == "clipping") & ~F.col("flagged")).select(
        "site_id", "local_date", "label"
    )


# --- referee, events ------------------------------------------------------------
def inverter_divergence(spark, sf):
    ref = daily_divergence(
        inverter_daily(views.plant_inverters(spark, sf), views.plant_sites(spark, sf))
    )
    return ref.select(
        "site_id", "local_date", big("n_divergent"),
        F.array_join("divergent", ",").alias("divergent"), r("fleet_median"), r("div_share", 5),
    )


def _diagnosis(spark, sf) -> Diagnosis:
    interval, sites = _plant(spark, sf)
    return diagnose(interval, sites, views.plant_inverters(spark, sf))


def _final(spark, sf):
    return _diagnosis(spark, sf).days


def referee_verdicts(spark, sf):
    return _final(spark, sf).where(F.col("label").isNotNull()).select(
        "site_id", "local_date", "label", "final_label", "final_label_2", "verdict"
    )


def label_counts(spark, sf):
    return tables.label_counts(_final(spark, sf))


def verdict_counts(spark, sf):
    return tables.verdict_counts(_final(spark, sf))


def refuted_days(spark, sf):
    return tables.refuted_days(_final(spark, sf)).drop("evidence")


def energy_series(spark, sf):
    daily, _ = _daily(spark, sf)
    return tables.energy_series(daily).withColumn("kwh", F.round("kwh", 4))


def pi_series(spark, sf):
    return tables.pi_series(_final(spark, sf)).select(
        "site_id", "local_date", r("pi"), r("pi_baseline"), r("threshold"), r("flagged_pi"), "final_label"
    )


def labelled_curves(spark, sf):
    interval, _ = _plant(spark, sf)
    return tables.labelled_curves(interval, _final(spark, sf)).select(
        "site_id", "local_date", F.hour("local_ts").cast("int").alias("hour"),
        r("ac_power_kw"), r("expected_kw"), r("clearsky_kw"),
    )


def event_islands(spark, sf):
    final = _final(spark, sf).where(F.col("final_label").isNotNull()).select(
        "site_id", "local_date", F.col("final_label").alias("label"),
        F.col("final_evidence").alias("evidence"),
    )
    return ev.segments(final).select("site_id", "label", "start", "end")


def event_rollup(spark, sf):
    # the event job reads the resolved days three times; they are written once
    return event_table(cut_lineage(_final(spark, sf), "final")).select(
        "site_id", big("event_seq"), "label", "start", "end", big("days"),
        r("median_pi"), r("energy_deficit_kwh", 4),
    )


# --- training table, splits, evaluation -----------------------------------------
_TEXT = {"site", "flagged", "rule_label", "final_label", "final_label_2", "verdict",
         "provenance", "evidence"}


def _training(spark, sf):
    return _diagnosis(spark, sf).training


def feature_vector(spark, sf):
    numbers = [c for c in TRAINING_COLUMNS if c not in _TEXT | {"actual_kwh", "expected_kwh"}]
    return _training(spark, sf).select(
        "site", "date", *[r(c, {"temp_corr": 5, "pi_drop_share": 2}.get(c, 6)) for c in numbers]
    )


def training_frame(spark, sf):
    return _training(spark, sf).select(
        "site", "date", r("actual_kwh", 4), r("expected_kwh", 4), r("pi"), i("flagged"),
        "rule_label", "final_label", "final_label_2", "verdict", "provenance",
    )


def event_ids(spark, sf):
    return ev.assign_events(cut_lineage(_training(spark, sf), "training")).select("site", "date", "final_label", "event_id")


def event_split(spark, sf):
    rows = cut_lineage(_training(spark, sf), "training")
    return splits.event_split(rows, 0.2, "dev").select(
        "site", "date", "event_id", i("is_test")
    )


def class_weights(spark, sf):
    rows = evaluation.class_weights(splits.trainable(_training(spark, sf)))
    return rows.groupBy("final_label", "provenance", r("weight")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(spark, sf):
    out = evaluation.classification_report(_training(spark, sf), "final_label", "rule_label")
    return out.select("label", r("precision"), r("recall"), r("f1"), big("support"))


def confusions(spark, sf):
    return evaluation.top_confusions(_training(spark, sf), 8, "final_label", "rule_label")


def agreement_by_class(spark, sf):
    out = evaluation.agreement_by_class(_training(spark, sf), "final_label", "rule_label")
    return out.select("truth", "n", r("agreement"))


def overruled_days(spark, sf):
    return evaluation.overruled(_training(spark, sf)).select(
        "site", "date", "rule_label", "final_label"
    )


# --- trends -----------------------------------------------------------------------
def _full_pi(spark, sf):
    daily, sites = _daily(spark, sf)
    return trend.daily_pi(daily.join(sites.select("site_id", "coverage_min"), "site_id"))


def yoy_pairs(spark, sf):
    return trend.yoy_pairs(_full_pi(spark, sf)).select(
        "site_id", "local_date", "paired_with", r("rate", 5)
    )


def yoy_rate(spark, sf):
    return trend.degradation(_full_pi(spark, sf)).select("site_id", r("rate"), "n_pairs")


def degradation(spark, sf):
    """Rates with their intervals and text."""
    return trend.degradation(_full_pi(spark, sf))


def insolation(spark, sf):
    return trend.daily_insolation(*_plant(spark, sf)).select(
        "site_id", "local_date", r("insolation", 4)
    )


def _soil(spark, sf):
    return trend.soiling_intervals(_full_pi(spark, sf), trend.daily_insolation(*_plant(spark, sf)))


def soiling_intervals(spark, sf):
    return _soil(spark, sf).groupBy("site_id", big("interval_no")).agg(
        F.min("local_date").alias("start"), F.count(F.lit(1)).alias("days"),
        F.count("pi").alias("n_obs"),
    )


def soiling_fits(spark, sf):
    return trend.soiling_fits(_soil(spark, sf)).select("site_id", "interval_no", r("slope"))


def soiling_ratio(spark, sf):
    interval, sites = _plant(spark, sf)
    return trend.soiling(_full_pi(spark, sf), trend.daily_insolation(interval, sites), sites)


# --- conversion and stream intake ----------------------------------------------------
def wide_to_long(spark, sf):
    wide = views.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("measured_on"), "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    return (
        melt(wide).groupBy("name", F.year("measured_on").cast("long").alias("year"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total"))
    )


def datum_status(spark, sf):
    return (
        intake.judge(views.datum_lines(spark, sf), "view")
        .groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    )


def datum_upsert(spark, sf):
    kept = intake.accepted_power(intake.judge(views.datum_lines(spark, sf), "view"))
    bucketed = kept.withColumn("bucket", F.col("ts") - F.pmod(F.col("ts"), F.lit(3600)))
    newest = intake.upsert(bucketed, ["node_id", "bucket"], "seq")
    return newest.select(F.col("node_id").cast("long").alias("node"), "bucket", "watts")


def pending_days(spark, sf):
    ev_t = views.table(spark, sf, "events")
    label = F.to_date(F.col("ts").cast("timestamp") + F.expr("interval 1 hour"))
    k = F.get_json_object("props", "$.k").cast("int")
    src = ev_t.select((F.col("user_id") % 4).alias("node"), "event_type", label.alias("local_date"), k.alias("k"))
    closed = src.where((F.col("event_type") == "error") & (F.col("k") < 4)).select("node", "local_date")
    return intake.pending_days(src.where(F.col("event_type") == "view"), closed, ["node"])


# --- whole jobs: canonical dataset, learning, streaming ------------------------------
def canonical_dataset(spark, sf):
    sites = views.geometry_sites(spark, sf)
    interval, _ = build_dataset(
        views.meter_only(spark, sf), sites, views.plant_weather(spark, sf), has_poa=False
    )
    return interval.select(
        "site_id", stamp("ts_utc"), r("ac_power_kw"), r("expected_kw"), r("clearsky_kw", 5),
        r("temp_c"), r("rain_mm"), r("snow_cm"),
    )


def _laddered(spark, sf):
    """Plants on every rung of the trust ladder, their readings judged once."""
    sites = views.sensor_sites(spark, sf)
    return build_dataset(
        views.sensor_readings(spark, sf), sites, views.plant_weather(spark, sf), materialize=True
    )


def trust_ladder(spark, sf):
    """Expected power from the plant's sensor, else the weather, else the clear sky."""
    return _laddered(spark, sf)[0].select("site_id", stamp("ts_utc"), r("poa_wm2"), r("expected_kw", 5), r("temp_c"))


def night_zero(spark, sf):
    """Meter readings after the gate, with the missing ones of the night as zeros, per day."""
    return _laddered(spark, sf)[0].groupBy("site_id", "local_date").agg(
        F.count("ac_power_kw").alias("n"), F.count_if(F.col("ac_power_kw") == 0).alias("zeros"),
        F.round(F.sum("ac_power_kw"), 4).alias("kwh"),
    )


def poa_checks(spark, sf):
    """Masked readings per plant and check, the irradiance checks among them."""
    return _laddered(spark, sf)[1]


def _learnable(spark, sf):
    """The training table, written once: every fit reads it many times."""
    return splits.trainable(cut_lineage(_training(spark, sf), "training"))


def _holdout(name, **options):
    def run(spark, sf):
        _, scored = evaluate.holdout_predictions(_learnable(spark, sf), name, **options)
        return evaluation.classification_report(scored, "final_label", "pred")
    return run


def loso_eval(spark, sf):
    scored = evaluate.loso_predictions(_learnable(spark, sf), "logreg")
    return evaluation.classification_report(scored, "final_label", "pred")


def feature_shuffle(spark, sf):
    """One repeat of the importance's permutation: each day with the clear-sky ratio of its partner."""
    rows = cut_lineage(_training(spark, sf).select("site", "date", "csr", "chop"), "shuffle")
    return shuffled(rows, ["site", "date"], ["csr", "chop"], 7).select(
        "site", "date", r("csr"), F.round("moved.csr", 6).alias("moved_csr"), F.round("moved.chop", 6).alias("moved_chop")
    )


def perm_importance(spark, sf):
    bundle, scored = evaluate.holdout_predictions(_learnable(spark, sf), "logreg")
    return evaluate.permutation_importance(bundle, cut_lineage(scored, "holdout"))


def confident_unclassified(spark, sf):
    rows = cut_lineage(_training(spark, sf), "training")
    bundle = models.fit(splits.trainable(rows), "logreg")
    return evaluation.confident_counts(models.score(bundle, splits.unclassified(rows)))


def _batch_days(spark, sf):
    """The streamed plants through the batch path."""
    sites = views.geometry_sites(spark, sf)
    clear = with_clearsky(views.meter_only(spark, sf), sites)
    return diagnose(model_power(clear, views.plant_weather(spark, sf), sites, has_poa=False), sites)


def _weather(spark, sf):
    """The plants' weather, written once: each micro-batch reads it anew."""
    return cut_lineage(views.plant_weather(spark, sf), "weather")


def _streamed(spark, sf):
    """(batch training rows, streamed closed days) of the same plants."""
    sites = cut_lineage(views.geometry_sites(spark, sf), "sites")
    batch = cut_lineage(_batch_days(spark, sf).training, "batch")
    scorer = linear_scorer(models.fit(splits.trainable(batch), "logreg"))
    path = work_dir(spark, "stream")
    views.posted_lines(spark, sf).write.text(f"{path}/posted")
    lines = intake.read_lines(spark, f"{path}/posted")
    stored = intake.accepted_power(intake.judge(lines, "Solar"))
    closed = dayclose.run_available(spark, stored, sites, scorer, path, _weather(spark, sf))
    return batch, closed


def stream_day_close(spark, sf):
    """Posted readings -> closed, labelled days."""
    _, closed = _streamed(spark, sf)
    return closed.select(
        "site_id", "local_date", "label", r("pi"), r("pi_baseline"), r("coverage"), "history_days"
    )


def stream_replay_diff(spark, sf):
    """Agreement of streamed and batch labels, per batch label."""
    batch, closed = _streamed(spark, sf)
    truth = batch.select(
        F.col("site").alias("site_id"), F.col("date").alias("local_date"),
        F.col("final_label").alias("label"),
    )
    return evaluation.agreement_by_class(replay.compare(truth, closed))


def stream_boot(spark, sf):
    """Half of the posted readings become state; the stream closes the rest, and
    continues the count of days, as if it had seen everything."""
    sites = cut_lineage(views.geometry_sites(spark, sf), "sites")
    judged = intake.judge(views.posted_lines(spark, sf).withColumn("seq", F.lit("")), "Solar")
    judged = cut_lineage(judged, "judged")
    early = F.col("ts") < views.BOOT_AT
    path = work_dir(spark, "boot")
    judged.where(~early).select("value").write.text(f"{path}/posted")
    live = intake.accepted_power(intake.judge(intake.read_lines(spark, f"{path}/posted"), "Solar"))
    history = intake.accepted_power(judged.where(early)).select("node_id", "ts", "watts", "seq")
    closed = boot.boot(spark, history, live, sites, RatioScorer(), path, _weather(spark, sf))
    return closed.select("site_id", "local_date", r("pi"), r("coverage"), "history_days")


def stream_replay_chunks(spark, sf):
    """A history posted in chunks, some readings again and some wrong and late, closed chunk by chunk."""
    sites = cut_lineage(views.geometry_sites(spark, sf), "sites")
    closed = replay.replay(
        spark, views.posted_again(spark, sf), sites, RatioScorer(), work_dir(spark, "replay"), "Solar",
        views.CHUNK, hourly=_weather(spark, sf))
    return closed.select("site_id", "local_date", r("pi"), r("coverage"), "history_days")


def stream_late_weather(spark, sf):
    """Weather that lands in two parts, the second after the stream has closed half of
    the days; what it says of those days is ignored."""
    sites = cut_lineage(views.geometry_sites(spark, sf), "sites")
    path = work_dir(spark, "late")
    hourly = _weather(spark, sf)
    hour = F.unix_timestamp("hour_utc")
    judged = cut_lineage(intake.judge(views.posted_lines(spark, sf).withColumn("seq", F.lit("")), "Solar"), "judged")
    live = lambda: intake.accepted_power(intake.judge(intake.read_lines(spark, f"{path}/posted"), "Solar"))
    day = 86400
    weather = landed(spark, f"{path}/weather")
    views.land_weather(hourly.where(hour < views.BOOT_AT - day), f"{path}/weather")
    judged.where(F.col("ts") < views.BOOT_AT).select("value").write.mode("append").text(f"{path}/posted")
    dayclose.run_available(spark, live(), sites, RatioScorer(), path, weather, hold_days=2)
    views.land_weather(hourly.where(hour >= views.BOOT_AT - day), f"{path}/weather")
    changed = hourly.where(hour < views.BOOT_AT - 10 * day).withColumn("poa_model", F.col("poa_model") * 2 + 50)
    views.land_weather(changed, f"{path}/weather")
    judged.where(F.col("ts") >= views.BOOT_AT).select("value").write.mode("append").text(f"{path}/posted")
    closed = dayclose.run_available(spark, live(), sites, RatioScorer(), path, weather, hold_days=2)
    return closed.select("site_id", "local_date", r("pi"), r("coverage"), "history_days")


def _posted(spark, sf):
    """Where a stream has sorted the posted lines, file by file."""
    path = work_dir(spark, "intake")
    lines = views.datum_lines(spark, sf)
    for part in range(3):
        lines.where(F.col("seq") % 3 == part).select("value").coalesce(1).write.mode("append").text(f"{path}/posted")
    stream = intake.read_lines(spark, f"{path}/posted", files_per_trigger=1)
    intake.start_intake(stream, "view", path, availableNow=True).awaitTermination()
    return path


def stream_rejects(spark, sf):
    """Rejected lines that a stream has kept apart, by the source they name."""
    rows = intake.judged_rows(spark, _posted(spark, sf)).where(F.col("status") == intake.REJECTED)
    return rows.groupBy("source_id").agg(F.count("value").alias("n"))


def stream_counts(spark, sf):
    """Counters of all micro-batches."""
    counts = intake.batch_counts(spark, _posted(spark, sf))
    return counts.agg(*[F.sum(c).alias(c) for c in ("accepted", "rejected", "stored")], F.count("*").alias("batches"))


def prediction_delivery(spark, sf):
    """Days labelled by coverage, landed in three parts with a third of them twice and
    delivered by a stream; the first batch is retried after it has ended."""
    sites = cut_lineage(views.geometry_sites(spark, sf), "sites")
    daily, _ = _daily(spark, sf)
    label = F.when(F.col("coverage") >= 0.8, F.lit("healthy")).otherwise(F.lit("data_gap"))
    n = F.datediff("local_date", F.lit("1995-01-01").cast("date"))
    days = cut_lineage(daily.select(
        "site_id", "local_date", label.alias("label"), F.round("coverage", 4).alias("confidence"), "pi",
        F.lit(None).cast("double").alias("pi_baseline"), "coverage", "actual_kwh", "expected_kwh", "rain_mm", "snow_cm",
        n.cast("int").alias("history_days"), F.lit("coverage").alias("model_version")), "closed")
    path = work_dir(spark, "delivery")
    for part in range(3):
        days.where((n % 3 == part) | (n % 3 == 0)).coalesce(1).write.mode("append").parquet(f"{path}/closed")
    stream = spark.readStream.schema(dayclose.CLOSED).option("maxFilesPerTrigger", 1).parquet(f"{path}/closed")
    delivery.start_delivery(stream, sites, path, availableNow=True).awaitTermination()
    first = delivery.delivered(spark, path).where("batch_id = 0").select("site_id", "local_date")
    delivery.deliver(days.join(first, ["site_id", "local_date"], "left_semi"), 0, sites, path)
    body = F.from_json("value", "timestamp long, s struct<faultClass: string>, meta struct<confidence: double, history_days: int>")
    return delivery.delivered(spark, path).withColumn("b", body).select(
        "site_id", "local_date", F.col("b.timestamp").alias("stamp"), F.col("b.s.faultClass").alias("label"),
        F.col("b.meta.confidence").alias("confidence"), F.col("b.meta.history_days").alias("history_days"))


QUERIES: dict[str, Query] = {
    "sentinel_mask": sentinel_mask,
    "channel_last_value": channel_last_value,
    "unit_eras": unit_eras,
    "resample_right_closed": _resample("right"),
    "resample_left_closed": _resample("left"),
    "dedupe_precedence": dedupe_precedence,
    "lake_canonical": lake_canonical,
    "csv_plants": csv_plants,
    "csv_inverters": csv_inverters,
    "csv_lake": csv_lake,
    "hour_to_grid": hour_to_grid,
    "localized_stamps": localized_stamps,
    "expected_power": expected_power,
    "clearsky_curve": clearsky_curve,
    "stale_runs": _runs("stale"),
    "interp_runs": _runs("interp"),
    "quality_counts": quality_counts,
    "quality_gate": quality_gate,
    "daily_build": daily_build,
    "baseline_flags": baseline_flags,
    "baseline_windows": baseline_windows,
    "day_shape": shape,
    "snow_trails": snow_trails,
    "pi_step": pi_step,
    "pi_trend14": pi_trend14,
    "rule_labels": rule_labels,
    "rule_evidence": rule_evidence,
    "clipping_census": clipping_census,
    "inverter_divergence": inverter_divergence,
    "referee_verdicts": referee_verdicts,
    "label_counts": label_counts,
    "verdict_counts": verdict_counts,
    "refuted_days": refuted_days,
    "energy_series": energy_series,
    "pi_series": pi_series,
    "labelled_curves": labelled_curves,
    "event_islands": event_islands,
    "event_rollup": event_rollup,
    "feature_vector": feature_vector,
    "training_frame": training_frame,
    "event_ids": event_ids,
    "event_split": event_split,
    "class_weights": class_weights,
    "classification_report": classification_report,
    "confusions": confusions,
    "agreement_by_class": agreement_by_class,
    "overruled_days": overruled_days,
    "yoy_pairs": yoy_pairs,
    "yoy_rate": yoy_rate,
    "degradation": degradation,
    "insolation": insolation,
    "soiling_intervals": soiling_intervals,
    "soiling_fits": soiling_fits,
    "soiling_ratio": soiling_ratio,
    "wide_to_long": wide_to_long,
    "datum_status": datum_status,
    "datum_upsert": datum_upsert,
    "pending_days": pending_days,
    "canonical_dataset": canonical_dataset,
    "trust_ladder": trust_ladder,
    "night_zero": night_zero,
    "poa_checks": poa_checks,
    "model_logreg": _holdout("logreg"),
    "model_rf": _holdout("rf"),
    "model_gbt": _holdout("hgb"),
    "loso_eval": loso_eval,
    "perm_importance": perm_importance,
    "feature_shuffle": feature_shuffle,
    "confident_unclassified": confident_unclassified,
    "stream_day_close": stream_day_close,
    "stream_replay_diff": stream_replay_diff,
    "stream_boot": stream_boot,
    "stream_replay_chunks": stream_replay_chunks,
    "stream_late_weather": stream_late_weather,
    "prediction_delivery": prediction_delivery,
    "stream_rejects": stream_rejects,
    "stream_counts": stream_counts,
}
