"""Long channel lake and its conversion from wide CSVs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timeparts import localized, with_local_clock
from ..functions.units import convert, mask_sentinels
from ..operators.align import (
    attach_on, attach_sites, interval_spine, last_value_per_channel, resample_mean,
)
from ..operators.daily import clamp_stamps
from ..schema import CSV_SENTINELS, INTERVAL, INVERTER, LAKE, conform
from .headers import files_of, header_groups, scan

ORDER = ["_file", "_row"]


def scan_lake(
    spark: SparkSession, path: str, metrics: list[int] | None = None,
    site_id: str | None = None, years: tuple[int, int] | None = None,
) -> DataFrame:
    """Raw readings with their file order. The channel list and, where given, the
    year range reach the scan as pushed filters and partition filters.

    ``site_id`` may be a partition column of the tree or be given for one tree.
    """
    raw = spark.read.option("mergeSchema", "false").parquet(path)
    if years and "year" in raw.columns:
        raw = raw.where(F.col("year").between(*years))
    if metrics is not None:
        raw = raw.where(F.col("metric_id").isin([int(m) for m in metrics]))
    site = F.lit(site_id) if site_id is not None else F.col("site_id").cast("string")
    return raw.select(
        site.alias("site_id"),
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in LAKE],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )


def channel_grid(raw: DataFrame, sites: DataFrame, channels: DataFrame) -> DataFrame:
    """Readings -> one value per (site, channel, label) on the site grid.

    ``raw``: site_id, measured_on, metric_id, value and order columns.
    """
    used = channels.select("site_id", "metric_id").distinct()
    df = raw.withColumn("value", mask_sentinels(F.col("value")))
    df = attach_on(df, used, ["site_id", "metric_id"], "measured_on", "inner")
    df = last_value_per_channel(df, ["site_id", "metric_id", "measured_on"], ORDER)
    df = attach_sites(df, sites, ["tz", "stamp_tz", "interval_min"], spread="measured_on")
    df = df.withColumn(
        "ts_utc", localized(F.col("measured_on"), F.coalesce("stamp_tz", "tz"))
    ).where(F.col("ts_utc").isNotNull())
    df = clamp_stamps(with_local_clock(df), sites)
    return resample_mean(df, ["value"], ["site_id", "metric_id"])


def _spine(grid: DataFrame, sites: DataFrame) -> DataFrame:
    spans = grid.groupBy("site_id").agg(
        F.min("ts_utc").alias("first_ts"), F.max("ts_utc").alias("last_ts")
    )
    spine = interval_spine(attach_sites(spans, sites, ["interval_min", "tz"]), ["site_id"])
    return with_local_clock(spine).drop("tz", "interval_min")


def canonical_from_grid(grid: DataFrame, sites: DataFrame, channels: DataFrame) -> DataFrame:
    """Channel grid -> canonical interval frame (D1); a meter made of several
    parts is NULL wherever one part is."""
    plant = channels.where(F.col("canonical").isin("ac_power_kw", "poa_wm2", "temp_c"))
    parts = plant.groupBy("site_id").agg(
        F.count_if(F.col("canonical") == "ac_power_kw").alias("_parts")
    )
    spec = plant.select("site_id", "metric_id", "canonical", "offset", "scale", "breaks")
    df = attach_on(grid, spec, ["site_id", "metric_id"], "local_date", "inner").withColumn(
        "value", convert(F.col("value"), F.col("local_ts"), F.col("offset"), F.col("scale"),
                         F.col("breaks"))
    )
    # grid bins without any reading are part of the frame, as rows of NULLs
    df = df.unionByName(_spine(grid, sites), allowMissingColumns=True)
    of = lambda name: F.when(F.col("canonical") == name, F.col("value"))
    wide = df.groupBy("site_id", "ts_utc", "local_ts", "local_date").agg(
        F.sum(of("ac_power_kw")).alias("_ac"),
        F.count(of("ac_power_kw")).alias("_n"),
        F.max(of("poa_wm2")).alias("poa_wm2"),
        F.max(of("temp_c")).alias("temp_c"),
    )
    return conform(
        attach_sites(wide, parts, ["_parts"], spread="local_date").withColumn(
            "ac_power_kw", F.when(F.col("_n") == F.col("_parts"), F.col("_ac"))
        ),
        INTERVAL,
    )


def channel_list(channels: DataFrame) -> list[int]:
    """The channels that a map names: configuration, so a short list."""
    return sorted(r["metric_id"] for r in channels.select("metric_id").distinct().collect())


def load_lake(
    spark: SparkSession, path: str, sites: DataFrame, channels: DataFrame,
    metrics: list[int] | None = None, site_id: str | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Lake -> canonical interval frame (S4). Only mapped channels are read, or ``metrics``."""
    plant = channels.where(F.col("canonical") != "inverter")
    raw = scan_lake(spark, path, channel_list(plant) if metrics is None else metrics, site_id, years)
    return canonical_from_grid(channel_grid(raw, sites, plant), sites, plant)


def load_lake_inverters(
    spark: SparkSession, path: str, sites: DataFrame, channels: DataFrame,
    metrics: list[int] | None = None, site_id: str | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Lake -> long inverter frame (S6); ``part_no`` gives the fleet order."""
    inv = channels.where(F.col("canonical") == "inverter")
    metrics = channel_list(inv) if metrics is None else metrics
    grid = channel_grid(scan_lake(spark, path, metrics, site_id, years), sites, inv)
    df = attach_on(
        grid, inv.select("site_id", "metric_id", "part_no", "offset", "scale", "breaks"),
        ["site_id", "metric_id"], "local_date", "inner",
    )
    return conform(
        df.withColumn("inverter", F.format_string("inv_%02d", "part_no")).withColumn(
            "kw", convert(F.col("value"), F.col("local_ts"), F.col("offset"), F.col("scale"),
                          F.col("breaks"))
        ),
        INVERTER,
    )


def preferred_files(files: list[str]) -> list[str]:
    """Corrected files, and plain files no corrected file stands in for."""
    corrected = [f for f in files if f.removesuffix(".gz").endswith("_corrected.csv")]
    names = [f.rsplit("/", 1)[-1] for f in corrected]
    plain = [
        f for f in files
        if "corrected" not in f.rsplit("/", 1)[-1]
        and not any(f.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".csv") in n for n in names)
    ]
    return sorted(corrected) + sorted(plain)


def channel_manifest(names: DataFrame) -> DataFrame:
    """Distinct channel names, sorted and numbered from 1 (U3). ``names`` holds one
    row per source column, so it is bounded by the files' headers."""
    return names.select("name").distinct().withColumn(
        "metric_id", F.row_number().over(Window.orderBy("name"))
    )


def melt(df: DataFrame, stamp: str = "measured_on") -> DataFrame:
    """Wide readings -> (stamp, name, value) without NULLs and sentinels."""
    cols = [c for c in df.columns if c != stamp]
    doubles = df.select(stamp, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    return (
        doubles.unpivot(stamp, cols, "name", "value")
        .withColumn("value", mask_sentinels(F.col("value"), CSV_SENTINELS))
        .where(F.col("value").isNotNull())
    )


def convert_csv_lake(spark: SparkSession, files: list[str], dest: str) -> DataFrame:
    """Yearly wide CSVs -> long parquet by year; returns the manifest (Q6).

    One scan for each different header, whatever the number of files.
    """
    chosen = [f for path in preferred_files(files) for f in files_of(spark, path)]
    groups = header_groups(spark, chosen)
    names = sorted({c for header in groups for c in header if c != "measured_on"})
    manifest = channel_manifest(spark.createDataFrame([(n,) for n in names], "name string"))
    long = None
    for header, paths in groups.items():
        raw = scan(spark, header, paths)
        part = melt(raw.withColumn("measured_on", F.col("measured_on").cast("timestamp_ntz")))
        long = part if long is None else long.unionByName(part)
    if long is None:
        return manifest
    (
        long.join(F.broadcast(manifest), "name")
        .select(
            "measured_on", F.col("metric_id").cast("int"), "value",
            F.year("measured_on").alias("year"),
        )
        .write.mode("overwrite").partitionBy("year").parquet(dest, compression="zstd")
    )
    return manifest
