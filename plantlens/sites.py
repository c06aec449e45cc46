"""Plant configuration as dimension tables."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

SITE = T.StructType([
    T.StructField("site_id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("tz", T.StringType()),
    T.StructField("dc_kw", T.DoubleType()),
    T.StructField("ac_kw", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("tilt", T.DoubleType()),
    T.StructField("azimuth", T.DoubleType()),
    T.StructField("n_units", T.IntegerType()),
    T.StructField("interval_min", T.IntegerType()),
    T.StructField("derate", T.DoubleType()),
    T.StructField("low_light_k", T.DoubleType()),
    T.StructField("coverage_min", T.DoubleType()),
    T.StructField("flag_threshold", T.DoubleType()),
    T.StructField("pi_ceiling", T.DoubleType()),
    T.StructField("window_days", T.IntegerType()),
    T.StructField("report_start", T.DateType()),
    T.StructField("report_end", T.DateType()),
    T.StructField("stamp_start", T.DateType()),
    T.StructField("stamp_end", T.DateType()),
    T.StructField("stamp_tz", T.StringType()),
    T.StructField("has_poa", T.BooleanType()),
    T.StructField("has_temp", T.BooleanType()),
    T.StructField("has_met", T.BooleanType()),
    T.StructField("has_submeter", T.BooleanType()),
])
SITE_COLUMNS = [f.name for f in SITE]

# fixed values: tuning a plant gets unless its row says otherwise
DEFAULTS = {
    "tz": "UTC", "n_units": 1, "interval_min": 15, "derate": 0.8, "low_light_k": 0.0,
    "coverage_min": 0.8, "flag_threshold": 0.92, "pi_ceiling": 0.95, "window_days": 30,
    "has_poa": False, "has_temp": False, "has_met": False, "has_submeter": False,
}

CHANNEL = T.StructType([
    T.StructField("site_id", T.StringType(), False),
    T.StructField("canonical", T.StringType()),
    T.StructField("metric_id", T.IntegerType()),
    T.StructField("part_no", T.IntegerType()),
    T.StructField("offset", T.DoubleType()),
    T.StructField("scale", T.DoubleType()),
    T.StructField("breaks", T.ArrayType(T.StructType([
        T.StructField("from", T.DateType()),
        T.StructField("offset", T.DoubleType()),
        T.StructField("scale", T.DoubleType()),
    ]))),
])

CONFIG = Path(__file__).with_name("plants.csv")


def with_defaults(df: DataFrame) -> DataFrame:
    """Complete a partial site table to the full schema."""
    have = set(df.columns)
    out = []
    for f in SITE:
        col = F.col(f.name) if f.name in have else F.lit(None)
        col = col.cast(f.dataType)
        if f.name in DEFAULTS:
            col = F.coalesce(col, F.lit(DEFAULTS[f.name]).cast(f.dataType))
        out.append(col.alias(f.name))
    return df.select(*out)


def local_table(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Configuration rows as a local relation: its size is known when a join is
    planned, so Spark's own check decides on broadcasting it."""
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    arrow = pa.Table.from_pylist(
        [{f.name: row.get(f.name) for f in loose} for row in rows], to_arrow_schema(loose)
    )
    return spark.createDataFrame(arrow, loose)


def site_dim(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Site table from configuration rows; absent fields take the defaults."""
    return local_table(spark, [{**DEFAULTS, **row} for row in rows], SITE)


def channel_map(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Source channel -> canonical column, with unit conversion and eras."""
    base = {"part_no": 0, "offset": 0.0, "scale": 1.0, "breaks": []}
    eras = lambda row: [
        b if isinstance(b, dict) else dict(zip(("from", "offset", "scale"), b))
        for b in row.get("breaks", [])
    ]
    return local_table(spark, [{**base, **row, "breaks": eras(row)} for row in rows], CHANNEL)


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Site table from a header CSV; adding a plant is adding a row."""
    raw = spark.read.csv(path, header=True, nullValue="")
    return with_defaults(raw)


def landing_azimuth(azimuth):
    """Compass azimuth (0 = north) -> the archive's convention (0 = south)."""
    return azimuth - 180.0


def distinct_windows(sites: DataFrame) -> tuple[int, ...]:
    """Baseline window lengths in use; one short list from the site table."""
    return tuple(sorted(r[0] for r in sites.select("window_days").distinct().collect()))
