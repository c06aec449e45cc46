"""Training and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.referee import yes
from ..schema import TRAINING, conform


def write_training(frame: DataFrame, path: str, run_ts: str, fmt: str = "parquet") -> None:
    """Append one run's rows, partitioned by site and run stamp."""
    (
        frame.withColumn("run_ts", F.lit(run_ts))
        .write.mode("append").partitionBy("site", "run_ts").format(fmt)
        .option("header", "true").save(path)
    )


def load_training(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Newest run of every site.

    Which runs exist is read from the partition columns alone. The newest runs'
    stamps, of which there are at most as many as runs, reach the scan as
    partition filters; the join then picks each site's own.
    """
    from pyspark.sql import types as T

    schema = T.StructType(list(TRAINING) + [T.StructField("run_ts", T.StringType())])
    rows = spark.read.schema(schema).format(fmt).option("header", "true").load(path)
    newest = (
        rows.select("site", "run_ts").distinct()
        .groupBy("site").agg(F.max("run_ts").alias("run_ts"))
    )
    stamps = [r["run_ts"] for r in newest.select("run_ts").distinct().collect()]
    recent = rows.where(F.col("run_ts").isin(stamps))
    return conform(recent.join(newest, ["site", "run_ts"], "left_semi"), TRAINING)


def label_counts(final: DataFrame) -> DataFrame:
    return final.where(F.col("final_label").isNotNull()).groupBy("site_id", "final_label").agg(
        F.count(F.lit(1)).alias("n")
    )


def verdict_counts(final: DataFrame) -> DataFrame:
    return final.where(F.col("verdict").isNotNull()).groupBy("site_id", "verdict").agg(
        F.count(F.lit(1)).alias("n")
    )


def refuted_days(final: DataFrame) -> DataFrame:
    """Days whose claim the fleet contradicts."""
    return final.where(F.col("verdict") == "refuted").select(
        "site_id", "local_date", F.col("final_label").alias("label"),
        F.col("final_evidence").alias("evidence"),
    )


def energy_series(daily: DataFrame) -> DataFrame:
    """Expected and actual energy in long form for charting."""
    return daily.select("site_id", "local_date", "actual_kwh", "expected_kwh").unpivot(
        ["site_id", "local_date"], ["actual_kwh", "expected_kwh"], "series", "kwh"
    )


def pi_series(days: DataFrame) -> DataFrame:
    """PI, baseline, threshold line and flag marker per day."""
    return days.select(
        "site_id", "local_date", "pi", "pi_baseline",
        (F.col("flag_threshold") * F.col("pi_baseline")).alias("threshold"),
        F.when(yes(F.col("flagged")), F.col("pi")).alias("flagged_pi"),
        "final_label",
    )


def labelled_curves(interval: DataFrame, final: DataFrame) -> DataFrame:
    """Intraday curves of labelled days only."""
    wanted = final.where(F.col("final_label").isNotNull()).select("site_id", "local_date")
    return interval.join(wanted, ["site_id", "local_date"], "left_semi").select(
        "site_id", "local_date", "local_ts", "ac_power_kw", "expected_kw", "clearsky_kw"
    )
