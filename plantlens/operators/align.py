"""Keyed alignment: site attributes, dedupe, resampling and dense grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeparts import label_shift, plus_micros

SITE_SALT = 16


def attach_sites(df: DataFrame, sites: DataFrame, columns: list[str], spread: str | None = None) -> DataFrame:
    """Add site attributes.

    No broadcast is forced: Spark broadcasts ``sites`` only under its own size
    check. ``spread`` names a column to salt on, for interval-sized inputs, so
    that beyond the check one huge plant is still shuffled over many tasks.
    """
    columns = [c for c in columns if c not in df.columns]
    if not columns:
        return df
    return attach_on(df, sites.select("site_id", *columns), ["site_id"], spread)


def attach_on(df: DataFrame, dim: DataFrame, keys: list[str], spread: str | None, how: str = "left") -> DataFrame:
    """Join a small table with one row per key, salted where ``spread`` is given."""
    if spread is None:
        return df.join(dim, keys, how)
    salted = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SITE_SALT - 1))))
    return (
        df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SITE_SALT)).cast("int"))
        .join(salted, [*keys, "_salt"], how)
        .drop("_salt")
    )


def dedupe(df: DataFrame, keys: list[str], order: list[str], keep: str = "last") -> DataFrame:
    """One row per key by source precedence.

    An aggregate rather than a ranking window: it combines map-side and needs no
    sort, so a key with many copies costs one partial result per task.
    """
    pick = F.max_by if keep == "last" else F.min_by
    rest = [c for c in df.columns if c not in keys and c not in order]
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*rest), rank).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def last_value_per_channel(df: DataFrame, keys: list[str], order: list[str], value: str = "value") -> DataFrame:
    """Last non-NULL value per (stamp, channel) in file order (A3)."""
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(F.max_by(value, rank).alias(value))
    )


def to_labels(df: DataFrame, closed: str = "right", step: str | Column = "interval_min") -> DataFrame:
    """Move ``ts_utc``/``local_ts`` to the END label of their interval (A1, A2)."""
    step_col = F.col(step) if isinstance(step, str) else step
    gap = label_shift(F.col("local_ts"), step_col, closed)
    return (
        df.withColumn("_gap", gap)
        .withColumn("ts_utc", plus_micros(F.col("ts_utc"), F.col("_gap")))
        .withColumn(
            "local_ts",
            plus_micros(F.col("local_ts").cast("timestamp"), F.col("_gap")).cast("timestamp_ntz"),
        )
        .withColumn("local_date", F.to_date("local_ts"))
        .drop("_gap")
    )


def resample_mean(
    df: DataFrame, values: list[str], keys: list[str] = ("site_id",), closed: str = "right",
) -> DataFrame:
    """Mean per interval, labelled at its END; NULLs are skipped (A1, A2)."""
    labelled = to_labels(df, closed)
    return labelled.groupBy(*keys, "ts_utc", "local_ts", "local_date").agg(
        *[F.avg(v).alias(v) for v in values]
    )


def interval_spine(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Every label between ``first_ts`` and ``last_ts`` of each key.

    Exploded in two steps, day by day, so that no single row expands to a
    whole plant history inside one array; between them the days are dealt to
    all tasks, as the few rows of ``spans`` lie in one.
    """
    parts = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = F.make_dt_interval(mins=F.col("interval_min"))
    day = F.make_dt_interval(days=F.lit(1))
    return (
        spans.withColumn(
            "_day", F.explode(F.sequence(F.col("first_ts"), F.col("last_ts"), day))
        )
        .repartition(parts, *keys, "_day")
        .withColumn(
            "ts_utc",
            F.explode(
                F.sequence(
                    F.col("_day"),
                    F.least(F.col("_day") + day - step, F.col("last_ts")),
                    step,
                )
            ),
        )
        .drop("_day", "first_ts", "last_ts")
    )


def fill_days(daily: DataFrame, keys: list[str] = ("site_id",), day: str = "local_date") -> DataFrame:
    """Dense calendar: silent days become rows of NULLs (A4e).

    Each day is stretched up to its successor, so the spine needs neither a
    second scan nor a join, and the per-site partitioning it creates is the one
    all trailing windows use. The input has one row per key and calendar day.
    """
    keys = list(keys)
    by_day = Window.partitionBy(*keys).orderBy(day)
    rest = [c for c in daily.columns if c not in keys and c != day]
    stretched = daily.withColumn(
        "_until", F.coalesce(F.date_sub(F.lead(day).over(by_day), 1), F.col(day))
    ).withColumn("_day", F.explode(F.sequence(F.col(day), F.col("_until"))))
    real = F.col("_day") == F.col(day)
    return stretched.select(
        *keys,
        F.col("_day").alias(day),
        *[F.when(real, F.col(c)).alias(c) for c in rest],
    )
