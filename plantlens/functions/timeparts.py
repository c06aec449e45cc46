"""Local clocks, interval labels and unit-of-time helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def localized(stamp: Column, tz: Column) -> Column:
    """Instant of a naive local stamp.

    The repeated autumn hour cannot be resolved and gives NULL; a stamp inside
    the skipped spring hour moves to the first instant after the jump. The
    session time zone must be UTC, so a wall-clock TIMESTAMP has no offset.
    """
    wall = stamp.cast("timestamp")
    instant = F.to_utc_timestamp(wall, tz)
    back = F.from_utc_timestamp(instant, tz)
    repeated = F.lit(False)
    for minutes in (30, 60):
        step = F.make_dt_interval(mins=F.lit(minutes))
        repeated = repeated | (F.from_utc_timestamp(instant + step, tz) == wall)
    after_jump = F.to_utc_timestamp(F.date_trunc("hour", wall) + (back - wall), tz)
    return F.when(repeated, F.lit(None)).when(back != wall, after_jump).otherwise(instant)


def with_local_clock(df: DataFrame, tz: Column | str = "tz") -> DataFrame:
    """Adds ``local_ts`` (naive label) and ``local_date`` from ``ts_utc``."""
    tz = F.col(tz) if isinstance(tz, str) else tz
    local = F.from_utc_timestamp("ts_utc", tz)
    return df.withColumn("local_ts", local.cast("timestamp_ntz")).withColumn(
        "local_date", F.to_date(local)
    )


def wall_seconds(naive: Column) -> Column:
    """Seconds of a naive stamp on its own clock, with fraction."""
    return F.unix_micros(naive.cast("timestamp")) / F.lit(1e6)


def label_shift(naive: Column, step_min: Column, closed: str) -> Column:
    """Seconds from a stamp to the END label of its interval on the local grid.

    ``closed='right'``: (t-step, t] -> t.  ``closed='left'``: [t-step, t) -> t.
    """
    micros = F.unix_micros(naive.cast("timestamp"))
    step = step_min.cast("long") * F.lit(60_000_000)
    rest = F.pmod(micros, step)
    if closed == "right":
        gap = F.when(rest == 0, F.lit(0)).otherwise(step - rest)
    else:
        gap = step - rest
    return gap


def plus_micros(stamp: Column, micros: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(stamp) + micros.cast("long"))


def minute_of_day(naive: Column) -> Column:
    return F.hour(naive) * 60 + F.minute(naive)


def within(naive: Column, bounds: tuple[int, int]) -> Column:
    """Inclusive time-of-day window on the local label, to the second (F8)."""
    second = minute_of_day(naive) * 60 + F.second(naive)
    return (second >= bounds[0] * 60) & (second <= bounds[1] * 60)


def datum_to_interval(df: DataFrame) -> DataFrame:
    """Start-stamped watts -> END-labelled kW; needs ``interval_min``."""
    return df.withColumn("ac_power_kw", F.col("watts") / 1000.0).withColumn(
        "ts_utc", plus_micros(F.col("ts_utc"), F.col("interval_min") * 60_000_000)
    )


def interval_to_datum(df: DataFrame) -> DataFrame:
    """Inverse of :func:`datum_to_interval`; NULL readings are skipped."""
    return (
        df.where(F.col("ac_power_kw").isNotNull())
        .withColumn("timestamp", F.unix_timestamp("ts_utc") - F.col("interval_min") * 60)
        .withColumn("watts", F.col("ac_power_kw") * 1000.0)
    )
