"""Multi-day events (W7, A28, J8) and training event ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DATA_GAP
from ..session import cut_lineage


def segments(labels: DataFrame) -> DataFrame:
    """Runs of the same label on consecutive days: ``site_id, label, start, end, evidence``."""
    w = Window.partitionBy("site_id").orderBy("local_date")
    opens = (
        F.lag("label").over(w).isNull()
        | (F.lag("label").over(w) != F.col("label"))
        | (F.datediff("local_date", F.lag("local_date").over(w)) != 1)
    )
    return (
        labels.withColumn("_seg", F.sum(opens.cast("int")).over(w))
        .groupBy("site_id", "_seg")
        .agg(
            F.first("label").alias("label"),
            F.min("local_date").alias("start"),
            F.max("local_date").alias("end"),
            F.min_by("evidence", "local_date").alias("evidence"),
        )
    )


def bridge_gaps(segs: DataFrame) -> DataFrame:
    """Numbers events so that a gap between two touching runs of one label joins them.

    Whether a gap is absorbed depends on its two neighbours only, so ``lag`` and
    ``lead`` decide it.
    """
    w = Window.partitionBy("site_id").orderBy("start")
    prev_label, next_label = F.lag("label").over(w), F.lead("label").over(w)
    absorbed = (
        (F.col("label") == DATA_GAP)
        & (prev_label == next_label)
        & (F.datediff("start", F.lag("end").over(w)) == 1)
        & (F.datediff(F.lead("start").over(w), "end") == 1)
    )
    out = segs.withColumn("_absorbed", F.coalesce(absorbed, F.lit(False)))
    follows = F.coalesce(F.lag("_absorbed").over(w), F.lit(False))
    opens = ~F.col("_absorbed") & ~follows
    return out.withColumn("event_seq", F.sum(opens.cast("int")).over(w)).drop("_absorbed")


def events(labels: DataFrame, daily: DataFrame) -> DataFrame:
    """Event table (D8). ``labels``: site_id, local_date, label, pi, evidence;
    ``daily``: dense days with energies, coverage and ``coverage_min``."""
    spans = (
        bridge_gaps(segments(labels))
        .groupBy("site_id", "event_seq")
        .agg(
            F.min_by("label", "start").alias("label"),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.min_by("evidence", "start").alias("evidence"),
        )
        .withColumn("days", F.datediff("end", "start") + 1)
    )
    # one row per day of the event: an equi-join replaces the range join
    by_day = spans.select(
        "site_id", "event_seq",
        F.explode(F.sequence("start", "end")).alias("local_date"),
    )
    valid = F.col("coverage") >= F.col("coverage_min")
    facts = daily.select(
        "site_id", "local_date",
        F.when(valid, F.col("expected_kwh") - F.col("actual_kwh")).alias("_deficit"),
    )
    rolled = (
        by_day.join(facts, ["site_id", "local_date"], "left")
        .join(
            labels.select("site_id", "local_date", F.col("pi").alias("_pi")),
            ["site_id", "local_date"], "left",
        )
        .groupBy("site_id", "event_seq")
        .agg(
            F.percentile("_pi", F.lit(0.5)).alias("median_pi"),
            F.coalesce(F.sum("_deficit"), F.lit(0.0)).alias("energy_deficit_kwh"),
        )
    )
    return spans.join(rolled, ["site_id", "event_seq"]).select(
        "site_id", "event_seq", "label", "start", "end", "days", "median_pi",
        "energy_deficit_kwh", "evidence",
    )


def assign_events(rows: DataFrame) -> DataFrame:
    """Adds ``event_id = site:label:counter`` and the stable ``event_key``.

    The counter runs over all sites in order. It is the per-site running count
    plus an offset. The sites are cut into ranges of about equal size; offsets
    are sums inside a range plus sums over the ranges, of which there is one for
    each shuffle partition, so no step sorts all rows, or all sites, in one task.
    """
    w = Window.partitionBy("site").orderBy("date")
    opens = (
        F.lag("final_label").over(w).isNull()
        | (F.lag("final_label").over(w) != F.col("final_label"))
        | (F.datediff("date", F.lag("date").over(w)) != 1)
    )
    numbered = rows.withColumn("_opens", opens.cast("long")).withColumn(
        "_local", F.sum("_opens").over(w)
    ).withColumn(
        "_start",
        F.last(F.when(F.col("_opens") == 1, F.col("date")), ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, 0)
        ),
    )
    counts = numbered.groupBy("site").agg(F.max("_local").alias("n"))
    # written, so that both readings see the same ranges
    ranged = cut_lineage(
        counts.repartitionByRange("site").withColumn("_range", F.spark_partition_id()), "event-counts"
    )
    before_range = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("_range").agg(F.sum("n").alias("n")).select(
        "_range", F.coalesce(F.sum("n").over(before_range), F.lit(0)).alias("_range_off")
    )
    before_site = (
        Window.partitionBy("_range").orderBy("site").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        ranged.withColumn("_site_off", F.coalesce(F.sum("n").over(before_site), F.lit(0)))
        .join(ranges, "_range")
        .select("site", (F.col("_site_off") + F.col("_range_off")).alias("_offset"))
    )
    return (
        numbered.join(offsets, "site")
        .withColumn(
            "event_id",
            F.concat_ws(
                ":", "site", "final_label", (F.col("_local") + F.col("_offset")).cast("string")
            ),
        )
        .withColumn("event_key", F.concat_ws(":", "site", "final_label", F.col("_start").cast("string")))
        .drop("_opens", "_local", "_start", "_offset")
    )
