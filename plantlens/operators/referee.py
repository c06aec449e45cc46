"""Fleet-relative grading by inverter energy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.physics import per_hour
from .align import attach_sites, fill_days
from .history import column, medians, over_history, past
from .rules import yes

# fixed values: evidence formats
TEXT = {
    "subset": "%d/%d inverters divergent, explaining %.0f%% of the shortfall — was: %s",
    "collapse": "plant-wide: fleet at %.0f%% of trailing norm — was: %s",
    "residual": "fleet-wide %s%s plus %d divergent inverters explaining %.0f%% — was: %s",
    "dim": " (dim day: %.0f%% of clear ceiling)",
    "clamp": " (bright day clamped at %.0f kW)",
    "curtail": "bright day clamped flat at %.0f kW with zero divergent inverters — was: %s",
}


def inverter_daily(inverters: DataFrame, sites: DataFrame) -> DataFrame:
    """Energy per inverter and day on the plant's full calendar; missing is 0."""
    kwh = inverters.groupBy("site_id", "inverter", "local_date").agg(
        F.sum("kw").alias("_kw")
    )
    kwh = attach_sites(kwh, sites, ["interval_min"])
    kwh = kwh.select(
        "site_id", "inverter", "local_date",
        (F.coalesce("_kw", F.lit(0.0)) * F.col("interval_min") / 60.0).alias("kwh"),
    )
    # every inverter spans the plant's first to last day: its own first and last rows
    # bring the calendar ends of the plant that it lacks. One exchange of day rows, by site
    site, own = Window.partitionBy("site_id"), Window.partitionBy("site_id", "inverter")
    day, none = F.col("local_date"), F.lit(None).cast("date")
    known = F.col("site_id").isNotNull()
    lo, hi = F.when(known, F.min(day).over(site)), F.when(known, F.max(day).over(site))
    ends = F.array(
        day,
        F.when(day.eqNullSafe(F.min(day).over(own)), F.col("_lo")).otherwise(none),
        F.when(day.eqNullSafe(F.max(day).over(own)), F.col("_hi")).otherwise(none),
    )
    full = (
        kwh.withColumns({"_lo": lo, "_hi": hi}).withColumn("_days", F.array_distinct(F.array_compact(ends)))
        .withColumn("_day", F.explode("_days"))
        .select("site_id", "inverter", F.col("_day").alias("local_date"),
                F.when(F.col("_day") == day, F.col("kwh")).otherwise(F.lit(0.0)).alias("kwh"))
    )
    return fill_days(full, ["site_id", "inverter"]).withColumn(
        "kwh", F.coalesce("kwh", F.lit(0.0))
    )


def daily_divergence(kwh: DataFrame) -> DataFrame:
    """Which inverters fell under the fleet, per site and day (G1)."""
    def norm(rows):
        import numpy as np

        middle, seen = medians(past(column(rows, "kwh"), S.TRAIL_DAYS))
        return [np.ma.MaskedArray(middle, seen < S.TRAIL_DAYS // 3)]

    fleet_day = Window.partitionBy("site_id", "local_date")
    zero = F.lit(0.0)
    df = over_history(kwh, ["site_id", "inverter"], "_trail double", norm).withColumn(
        "_norm",
        F.when(
            (F.col("_trail") == 0) & (F.col("kwh") > 0), F.lit(float("inf"))
        ).otherwise(F.try_divide("kwh", "_trail")),
    )
    df = df.withColumn("_fleet", F.percentile("_norm", F.lit(0.5)).over(fleet_day))
    divergent = yes(
        (F.col("_fleet") > S.FLEET_HEALTHY)
        & (F.col("_norm") < (1 - S.DIVERGENCE_MARGIN) * F.col("_fleet"))
    )
    df = df.withColumn("_div", divergent)
    short = lambda expected: F.greatest(expected - F.col("kwh"), zero)
    out = df.groupBy("site_id", "local_date").agg(
        F.count_if("_div").cast("int").alias("n_divergent"),
        F.sort_array(F.collect_list(F.when(F.col("_div"), F.col("inverter")))).alias("divergent"),
        F.max("_fleet").alias("fleet_median"),
        F.coalesce(
            F.sum(F.when(F.col("_div"), short(F.col("_trail") * F.col("_fleet")))), zero
        ).alias("_div_short"),
        F.coalesce(
            F.sum(F.when(F.col("_trail").isNotNull(), short(F.col("_trail")))), zero
        ).alias("_short"),
    )
    return out.withColumn(
        "div_share", F.when(F.col("_short") > 0, F.col("_div_short") / F.col("_short"))
    ).drop("_div_short", "_short")


def resolve(labelled: DataFrame, referee: DataFrame) -> DataFrame:
    """Final label, secondary label and verdict for labelled days.

    ``labelled`` carries the rule label and the day shape; plants without
    sub-metering pass through with a NULL verdict.
    """
    c = F.col
    df = labelled.join(
        referee.select("site_id", "local_date", "n_divergent", "div_share", "fleet_median"),
        ["site_id", "local_date"], "left",
    )
    graded = c("label").isNotNull() & c("has_submeter")
    seen = c("fleet_median").isNotNull()
    faulty = yes((c("n_divergent") >= 1) & (c("div_share") >= S.SHARE_DOMINANT))
    some = yes((c("n_divergent") >= 1) & (c("div_share") > 0))
    collapsed = c("fleet_median") <= S.FLEET_HEALTHY
    run_h = c("plateau_run") / per_hour(c("interval_min"))
    clamped = yes(
        (run_h >= S.CURTAIL_PLATEAU_H) & (c("peak") < S.CEILING_FRAC * c("ac_kw"))
    )
    dim = yes(c("csr") < S.CSR_WEATHER)
    bright = yes(c("csr") >= S.CSR_WEATHER)
    sky = c("label").isin(
        S.THERMAL, S.WEATHER, S.SNOW, S.SNOW_SHEDDING, S.CLOUD_INTERMITTENT
    )
    was = c("evidence")
    share = 100 * c("div_share")
    residual = (
        F.when(dim, F.lit(S.WEATHER)).when(clamped, F.lit(S.CURTAILMENT))
        .otherwise(F.lit(S.UNCLASSIFIED))
    )
    detail = (
        F.when(dim, F.format_string(TEXT["dim"], 100 * c("csr")))
        .when(clamped, F.format_string(TEXT["clamp"], c("peak")))
        .otherwise(F.lit(""))
    )

    def ruling(label: Column, verdict, evidence: Column, label_2: Column | None = None) -> Column:
        verdict = F.lit(verdict) if isinstance(verdict, str) else verdict
        label_2 = F.lit(None).cast("string") if label_2 is None else label_2
        return F.struct(
            label.alias("label"), label_2.alias("label_2"),
            verdict.alias("verdict"), evidence.alias("evidence"),
        )

    keep = c("label")
    unresolved = c("label") == S.UNCLASSIFIED
    decision = (
        F.when(~graded, ruling(keep, F.lit(None).cast("string"), was))
        .when(~seen, ruling(keep, "uncheckable", was))
        .when(
            c("label") == S.OUTAGE,
            ruling(
                keep,
                F.when((c("n_divergent") >= 1) | collapsed, "confirmed").otherwise("refuted"),
                was,
            ),
        )
        .when(sky, ruling(keep, F.when(faulty, "refuted").otherwise("confirmed"), was))
        .when(
            unresolved & faulty,
            ruling(
                F.lit(S.OUTAGE), "attributed",
                F.format_string(TEXT["subset"], c("n_divergent"), c("n_units"), share, was),
            ),
        )
        .when(
            unresolved & collapsed,
            ruling(
                F.lit(S.OUTAGE), "attributed",
                F.format_string(TEXT["collapse"], 100 * c("fleet_median"), was),
            ),
        )
        .when(
            unresolved & some,
            ruling(
                residual, "attributed",
                F.format_string(TEXT["residual"], residual, detail, c("n_divergent"), share, was),
                F.lit(S.OUTAGE),
            ),
        )
        .when(
            unresolved & bright & clamped,
            ruling(
                F.lit(S.CURTAILMENT), "attributed",
                F.format_string(TEXT["curtail"], c("peak"), was),
            ),
        )
        .otherwise(ruling(keep, "uncheckable", was))
    )
    return df.withColumn("_r", decision).select(
        *labelled.columns,
        c("_r.label").alias("final_label"),
        c("_r.label_2").alias("final_label_2"),
        c("_r.verdict").alias("verdict"),
        c("_r.evidence").alias("final_evidence"),
        "n_divergent", "div_share", "fleet_median",
    )
