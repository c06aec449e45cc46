"""Ordered day rules: first match wins.

A rule is a label, a condition and an evidence text, all plain columns over the
day table. ``RULES`` is an ordinary list: append to it to add a rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.physics import per_hour, unit_count

# fixed values: evidence formats
TEXT = {
    "gap": "only %.0f%% of intervals judgeable — meter or sensor gap, performance unknown",
    "none": "no rule matched",
    "dead": "actual <5%% of expected for %d consecutive intervals (~%.1fh) with expected >20%% of capacity",
    "tmax": "day max %.0f °C",
    "no_tmax": "no temp reading",
    "snow": "PI %.2f with %.1f cm snow in 3 days (%.1f cm in 7) and %s — panel burial, not hardware",
    "shed": "PI %.2f with %.1f cm snow in 7 days (%.1f cm in 30) and %s — partial cover shedding off panels",
    "cloud": "bright but changeable — output %.0f%% of clear-sky ceiling, hourly ratio chopping ±%.2f, PI %.2f — cloud timing the model missed",
    "thermal": "midday sag tracking %.0f °C afternoon (ratio↔temp r=%.2f), deficit %.1f/%d units — thermal derate, not capacity loss",
    "plateau": "bright-day output plateaued %.1fh at %.0f kW — %.0f%% of the %.0f kW AC ceiling — partial capacity loss%s",
    "hole": "morning output %.0f%% of expected but midday only %.0f%% — capacity missing at high sun, panels healthy%s",
    "units": " ≈ %.0f of %d units out (deficit %.1f units)",
    "step": "PI %.2f vs baseline %.2f for 3+ consecutive days — persistent step; partial loss and uniform curtailment/drift both fit (sub-metering would resolve)",
    "sky": "changeable-sky day — output %.0f%% of clear-sky ceiling, hourly output/expected chopping ±%.2f%s",
    "sky_rain": "; %.1f mm rain",
    "rain": "dim rain day — output %.0f%% of clear-sky ceiling, %.1f mm rain",
    "overcast": "deep overcast — output %.0f%% of clear-sky ceiling with the model itself at %.0f%%, smooth hourly ratio (chop ±%.2f); model missed cloud depth",
    "clip": "actual pinned %.1fh at %.0f kW — the %.0f kW AC ceiling — while expected reached %.0f kW",
    "soil": "PI declining %.2f%%/day over trailing %d days; largest single-day drop only %.0f%% of total",
}


@dataclass(frozen=True)
class Rule:
    label: str
    when: Column
    evidence: Column


def text(key: str, *args: Column) -> Column:
    return F.format_string(TEXT[key], *args)


def _unit_text(deficit: Column) -> Column:
    units = unit_count(deficit, F.col("ac_kw"), F.col("n_units"))
    return F.when(
        F.col("n_units") > 1,
        text("units", F.rint(units), F.col("n_units"), units),
    ).otherwise(F.lit(""))


def yes(cond: Column) -> Column:
    """A comparison with a missing measurement does not fire."""
    return F.coalesce(cond, F.lit(False))


def day_rules() -> list[Rule]:
    """Rules in order of precedence, after the coverage gate."""
    c = F.col
    hours = lambda run: c(run) / per_hour(c("interval_min"))
    too_warm = lambda limit: yes(c("tmax") >= limit)
    tmax_text = F.when(c("tmax").isNotNull(), text("tmax", c("tmax"))).otherwise(
        F.lit(TEXT["no_tmax"])
    )
    model_sky = ~c("has_poa")
    rain = F.coalesce("rain_mm", F.lit(0.0))
    model_csr = F.coalesce("model_csr", F.lit(1.0))
    units = unit_count(c("bright_deficit"), c("ac_kw"), c("n_units"))
    share = F.try_divide("trend_drop1", "trend_total")
    chopping = c("chop") > S.CHOP_BROKEN_SKY
    below_ceiling = c("peak") < S.CEILING_FRAC * c("ac_kw")
    return [
        Rule(
            S.SNOW,
            c("has_met")
            & ((c("snow_3d") >= S.SNOW_3D_CM) | (c("snow_7d") >= S.SNOW_7D_CM))
            & (c("pi") < S.SNOW_PI)
            & ~too_warm(S.SNOW_TMAX_C),
            text("snow", c("pi"), c("snow_3d"), c("snow_7d"), tmax_text),
        ),
        Rule(
            S.OUTAGE,
            hours("dead_run") >= S.DEAD_RUN_H,
            text("dead", c("dead_run"), hours("dead_run")),
        ),
        Rule(
            S.THERMAL,
            (c("tmax") >= S.TMAX_HOT_C)
            & (c("ratio_hours") >= S.MIN_RATIO_HOURS)
            & (c("temp_corr") < S.TEMP_CORR)
            & (c("bright_rows") > 0)
            & ~yes((c("n_units") > 1) & (units >= 1 - S.QUANT_TOL)),
            text("thermal", c("tmax"), c("temp_corr"), units, c("n_units")),
        ),
        Rule(
            S.OUTAGE,
            (hours("plateau_run") >= S.PARTIAL_PLATEAU_H)
            & below_ceiling
            & (c("midday_expected") > S.CEILING_FRAC * c("ac_kw")),
            text(
                "plateau", hours("plateau_run"), c("peak"), 100 * c("peak") / c("ac_kw"),
                c("ac_kw"), _unit_text(c("ac_kw") - c("peak")),
            ),
        ),
        Rule(
            S.OUTAGE,
            (c("morning_ratio") > S.MORNING_MIN) & (c("midday_ratio") < S.MIDDAY_MAX),
            text(
                "hole", 100 * c("morning_ratio"), 100 * c("midday_ratio"),
                _unit_text((1 - c("midday_ratio")) * c("ac_kw")),
            ),
        ),
        clipping_rule(),
        Rule(
            S.WEATHER,
            model_sky & (c("csr") < S.CSR_WEATHER) & chopping,
            text(
                "sky", 100 * c("csr"), c("chop"),
                F.when(rain >= S.RAIN_MM, text("sky_rain", rain)).otherwise(F.lit("")),
            ),
        ),
        Rule(
            S.WEATHER,
            model_sky & (c("csr") < S.CSR_RAINY) & (rain >= S.RAIN_MM),
            text("rain", 100 * c("csr"), rain),
        ),
        Rule(
            S.WEATHER,
            model_sky & (c("csr") < S.CSR_DIM) & (model_csr < S.CSR_WEATHER),
            text("overcast", 100 * c("csr"), 100 * model_csr, c("chop")),
        ),
        Rule(
            S.SNOW_SHEDDING,
            c("has_met")
            & ((c("snow_7d") >= S.SNOW_3D_CM) | (c("snow_30d") >= S.SNOW_30D_CM))
            & (c("pi") < S.SHED_PI)
            & ~too_warm(S.SNOW_SHED_TMAX_C),
            text("shed", c("pi"), c("snow_7d"), c("snow_30d"), tmax_text),
        ),
        Rule(
            S.CLOUD_INTERMITTENT,
            model_sky
            & (c("csr") >= S.CSR_WEATHER) & (c("csr") < S.CSR_BRIGHT)
            & chopping
            & (c("pi") >= S.CLOUD_PI),
            text("cloud", 100 * c("csr"), c("chop"), c("pi")),
        ),
        Rule(S.UNCLASSIFIED, c("step3"), text("step", c("step3_median"), c("pi_baseline"))),
        Rule(
            S.SOILING,
            (c("trend_n") >= S.TREND_MIN)
            & (c("trend_slope") < S.TREND_SLOPE)
            & ~yes(c("trend_drop1") > S.TREND_DROP1 * c("trend_total"))
            & ~yes(c("trend_drop2") > S.TREND_DROP2 * c("trend_total")),
            text("soil", 100 * c("trend_slope"), c("trend_n"), 100 * share),
        ),
    ]


def clipping_rule() -> Rule:
    c = F.col
    run_h = c("plateau_run") / per_hour(c("interval_min"))
    return Rule(
        S.CLIPPING,
        (run_h >= S.CLIP_PLATEAU_H)
        & (c("peak") >= S.CEILING_FRAC * c("ac_kw"))
        & (c("midday_expected") > S.CLIP_EXPECTED * c("peak")),
        text("clip", run_h, c("peak"), c("ac_kw"), c("midday_expected")),
    )


def precedence(rules: list[Rule]) -> list[str]:
    """Distinct labels in rule order, led by the coverage gate."""
    return list(dict.fromkeys([S.DATA_GAP, *[r.label for r in rules]]))


def _verdict(label: str, evidence: Column) -> Column:
    return F.struct(F.lit(label).alias("label"), evidence.alias("evidence"))


def label_days(days: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Adds ``label`` and ``evidence``; both stay NULL on days nothing applies to.

    Flagged days go through the gate and all rules; unflagged, well-covered days
    only through the clipping census (R13).
    """
    rules = day_rules() if rules is None else rules
    covered = F.col("coverage") >= F.col("coverage_min")
    census = clipping_rule()
    chain = F.when(
        ~F.col("flagged"),
        F.when(covered & yes(census.when), _verdict(census.label, census.evidence)),
    ).when(~covered, _verdict(S.DATA_GAP, text("gap", 100 * F.col("coverage"))))
    for rule in rules:
        chain = chain.when(yes(rule.when), _verdict(rule.label, rule.evidence))
    chain = chain.otherwise(_verdict(S.UNCLASSIFIED, F.lit(TEXT["none"])))
    return (
        days.withColumn("_v", chain)
        .withColumn("label", F.col("_v.label"))
        .withColumn("evidence", F.col("_v.evidence"))
        .drop("_v")
    )


def classify(days: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Labelled days only."""
    return (
        label_days(days, rules)
        .where(F.col("label").isNotNull())
        .select("site_id", "local_date", "label", "pi", "evidence")
    )
