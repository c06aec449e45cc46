"""Plant-day diagnosis for all plants at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.align import attach_sites
from ..operators.daily import add_flags, finish_daily, report_window
from ..operators.events import events
from ..operators.features import training_frame
from ..operators.referee import daily_divergence, inverter_daily, resolve
from ..operators.rules import Rule, label_days
from ..operators.shape import day_shape
from ..operators.trailing import trailing_context
from ..operators.trend import daily_insolation, daily_pi, degradation, soiling
from ..session import cut_lineage
from ..sites import distinct_windows

DAY_FACTS = ["ac_kw", "dc_kw", "n_units", "interval_min", "coverage_min", "flag_threshold",
             "pi_ceiling", "window_days", "has_poa", "has_met", "has_submeter"]


def day_table(interval: DataFrame, sites: DataFrame) -> DataFrame:
    """Dense days over the full span: energies, coverage, PI and day shape."""
    shape = attach_sites(day_shape(interval, sites), sites, ["interval_min"])
    return attach_sites(finish_daily(shape), sites, DAY_FACTS)


def flagged_days(days: DataFrame, sites: DataFrame, windows: tuple[int, ...] = (30,)) -> DataFrame:
    """Reporting span with baseline, flags and trailing context."""
    return trailing_context(add_flags(report_window(days, sites), windows))


def no_referee(spark) -> DataFrame:
    return spark.createDataFrame(
        [], "site_id string, local_date date, n_divergent int, div_share double, fleet_median double"
    )


@dataclass
class Diagnosis:
    days: DataFrame       # every day of the report, labels where given
    full_days: DataFrame  # every day of the span, PI unmasked
    events: DataFrame
    training: DataFrame


def diagnose(
    interval: DataFrame, sites: DataFrame, inverters: DataFrame | None = None,
    windows: tuple[int, ...] | None = None, rules: list[Rule] | None = None, materialize: bool = False,
) -> Diagnosis:
    """The whole diagnosis. With ``materialize`` the day table, which everything
    below reads, is written once to the shared folder instead of recomputed."""
    full = day_table(interval, sites)
    if materialize:
        full = cut_lineage(full, "days")
    labelled = label_days(flagged_days(full, sites, windows or distinct_windows(sites)), rules)
    if inverters is None:
        referee = no_referee(interval.sparkSession)
    else:
        referee = daily_divergence(inverter_daily(inverters, sites))
    final = resolve(labelled, referee)
    if materialize:
        final = cut_lineage(final, "final")
    return Diagnosis(final, full, event_table(final), training_frame(final))


def event_table(final: DataFrame) -> DataFrame:
    labels = final.where(F.col("final_label").isNotNull()).select(
        "site_id", "local_date", F.col("final_label").alias("label"), "pi",
        F.col("final_evidence").alias("evidence"),
    )
    return events(labels, final)


def trend_table(diagnosis: Diagnosis, interval: DataFrame, sites: DataFrame) -> DataFrame:
    """Degradation and soiling per site, over the full span."""
    pi = daily_pi(diagnosis.full_days)
    return degradation(pi).join(
        soiling(pi, daily_insolation(interval, sites), sites), "site_id", "left"
    )
