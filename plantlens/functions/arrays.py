"""Small array expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Bind ``value`` once and evaluate ``body(value)``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def median_of(values: Column) -> Column:
    """Median of the non-NULL entries; NULL when there are none."""
    def body(s):
        n = F.size(s)
        lo = F.get(s, F.floor((n - 1) / 2).cast("int"))
        hi = F.get(s, F.floor(n / 2).cast("int"))
        return F.when(n > 0, (lo + hi) / F.lit(2.0))
    return let(F.sort_array(F.array_compact(values)), body)


def sum_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def diffs(values: Column) -> Column:
    """Consecutive differences; empty for fewer than two entries."""
    n = F.size(values)
    return F.when(
        n > 1,
        F.zip_with(
            F.slice(values, 2, F.greatest(n - 1, F.lit(1))),
            F.slice(values, 1, F.greatest(n - 1, F.lit(1))),
            lambda b, a: b - a,
        ),
    ).otherwise(F.array().cast("array<double>"))


def ols_slope(values: Column) -> Column:
    """Least-squares slope of the entries against 0..n-1."""
    n = F.size(values).cast("double")
    mid = (n - 1) / 2
    sxy = sum_of(F.transform(values, lambda y, i: (i.cast("double") - mid) * y))
    return F.try_divide(sxy, n * (n * n - 1) / 12)


def longest_run(values: Column, test) -> Column:
    """Length of the longest run of adjacent entries passing ``test`` (A10)."""
    def step(acc, v):
        run = F.when(F.coalesce(test(v), F.lit(False)), acc["run"] + 1).otherwise(F.lit(0))
        return F.struct(run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))
    return F.aggregate(values, start, step, lambda acc: acc["best"])
