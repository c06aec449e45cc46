"""Measurements over the ordered readings of a day, and over the history of a plant or inverter.

One row per key and calendar day bounds a history by the days of the plant, which
is what a per-site window would hold; a task measures all days of one together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_day(df: DataFrame, ties: list) -> DataFrame:
    """Adds ``nth``, the place of a reading in its day. Rows lie together by day, in that order.

    Rows dealt by site and day need no exchange for it; a number in front, which
    differs from day to day, spares most comparisons of names.
    """
    place = Window.partitionBy("_day", "site_id", "local_date").orderBy("ts_utc", *ties)
    return df.withColumn("_day", F.xxhash64("site_id", "local_date")).withColumn(
        "nth", F.row_number().over(place)).drop("_day")


def whole_days(batches):
    """Tables of whole days and where their days start, from batches of :func:`by_day` rows."""
    import numpy as np
    import pyarrow as pa

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        heads = np.flatnonzero(np.asarray(rows["nth"].combine_chunks()) == 1)
        last = int(heads[-1])
        if last:
            yield rows.slice(0, last), heads[:-1]
        rest = rows.slice(last)
    if rest is not None:
        yield rest, np.zeros(1, int)


def over_history(df: DataFrame, keys: list[str], added: str, measure: Callable, order: str = "local_date") -> DataFrame:
    """``df`` with the columns ``added`` (a schema) that ``measure`` makes of a history's rows.

    ``measure`` gets the rows of one key as an Arrow table in ``order`` and
    returns one masked array per added column. A column of that name is replaced.
    """
    import pyarrow as pa

    names = [c.split()[0] for c in added.split(", ")]
    kept = df.select(*[c for c in df.columns if c not in names])
    kinds = {"double": pa.float64(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in added.split(", ")]

    def run(rows: pa.Table) -> pa.Table:
        import numpy as np

        rows = rows.sort_by(order)
        for name, kind, values in zip(names, types, measure(rows)):
            values = np.ma.MaskedArray(values)
            rows = rows.append_column(name, pa.array(values.data, kind, mask=np.ma.getmaskarray(values)))
        return rows

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), added])
    return kept.groupBy(*keys).applyInArrow(run, schema)


def column(rows, name: str):
    """Values of a number column as doubles; unknown ones are NaN."""
    import numpy as np
    import pyarrow as pa

    return np.asarray(rows[name].combine_chunks().cast(pa.float64()).fill_null(float("nan")))


def past(values, n: int):
    """For each day its ``n`` days before, oldest first; days before the first are NaN."""
    import numpy as np

    return np.lib.stride_tricks.sliding_window_view(np.r_[np.full(n, np.nan), values], n)[: len(values)]


def medians(windows):
    """(median, number) of the known values of each window; no median of none is NaN."""
    import numpy as np

    ranked = np.sort(windows, axis=1)
    n = np.count_nonzero(~np.isnan(ranked), axis=1)
    at = lambda k: np.take_along_axis(ranked, np.maximum(k, 0)[:, None], 1)[:, 0]
    some = n > 0
    mid = np.full(len(n), np.nan)
    mid[some] = ((at((n - 1) // 2) + at(np.minimum(n // 2, ranked.shape[1] - 1))) / 2.0)[some]
    return mid, n
