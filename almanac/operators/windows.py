"""Per-series window operators (W-rows).

Every window here partitions by the series key, so at scale one shuffle on
that key serves the whole validation pass; no window is unpartitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions.numeric import from_units, to_units


def _w(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def _join_back(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of per-bucket summaries; null keys are keys like any other, as
    in the windows that made the summaries."""
    named = summary.withColumnsRenamed({k: f"__j{i}" for i, k in enumerate(keys)})
    cond = [F.col(k).eqNullSafe(F.col(f"__j{i}")) for i, k in enumerate(keys)]
    return df.join(named, cond, "left").drop(*[f"__j{i}" for i in range(len(keys))])


def running_sum(df: DataFrame, keys: Sequence[str], order, value: str, out: str,
                bucket: Column | None = None, scale: int | None = None) -> DataFrame:
    """Running sum of ``value`` per series, ordered by ``order`` (a column
    name or Column). Nulls are skipped in the sum.

    With ``bucket`` (a value that never decreases along ``order``, e.g. the
    year or the month start of the date) a long series is split into
    buckets that are summed in parallel: a running sum inside each bucket
    plus the total of all earlier buckets (a partial aggregate per bucket and
    a window over the few bucket totals, joined back on (series, bucket)).
    A series holding a third of all rows then no longer lands in one task.
    """
    keys = list(keys)
    # with a scale: sum integer units, divide once at the end
    v = F.col(value) if scale is None else to_units(value, scale)
    back = (lambda c: c) if scale is None else (lambda c: from_units(c, scale))
    o = F.col(order) if isinstance(order, str) else order
    rows = Window.unboundedPreceding, Window.currentRow
    if bucket is None:
        s = F.sum(v).over(Window.partitionBy(*keys).orderBy(o).rowsBetween(*rows))
        return df.withColumn(out, back(s))
    b = df.withColumn("__b", bucket)
    inner = F.sum(v).over(Window.partitionBy(*keys, "__b").orderBy(o).rowsBetween(*rows))
    b = b.withColumn("__in", inner)
    totals = b.groupBy(*keys, "__b").agg(F.sum(v).alias("__t"))
    wb = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "__b", F.coalesce(F.sum("__t").over(wb), F.lit(0)).alias("__off"))
    j = _join_back(b, offsets, [*keys, "__b"])
    total = F.col("__in") + F.coalesce(F.col("__off"), F.lit(0))
    return j.withColumn(out, back(total)).drop("__b", "__in", "__off")


def series_lag(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str = "__prev",
               bucket: Column | None = None) -> DataFrame:
    """Previous row's ``value`` within each series (``lag(1)``).

    With ``bucket`` the series is split: inside a bucket the plain lag; the
    first row of a bucket takes the last value of the nearest earlier bucket
    (``max_by`` per bucket, then a lag over the bucket summaries).
    """
    keys = list(keys)
    if bucket is None:
        return df.withColumn(out, F.lag(value).over(_w(keys, order)))
    b = df.withColumn("__b", bucket)
    w = Window.partitionBy(*keys, "__b").orderBy(order)
    b = b.withColumns({"__lag": F.lag(value).over(w), "__rn": F.row_number().over(w)})
    last = b.groupBy(*keys, "__b").agg(F.max_by(F.col(value), F.col(order)).alias("__last"))
    prev = last.select(*keys, "__b", F.lag("__last").over(Window.partitionBy(*keys).orderBy("__b"))
                       .alias("__pb"))
    j = _join_back(b, prev, [*keys, "__b"])
    return (j.withColumn(out, F.when(F.col("__rn") == 1, F.col("__pb")).otherwise(F.col("__lag")))
            .drop("__b", "__lag", "__rn", "__pb"))


def running_total(df: DataFrame, keys: Sequence[str], order: str = "dt", value: str = "value",
                  out: str | None = None, scale: int | None = None,
                  bucket: Column | None = None) -> DataFrame:
    """``groupby(keys).cumsum()``: nulls are skipped in the sum and stay null
    in the output. ``scale`` (decimals of the source's values) sums without float
    drift; ``bucket`` splits long series (see ``running_sum``)."""
    out = out or value
    summed = running_sum(df, keys, order, value, "__cum", bucket=bucket, scale=scale)
    v = F.col(value)
    return summed.withColumn(out, F.when(v.isNull(), F.lit(None).cast("double"))
                             .otherwise(F.col("__cum").cast("double"))).drop("__cum")


def daily_new(df: DataFrame, keys: Sequence[str], order: str = "dt", value: str = "value",
              out: str = "new_value", bucket: Column | None = None) -> DataFrame:
    """New from cumulative: ``value - lag(value)`` within each series (a
    series' first row is null; the diff never crosses series)."""
    lagged = series_lag(df, keys, order, value, bucket=bucket)
    return lagged.withColumn(out, F.col(value) - F.col("__prev")).drop("__prev")


def drop_plateaus(df: DataFrame, keys: Sequence[str], start, end, scope: Column | None = None,
                  order: str = "dt", value: str = "value") -> DataFrame:
    """Within ``[start, end]`` and ``scope``, drop rows equal to the previous
    row of their series. The lag is taken inside the window only, so the
    first row of the window is kept; rows outside stay untouched.

    Only the rows inside the date window are shuffled and sorted for the lag;
    everything else passes through a filter (the scan is read twice, which
    is far cheaper than sorting the whole table by series).
    """
    in_win = F.col(order).between(F.lit(start), F.lit(end))
    if scope is not None:
        in_win = in_win & scope
    in_win = F.coalesce(in_win, F.lit(False))
    outside = df.filter(~in_win)
    inside = df.filter(in_win)
    diff = F.col(value) - F.lag(value).over(_w(keys, order))
    kept = (inside.withColumn("__diff", diff)
            .filter(~F.coalesce(F.col("__diff") == 0, F.lit(False))).drop("__diff"))
    return outside.unionByName(kept)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All members of duplicated keys (``duplicated(keep=False)``).

    A partial count per key (map-side combine, so a hot key costs one row
    per task) finds the duplicated keys; a semi join returns their members.
    """
    keys = list(keys)
    dup = (df.groupBy(*keys).count().filter(F.col("count") > 1)
           .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]))
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return df.join(dup, cond, "left_semi")


def cumulative_decreases(df: DataFrame, series_key: Sequence[str], cut_date: str = "2021-01-01",
                         order: str = "dt", value: str = "value",
                         measurement: str = "cumulative", bucket: Column | None = None) -> DataFrame:
    """Rows of cumulative series whose value dropped from the previous date.

    Nulls are removed and the date cut is applied *before* the diff, so a
    drop across the cut is not reported.
    """
    base = df.filter((F.col("measurement") == measurement) & F.col(value).isNotNull()
                     & ~F.isnan(F.col(value)) & (F.col(order) >= F.lit(cut_date).cast("date")))
    lagged = series_lag(base, series_key, order, value, bucket=bucket)
    return (lagged.withColumn("diff", F.col(value) - F.col("__prev")).drop("__prev")
            .filter(F.col("diff") < 0))


def cumulative_decrease_report(df: DataFrame, series_key: Sequence[str], **kw) -> DataFrame:
    """One issue per series with its sorted list of bad dates."""
    bad = cumulative_decreases(df, series_key, **kw)
    return bad.groupBy(*series_key).agg(F.array_sort(F.collect_list("dt")).alias("dates"))
