"""Aggregations (A-rows). Values are summed as they are; with ``scale`` (the
number of decimals that the source's values have) the sum is exact and does not
depend on shuffle order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions import half_even, not_in_keep_null, replace_map, total


def rollup_sum(df: DataFrame, keys: Sequence[str], values: Sequence[str],
               scale: int | None = None) -> DataFrame:
    """Group sum to a coarser level (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(*[total(v, scale).alias(v) for v in values])


def detail_and_rollup(df: DataFrame, county: str, state: str, keys: Sequence[str],
                      value: str = "value", exclude: Sequence = (), detail_min_exclusive=1000,
                      scale: int | None = None) -> DataFrame:
    """Detail rows plus a per-state rollup, stacked with a ``location_type`` label.

    ``exclude`` drops from both levels; detail keeps only
    ``county > detail_min_exclusive`` while the rollup includes the
    unallocated rows. The detail needs no shuffle, so it is a filter +
    projection unioned with a partially aggregated rollup (instead of
    grouping sets, which would push every detail row through the shuffle).
    """
    base = df.filter(not_in_keep_null(county, exclude)) if exclude else df
    detail = (base.filter(F.col(county) > F.lit(detail_min_exclusive))
              .select(*keys, F.col(county).cast("bigint").alias("location"),
                      F.col(value).cast("double").alias(value),
                      F.lit("county").alias("location_type")))
    roll = (base.groupBy(*keys, F.col(state).cast("bigint").alias("location"))
            .agg(total(value, scale).alias(value))
            .withColumn("location_type", F.lit("state")))
    return detail.unionByName(roll)


def merge_members_sum(df: DataFrame, column: str, mapping: Mapping[str, str],
                      keys: Sequence[str], values: Sequence[str], scale: int | None = None) -> DataFrame:
    """Fold members into one (``NYC`` -> ``NY``) and sum numeric columns by key."""
    m = df.withColumn(column, replace_map(column, mapping))
    return rollup_sum(m, [column, *keys], values, scale)


def strict_group_sum(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                     scale: int | None = None) -> DataFrame:
    """``sum(skipna=False)``: one null poisons the group sum."""
    return df.groupBy(*keys).agg(*[
        F.when(F.count(F.lit(1)) == F.count(v), total(v, scale)).alias(v) for v in values])


def last_per_key(df: DataFrame, keys: Sequence[str], value: str, ordinal: str) -> DataFrame:
    """``groupby(keys).last()``: the last non-null value in ingest order.
    The order is an explicit ordinal column, never shuffle order."""
    return df.groupBy(*keys).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(ordinal))).alias(value))


def distinct_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def is_time_series(df: DataFrame, keys: Sequence[str] = (), dt: str = "dt") -> DataFrame:
    """More than one distinct date (per key group, or over the whole frame)."""
    return df.groupBy(*keys).agg((F.countDistinct(dt) > 1).alias("is_time_series"))


def cumulative_present(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        (F.count_if(F.col("measurement") == "cumulative") > 0).alias("has_cumulative"))


def proportional_allocation(df: DataFrame, group: Sequence[str], weight: str, amount: Column,
                            out: str = "allocated", large_groups: bool = False) -> DataFrame:
    """``(x / x.sum() * n).round()`` per group with half-even rounding.

    One window over the group reads the input once; a state's counties on one
    day are a small group. With ``large_groups`` the totals are a partial
    aggregate joined back null-safe instead, so that a group holding a third of
    all rows is split by AQE's skew handling (the input is computed twice).
    A null group key is a group of its own, as in pandas."""
    group = list(group)
    if large_groups:
        totals = df.groupBy(*group).agg(F.sum(weight).alias("__total")).select(
            *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], "__total")
        cond = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)]
        j = df.join(totals, cond).drop(*[f"__g{i}" for i in range(len(group))])
    else:
        j = df.withColumn("__total", F.sum(weight).over(Window.partitionBy(*group)))
    return j.withColumn(out, half_even(F.col(weight) / F.col("__total") * amount)).drop("__total")


def variable_names(df: DataFrame, keys: Sequence[str] = ("provider",),
                   name: str = "category") -> DataFrame:
    """Distinct variable names per dataset/provider."""
    return df.select(*keys, F.col(name).alias("variable_name")).distinct()
