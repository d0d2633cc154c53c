"""Backfill corrections on cumulative panels.

A correction "subtract n from a series on every date >= d" is an as-of step. The
corrections are a short list: gathered per series into an array of (date, n)
and joined to the panel by broadcast, they are summed up to each row's date in
the row itself. The panel is neither shuffled nor sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.errors import ValidationError
from almanac.functions import half_even

SERIES = ["location_type", "location", "category"]


def apply_deltas(panel: DataFrame, deltas: DataFrame, value: str = "value",
                 series: Sequence[str] = tuple(SERIES), dt: str = "dt") -> DataFrame:
    """Subtract, from every row, the sum of the series' deltas dated on or before
    the row's date. ``deltas`` (a list of corrections: series columns, ``dt``,
    ``delta``) becomes one array per series. Null series keys are keys like any
    other."""
    series = list(series)
    steps = (deltas.groupBy(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(series)])
             .agg(F.collect_list(F.struct(F.col(dt).alias("dt"), F.col("delta").cast("bigint").alias("n"))).alias("__steps")))
    on = [F.col(c).eqNullSafe(F.col(f"__s{i}")) for i, c in enumerate(series)]
    due = F.aggregate(F.filter("__steps", lambda d: d["dt"] <= F.col(dt)), F.lit(0).cast("bigint"), lambda a, d: a + d["n"])
    return (panel.join(steps, on, "left")  # one row per corrected series: a literal list, which Spark broadcasts
            .withColumn(value, F.col(value) - F.coalesce(due, F.lit(0)))
            .drop("__steps", *[f"__s{i}" for i in range(len(series))]))


def _corrections_frame(spark: SparkSession, corrections, cols: str) -> DataFrame:
    from almanac.session import literal_frame
    return literal_frame(spark, list(corrections), cols).withColumn("dt", F.col("dt").cast("date"))


def backfill_county(panel: DataFrame, corrections, locations: DataFrame, category: str,
                    value: str = "value") -> DataFrame:
    """For each (county, date, n): subtract n from the county and from its
    state on all dates >= date. ``corrections`` is a list of
    (location, date, n); a county's state comes from ``locations``."""
    c = _corrections_frame(panel.sparkSession, corrections, "location long, dt string, delta long")
    county_state = locations.filter(F.col("location_type") == "county").select("location", "state_fips")
    county = c.select(F.lit("county").alias("location_type"), "location", "dt", "delta")
    state = (county_state.join(c, ["location"])  # the literal list
             .select(F.lit("state").alias("location_type"),
                     F.col("state_fips").cast("bigint").alias("location"), "dt", "delta"))
    return apply_deltas(panel, county.unionByName(state).withColumn("category", F.lit(category)), value)


def backfill_state(panel: DataFrame, corrections, category: str, exclude: Sequence = (),
                   value: str = "value") -> DataFrame:
    """For each (state, date, n): allocate n to the state's counties by that
    day's new count (half-even rounding), subtract the allocations from the
    counties and n from the state on all dates >= date.

    Corrections of one state must have distinct dates: a step at d changes
    a series' daily diff only at d, so distinct dates are independent and
    one pass equals the sequential loop. Apply after ``backfill_county``.

    A day's new count is the value on that date less the value on the date
    before; both are partial aggregates per (county, correction), so only those
    few rows are shuffled.
    """
    corrections = list(corrections)
    if len({(s, d) for s, d, _ in corrections}) != len(corrections):
        raise ValidationError("state backfill corrections must have distinct (state, date)")
    c = _corrections_frame(panel.sparkSession, corrections, "state_fips long, dt string, n long")
    counties = panel.filter((F.col("location_type") == "county") & (F.col("category") == category))
    if exclude:
        counties = counties.filter(~F.col("location").isin(list(exclude)))
    cc = c.select(F.col("state_fips").alias("sf"), F.col("dt").alias("cdt"), "n")
    before = F.when(F.col("dt") < F.col("cdt"), F.col("dt"))
    hit = (counties.join(F.broadcast(cc), (F.col("state_fips").cast("bigint") == F.col("sf")) & (F.col("dt") <= F.col("cdt")))
           .groupBy("location", "sf", "cdt", "n")
           .agg(F.count_if(F.col("dt") == F.col("cdt")).alias("__there"),
                F.max(F.when(F.col("dt") == F.col("cdt"), F.col(value))).alias("__now"),
                F.max_by(F.col(value), before).alias("__before"))
           .filter("__there > 0").withColumn("w", F.col("__now") - F.col("__before")))
    share = F.col("w") / F.sum("w").over(Window.partitionBy("sf", "cdt"))
    alloc = hit.select(F.lit("county").alias("location_type"), "location", F.col("cdt").alias("dt"),
                       F.coalesce(half_even(share * F.col("n")), F.lit(0.0)).cast("bigint").alias("delta"))
    state = c.select(F.lit("state").alias("location_type"), F.col("state_fips").alias("location"),
                     "dt", F.col("n").alias("delta"))
    return apply_deltas(panel, alloc.unionByName(state).withColumn("category", F.lit(category)), value)
