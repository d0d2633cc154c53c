"""Validation operators (V-rows). Each returns a violations DataFrame; an
empty frame means the check passed. ``raise_if_any`` turns violations into
a driver exception with a bounded sample (never a full collect)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.errors import ValidationError
from almanac.operators.windows import cumulative_decrease_report, cumulative_decreases  # noqa: F401

# index columns of a normalised frame besides the location column
INDEX_COLUMNS = ["dt", "category", "measurement", "unit", "age", "sex", "race", "ethnicity"]


# Category pairs of which the first never exceeds the second.
ORDERED_CATEGORIES = [
    ("total_vaccine_initiated", "total_vaccine_doses_administered"),
    ("total_vaccine_completed", "total_vaccine_doses_administered"),
    ("total_vaccine_completed", "total_vaccine_initiated"),
]


def _row_keys(df: DataFrame) -> list[str]:
    loc = "location" if "location" in df.columns else "location_name"
    keys = [loc] + [c for c in INDEX_COLUMNS if c not in ("category", "unit")]
    return keys + (["provider"] if "provider" in df.columns else [])


def category_orders(df: DataFrame, pairs: Sequence[tuple[str, str]], strict: bool = False,
                    keys: Sequence[str] | None = None, measurement: str = "cumulative") -> DataFrame:
    """Ordered categories among cumulative rows: for each (small, large) pair,
    ``large >= small`` on every common key (``large > small`` when ``strict``).

    The key leaves out unit and category, and rows are compared one by one: rows
    of the same unit with each other, a row without a partner of its unit with
    every row of units the other side alone has. A missing value on either side
    is a violation. All pairs are checked in one aggregation; a key's rows are
    its categories and units, so the collected list is short. Returns the
    violating rows: category, other_category, the key, both units and values."""
    keys = list(keys) if keys is not None else _row_keys(df)
    names = sorted({c for p in pairs for c in p})
    base = df.filter((F.col("measurement") == measurement) & F.col("category").isin(names))
    rows = base.groupBy(*keys).agg(F.collect_list(F.struct("category", "unit", "value")).alias("rows"))
    wanted = F.array(*[F.struct(F.lit(a).alias("small"), F.lit(b).alias("large")) for a, b in pairs])
    side = lambda name: F.filter("rows", lambda r: r["category"] == F.col(name))
    rows = rows.withColumn("pair", F.explode(wanted)).select(
        *keys, F.col("pair.small").alias("category"), F.col("pair.large").alias("other_category"), "rows")
    rows = rows.withColumns({"smalls": side("category"), "larges": side("other_category")}).drop("rows")
    unit_in = lambda unit, rows: F.exists(rows, lambda r: r["unit"].eqNullSafe(unit))
    rows = rows.withColumn("s", F.explode("smalls"))
    partners = F.when(unit_in(F.col("s.unit"), F.col("larges")),
                      F.filter("larges", lambda r: r["unit"].eqNullSafe(F.col("s.unit")))).otherwise(
        F.filter("larges", lambda r: ~unit_in(r["unit"], F.col("smalls"))))
    rows = rows.withColumn("l", F.explode(partners))
    small, large = F.col("s.value"), F.col("l.value")
    bad = (large <= small) if strict else (large < small)
    missing = small.isNull() | large.isNull() | F.isnan(small) | F.isnan(large)
    return (rows.filter(missing | bad)
            .select("category", "other_category", *keys, F.col("s.unit").alias("small_unit"),
                    F.col("l.unit").alias("large_unit"), small.alias("small_value"), large.alias("large_value")))


def category_order_check(df: DataFrame, small: str, large: str, strict: bool = False,
                         keys: Sequence[str] | None = None,
                         measurement: str = "cumulative") -> DataFrame:
    """One ordered pair (see ``category_orders``), without the category columns."""
    return category_orders(df, [(small, large)], strict, keys, measurement).drop("category", "other_category")


def violations(df: DataFrame, pairs: Sequence[tuple[str, str]] = tuple(ORDERED_CATEGORIES),
               cut_date: str = "2021-01-01") -> DataFrame:
    """All findings of the validation pass in one frame: decreases of cumulative
    series (``value`` against ``other_value`` of the date before) and wrongly
    ordered categories (``value`` of ``category`` against ``other_value`` of
    ``other_category``)."""
    keys = [k for k in _row_keys(df) if k not in ("dt", "measurement")]
    falls = cumulative_decreases(df, [*keys, "category", "unit"], cut_date=cut_date).select(
        F.lit("cumulative_decrease").alias("check"), "category", F.lit(None).cast("string").alias("other_category"),
        *keys, "dt", F.col("unit"), F.col("unit").alias("other_unit"), F.col("value").cast("double").alias("value"),
        (F.col("value") - F.col("diff")).cast("double").alias("other_value"))
    orders = category_orders(df, pairs).select(
        F.lit("category_order").alias("check"), "category", "other_category", *keys, "dt",
        F.col("small_unit").alias("unit"), F.col("large_unit").alias("other_unit"),
        F.col("small_value").cast("double").alias("value"), F.col("large_value").cast("double").alias("other_value"))
    return falls.unionByName(orders)


def check_observations(df: DataFrame, **kw) -> DataFrame:
    """The frame itself, or a ValidationError that lists a sample of the findings
    of ``violations`` and carries them all."""
    raise_if_any(violations(df, **kw), "the following errors were found")
    return df


def required_categories(df: DataFrame, required: Sequence[str], keys: Sequence[str] = (),
                        column: str = "category") -> DataFrame:
    """Groups lacking some required category, with the missing ones listed.
    Counting per required value keeps it a plain aggregate."""
    missing = F.array_compact(F.array(*[
        F.when(F.count_if(F.col(column) == F.lit(r)) == 0, F.lit(r)) for r in required]))
    out = df.groupBy(*keys).agg(missing.alias("missing"))
    return out.filter(F.size("missing") > 0)


def raise_if_any(violations: DataFrame, message: str, sample: int = 20) -> None:
    rows = violations.limit(sample).collect()
    if rows:
        raise ValidationError(f"{message}: {rows}", violations)


def series_checks(df: DataFrame, series_key: Sequence[str], cut_date: str = "2021-01-01",
                  order: str = "dt", value: str = "value") -> DataFrame:
    """The time-series validation pass in one shuffle: duplicate keys (same
    series and date) and cumulative decreases after ``cut_date``.

    Both windows are clustered by the series key (the duplicate window's
    key is a superset of it), so a single hash exchange on the series key
    serves them; the output lists every violating row with a ``kind``.
    """
    keys = list(series_key)
    dup_w = Window.partitionBy(*keys, order)
    cum = ((F.col("measurement") == "cumulative") & F.col(value).isNotNull() & ~F.isnan(F.col(value))
           & (F.col(order) >= F.lit(cut_date).cast("date")))
    # the lag runs over the cumulative rows after the cut only, like the
    # stand-alone check: other rows sort into their own partition group
    lag_w = Window.partitionBy(*keys, cum.alias("__c")).orderBy(order)
    flagged = df.withColumns({
        "__dups": F.count(F.lit(1)).over(dup_w),
        "__diff": F.when(cum, F.col(value) - F.lag(value).over(lag_w)),
    })
    kind = (F.when(F.col("__dups") > 1, F.lit("duplicate"))
            .when(F.col("__diff") < 0, F.lit("cumulative_decrease")))
    return flagged.withColumn("kind", kind).filter(F.col("kind").isNotNull()).drop("__dups", "__diff")
