"""Wide <-> long reshapes and the variable descriptor (R-rows).

The variable map (column name -> category/measurement/unit/demographics) is
a literal of bounded size; it is applied as a map-literal lookup inside one
projection (no join, no Python), and an unknown variable fails the job the
way the reference's ``KeyError`` does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.errors import ContractError
from almanac.functions import from_units, parse_numeric, replace_map, to_units
from almanac.operators.transform import drop_nulls
from almanac.schema import CMU_COLUMNS, CMU_DEFAULTS

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def cmu(**kw) -> dict:
    """A variable descriptor with the reference's defaults filled in."""
    unknown = set(kw) - set(CMU_COLUMNS)
    if unknown:
        raise ValueError(f"unknown descriptor fields {unknown}")
    return {**CMU_DEFAULTS, **kw}


def melt(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str] | None = None,
         var_name: str = "variable", value_name: str = "value",
         value_type: str | None = None) -> DataFrame:
    """``pd.melt``. Nulls are kept (as pandas does). Value columns are cast to
    one type first: double if all are numeric, else string (``value_type``
    overrides)."""
    if value_vars is None:
        value_vars = [c for c in df.columns if c not in id_vars]
    value_vars = list(value_vars)
    if value_type is None:
        numeric = all(isinstance(df.schema[c].dataType, _NUMERIC) for c in value_vars)
        value_type = "double" if numeric else "string"
    cast = df.select(*id_vars, *[F.col(c).cast(value_type).alias(c) for c in value_vars])
    return cast.unpivot(list(id_vars), value_vars, var_name, value_name)


def melt_date_columns(df: DataFrame, id_vars: Sequence[str], date_format: str | None = None,
                      var_name: str = "dt", value_name: str = "value") -> DataFrame:
    """Melt every non-id column (their names are dates) and parse the name."""
    out = melt(df, id_vars, None, var_name, value_name)
    parsed = F.to_date(F.col(var_name), date_format) if date_format else F.to_date(F.col(var_name))
    return out.withColumn(var_name, parsed)


def _descriptor_map(mapping: Mapping[str, Mapping[str, str]], columns: Sequence[str]) -> Column:
    args = []
    for key, desc in mapping.items():
        full = cmu(**desc) if set(desc) <= set(CMU_COLUMNS) else dict(desc)
        args.append(F.lit(key))
        args.append(F.struct(*[F.lit(full[c]).cast("string").alias(c) for c in columns]))
    return F.create_map(*args)


def attach_cmu(df: DataFrame, mapping: Mapping[str, Mapping[str, str]],
               var_name: str = "variable", columns: Sequence[str] = tuple(CMU_COLUMNS),
               skip_columns: Sequence[str] = ()) -> DataFrame:
    """Look ``var_name`` up in ``mapping`` and set the descriptor columns.

    An unknown variable raises (``raise_error`` in a filter that is always
    evaluated); ``skip_columns`` keeps those columns from the data.
    """
    cols = [c for c in columns if c not in skip_columns]
    if not cols:
        return df
    m = _descriptor_map(mapping, cols)
    d = F.element_at(m, F.col(var_name))
    checked = df.withColumn("__cmu", d).filter(
        F.when(F.col("__cmu").isNull(),
               F.raise_error(F.concat(F.lit("unknown variable: "),
                                      F.coalesce(F.col(var_name).cast("string"), F.lit("NULL")))))
        .otherwise(F.lit(True)))
    return checked.withColumns({c: F.col(f"__cmu.{c}") for c in cols}).drop("__cmu")


def reshape_variables(df: DataFrame, variable_map: Mapping[str, Mapping[str, str]],
                      id_vars: Sequence[str] | None = None, drop_duplicates: bool = False,
                      vintage: Column | None = None, skip_columns: Sequence[str] = (),
                      variables: Sequence[str] | None = None) -> DataFrame:
    """Wide frame -> normalised long frame.

    Every mapped column must be present. Ids = given + any of
    ``location_name``, ``location``, ``dt``, ``vintage``. Melt, drop rows
    with a null in any column, parse numbers (``1,234``), attach the
    descriptor, drop ``variable``, add ``vintage`` if absent, optionally
    de-duplicate. ``variables`` prunes the map *before* the unpivot so the
    scan reads only the requested columns (Catalyst cannot prune the
    unpivot's projections from a later filter).
    """
    missing = [c for c in variable_map if c not in df.columns]
    if missing:
        raise ContractError(f"mapped columns missing from frame: {missing}")
    ids = list(id_vars or [])
    for c in ("location_name", "location", "dt", "vintage"):
        if c in df.columns and c not in ids:
            ids.append(c)
    keep = [v for v in variable_map if variables is None or v in variables]
    long = melt(df, ids, keep)
    long = drop_nulls(long)
    if dict(long.dtypes)["value"] == "string":
        long = long.withColumn("value", parse_numeric("value"))
    long = attach_cmu(long, {k: variable_map[k] for k in keep}, skip_columns=skip_columns)
    long = long.drop("variable")
    if "vintage" not in long.columns:
        long = long.withColumn("vintage", vintage if vintage is not None
                               else F.date_trunc("HOUR", F.current_timestamp()))
    if drop_duplicates:
        long = long.dropDuplicates()
    return long


def split_demographics(df: DataFrame, category_column: str, value_column: str,
                       labels: Mapping[str, str]) -> DataFrame:
    """One pass instead of filter-per-label + union: for each demographic
    dimension, take the label's value where the row's category is that
    label, ``all`` elsewhere. ``labels`` maps category label -> dimension."""
    cat = F.col(category_column)
    out = {}
    for dim in ("age", "race", "ethnicity", "sex"):
        hit = [lab for lab, d in labels.items() if d == dim]
        out[dim] = (F.when(cat.isin(hit), F.col(value_column)).otherwise(F.lit("all"))
                    if hit else F.lit("all"))
    return df.withColumns(out)


def reshape_with_demographic(df: DataFrame, variable_map, demographic: str,
                             relabel: Mapping[str, str] | None = None, **kw) -> DataFrame:
    """Reshape keeping one demographic column from the data, then relabel it."""
    out = reshape_variables(df, variable_map, skip_columns=[demographic], **kw)
    if relabel:
        out = out.withColumn(demographic, replace_map(demographic, relabel))
    return out


def pivot_sum_total(df: DataFrame, index: Sequence[str], columns: str, values: str,
                    pivot_values: Sequence, total_name: str = "total",
                    scale: int | None = None) -> DataFrame:
    """``pivot_table(aggfunc="sum")`` plus a row total over the pivoted
    columns (nulls ignored; an all-null row totals 0, as in pandas). With
    ``scale`` (decimals of the source's values) the sums are exact."""
    v = F.col(values) if scale is None else to_units(values, scale)
    wide = df.groupBy(*index).pivot(columns, list(pivot_values)).agg(F.sum(v))
    names = [str(p) for p in pivot_values]
    total = None
    for n in names:
        t = F.coalesce(F.col(f"`{n}`"), F.lit(0))
        total = t if total is None else total + t
    out = wide.withColumn(total_name, total)
    if scale is not None:
        out = out.select(*index, *[from_units(F.col(f"`{n}`"), scale).alias(n) for n in names],
                         from_units(F.col(total_name), scale).alias(total_name))
    return out


def pivot_first_metrics(df: DataFrame, index: Sequence[str], columns: str, values: str,
                        pivot_values: Sequence, ordinal: str) -> DataFrame:
    """``pivot_table(aggfunc="first")`` made deterministic: the value with the
    smallest ingest ordinal wins (``min_by``), never shuffle order."""
    return df.groupBy(*index).pivot(columns, list(pivot_values)).agg(
        F.min_by(F.col(values), F.col(ordinal)))


def latest_window_pivot(df: DataFrame, categories: Sequence[str], days_back: int = 7,
                        index: Sequence[str] | None = None, location=None,
                        location_type: str | None = None) -> DataFrame:
    """Last ``days_back`` days (strictly after ``max(dt) - days_back``) of the
    chosen categories for all demographics, one column per category, optionally
    of one location or one location type.

    The latest date is that of the whole frame, whatever categories or groups
    it belongs to: a scalar subquery, computed once, without a join. The pivot
    values are given, so no extra distinct job runs. An (index, category) that
    repeats is an error, as in the reference's unstack; of equal values one is
    taken."""
    if index is None:
        index = ["dt"] + [c for c in ("location", "location_name") if c in df.columns]
    max_dt = df.select(F.max("dt")).scalar()
    base = df.filter(F.col("category").isin(list(categories)) & (F.col("dt") > F.date_sub(max_dt, days_back)))
    for d in ("age", "race", "ethnicity", "sex"):
        base = base.filter(F.col(d) == "all")
    if location is not None:
        base = base.filter(F.col("location") == F.lit(location))
    if location_type is not None:
        base = base.filter(F.col("location_type") == F.lit(location_type))
    low, high = F.min("value"), F.max("value")
    one = F.when(low == high, low).when(low.isNotNull(), F.raise_error(F.lit(
        "latest window: several values of one category at one place and date")).cast("double"))
    return base.groupBy(*index).pivot("category", list(categories)).agg(one)


def decode_codes(df: DataFrame, column: str, dictionary: DataFrame, out_column: str | None = None,
                 code_key: str = "idx", value_key: str = "value",
                 pre_filter: Column | None = None) -> DataFrame:
    """Integer codes -> dictionary values via a join with the dictionary.
    ``pre_filter`` runs on the coded frame before decoding."""
    if pre_filter is not None:
        df = df.filter(pre_filter)
    d = dictionary.select(F.col(code_key).alias("__idx"), F.col(value_key).alias("__val"))
    out = df.join(d, F.col(column) == F.col("__idx"), "left")
    return out.withColumn(out_column or column, F.col("__val")).drop("__idx", "__val")
