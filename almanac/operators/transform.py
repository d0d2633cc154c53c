"""Row-wise projections, filters and column housekeeping (P-rows, K01, V05).

All functions are lazy DataFrame -> DataFrame; the only driver-side work is
reading ``df.columns`` / ``df.schema``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.errors import ContractError
from almanac.functions import (not_in_keep_null, parse_date, replace_map,
                               title_case)


def normalize_column_names(df: DataFrame, strip: bool = True) -> DataFrame:
    """Lower-case (and strip) every column name."""
    names = [c.lower().strip() if strip else c.lower() for c in df.columns]
    return df.toDF(*names)


def rename_add_date_location(
    df: DataFrame,
    location_name_column: str | None = None,
    location_column: str | None = None,
    location_names_to_drop: Sequence[str] | None = None,
    location_names_to_replace: Mapping[str, str] | None = None,
    locations_to_drop: Sequence | None = None,
    date_column: str | None = None,
    date_format: str | None = None,
    date: Column | str | None = None,
    run_ts: Column | None = None,
    timezone: str | None = None,
    apply_title_case: bool = True,
) -> DataFrame:
    """Rename/add ``dt`` and ``location``/``location_name`` in the reference's order.

    Order matters: names are dropped *before* title case, replaced *after* it;
    FIPS values are dropped *before* the numeric cast.
    """
    if not (location_name_column or location_column):
        raise ValueError("need location_name_column or location_column")
    if not (date_column or date is not None or timezone):
        raise ValueError("need date_column, date or timezone")
    renames = {}
    if location_name_column:
        renames[location_name_column] = "location_name"
    if location_column and location_column in df.columns:
        renames[location_column] = "location"
    if date_column:
        renames[date_column] = "dt"
    df = df.withColumnsRenamed(renames)
    if date_column:
        df = df.withColumn("dt", parse_date("dt", date_format))
    if timezone:
        if date is not None:
            raise ValueError("date and timezone exclude each other")
        ts = run_ts if run_ts is not None else F.current_timestamp()
        date = F.to_date(F.from_utc_timestamp(ts, timezone))
    if date is not None:
        df = df.withColumn("dt", F.to_date(date if isinstance(date, Column) else F.lit(date)))
    if location_names_to_drop:
        df = df.filter(not_in_keep_null("location_name", location_names_to_drop))
    if "location_name" in df.columns and apply_title_case:
        df = df.withColumn("location_name", title_case("location_name"))
    if location_names_to_replace:
        df = df.withColumn("location_name", replace_map("location_name", location_names_to_replace))
    if "location" in df.columns:
        if locations_to_drop:
            df = df.filter(not_in_keep_null(F.col("location").cast("string"),
                                            [str(v) for v in locations_to_drop]))
        from almanac.functions import parse_numeric
        df = df.withColumn("location", parse_numeric("location").cast("bigint"))
    return df


def drop_by_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """``df[~df[c].isin(values)]``; a null key is kept, as in pandas."""
    return df.filter(not_in_keep_null(column, values))


def keep_by_values(df: DataFrame, conditions: Mapping[str, object]) -> DataFrame:
    """Conjunction of ``column == value`` (or ``isin`` for a list value)."""
    pred = F.lit(True)
    for c, v in conditions.items():
        pred = pred & (F.col(c).isin(list(v)) if isinstance(v, (list, tuple, set)) else (F.col(c) == F.lit(v)))
    return df.filter(pred)


def replace_values(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    return df.withColumn(column, replace_map(column, mapping))


def replace_values_all(df: DataFrame, mapping: Mapping, to_null: Iterable[str] = ()) -> DataFrame:
    """Replace values in every string column (``DataFrame.replace``); values
    in ``to_null`` become null (``replace(x, np.nan)``)."""
    to_null = list(to_null)
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            if mapping:
                c = replace_map(c, mapping)
            if to_null:
                c = F.when(c.isin(to_null), F.lit(None).cast("string")).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``dropna()`` (any column) or ``dropna(subset=...)``. NaN counts as null."""
    cols = list(subset) if subset else df.columns
    pred = F.lit(True)
    types = dict(df.dtypes)
    for c in cols:
        p = F.col(c).isNotNull()
        if types.get(c) in ("double", "float"):
            p = p & ~F.isnan(F.col(c))
        pred = pred & p
    return df.filter(pred)


def drop_zeros(df: DataFrame, column: str = "value") -> DataFrame:
    return df.filter(F.col(column) != 0)


def range_filter(df: DataFrame, column: str, low=None, high=None,
                 low_inclusive: bool = True, high_inclusive: bool = True) -> DataFrame:
    pred = F.lit(True)
    c = F.col(column)
    if low is not None:
        pred = pred & ((c >= F.lit(low)) if low_inclusive else (c > F.lit(low)))
    if high is not None:
        pred = pred & ((c <= F.lit(high)) if high_inclusive else (c < F.lit(high)))
    return df.filter(pred)


def project_contract(df: DataFrame, columns: Sequence[str],
                     constants: Mapping[str, object] | None = None) -> DataFrame:
    """Add constant columns, then keep ``columns`` in order."""
    if constants:
        df = df.withColumns({k: F.lit(v) for k, v in constants.items()})
    return df.select(*columns)


def load_defaults(df: DataFrame, provider: str | None, source_url: str, source_name: str,
                  location_type: str, state_fips: int | None = None,
                  insert_op: str | None = None) -> DataFrame:
    """Defaults added at load time. ``vintage`` becomes ``last_updated``;
    ``provider`` is always set (``None`` keeps a per-row provider column);
    ``location_type``, ``source_url`` and ``source_name`` are filled only
    where the frame does not carry them already."""
    df = df.withColumnsRenamed({"vintage": "last_updated"})
    add = {}
    if insert_op is not None:
        add["insert_op"] = F.lit(insert_op)
    if provider is not None:
        add["provider"] = F.lit(provider)
    if state_fips is not None:
        add["state_fips"] = F.lit(state_fips)
    for name, val in (("location_type", location_type), ("source_url", source_url),
                      ("source_name", source_name)):
        if name not in df.columns:
            add[name] = F.lit(val)
    return df.withColumns(add) if add else df


def conform_columns(df: DataFrame, target: Sequence[str] | T.StructType) -> DataFrame:
    """Staging-append schema check: every target column must exist (error
    names the missing ones); extra columns are dropped; with a StructType
    the columns are cast to the target types."""
    names = [f.name for f in target.fields] if isinstance(target, T.StructType) else list(target)
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {missing}")
    if isinstance(target, T.StructType):
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
    return df.select(*names)


def contract_check(df: DataFrame, has_location: bool = True,
                   required: Sequence[str] | None = None) -> DataFrame:
    """Normalised-contract check (columns present; location or location_name
    by flag). Returns the frame unchanged; non-emptiness is checked by
    ``is_non_empty`` (one bounded job)."""
    from almanac.schema import contract_columns
    need = list(required) if required else contract_columns(has_location)
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise ContractError(f"normalised frame lacks {missing}")
    return df


def is_non_empty(df: DataFrame) -> bool:
    return not df.isEmpty()


def state_to_fips(df: DataFrame, states: DataFrame, code_column: str,
                  out_column: str = "location", code_key: str = "code",
                  fips_key: str = "fips", strict: bool = True) -> DataFrame:
    """State code -> FIPS by a join to a (small, broadcast) state dimension.

    An unknown code fails the job (the reference dereferences None) unless
    ``strict=False``, which leaves null.
    """
    dim = states.select(F.col(code_key).alias("__code"), F.col(fips_key).alias("__fips"))
    out = df.join(dim, F.col(code_column) == F.col("__code"), "left")
    fips = F.col("__fips")
    if strict:
        fips = F.when(F.col(code_column).isNotNull() & F.col("__code").isNull(),
                      F.raise_error(F.concat(F.lit("unknown state code: "), F.col(code_column)))
                      .cast(dim.schema["__fips"].dataType)).otherwise(fips)
    return out.withColumn(out_column, fips).drop("__code", "__fips")


def conditional_assign(df: DataFrame, column: str, condition: Column, other) -> DataFrame:
    """``df[c].where(cond, other)``: keep where cond holds, else ``other``."""
    other = other if isinstance(other, Column) else F.lit(other)
    return df.withColumn(column, F.when(condition, F.col(column)).otherwise(other))
