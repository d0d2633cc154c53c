"""Dimension resolution, anti-join checks and merges (J-rows, S16, V07, V10).

Dimensions are small by construction (hundreds of rows), but nothing here relies on
it: the joins carry no hint, so Spark broadcasts a side whose size it knows to be under
``spark.sql.autoBroadcastJoinThreshold`` (from file sizes and literal rows when planning,
from measured ones at run time) and shuffles a grown one.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators.numbering import numbered
from almanac.schema import DEMOGRAPHIC_COLUMNS, VARIABLE_COLUMNS

def load_dimension(dim: DataFrame, natural_key: Sequence[str], id_column: str = "id",
                   existing: DataFrame | None = None) -> DataFrame:
    """Reference-table load: de-duplicate on the natural key, skip keys that
    ``existing`` holds (conflicts ignored, null keys compared like values) and
    number the rest in the order of the key, from the largest existing id on.
    Returns the new rows. The numbers come from a range-partitioned sort with
    per-partition offsets, so no size is too large."""
    key = list(natural_key)
    new = dim.dropDuplicates(key)
    first = 1
    if existing is not None:
        held = existing.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(key)])
        new = new.join(held, [F.col(k).eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(key)], "left_anti")
        first = 1 + (existing.agg(F.max(id_column)).first()[0] or 0)
    rows = numbered(new, *[F.col(k).asc_nulls_first() for k in key], name=id_column)
    return rows.withColumn(id_column, (F.col(id_column) + first).cast("int"))


class DimensionTable:
    """A stored dimension: ids are given once and never change, new keys are
    appended with the next numbers."""

    def __init__(self, spark: SparkSession, path: str, natural_key: Sequence[str], id_column: str = "id"):
        self.spark, self.path, self.key, self.id_column = spark, path, list(natural_key), id_column

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def exists(self) -> bool:
        try:
            return bool(self.read().columns)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False

    def load(self, dim: DataFrame) -> DataFrame:
        existing = self.read() if self.exists() else None
        new = load_dimension(dim, self.key, self.id_column, existing)
        new.write.mode("append").parquet(self.path)
        return self.read()


def _left(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(dim, list(on), "left")


def resolve_keys(obs: DataFrame, locations: DataFrame, providers: DataFrame,
                 demographics: DataFrame, variables: DataFrame, by: str = "fips",
                 on_unresolved: str = "fail") -> DataFrame:
    """Staging -> fact rows: attach ``location_id``, ``provider_id``,
    ``demographic_id``, ``variable_id`` by left joins.

    ``by="fips"`` matches (location, location_type); ``by="name"`` matches
    (location_type, state_fips, location_name). ``on_unresolved``:
    ``fail`` (default) raises on any null id, as the reference rejects the
    whole batch; ``reject`` drops them; ``keep`` leaves null ids so that
    ``reject_unresolved`` can report them.
    """
    if by == "fips":
        loc = locations.select(F.col("id").alias("location_id"), "location", "location_type")
        on_loc = ["location", "location_type"]
    else:
        loc = locations.select(F.col("id").alias("location_id"), "location_type", "state_fips",
                               F.col("name").alias("location_name"))
        on_loc = ["location_type", "state_fips", "location_name"]
    prov = providers.select(F.col("id").alias("provider_id"), F.col("name").alias("provider"))
    dem = demographics.select(F.col("id").alias("demographic_id"), *DEMOGRAPHIC_COLUMNS)
    var = variables.select(F.col("id").alias("variable_id"), *VARIABLE_COLUMNS)
    out = _left(obs, loc, on_loc)
    out = _left(out, prov, ["provider"])
    out = _left(out, dem, DEMOGRAPHIC_COLUMNS)
    out = _left(out, var, VARIABLE_COLUMNS)
    ids = ["location_id", "provider_id", "demographic_id", "variable_id"]
    if on_unresolved == "fail":
        bad = functools.reduce(lambda a, b: a | b, [F.col(i).isNull() for i in ids])
        out = out.filter(F.when(bad, F.raise_error(F.lit("unresolved dimension key in batch")))
                         .otherwise(F.lit(True)))
    elif on_unresolved == "reject":
        out = out.filter(functools.reduce(lambda a, b: a & b, [F.col(i).isNotNull() for i in ids]))
    return out


def reject_unresolved(resolved: DataFrame) -> DataFrame:
    """Rows whose keys did not resolve, with the list of failing dimensions."""
    kinds = F.array_compact(F.array(
        *[F.when(F.col(c).isNull(), F.lit(k)) for c, k in
          (("location_id", "location"), ("provider_id", "provider"),
           ("demographic_id", "demographic"), ("variable_id", "variable"))]))
    return resolved.withColumn("unresolved", kinds).filter(F.size("unresolved") > 0)


def unknown_variables(df: DataFrame, variables: DataFrame, distinct: bool = True) -> DataFrame:
    out = df.join(variables.select(*VARIABLE_COLUMNS), VARIABLE_COLUMNS, "left_anti")
    return out.select(*VARIABLE_COLUMNS).distinct() if distinct else out


def unknown_demographics(df: DataFrame, demographics: DataFrame, distinct: bool = True) -> DataFrame:
    out = df.join(demographics.select(*DEMOGRAPHIC_COLUMNS), DEMOGRAPHIC_COLUMNS, "left_anti")
    return out.select(*DEMOGRAPHIC_COLUMNS).distinct() if distinct else out


def unknown_locations(df: DataFrame, locations: DataFrame, by: str = "fips",
                      state_fips: int | None = None, distinct: bool = True) -> DataFrame:
    """By FIPS (any location type), or by name within one state."""
    if by == "fips":
        out = df.join(locations.select("location").distinct(), ["location"], "left_anti")
        cols = ["location"]
    else:
        names = locations.filter(F.col("state_fips") == F.lit(state_fips)) \
            .select(F.col("name").alias("location_name")).distinct()
        out = df.join(names, ["location_name"], "left_anti")
        cols = ["location_name"]
    return out.select(*cols).distinct() if distinct else out


def unknown_report(df: DataFrame, locations: DataFrame, demographics: DataFrame,
                   variables: DataFrame, by: str = "fips", state_fips: int | None = None) -> DataFrame:
    """One frame of distinct unknown keys with a ``kind`` column (text key).

    The input is read once: flags of all three dimensions come from left joins
    with their (size-checked) key lists, then one distinct."""
    if by == "fips":
        loc_col, loc = "location", locations.select("location").distinct()
    else:
        loc_col = "location_name"
        loc = (locations.filter(F.col("state_fips") == F.lit(state_fips))
               .select(F.col("name").alias("location_name")).distinct())
    out = df.select(*VARIABLE_COLUMNS, *DEMOGRAPHIC_COLUMNS, loc_col).distinct()
    for flag, dim, on in (("__v", variables, VARIABLE_COLUMNS), ("__d", demographics, DEMOGRAPHIC_COLUMNS),
                          ("__l", loc, [loc_col])):
        out = _left(out, dim.select(*on).distinct().withColumn(flag, F.lit(True)), on)
    kinds = F.array_compact(F.array(*[
        F.when(F.col(flag).isNull(), F.struct(F.lit(kind).alias("kind"), key.alias("key")))
        for flag, kind, key in (("__v", "variable", F.concat_ws("|", *VARIABLE_COLUMNS)),
                                ("__d", "demographic", F.concat_ws("|", *DEMOGRAPHIC_COLUMNS)),
                                ("__l", "location", F.col(loc_col).cast("string")))]))
    return out.select(F.explode(kinds).alias("u")).select("u.*").distinct()


def nway_merge(frames: Sequence[DataFrame], on: Sequence[str], how: str = "inner") -> DataFrame:
    """``reduce(pd.merge(on=...))``."""
    return functools.reduce(lambda a, b: a.join(b, list(on), how), frames)
