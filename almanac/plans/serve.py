"""Serving layer: the joined API view, declarative REST-style filters, the
published extracts and the weekly changelog (J03, Q01, Q02, K04, K05, A12)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import week_end_monday
from almanac.schema import PUBLISHED_SCHEMA
from almanac.session import literal_frame

VIEW_COLUMNS = [f.name for f in PUBLISHED_SCHEMA.fields]
# which dimension supplies which view column
_DIM_COLUMNS = {
    "variables": {"variable_name", "measurement", "unit"},
    "locations": {"location", "location_type"},
    "providers": {"provider"},
    "demographics": {"age", "race", "ethnicity", "sex"},
}


def api_view(fact: DataFrame, variables: DataFrame, locations: DataFrame, providers: DataFrame,
             demographics: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Live fact rows left-joined to their dimensions.

    Catalyst keeps a left join to an unused dimension (it does not know the
    key is unique), so a dimension is joined only when one of its columns is
    requested.
    """
    cols = list(columns) if columns else VIEW_COLUMNS
    want = set(cols)
    out = fact.filter(~F.col("deleted"))
    if want & _DIM_COLUMNS["variables"]:
        v = variables.select(F.col("id").alias("variable_id"),
                             F.col("category").alias("variable_name"), "measurement", "unit")
        out = out.join(v, ["variable_id"], "left")
    if want & _DIM_COLUMNS["locations"]:
        loc = locations.select(F.col("id").alias("location_id"), "location", "location_type")
        out = out.join(loc, ["location_id"], "left")
    if want & _DIM_COLUMNS["providers"]:
        p = providers.select(F.col("id").alias("provider_id"), F.col("name").alias("provider"))
        out = out.join(p, ["provider_id"], "left")
    if want & _DIM_COLUMNS["demographics"]:
        d = demographics.select(F.col("id").alias("demographic_id"), "age", "race", "ethnicity", "sex")
        out = out.join(d, ["demographic_id"], "left")
    return out.select(*cols)


_OPS = {"eq": "__eq__", "neq": "__ne__", "gt": "__gt__", "gte": "__ge__",
        "lt": "__lt__", "lte": "__le__"}


def _typed(df: DataFrame, column: str, text: str):
    """Literal of the column's type (so ``dt=gt.2020-01-01`` compares dates)."""
    return F.lit(text).cast(df.schema[column].dataType)


def rest_query(df: DataFrame, params: Mapping[str, object], default_limit: int = 100) -> DataFrame:
    """REST-style request over a view: ``col=op.value`` filters (eq, neq, gt,
    gte, lt, lte, in.(a,b)), ``select=a,b``, ``order=a.desc,b``,
    ``limit=n`` (default 100, the API's default page), ``offset=n``. Without an
    order the rows are ordered by all columns of the answer, so that the pages
    of one request fit together."""
    out = df
    for k, v in params.items():
        if k in ("select", "order", "limit", "offset"):
            continue
        op, _, val = str(v).partition(".")
        c = F.col(k)
        if op == "in":
            vals = [x.strip() for x in val.strip("()").split(",")]
            out = out.filter(c.isin([_typed(df, k, x) for x in vals]))
        elif op == "is" and val == "null":
            out = out.filter(c.isNull())
        else:
            out = out.filter(getattr(c, _OPS[op])(_typed(df, k, val)))
    if "order" in params:
        keys = []
        for part in str(params["order"]).split(","):
            name, _, direction = part.partition(".")
            keys.append(F.col(name).desc() if direction == "desc" else F.col(name).asc())
        out = out.orderBy(*keys)
    chosen = [s.strip() for s in str(params["select"]).split(",")] if "select" in params else df.columns
    if "order" not in params:
        out = out.orderBy(*chosen)
    if int(params.get("offset", 0)):
        out = out.offset(int(params["offset"]))
    return out.limit(int(params.get("limit", default_limit))).select(*chosen)


def publish_view(view: DataFrame, root: str, run_date: _dt.date, csv: bool = True) -> dict:
    """Publish the view: typed Parquet under a dated path and under
    ``latest`` (same content), and optionally a CSV extract with header.
    The dated copy is written once and ``latest`` is rewritten from it."""
    typed = view.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PUBLISHED_SCHEMA.fields])
    dated = f"{root}/parquet/{run_date.isoformat()}"
    latest = f"{root}/parquet/latest"
    typed.write.mode("overwrite").parquet(dated)
    spark = view.sparkSession
    spark.read.parquet(dated).write.mode("overwrite").parquet(latest)
    out = {"dated": dated, "latest": latest}
    if csv:
        path = f"{root}/csv/{run_date.isoformat()}"
        spark.read.parquet(dated).write.mode("overwrite").option("header", True).csv(path)
        out["csv"] = path
    return out


def variable_start_dates(fact_view: DataFrame, locations: DataFrame) -> DataFrame:
    """First date per (location, variable, source) with location names: the
    changelog's input view."""
    first = (fact_view.groupBy("location_id", "variable_name", "source")
             .agg(F.min("dt").alias("start_date")))
    loc = locations.select(F.col("id").alias("location_id"), F.col("location").alias("fips"),
                           "state", "fullname")
    return first.join(loc, ["location_id"], "left").drop("location_id")


def changelog_report(starts: DataFrame) -> DataFrame:
    """Weekly changelog: per week (ending Monday) and state, the state's own
    sources (source -> variables) and an array of counties, each with its
    sources. A location is the state itself when its name equals the state.

    Built from nested aggregates only: the variable lists are per (week,
    location, source), bounded by the variable dimension, so no unbounded
    group is collected.
    """
    wk = starts.withColumn("week_end", week_end_monday("start_date"))
    per_src = (wk.groupBy("week_end", "state", "fips", "fullname", "source")
               .agg(F.array_sort(F.collect_list("variable_name")).alias("variables")))
    per_loc = (per_src.groupBy("week_end", "state", "fips", "fullname")
               .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "variables"))))
                    .alias("sources")))
    is_state = F.col("fullname") == F.col("state")
    per_state = (per_loc.groupBy("week_end", "state").agg(
        F.first(F.when(is_state, F.col("sources")), ignorenulls=True).alias("state_sources"),
        F.array_sort(F.collect_list(F.when(~is_state, F.struct(
            F.col("fips"), F.col("fullname").alias("name"), F.col("sources")))),
            lambda a, b: F.when(a["fips"] < b["fips"], -1).when(a["fips"] > b["fips"], 1)
            .otherwise(0)).alias("counties")))
    return per_state.select(
        "week_end", F.date_sub("week_end", 7).alias("week_start"), "state",
        F.coalesce("state_sources", F.create_map().cast("map<string,array<string>>")).alias("sources"),
        "counties")


def dataset_variables(view: DataFrame, registry: Mapping[str, Sequence[str]] | None = None,
                      dataset_column: str = "provider") -> DataFrame:
    """Dataset -> distinct variable names (the variable-name registry)."""
    out = view.select(F.col(dataset_column).alias("dataset"), "variable_name").distinct()
    if registry:
        spark: SparkSession = view.sparkSession
        extra = literal_frame(spark, [(d, v) for d, vs in registry.items() for v in vs],
                                      "dataset string, variable_name string")
        out = out.unionByName(extra).distinct()
    return out
