"""Observation frames derived from the TPC-H-style test tables.

The orders star schema stands in for a landed source: a day of orders per
customer nation is an observation of a location, the order status is the
provider, the market segment and the order priority are two demographic
dimensions. Everything is derived from the given tables, so the work grows
with them.

Plan shape at scale: lineitem is pre-aggregated per order (partial
aggregation before the shuffle on ``l_orderkey``), joined to orders on the
same key (the aggregated side is already hash-partitioned on it), then to
customer, then grouped to one row per (day, nation, status, segment,
priority). Sums are exact (integer hundredths) and cast to double at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import cents, from_cents, money_sum
from almanac.operators.reshape import cmu, reshape_variables
from almanac.session import literal_frame, table

_FRAMES: dict[tuple, DataFrame] = {}


def _per_session(fn):
    """Reuse a test-bed frame (a lazy plan over read-only tables) within a
    session instead of rebuilding the same plan for every query."""
    import functools

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, *args):
        key = (fn.__name__, id(spark), args)
        df = _FRAMES.get(key)
        if df is None or df.sparkSession is not spark:
            df = _FRAMES[key] = fn(spark, *args)
        return df
    return wrapper


# Fixed run time of the test-bed load (vintage).
RUN_TS = "2024-02-01 05:00:00"
SOURCE_URL = "file:///landed/orders"
SOURCE_NAME = "orders warehouse"

# The test bed's variable map (column -> descriptor); the
# demographic columns age and race come from the data.
VARIABLE_MAP = {
    "orders": cmu(category="orders", measurement="new", unit="count"),
    "quantity": cmu(category="quantity", measurement="new", unit="units"),
    "revenue": cmu(category="revenue", measurement="new", unit="usd"),
}
# Admissible variable triples of the test bed.
VARIABLE_TRIPLES = [
    ("orders", "new", "count"), ("quantity", "new", "units"), ("revenue", "new", "usd"),
    ("orders", "cumulative", "count"), ("quantity", "cumulative", "units"),
    ("revenue", "cumulative", "usd"),
]
SERIES_KEY = ["location", "provider", "age", "race", "ethnicity", "sex", "category", "unit"]


def run_ts():
    return F.lit(RUN_TS).cast("timestamp_ntz")


@_per_session
def daily_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.sum(cents("l_quantity")).alias("qty"), F.sum(cents("l_extendedprice")).alias("rev")))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = (orders.join(li, orders.o_orderkey == li.l_orderkey)
         .join(cust, orders.o_custkey == cust.c_custkey))
    return (j.groupBy(F.col("o_orderdate").cast("date").alias("dt"),
                      F.col("c_nationkey").cast("bigint").alias("location"),
                      F.col("o_orderstatus").alias("provider"),
                      F.lower("c_mktsegment").alias("age"),
                      F.col("o_orderpriority").alias("race"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 from_cents(F.sum("qty")).alias("quantity"),
                 from_cents(F.sum("rev")).alias("revenue")))


@_per_session
def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised long observations (one row per series and day)."""
    wide = daily_wide(spark, sf_dir).withColumn("location_type", F.lit("county"))
    return reshape_variables(wide, VARIABLE_MAP,
                             id_vars=["location_type", "provider", "age", "race"],
                             vintage=run_ts(), skip_columns=["age", "race"])


def obs_cum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals per series (measurement ``cumulative``), exact."""
    from almanac.operators.windows import running_total
    o = obs(spark, sf_dir)
    return running_total(o, SERIES_KEY, "dt", "value", scale=2) \
        .withColumn("measurement", F.lit("cumulative"))


def obs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-demographics totals per (location, day, variable)."""
    o = obs(spark, sf_dir)
    return (o.groupBy("vintage", "dt", "location", "location_type", "category", "measurement", "unit")
            .agg(money_sum("value").alias("value"))
            .withColumns({"age": F.lit("all"), "race": F.lit("all"),
                          "ethnicity": F.lit("all"), "sex": F.lit("all")}))


@_per_session
def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location dimension: nations are counties of their region (state)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    county = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat(F.lit("loc#"), F.col("n_nationkey").cast("string")).alias("id"),
        F.col("n_nationkey").cast("bigint").alias("location"),
        F.lit("county").alias("location_type"),
        F.col("n_regionkey").cast("int").alias("state_fips"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("name"),
        F.concat_ws(", ", F.col("n_name"), F.col("r_name")).alias("fullname"))
    state = region.select(
        F.concat(F.lit("state#"), F.col("r_regionkey").cast("string")).alias("id"),
        F.col("r_regionkey").cast("bigint").alias("location"),
        F.lit("state").alias("location_type"),
        F.col("r_regionkey").cast("int").alias("state_fips"),
        F.col("r_name").alias("state"),
        F.col("r_name").alias("name"),
        F.col("r_name").alias("fullname"))
    return county.unionByName(state)


@_per_session
def variables(spark: SparkSession) -> DataFrame:
    from almanac.operators.joins import load_dimension
    raw = literal_frame(spark, VARIABLE_TRIPLES, "category string, measurement string, unit string")
    return load_dimension(raw, ["category", "measurement", "unit"])


# The bootstrap lists of the test bed's reference tables
# (order statuses as providers; market segments and order priorities as the
# two demographic dimensions), like the reference's bootstrap CSV files.
PROVIDER_NAMES = ["F", "O", "P"]
SEGMENTS = ["automobile", "building", "furniture", "household", "machinery"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@_per_session
def providers(spark: SparkSession) -> DataFrame:
    from almanac.operators.joins import load_dimension
    raw = literal_frame(spark, [(n, 1) for n in PROVIDER_NAMES], "name string, priority int")
    return load_dimension(raw, ["name"])


def demographic_rows(segments=SEGMENTS, priorities=PRIORITIES) -> list[tuple]:
    rows = [(s, p, "all", "all") for s in segments for p in priorities]
    return rows + [("all", "all", "all", "all")]


@_per_session
def demographics(spark: SparkSession) -> DataFrame:
    from almanac.operators.joins import load_dimension
    raw = literal_frame(spark, demographic_rows(),
                                "age string, race string, ethnicity string, sex string")
    return load_dimension(raw, ["age", "race", "ethnicity", "sex"])


# Fact table versions for the state operators (see oracle_ctes.FACTS): all rows, the
# base of an upsert (two thirds of the keys) and the batch (two thirds, one of
# them new).
BASE_URL = "file:///landed/v1"
BATCH_URL = "file:///landed/v2"
BATCH_TS = "2024-03-01 05:00:00"
BASE_DELETE_BATCH = 7


def resolved(spark: SparkSession, sf_dir: str, obs_frame: DataFrame | None = None,
             on_unresolved: str = "fail") -> DataFrame:
    from almanac.operators.joins import resolve_keys
    o = obs_frame if obs_frame is not None else obs(spark, sf_dir)
    return resolve_keys(o, locations(spark, sf_dir), providers(spark), demographics(spark),
                        variables(spark), by="fips", on_unresolved=on_unresolved)


def _third(remainder: int):
    """One of three parts of the fact keys, by day and location."""
    return F.pmod(F.dayofyear("dt") + F.col("location"), F.lit(3)) == remainder


def facts(spark: SparkSession, sf_dir: str, res: DataFrame | None = None, where=None) -> DataFrame:
    """All observations as fact rows; those of the first of a month are deleted."""
    from almanac.operators.store import FACT_COLUMNS
    r = res if res is not None else resolved(spark, sf_dir)
    first = F.dayofmonth("dt") == 1
    return ((r if where is None else r.filter(where))
            .select("dt", "location_id", "variable_id", "demographic_id", "provider_id", "value",
                    F.col("vintage").alias("last_updated"),
                    F.lit(BASE_URL).alias("source_url"), F.lit(SOURCE_NAME).alias("source_name"),
                    first.alias("deleted"),
                    F.when(first, F.lit(BASE_DELETE_BATCH).cast("bigint")).alias("delete_batch_id"))
            .select(*FACT_COLUMNS))


def fact_base(spark: SparkSession, sf_dir: str, res: DataFrame | None = None) -> DataFrame:
    """The state before an upsert: all keys but those of the last third."""
    return facts(spark, sf_dir, res, ~_third(2))


def fact_batch(spark: SparkSession, sf_dir: str, res: DataFrame | None = None) -> DataFrame:
    from almanac.operators.store import FACT_COLUMNS
    r = res if res is not None else resolved(spark, sf_dir)
    return (r.filter(~_third(0))
            .select("dt", "location_id", "variable_id", "demographic_id", "provider_id",
                    (F.col("value") * 2).alias("value"),
                    F.lit(BATCH_TS).cast("timestamp_ntz").alias("last_updated"),
                    F.lit(BATCH_URL).alias("source_url"), F.lit(SOURCE_NAME + " v2").alias("source_name"),
                    F.lit(False).alias("deleted"), F.lit(None).cast("bigint").alias("delete_batch_id"))
            .select(*FACT_COLUMNS))


def county_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative panel per nation (county) and region (state), for the
    categories ``orders`` (all orders) and ``urgent`` (1-URGENT orders; flat
    on days without one). Columns: location_type, location, state_fips, dt,
    category, value."""
    from almanac.operators.reshape import melt
    from almanac.operators.windows import running_total
    dw = daily_wide(spark, sf_dir)
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("location"),
        F.col("n_regionkey").cast("int").alias("state_fips"))
    daily = (dw.groupBy("location", "dt")
             .agg(F.sum("orders").alias("orders"),
                  F.sum(F.when(F.col("race") == "1-URGENT", F.col("orders")).otherwise(0)).alias("urgent"))
             .join(nation, ["location"]))
    county = daily.withColumn("location_type", F.lit("county"))
    state = (daily.groupBy("state_fips", "dt")
             .agg(F.sum("orders").alias("orders"), F.sum("urgent").alias("urgent"))
             .withColumns({"location": F.col("state_fips").cast("bigint"),
                           "location_type": F.lit("state")}))
    both = county.unionByName(state)
    long = melt(both, ["location_type", "location", "state_fips", "dt"], ["orders", "urgent"],
                var_name="category")
    return running_total(long, ["location_type", "location", "category"], "dt", "value")
