"""Shared plumbing of the operators: input tables, connected components, cut points
of a total order."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.session import settle


#: Data handed to Python at a time.
ARROW_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Cut the batches that Python gets by bytes: texts run from nothing to megabytes,
    and the default number of rows says little about memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, *order: Column | str, name: str = "row_number") -> DataFrame:
    """``df`` with 0-based row numbers in the given order, settled in the shared folder.
    A range shuffle and a sort place each row within its partition; the partitions'
    sizes, one row each, reach the driver and shift them. Rows equal in all of ``order``
    take any order among themselves."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    rows = settle(sorted_, "numbered")  # the ids hold the partition and the place in it
    part, place = F.shiftright("_id", 33).cast("int"), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = {r.part: r.n for r in rows.groupBy(part.alias("part")).agg((F.max(place) + 1).alias("n")).collect()}
    firsts = dict(zip(sorted(sizes), accumulate([0, *(sizes[p] for p in sorted(sizes))]), strict=False))
    starts = df.sparkSession.createDataFrame(list(firsts.items()), "_part int, _start long")
    # a row per partition: small enough to broadcast for any number of them
    return (rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + place).drop("_id", "_part", "_start"))


#: Edges of a file between two rounds, and the least number of files.
EDGES = 1 << 17
LEAST_FILES = 8


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``links(a long, b long)`` as (node, component), the
    component being its smallest node. Alternating large-star and small-star
    steps; each round's edges go to the shared folder. Nodes without a link do
    not appear."""
    edges = (links.where("a <> b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    edges = settle(edges, name)
    state = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct("u", F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u <> v").distinct())
        # rounds don't add edges: as many files as the last round's fill
        edges = settle(small if state is None else small.coalesce(max(LEAST_FILES, -(-state[0] // EDGES))), name)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == state:
            break
        state = now
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionAll(star.select(F.col("component").alias("node"), "component").distinct())


#: Keys with more rows than this, and than one in HEAVY_SHARE of all, are joined by broadcast.
HEAVY_ROWS = 1000
HEAVY_SHARE = 10_000


def join_copies(rows: DataFrame, names: DataFrame, key: str, copies: str) -> DataFrame:
    """``rows`` left joined with ``names``, which has one row per key and in ``copies``
    the number of rows of the key. The commonest keys don't meet in one task each: there
    are at most HEAVY_SHARE keys with more than that share of all rows, so their names
    are broadcast. Null keys pass by. Both sides should be settled tables."""
    total = names.agg(F.sum(copies)).first()[0] or 0
    heavy = F.col(copies) > max(HEAVY_ROWS, total // HEAVY_SHARE)
    often = F.broadcast(names.where(heavy))
    known = rows.where(F.col(key).isNotNull())
    return (known.join(often, key)
            .unionByName(known.join(F.broadcast(names.where(heavy).select(key)), key, "left_anti").join(names.where(~heavy), key, "left"))
            .unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True))


def cut_points(df: DataFrame, *order: Column | str, shards: int) -> list:
    """At most ``shards`` rows at even steps of the given total order, the first row
    included: exact, so the same for every run and partitioning."""
    rows = numbered(df, *order, name="_at")
    n = rows.count()
    step = max(1, -(-n // shards))
    return rows.where(F.pmod("_at", F.lit(step)) == 0).orderBy("_at").drop("_at").collect()
