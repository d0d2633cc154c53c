"""Global row numbers without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.session import settle


def numbered(df: DataFrame, *order: Column | str, name: str = "row_number") -> DataFrame:
    """0-based row numbers in the given order, written to the shared folder.

    A range shuffle and a sort within partitions give each row its place in its
    partition; the sizes of the partitions (one row each reaches the driver) give
    the offsets. Rows equal in all of ``order`` take any order among themselves."""
    marked = settle(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = marked.groupBy(part.alias("p")).agg((F.max(place) + 1).alias("n")).orderBy("p").collect()
    offsets, total = [], 0
    for r in sizes:
        offsets.append((int(r.p), total))
        total += r.n
    first = df.sparkSession.createDataFrame(offsets, "_p long, _first long")
    # one row per partition: small enough to broadcast for any partition count
    return (marked.withColumn("_p", part.cast("long")).join(F.broadcast(first), "_p")
            .withColumn(name, F.col("_first") + place).drop("_place", "_p", "_first"))
