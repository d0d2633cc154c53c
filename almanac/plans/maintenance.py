"""Maintenance entry points: reprocess stored snapshots for a range of
vintages into the fact table (select -> delete -> undelete live in
``operators.store``)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators import store as ST
from almanac.session import settle


def reprocess_vintages(spark: SparkSession, snapshots_root: str, dataset: str,
                       normalize: Callable[[DataFrame], DataFrame],
                       to_fact: Callable[[DataFrame], DataFrame], table: ST.FactTable,
                       start: str | None = None, end: str | None = None,
                       continue_on_fail: bool = False) -> DataFrame:
    """Re-normalise every stored vintage of ``dataset`` in ``[start, end]`` and
    upsert the result as if the vintages were loaded oldest first: per key the
    newest vintage wins (one aggregation instead of a loop of upserts).
    ``normalize`` maps a raw snapshot (with its ``snapshot`` vintage column) to
    observations; ``to_fact`` resolves them to fact rows (``last_updated`` =
    vintage). Snapshots may differ in their columns: the read takes the union.

    A vintage that fails stops the run, or with ``continue_on_fail`` is left
    out: then each vintage is a job of its own, written to the shared folder
    before the one upsert. Returns the vintages with an ``error`` column (null
    where the vintage was processed)."""
    raw = (spark.read.option("basePath", snapshots_root).option("mergeSchema", True).parquet(snapshots_root)
           .filter(F.col("dataset") == dataset))
    if start is not None:
        raw = raw.filter(F.col("snapshot") >= start)
    if end is not None:
        raw = raw.filter(F.col("snapshot") <= end)
    if not continue_on_fail:
        table.upsert(ST.newest_vintage_wins(to_fact(normalize(raw))))
        return raw.select("snapshot").distinct().withColumn("error", F.lit(None).cast("string")).orderBy("snapshot")
    outcome, facts = [], []
    for r in raw.select("snapshot").distinct().orderBy("snapshot").collect():  # one row per stored vintage
        try:
            facts.append(settle(to_fact(normalize(raw.filter(F.col("snapshot") == r.snapshot)))
                                .select(*ST.FACT_COLUMNS), "vintage"))
            outcome.append((r.snapshot, None))
        except Exception as e:  # noqa: BLE001  whatever the vintage's normalizer raises is its outcome
            outcome.append((r.snapshot, str(e).splitlines()[0]))
    if facts:
        table.upsert(ST.newest_vintage_wins(functools.reduce(DataFrame.unionByName, facts)))
    return spark.createDataFrame(outcome, "snapshot string, error string").orderBy("snapshot")
