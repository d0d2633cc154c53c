"""Incremental ingest (X02): landed drops are upserted into the fact table as they
arrive, and a dataset runs only when its source has changed.

A file-stream source with a checkpoint sees each landed file once. Beside the table
stands a log, one Parquet row per event, which decides two things:

- *Epochs.* A micro-batch is logged as begun, with its counts, before the table
  changes, and as done after it. A replayed epoch that is done changes nothing and
  counts nothing; one that had only begun is run again under its first counts (an
  upsert gives the same state twice, but would count its own rows as updates).
- *Tokens.* A drop names its dataset, vintage and source token (an ETag, a run id).
  Within a dataset, in order of vintages, a drop whose token equals that of the drop
  before it is unchanged and skipped; the first of an epoch is compared with the last
  token that a finished epoch stored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.operators.store import FACT_COLUMNS, FactTable, newest_vintage_wins, stored
from almanac.schema import FACT_SCHEMA
from almanac.session import settle

DROP_COLUMNS = ["dataset", "vintage", "token"]
COUNT_COLUMNS = ["rows_inserted", "rows_updated", "batch_rows"]
LOG_SCHEMA = T.StructType(
    [T.StructField("stream", T.StringType()), T.StructField("epoch", T.LongType()), T.StructField("state", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in DROP_COLUMNS] + [T.StructField(c, T.LongType()) for c in COUNT_COLUMNS])


def changed_drops(drops: DataFrame, last: DataFrame) -> DataFrame:
    """The rows of ``drops(dataset, vintage, token)`` whose token differs from that of the
    drop before it (by vintage), the first from the dataset's token in ``last(dataset,
    token)``. A null token is never unchanged; a drop named twice is one."""
    before = F.lag(F.struct("token")).over(Window.partitionBy("dataset").orderBy("vintage", "token"))
    known = last.select(F.col("dataset").alias("__d"), F.struct(F.col("token").alias("token")).alias("__last"))
    marked = (drops.select(*DROP_COLUMNS).distinct().withColumn("__before", before)
              .join(known, F.col("dataset").eqNullSafe(F.col("__d")), "left"))
    unchanged = F.coalesce(F.coalesce(F.col("__before"), F.col("__last"))["token"] == F.col("token"), F.lit(False))
    return marked.where(~unchanged).select(*DROP_COLUMNS)


@dataclass
class IngestLog:
    """The events of a table's ingest, append only."""
    spark: SparkSession
    path: str

    def read(self) -> DataFrame:
        return stored(self.spark, self.path, LOG_SCHEMA)

    def append(self, stream: str, epoch: int, state: str, drops: list[Row], counts: dict[str, int]) -> None:
        """One row per drop of the epoch (one without a drop where it has none); the
        counts are the epoch's and stand in its first row."""
        rows = [(stream, epoch, state, *drop) for drop in drops] or [(stream, epoch, state, None, None, None)]
        rows = [(*row, *(counts.get(c) if i == 0 else None for c in COUNT_COLUMNS)) for i, row in enumerate(rows)]
        self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def of(self, stream: str, epoch: int) -> dict[str, dict[str, int]]:
        """States that an epoch has reached, with its counts."""
        rows = self.read().where((F.col("stream") == stream) & (F.col("epoch") == epoch)).collect()
        return {state: next(({c: r[c] for c in COUNT_COLUMNS} for r in rows if r.state == state and r.batch_rows is not None), {})
                for state in {r.state for r in rows}}

    def last_tokens(self) -> DataFrame:
        """(dataset, token) of each dataset's latest vintage that was taken in."""
        done = self.read().where((F.col("state") == "done") & F.col("vintage").isNotNull())
        return done.groupBy("dataset").agg(F.max_by("token", F.struct("vintage", "epoch")).alias("token"))

    def counts(self, stream: str | None = None) -> DataFrame:
        """(stream, epoch, rows_inserted, rows_updated, batch_rows) of finished epochs."""
        done = self.read().where((F.col("state") == "done") & F.col("batch_rows").isNotNull())
        return (done if stream is None else done.where(F.col("stream") == stream)).select("stream", "epoch", *COUNT_COLUMNS)


def run_if_changed(log: IngestLog, dataset: str, vintage: str, token: str, run: Callable[[], dict[str, int]]) -> dict[str, int] | None:
    """Run a dataset's load unless its source token is that of the last load, which gives
    None. The token is stored once the load has gone through, so a failing one is tried
    again; ``run`` returns the load's counts."""
    last = log.last_tokens().where(F.col("dataset") == dataset).collect()
    if token is not None and last and last[0].token == token:
        return None
    counts = run()
    epoch = (log.read().where(F.col("stream") == dataset).agg(F.max("epoch")).first()[0] or 0) + 1
    log.append(dataset, epoch, "done", [(dataset, vintage, token)], counts)
    return counts


def apply_epoch(table: FactTable, log: IngestLog, stream: str, batch: DataFrame, epoch: int, gate: bool) -> dict[str, int] | None:
    """One micro-batch: its changed drops are merged, drops that share a key as if they
    had come one after the other. Returns the epoch's counts, or None where it was done
    before or brings nothing."""
    reached = log.of(stream, epoch)
    if "done" in reached:
        return None
    drops: list[Row] = []
    if gate:
        batch = settle(batch, "ingest-batch")  # names its drops and feeds the merge
        new = changed_drops(batch, log.last_tokens())
        drops = new.collect()  # a row per landed drop
        batch = batch.join(new.select(*[F.col(c).alias(f"__{c}") for c in DROP_COLUMNS]),
                           [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in DROP_COLUMNS], "left_semi")
        if not drops:
            return None
    elif batch.isEmpty():
        return None
    counts = reached.get("begun", {})
    begin = None if counts else lambda found: log.append(stream, epoch, "begun", drops, found)
    found = table.upsert(newest_vintage_wins(batch.select(*FACT_COLUMNS)), before_commit=begin)
    counts = counts or found
    log.append(stream, epoch, "done", drops, counts)
    return {c: counts[c] for c in COUNT_COLUMNS}


def stream_upsert(spark: SparkSession, landing: str, fact_path: str, checkpoint: str,
                  max_files_per_trigger: int | None = None, gate: bool = False) -> IngestLog:
    """Take in what has landed since the last run and stop; returns the table's log. With
    ``gate`` the landing folder is partitioned by dataset, vintage and token, and
    drops of unchanged sources are skipped."""
    table, log = FactTable(spark, fact_path), IngestLog(spark, f"{fact_path}.ingest")
    drop = [T.StructField(c, T.StringType()) for c in DROP_COLUMNS] if gate else []
    reader = spark.readStream.schema(T.StructType(FACT_SCHEMA.fields + drop))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(landing).writeStream
         .foreachBatch(lambda batch, epoch: apply_epoch(table, log, checkpoint, batch, epoch, gate) and None)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return log
