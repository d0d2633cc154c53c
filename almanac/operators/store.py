"""State of the fact table: upsert, select, soft delete, undelete, reprocess
(M-rows) and snapshot/publish sinks (K-rows).

State changes are DataFrame -> DataFrame (new state) so they compose and can
be checked; ``FactTable`` persists a state by rewriting only the touched
partitions (Parquet has no MERGE/UPDATE): the new state of those partitions is settled
in the shared folder, counted there, and written over the old one by Spark's dynamic
partition overwrite. A job that dies before that commit has changed nothing and is run
again. One that dies within it can leave a partition's folder missing; the settled state
(``fact-state-*`` in the shared folder) holds all rows of the touched partitions, and
``write_state`` of it mends the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.errors import ValidationError
from almanac.schema import FACT_PK, FACT_SCHEMA
from almanac.session import settle

FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields]
PARTITION_COLUMNS = ["provider_id", "dt_month"]


def _check_unique_pk(batch: DataFrame, pk: Sequence[str], on_duplicate: str) -> DataFrame:
    w = Window.partitionBy(*pk)
    if on_duplicate == "error":
        n = F.count(F.lit(1)).over(w)
        return batch.withColumn("__n", n).filter(
            F.when(F.col("__n") > 1, F.raise_error(F.lit("duplicate primary key in batch")))
            .otherwise(F.lit(True))).drop("__n")
    if on_duplicate == "last":
        # keep the row with the largest ingest ordinal
        r = F.row_number().over(w.orderBy(F.col("__ordinal").desc()))
        return batch.withColumn("__r", r).filter(F.col("__r") == 1).drop("__r")
    raise ValueError(on_duplicate)


def upsert(fact: DataFrame, batch: DataFrame, mode: str = "postgres",
           on_duplicate: str = "error", pk: Sequence[str] = tuple(FACT_PK)) -> DataFrame:
    """Merge ``batch`` (fact layout) into ``fact`` on the primary key.

    ``mode="postgres"`` (canonical): on conflict take ``value`` and
    ``last_updated`` from the batch, set ``deleted=false`` and
    ``delete_batch_id=null``, keep the stored ``source_url``/``source_name``.
    ``mode="replace"``: the batch row replaces the stored row.
    One full outer join on the key; the batch's duplicate check uses the same
    hash partitioning, so it adds no exchange.
    """
    return merged(fact, batch, mode, on_duplicate, pk).select(*FACT_COLUMNS)


def merged(fact: DataFrame, batch: DataFrame, mode: str = "postgres",
           on_duplicate: str = "error", pk: Sequence[str] = tuple(FACT_PK)) -> DataFrame:
    """``upsert`` with two flags per row: ``stored`` (the key was there before) and
    ``loaded`` (the batch has it)."""
    pk = list(pk)
    batch = _check_unique_pk(batch.select(*FACT_COLUMNS, *(["__ordinal"] if on_duplicate == "last" else [])),
                             pk, on_duplicate).select(*FACT_COLUMNS)
    o = fact.select(*FACT_COLUMNS).withColumn("__o", F.lit(True))
    n = batch.withColumn("__n", F.lit(True))
    j = o.alias("o").join(n.alias("n"), pk, "full_outer")
    stored, loaded = F.col("o.__o").isNotNull(), F.col("n.__n").isNotNull()

    def pick_new(c):
        return F.when(loaded, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    def keep_old(c):
        return F.when(stored, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c)

    if mode == "postgres":
        cols = [pick_new("value"), pick_new("last_updated"), keep_old("source_url"),
                keep_old("source_name"), pick_new("deleted"), pick_new("delete_batch_id")]
    elif mode == "replace":
        cols = [pick_new(c) for c in FACT_COLUMNS if c not in pk]
    else:
        raise ValueError(mode)
    return j.select(*pk, *cols, stored.alias("stored"), loaded.alias("loaded")).select(*FACT_COLUMNS, "stored", "loaded")


def upsert_counts(fact: DataFrame, batch: DataFrame, pk: Sequence[str] = tuple(FACT_PK),
                  merged: DataFrame | None = None) -> DataFrame:
    """Rows inserted (new keys), updated (existing keys) and batch size, as one
    aggregate row. What was written is read off the ``merged`` state (by default
    that of ``upsert``), so a merge that took in none of a non-empty batch is an
    error."""
    pk = list(pk)
    merged = upsert(fact, batch, pk=pk) if merged is None else merged
    written = merged.select(*pk).join(batch.select(*pk).distinct(), pk, "left_semi")
    flagged = written.join(fact.select(*pk).withColumn("__o", F.lit(True)), pk, "left")
    counts = flagged.agg(F.count_if(F.col("__o").isNull()).alias("rows_inserted"),
                         F.count_if(F.col("__o").isNotNull()).alias("rows_updated"))
    sized = counts.withColumn("batch_rows", batch.select(F.count(F.lit(1))).scalar())
    return sized.withColumn("rows_inserted", F.when(
        (F.col("batch_rows") > 0) & (F.col("rows_inserted") + F.col("rows_updated") == 0),
        F.raise_error(F.lit("no rows written from a non-empty batch")).cast("bigint"))
        .otherwise(F.col("rows_inserted")))


def selection_predicate(providers: DataFrame, variables: DataFrame, locations: DataFrame,
                        provider: str = "state", variable_regex: str = ".+",
                        state_fips: int | None = None, start_date: str | None = None,
                        end_date: str | None = None, location: int | None = None,
                        location_type_regex: str = ".+", unit_regex: str = ".+",
                        measurement_regex: str = ".+"):
    """The selection's semi-join filters as (dimension frame, fact column)
    pairs plus a row predicate. Regexes are unanchored (``~``), so provider
    ``cdc`` also matches ``cdc2``. ``location`` beats ``state_fips``; the
    location-type regex applies only in the state branch."""
    semis = [
        (providers.filter(F.col("name").rlike(provider)).select(F.col("id").alias("provider_id")),
         "provider_id"),
        (variables.filter(F.col("category").rlike(variable_regex) & F.col("unit").rlike(unit_regex)
                          & F.col("measurement").rlike(measurement_regex))
         .select(F.col("id").alias("variable_id")), "variable_id"),
    ]
    if location is not None:
        semis.append((locations.filter(F.col("location") == F.lit(location))
                      .select(F.col("id").alias("location_id")), "location_id"))
    elif state_fips is not None:
        semis.append((locations.filter((F.col("state_fips") == F.lit(state_fips))
                                       & F.col("location_type").rlike(location_type_regex))
                      .select(F.col("id").alias("location_id")), "location_id"))
    pred = F.lit(True)
    if start_date is not None:
        pred = pred & (F.col("dt") >= F.lit(start_date).cast("date"))
    if end_date is not None:
        pred = pred & (F.col("dt") <= F.lit(end_date).cast("date"))
    return semis, pred


def _flag_selected(fact: DataFrame, semis, pred: Column) -> DataFrame:
    """Mark selected rows with ``__sel`` using broadcast semi-join flags (the
    dimension sides are tiny filtered id lists)."""
    out = fact.withColumn("__sel", pred)
    for i, (dim, col) in enumerate(semis):
        flag = f"__hit{i}"
        d = dim.distinct().withColumn(flag, F.lit(True))
        out = out.join(d, [col], "left").withColumn(
            "__sel", F.col("__sel") & F.coalesce(F.col(flag), F.lit(False))).drop(flag)
    return out


def select_observations(fact: DataFrame, providers: DataFrame, variables: DataFrame,
                        locations: DataFrame, limit: int | None = None, **filters) -> DataFrame:
    """Rows matching the selection (``select_scraped_data``). ``limit`` takes the
    first rows in the order of the primary key, the same at every run."""
    semis, pred = selection_predicate(providers, variables, locations, **filters)
    out = fact.filter(pred)
    for dim, col in semis:
        out = out.join(dim.distinct(), [col], "left_semi")
    return out.orderBy(*FACT_PK).limit(limit) if limit is not None else out


def soft_delete(fact: DataFrame, providers: DataFrame, variables: DataFrame,
                locations: DataFrame, batch_id: int, **filters) -> DataFrame:
    """Set ``deleted=true`` and ``delete_batch_id`` on every selected row.
    There is no ``deleted=false`` guard: deleted rows move to the new batch."""
    semis, pred = selection_predicate(providers, variables, locations, **filters)
    flagged = _flag_selected(fact.select(*FACT_COLUMNS), semis, pred)
    sel = F.col("__sel")
    return flagged.select(
        *[c for c in FACT_COLUMNS if c not in ("deleted", "delete_batch_id")],
        F.when(sel, F.lit(True)).otherwise(F.col("deleted")).alias("deleted"),
        F.when(sel, F.lit(batch_id).cast("bigint")).otherwise(F.col("delete_batch_id")).alias("delete_batch_id"),
        sel.alias("changed")).select(*FACT_COLUMNS, "changed")


def next_batch_id(fact: DataFrame) -> Column:
    """``max(delete_batch_id) + 1`` as a scalar subquery (no collect)."""
    return F.coalesce(fact.select(F.max("delete_batch_id")).scalar(), F.lit(0)) + 1


def undelete(fact: DataFrame, batch_id: int) -> DataFrame:
    """Revive every row of one delete batch."""
    hit = F.coalesce(F.col("delete_batch_id") == F.lit(batch_id), F.lit(False))
    return fact.select(
        *[c for c in FACT_COLUMNS if c not in ("deleted", "delete_batch_id")],
        F.when(hit, F.lit(False)).otherwise(F.col("deleted")).alias("deleted"),
        F.when(hit, F.lit(None).cast("bigint")).otherwise(F.col("delete_batch_id")).alias("delete_batch_id"),
        hit.alias("changed"))


def newest_vintage_wins(batch: DataFrame, pk: Sequence[str] = tuple(FACT_PK), vintage: str = "last_updated",
                        first_kept: Sequence[str] = ("source_url", "source_name")) -> DataFrame:
    """Many vintages at once: per key the newest vintage wins, exactly as if the
    vintages were upserted oldest first; ``first_kept`` columns are those an
    upsert keeps from the row that was there, so they come from the oldest. One
    aggregation per key instead of a loop of upserts."""
    pk = list(pk)
    kept = [c for c in first_kept if c in batch.columns]
    others = [c for c in batch.columns if c not in pk and c not in kept]
    # all columns take part in the order, so rows of one vintage resolve alike at every run
    newest = F.max(F.struct(F.col(vintage).alias("__v"), *[F.col(c).alias(c) for c in others]))
    oldest = F.min(F.struct(F.col(vintage).alias("__v"), *[F.col(c).alias(c) for c in kept]))
    return (batch.groupBy(*pk).agg(newest.alias("__s"), oldest.alias("__f"))
            .select(*[F.col(c) if c in pk else F.col(f"{'__f' if c in kept else '__s'}.{c}").alias(c)
                      for c in batch.columns]))


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, or one without rows where nothing is written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass
class FactTable:
    """Fact table stored as Parquet partitioned by provider and month.

    Writers are serialised per table (no concurrent writers, as with the
    reference's single database). The driver handles lists of partition keys:
    one per folder touched, as many as Spark's own file listing holds."""

    spark: SparkSession
    path: str

    @staticmethod
    def stored_schema() -> T.StructType:
        return T.StructType(FACT_SCHEMA.fields + [T.StructField("dt_month", T.StringType())])

    def scan(self) -> DataFrame:
        """The stored rows with the partition columns (``provider_id`` and
        ``dt_month`` come from the folder names); none before the first write."""
        return stored(self.spark, self.path, self.stored_schema())

    def read(self) -> DataFrame:
        return self.scan().select(*FACT_COLUMNS)

    @staticmethod
    def folders(keys) -> Column:
        """A static partition filter for the given (provider_id, dt_month) rows:
        the months of each provider as a set, the providers joined as a balanced
        tree, so the expression stays shallow for any number of keys."""
        months: dict = {}
        for r in keys:
            months.setdefault(r.provider_id, set()).add(r.dt_month)
        terms = []
        for provider, found in months.items():
            known = F.col("dt_month").isin(sorted(m for m in found if m is not None))
            month = known | F.col("dt_month").isNull() if None in found else known
            same = F.col("provider_id").isNull() if provider is None else F.col("provider_id") == F.lit(provider)
            terms.append(same & month)
        while len(terms) > 1:
            pairs = [terms[i:i + 2] for i in range(0, len(terms), 2)]
            terms = [p[0] | p[1] if len(p) == 2 else p[0] for p in pairs]
        return terms[0] if terms else F.lit(False)

    def write_state(self, state: DataFrame) -> None:
        """Replace the partitions present in ``state``; the others stay. The
        rebalance lets AQE split a hot (provider, month) over several writers and
        gather small ones, so files follow the rows; they are sorted by series
        for Parquet min/max pruning."""
        out = state.select(*FACT_COLUMNS).withColumn("dt_month", F.date_format("dt", "yyyy-MM"))
        (out.hint("rebalance", *PARTITION_COLUMNS)
         .sortWithinPartitions(*PARTITION_COLUMNS, "location_id", "variable_id", "dt")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PARTITION_COLUMNS).parquet(self.path))

    def touched(self, batch: DataFrame) -> DataFrame:
        """The stored rows of the partitions a batch hits; only those folders
        are listed and read."""
        keys = batch.select("provider_id", F.date_format("dt", "yyyy-MM").alias("dt_month")).distinct().collect()
        return self.scan().filter(self.folders(keys)).select(*FACT_COLUMNS)

    def upsert(self, batch: DataFrame, loaded_rows: int | None = None,
               before_commit: Callable[[dict[str, int]], None] | None = None, **kw) -> dict[str, int]:
        """Merge a batch, reading only the partitions the batch touches. Returns
        rows_inserted, rows_updated, batch_rows and rows_deleted (rows that left the
        staging area, as many as were staged); raises if rows were loaded
        (``loaded_rows`` before keys were resolved, else the batch's) and none of
        them reaches the table. ``before_commit`` gets the counts before the stored
        table changes."""
        # the batch is written once: it names the partitions, feeds the merge and is counted
        batch = settle(batch.select(*FACT_COLUMNS, *(["__ordinal"] if kw.get("on_duplicate") == "last" else [])), "fact-batch")
        state = settle(merged(self.touched(batch), batch, **kw), "fact-state")
        counts = state.agg(F.count_if(F.col("loaded") & ~F.col("stored")).alias("rows_inserted"),
                           F.count_if(F.col("loaded") & F.col("stored")).alias("rows_updated")).first().asDict()
        counts["batch_rows"] = counts["rows_deleted"] = batch.count()
        rows = counts["batch_rows"] if loaded_rows is None else loaded_rows
        if rows and not counts["rows_inserted"] + counts["rows_updated"]:
            raise ValidationError(f"the upsert completed but wrote zero of {rows} rows")
        if before_commit is not None:
            before_commit(counts)
        self.write_state(state)
        return counts

    def _rewrite(self, where: Column, change) -> int:
        """Apply ``change`` (a state -> state function with a ``changed`` flag) to
        the folders that hold rows of ``where``; only those in which a row changes
        are written back. Returns the number of rows changed."""
        keys = self.scan().filter(where).select(*PARTITION_COLUMNS).distinct().collect()
        rows = change(self.scan().filter(self.folders(keys)).select(*FACT_COLUMNS))
        hit = (rows.filter("changed").groupBy("provider_id", F.date_format("dt", "yyyy-MM").alias("dt_month"))
               .count().collect())
        if hit:
            self.write_state(settle(change(self.scan().filter(self.folders(hit)).select(*FACT_COLUMNS)), "fact-state"))
        return sum(r["count"] for r in hit)

    BATCHES = T.StructType([T.StructField("delete_batch_id", T.LongType())])

    def next_batch_id(self) -> int:
        """The next id of the table's sequence of delete batches, which it stores beside
        the table before it gives it out: an id is never given twice, also where its
        delete hits no row or dies. The sequence begins after the largest id in the table."""
        path = f"{self.path}.batches"
        last = F.max("delete_batch_id")
        given = stored(self.spark, path, self.BATCHES).agg(last).first()[0]
        if given is None:
            given = self.scan().agg(last).first()[0] or 0
        self.spark.range(given + 1, given + 2).select(F.col("id").alias("delete_batch_id")).write.mode("append").parquet(path)
        return given + 1

    def delete(self, providers: DataFrame, variables: DataFrame, locations: DataFrame, **filters) -> tuple[int, int]:
        """A soft delete under the next batch id: (rows changed, batch id)."""
        batch_id = self.next_batch_id()
        return self.soft_delete(providers, variables, locations, batch_id, **filters), batch_id

    def soft_delete(self, providers: DataFrame, variables: DataFrame, locations: DataFrame,
                    batch_id: int, **filters) -> int:
        """Persisted soft delete: only folders of the selected providers and dates
        are read, and only those that hold a selected row are rewritten."""
        semis, pred = selection_predicate(providers, variables, locations, **filters)
        chosen = [r.provider_id for dim, col in semis if col == "provider_id" for r in dim.distinct().collect()]
        return self._rewrite(pred & F.col("provider_id").isin(chosen),
                             lambda s: soft_delete(s, providers, variables, locations, batch_id, **filters))

    def undelete(self, batch_id: int) -> int:
        """Persisted undelete of one batch (only its partitions are rewritten)."""
        return self._rewrite(F.col("delete_batch_id") == F.lit(batch_id), lambda s: undelete(s, batch_id))
