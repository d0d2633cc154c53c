"""Batch = stream for the request log; the ingest stream is incremental
(a rerun with the same checkpoint only processes newly landed files)."""

import datetime as dt

from pyspark.sql import functions as F

from almanac.operators.store import FactTable, upsert
from almanac.plans import queries_sources as QS
from almanac.schema import FACT_SCHEMA
from almanac.session import scratch_path
from almanac.streaming import ingest
from almanac.streaming import request_log as RL


def test_request_log_batch_equals_stream(spark, sf_dir):
    text = QS._request_log_events(spark, sf_dir)
    batch = RL.flatten_request_log(RL.parse_request_log(text))
    landing, out, ckpt = (scratch_path(spark, n) for n in ("rl-land", "rl-out", "rl-ckpt"))
    text.write.text(landing)
    RL.run_request_log_stream(spark, landing, out, ckpt)
    streamed = spark.read.parquet(out)
    assert sorted(batch.collect()) == sorted(streamed.collect())
    # forwarded-for header wins over the socket address
    row = batch.filter(F.col("request_url").endswith("click")).first()
    assert row.client_ip.startswith("10.0.0.")


def _fact(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


def test_stream_upsert_is_incremental(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    d = dt.date(2024, 1, 1)
    base = _fact(spark, [(d, "a", 1, 1, 1, 1.0, t0, "u0", "n0", False, None)])
    drop1 = _fact(spark, [(d, "a", 1, 1, 1, 2.0, t1, "u1", "n1", False, None)])
    drop2 = _fact(spark, [(d, "b", 1, 1, 1, 5.0, t1, "u1", "n1", False, None)])
    fact_path, landing, ckpt = (scratch_path(spark, n) for n in ("f", "land", "ckpt"))
    table = FactTable(spark, fact_path)
    table.write_state(base)
    drop1.write.parquet(f"{landing}/drop=1")
    ingest.stream_upsert(spark, landing + "/*", fact_path, ckpt)
    assert {r.location_id: r.value for r in table.read().collect()} == {"a": 2.0}
    drop2.write.parquet(f"{landing}/drop=2")
    ingest.stream_upsert(spark, landing + "/*", fact_path, ckpt)
    got = {r.location_id: (r.value, r.source_url) for r in table.read().collect()}
    assert got == {"a": (2.0, "u0"), "b": (5.0, "u1")}
    expected = upsert(upsert(base, drop1), drop2)
    assert sorted(table.read().collect()) == sorted(expected.collect())


def test_reprocess_vintages_newest_wins(spark):
    from almanac.plans.maintenance import reprocess_vintages
    from almanac.sources.files import write_snapshot
    root = scratch_path(spark, "snaps")
    for vintage, val in (("2024-01-01_05", 1.0), ("2024-01-02_05", 2.0), ("2024-01-03_05", 3.0)):
        write_snapshot(spark.createDataFrame([("a", val)], "loc string, v double"), root, "ds", vintage)
    table = FactTable(spark, scratch_path(spark, "fact"))

    def normalize(raw):
        return raw.select("loc", "v", "snapshot")

    def to_fact(obs):
        return obs.select(F.lit(dt.date(2024, 1, 1)).alias("dt"), F.col("loc").alias("location_id"),
                          F.lit(1).alias("variable_id"), F.lit(1).alias("demographic_id"),
                          F.lit(1).alias("provider_id"), F.col("v").alias("value"),
                          F.to_timestamp("snapshot", "yyyy-MM-dd_HH").cast("timestamp_ntz").alias("last_updated"),
                          F.lit("u").alias("source_url"), F.lit("n").alias("source_name"),
                          F.lit(False).alias("deleted"), F.lit(None).cast("bigint").alias("delete_batch_id"))

    done = reprocess_vintages(spark, root, "ds", normalize, to_fact, table, end="2024-01-02_05")
    assert [r.snapshot for r in done.collect()] == ["2024-01-01_05", "2024-01-02_05"]
    assert [r.value for r in table.read().collect()] == [2.0]


def test_fact_table_delete_and_undelete_persist(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(dt.date(2024, m, 1), f"l{k}", 1, 1, 1, 1.0, t0, "u", "n", False, None)
            for m in (1, 2, 3) for k in (1, 2)]
    table = FactTable(spark, scratch_path(spark, "fact"))
    table.write_state(_fact(spark, rows))
    prov = spark.createDataFrame([(1, "state")], "id int, name string")
    var = spark.createDataFrame([(1, "cases", "cumulative", "people")],
                                "id int, category string, measurement string, unit string")
    loc = spark.createDataFrame([("l1", 1, "county", 1), ("l2", 2, "county", 2)],
                                "id string, location long, location_type string, state_fips int")
    n = table.soft_delete(prov, var, loc, batch_id=5, start_date="2024-02-01", state_fips=1,
                          location_type_regex="county")
    assert n == 2
    state = {(r.dt.month, r.location_id): r.deleted for r in table.read().collect()}
    assert state == {(1, "l1"): False, (1, "l2"): False, (2, "l1"): True, (2, "l2"): False,
                     (3, "l1"): True, (3, "l2"): False}
    assert table.undelete(5) == 2
    assert not any(r.deleted for r in table.read().collect())
    assert table.read().count() == 6


def test_drops_that_share_a_key_newest_wins(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    d = dt.date(2024, 1, 1)
    landing = scratch_path(spark, "land")
    table = FactTable(spark, scratch_path(spark, "fact"))
    _fact(spark, [(d, "a", 1, 1, 1, 2.0, t1, "u1", "n1", False, None)]).write.parquet(f"{landing}/drop=1")
    _fact(spark, [(d, "a", 1, 1, 1, 1.0, t0, "u0", "n0", False, None)]).write.parquet(f"{landing}/drop=2")
    ingest.stream_upsert(spark, landing + "/*", table.path, scratch_path(spark, "ckpt"))
    assert [(r.value, r.source_url) for r in table.read().collect()] == [(2.0, "u0")]


def _many(spark, n, value, batch=None):
    """One row per provider and month: n partitions."""
    return spark.range(n).select(
        F.expr("add_months(DATE '2000-01-01', CAST(id % 100 AS INT))").alias("dt"), F.lit("a").alias("location_id"),
        F.lit(1).alias("variable_id"), F.lit(1).alias("demographic_id"), (F.col("id") / 100).cast("int").alias("provider_id"),
        F.lit(value).alias("value"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("last_updated"),
        F.lit("u").alias("source_url"), F.lit("n").alias("source_name"), F.lit(batch is not None).alias("deleted"),
        F.lit(batch).cast("bigint").alias("delete_batch_id"))


def test_two_thousand_partitions(spark):
    table = FactTable(spark, scratch_path(spark, "fact"))
    first = table.upsert(_many(spark, 1999, 1.0, batch=3))
    assert first == {"rows_inserted": 1999, "rows_updated": 0, "batch_rows": 1999, "rows_deleted": 1999}
    assert table.undelete(3) == 1999 and table.read().filter("deleted").count() == 0
    again = table.upsert(_many(spark, 2000, 2.0))
    assert again == {"rows_inserted": 1, "rows_updated": 1999, "batch_rows": 2000, "rows_deleted": 2000}
    assert table.read().groupBy("value").count().collect()[0].asDict() == {"value": 2.0, "count": 2000}


def _files(path):
    import pathlib
    root = pathlib.Path(path.removeprefix("file:"))
    return {str(f.relative_to(root)) for f in root.rglob("*.parquet")}


def test_deletes_rewrite_only_their_folders(spark):
    t0 = dt.datetime(2024, 1, 1)
    table = FactTable(spark, scratch_path(spark, "fact"))
    table.upsert(_fact(spark, [(dt.date(2024, m, 1), "l1", 1, 1, p, 1.0, t0, "u", "n", False, None)
                               for m in (1, 2) for p in (1, 2, 3)]))
    prov = spark.createDataFrame([(p, f"p{p}") for p in (1, 2, 3)], "id int, name string")
    var = spark.createDataFrame([(1, "cases", "cumulative", "people")], "id int, category string, measurement string, unit string")
    loc = spark.createDataFrame([("l1", 1, "county", 1)], "id string, location long, location_type string, state_fips int")
    before = _files(table.path)
    assert table.soft_delete(prov, var, loc, batch_id=5, provider="p2", start_date="2024-02-01") == 1
    changed = before ^ _files(table.path)
    assert changed and all(f.startswith("provider_id=2/dt_month=2024-02/") for f in changed)
    assert table.soft_delete(prov, var, loc, batch_id=6, provider="nobody") == 0
    assert table.undelete(99) == 0


def test_upsert_that_writes_nothing_is_an_error(spark):
    import pytest

    from almanac.errors import ValidationError
    table = FactTable(spark, scratch_path(spark, "fact"))
    with pytest.raises(ValidationError, match="zero of 7 rows"):
        table.upsert(spark.createDataFrame([], FACT_SCHEMA), loaded_rows=7)


def test_reprocess_goes_on_past_a_failing_vintage(spark):
    from almanac.plans.maintenance import reprocess_vintages
    from almanac.sources.files import write_snapshot
    root = scratch_path(spark, "snaps")
    write_snapshot(spark.createDataFrame([("a", "1")], "loc string, v string"), root, "ds", "2024-01-01_05")
    write_snapshot(spark.createDataFrame([("a", "bad")], "loc string, v string"), root, "ds", "2024-01-02_05")
    write_snapshot(spark.createDataFrame([("a", "3", "x")], "loc string, v string, added string"), root, "ds", "2024-01-03_05")
    table = FactTable(spark, scratch_path(spark, "fact"))

    def to_fact(obs):
        return obs.select(F.lit(dt.date(2024, 1, 1)).alias("dt"), F.col("loc").alias("location_id"),
                          F.lit(1).alias("variable_id"), F.lit(1).alias("demographic_id"), F.lit(1).alias("provider_id"),
                          F.col("v").cast("double").alias("value"),
                          F.to_timestamp("snapshot", "yyyy-MM-dd_HH").cast("timestamp_ntz").alias("last_updated"),
                          F.coalesce("added", F.lit("u")).alias("source_url"), F.lit("n").alias("source_name"),
                          F.lit(False).alias("deleted"), F.lit(None).cast("bigint").alias("delete_batch_id"))

    done = reprocess_vintages(spark, root, "ds", lambda r: r, to_fact, table, continue_on_fail=True).collect()
    assert [(r.snapshot, r.error is None) for r in done] == [
        ("2024-01-01_05", True), ("2024-01-02_05", False), ("2024-01-03_05", True)]
    assert [r.value for r in table.read().collect()] == [3.0]


def _dims(spark):
    return (spark.createDataFrame([(1, "state"), (2, "county")], "id int, name string"),
            spark.createDataFrame([(1, "cases", "cumulative", "people")], "id int, category string, measurement string, unit string"),
            spark.createDataFrame([("l1", 1, "county", 1)], "id string, location long, location_type string, state_fips int"))


def test_each_delete_takes_the_next_batch_id(spark):
    t0 = dt.datetime(2024, 1, 1)
    table = FactTable(spark, scratch_path(spark, "fact"))
    table.write_state(_fact(spark, [(dt.date(2024, m, 1), "l1", 1, 1, p, 1.0, t0, "u", "n", m == 3, 4 if m == 3 else None)
                                    for m in (1, 2, 3) for p in (1, 2)]))
    assert table.delete(*_dims(spark), provider="state") == (3, 5)  # after the 4 that the table holds
    assert table.delete(*_dims(spark), provider="nobody") == (0, 6)  # an id is used up without a hit
    assert table.delete(*_dims(spark), provider="county", start_date="2024-02-01") == (2, 7)
    assert FactTable(spark, table.path).next_batch_id() == 8
    assert table.undelete(5) == 3
    state = {(r.provider_id, r.dt.month): r.delete_batch_id for r in table.read().collect()}
    assert state == {(1, 1): None, (1, 2): None, (1, 3): None, (2, 1): None, (2, 2): 7, (2, 3): 7}


def _drop(spark, landing, dataset, vintage, token, location, value):
    t = dt.datetime(2024, 2, int(vintage[8:10]))
    rows = [(dt.date(2024, 1, 1), location, 1, 1, 1, value, t, "u", "n", False, None)]
    _fact(spark, rows).write.parquet(f"{landing}/dataset={dataset}/vintage={vintage}/token={token}")


def test_unchanged_tokens_are_skipped(spark):
    landing, ckpt, path = (scratch_path(spark, n) for n in ("land", "ckpt", "fact"))
    table = FactTable(spark, path)
    run = lambda: ingest.stream_upsert(spark, landing, path, ckpt, gate=True)
    _drop(spark, landing, "a", "2024-02-01_05", "x", "l1", 1.0)
    _drop(spark, landing, "b", "2024-02-01_05", "x", "l2", 1.0)  # tokens are each dataset's own
    _drop(spark, landing, "a", "2024-02-02_05", "x", "l1", 2.0)  # unchanged within the epoch
    log = run()
    assert {r.location_id: r.value for r in table.read().collect()} == {"l1": 1.0, "l2": 1.0}
    _drop(spark, landing, "a", "2024-02-03_05", "x", "l1", 3.0)  # unchanged since the last epoch
    _drop(spark, landing, "b", "2024-02-03_05", "y", "l2", 3.0)
    run()
    assert {r.location_id: r.value for r in table.read().collect()} == {"l1": 1.0, "l2": 3.0}
    _drop(spark, landing, "a", "2024-02-04_05", "y", "l1", 4.0)
    _drop(spark, landing, "a", "2024-02-05_05", "x", "l1", 5.0)  # back to an older token: changed
    run()
    run()
    assert {r.location_id: r.value for r in table.read().collect()} == {"l1": 5.0, "l2": 3.0}
    assert sorted(tuple(r)[2:] for r in log.counts().collect()) == [(0, 1, 1), (0, 1, 1), (2, 0, 2)]
    assert {tuple(r) for r in log.last_tokens().collect()} == {("a", "x"), ("b", "y")}


def test_replayed_epoch_changes_and_counts_nothing(spark):
    d, t = dt.date(2024, 1, 1), dt.datetime(2024, 2, 1)
    table = FactTable(spark, scratch_path(spark, "fact"))
    log = ingest.IngestLog(spark, table.path + ".ingest")
    first = _fact(spark, [(d, "a", 1, 1, 1, 1.0, t, "u", "n", False, None)])
    assert ingest.apply_epoch(table, log, "s", first, 0, False) == {"rows_inserted": 1, "rows_updated": 0, "batch_rows": 1}
    other = first.withColumn("value", F.lit(9.0))
    assert ingest.apply_epoch(table, log, "s", other, 0, False) is None
    assert [r.value for r in table.read().collect()] == [1.0] and log.counts().count() == 1
    assert ingest.apply_epoch(table, log, "another", other, 0, False)["rows_updated"] == 1  # streams count their own epochs
    assert ingest.apply_epoch(table, log, "s", first.limit(0), 1, False) is None


def test_epoch_that_died_after_its_write_keeps_its_counts(spark, monkeypatch):
    import pytest
    d, t = dt.date(2024, 1, 1), dt.datetime(2024, 2, 1)
    table = FactTable(spark, scratch_path(spark, "fact"))
    log = ingest.IngestLog(spark, table.path + ".ingest")
    batch = _fact(spark, [(d, "a", 1, 1, 1, 1.0, t, "u", "n", False, None)])
    append = ingest.IngestLog.append
    with monkeypatch.context() as m:
        m.setattr(ingest.IngestLog, "append", lambda self, stream, epoch, state, *a: append(self, stream, epoch, state, *a)
                  if state == "begun" else (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ingest.apply_epoch(table, log, "s", batch, 0, False)
    assert table.read().count() == 1 and log.counts().count() == 0
    assert ingest.apply_epoch(table, log, "s", batch, 0, False) == {"rows_inserted": 1, "rows_updated": 0, "batch_rows": 1}
    assert [tuple(r) for r in log.counts("s").collect()] == [("s", 0, 1, 0, 1)]


def test_run_if_changed(spark):
    import pytest
    log, ran = ingest.IngestLog(spark, scratch_path(spark, "log")), []
    counts = {"rows_inserted": 1, "rows_updated": 0, "batch_rows": 1}
    run = lambda: ran.append(1) or counts
    assert ingest.run_if_changed(log, "a", "2024-02-01_05", "x", run) == counts
    assert ingest.run_if_changed(log, "a", "2024-02-02_05", "x", run) is None
    assert ingest.run_if_changed(log, "b", "2024-02-02_05", "x", run) == counts
    with pytest.raises(ValueError):
        ingest.run_if_changed(log, "a", "2024-02-03_05", "y", lambda: (_ for _ in ()).throw(ValueError()))
    assert ingest.run_if_changed(log, "a", "2024-02-03_05", "y", run) == counts  # a failing run is tried again
    assert ingest.run_if_changed(log, "a", "2024-02-04_05", None, run) == counts and len(ran) == 4


def _requests(spark, landing, name, rows):
    import json
    lines = [json.dumps({"started_at": int(dt.datetime(2024, 1, 1, h, m, tzinfo=dt.timezone.utc).timestamp() * 1000),
                         "latencies": {"request": latency}, "response": {"status": status, "size": "10"}}) for h, m, latency, status in rows]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{landing}/{name}")


def test_windows_count_late_requests_inside_the_watermark(spark):
    landing, out, ckpt = (scratch_path(spark, n) for n in ("rl-land", "rl-out", "rl-ckpt"))
    run = lambda: RL.run_windowed_stream(spark, landing + "/*", out, ckpt)
    hours = lambda: {(r.window_start.hour, r.response_status): (r.requests, r.latency_sum, r.latency_max, r.failures)
                     for r in RL.current_windows(spark, out).collect()}
    _requests(spark, landing, "a", [(10, 5, 7, 200), (10, 50, 9, 200), (10, 55, 1, 500), (11, 5, 2, 200)])
    run()
    assert hours() == {(10, 200): (2, 16, 9, 0), (10, 500): (1, 1, 1, 1), (11, 200): (1, 2, 2, 0)}
    _requests(spark, landing, "b", [(10, 58, 20, 200)])  # late, the window is open until 11:10
    run()
    assert hours()[(10, 200)] == (3, 36, 20, 0)
    _requests(spark, landing, "c", [(12, 30, 3, 200)])  # the watermark passes 10 and 11 o'clock's windows
    run()
    _requests(spark, landing, "d", [(10, 59, 40, 200), (11, 1, 40, 200), (12, 1, 5, 200)])  # two behind it, one inside
    run()
    assert hours() == {(10, 200): (3, 36, 20, 0), (10, 500): (1, 1, 1, 1), (11, 200): (1, 2, 2, 0), (12, 200): (2, 8, 5, 0)}


def test_windowed_stream_equals_batch(spark, sf_dir):
    text = QS._request_log_events(spark, sf_dir)
    landing, out, ckpt = (scratch_path(spark, n) for n in ("rl-land", "rl-out", "rl-ckpt"))
    text.write.text(landing)
    RL.run_windowed_stream(spark, landing, out, ckpt)
    batch = RL.windowed_metrics(RL.flatten_request_log(RL.parse_request_log(text)))
    assert sorted(batch.collect()) == sorted(RL.current_windows(spark, out).collect())


def test_settled_state_mends_a_commit_that_died(spark, monkeypatch):
    """Spark's commit takes a partition's folder away before the new one comes: the settled
    state holds the rows that the batch did not bring."""
    import shutil

    from almanac.operators import store
    t0 = dt.datetime(2024, 1, 1)
    row = lambda m, loc, v: (dt.date(2024, m, 1), loc, 1, 1, 1, v, t0, "u", "n", False, None)
    table = FactTable(spark, scratch_path(spark, "fact"))
    table.write_state(_fact(spark, [row(1, "a", 1.0), (row(1, "b", 1.0)), row(2, "a", 1.0)]))
    settled = []

    def settle(df, name):
        settled.append(store_settle(df, name))
        return settled[-1]

    store_settle = store.settle
    monkeypatch.setattr(store, "settle", settle)
    table.upsert(_fact(spark, [row(1, "a", 2.0)]))
    want = sorted(table.read().collect())
    shutil.rmtree(f"{table.path.removeprefix('file:')}/provider_id=1/dt_month=2024-01")
    assert table.read().count() == 1
    table.write_state(settled[-1])
    assert sorted(table.read().collect()) == want and len(want) == 3
