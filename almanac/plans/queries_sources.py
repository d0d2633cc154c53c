"""Catalog part 4: landed files, paged/encoded JSON payloads, request-log
stream and incremental ingest.

Payloads are built from the test tables by Spark (pages of at most 100
records keyed by ``id div 100``), written as landed files or JSON text, and
flattened back; the oracle states the source rows directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac import functions as X
from almanac.plans import oracle_ctes as C
from almanac.plans import testbed as TB
from almanac.plans.catalog import query
from almanac.session import scratch_path, table
from almanac.sources import files as FS
from almanac.sources import pages as PG
from almanac.streaming import request_log as RL

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.DateType()), T.StructField("o_orderpriority", T.StringType())])

_ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"""


def _orders(spark, sf):
    return table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _pages(df, key: str, fields, size: int = 100):
    """Group records into pages of ``size`` ids (bounded page size)."""
    return (df.groupBy((F.col(key) / size).cast("bigint").alias("page"))
            .agg(F.collect_list(F.struct(*fields)).alias("recs")))


def _as_json_lines(df, spark, schema):
    """Round-trip through JSON text, as landed files would be read."""
    text = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    return text.select(F.from_json("value", schema).alias("j")).select("j.*")


# --------------------------------------------------------------- CSV and JSON files

@query("scan_csv", _ORDERS_SQL)
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "csv-orders")
    _orders(spark, sf).write.option("header", True).csv(path)
    return FS.scan_csv(spark, path, ORDERS_SCHEMA)


@query("scan_csv_typed", """
SELECT c_custkey, repeat('0', greatest(5 - length(CAST(c_nationkey AS VARCHAR)), 0)) || c_nationkey AS fips, c_acctbal
FROM customer""")
def q_scan_csv_typed(spark, sf):
    path = scratch_path(spark, "csv-customer")
    c = table(spark, sf, "customer").select("c_custkey", X.zero_pad("c_nationkey").alias("fips"),
                                            "c_acctbal")
    c.write.option("header", True).csv(path)
    schema = "c_custkey bigint, fips string, c_acctbal double"  # fips stays text: leading zeros kept
    return FS.scan_csv(spark, path, schema)


@query("scan_multi_file_tagged", """
SELECT event_id, user_id, value, 'county' AS location_type FROM events
WHERE event_type IN ('click', 'view', 'error')
UNION ALL SELECT event_id, user_id, value, 'state' FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, 0, value, 'nation' FROM events WHERE event_type = 'signup'""")
def q_scan_multi_file_tagged(spark, sf):
    ev = table(spark, sf, "events")
    root = scratch_path(spark, "multi")
    ev.filter(F.col("event_type").isin("click", "view", "error")).select("event_id", "user_id", "value") \
        .write.option("header", True).csv(f"{root}/counties")
    ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "value") \
        .write.option("header", True).csv(f"{root}/states")
    ev.filter(F.col("event_type") == "signup").select("event_id", "value") \
        .write.option("header", True).csv(f"{root}/nation")
    s3 = "event_id bigint, user_id bigint, value double"
    return FS.scan_multi_file_tagged(spark, [
        {"path": f"{root}/counties", "schema": s3, "tags": {"location_type": "county"}},
        {"path": f"{root}/states", "schema": s3, "tags": {"location_type": "state"}},
        {"path": f"{root}/nation", "schema": "event_id bigint, value double",
         "tags": {"location_type": "nation"}, "fill": {"user_id": 0}},
    ]).withColumn("user_id", F.col("user_id").cast("bigint"))


@query("scan_json_records", """
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders""")
def q_scan_json_records(spark, sf):
    path = scratch_path(spark, "json-orders")
    orders = _orders(spark, sf)
    orders.write.json(path)
    # the limit sent to the source: one row more than it holds
    asked = orders.select(F.count(F.lit(1)) + 1).scalar()
    return FS.scan_json_records(spark, path, ORDERS_SCHEMA, row_cap=asked,
                                columns=["o_orderkey", "o_totalprice", "o_orderpriority"])


# --------------------------------------------------------------- paged payloads

_ATTRS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_ATTRS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


@query("flatten_feature_pages", _ATTRS_SQL)
def q_flatten_feature_pages(spark, sf):
    o = _orders(spark, sf)
    pages = (o.groupBy((F.col("o_orderkey") / 100).cast("bigint").alias("page"))
             .agg(F.collect_list(F.struct(F.struct(*_ATTRS).alias("attributes"))).alias("features"))
             .withColumn("exceededTransferLimit", F.lit(False)))
    path = scratch_path(spark, "feature-pages")
    pages.write.json(path)
    attr = T.StructType([f for f in ORDERS_SCHEMA.fields if f.name in _ATTRS])
    schema = T.StructType([T.StructField("page", T.LongType()),
                           T.StructField("features", T.ArrayType(T.StructType([
                               T.StructField("attributes", attr)]))),
                           T.StructField("exceededTransferLimit", T.BooleanType())])
    return PG.flatten_feature_pages(spark.read.schema(schema).json(path))


@query("flatten_record_pages", _ATTRS_SQL)
def q_flatten_record_pages(spark, sf):
    o = _orders(spark, sf)
    total = o.select(F.count(F.lit(1))).scalar()
    pages = _pages(o, "o_orderkey", _ATTRS).select(
        "page", F.lit(True).alias("success"),
        F.struct(total.alias("total"), F.col("recs").alias("records")).alias("result"))
    schema = T.StructType([
        T.StructField("page", T.LongType()), T.StructField("success", T.BooleanType()),
        T.StructField("result", T.StructType([
            T.StructField("total", T.LongType()),
            T.StructField("records", T.ArrayType(T.StructType(
                [f for f in ORDERS_SCHEMA.fields if f.name in _ATTRS])))]))])
    return PG.flatten_record_pages(_as_json_lines(pages, spark, schema))


@query("flatten_keyed_array", """
SELECT event_id, user_id, event_type, value FROM events""")
def q_flatten_keyed_array(spark, sf):
    ev = table(spark, sf, "events")
    pages = _pages(ev, "event_id", ["event_id", "user_id", "event_type", "value"]) \
        .withColumnRenamed("recs", "data")
    schema = T.StructType([T.StructField("page", T.LongType()), T.StructField("data", T.ArrayType(
        T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                      T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])))])
    return PG.flatten_keyed_array(_as_json_lines(pages, spark, schema))


@query("flatten_positional_records", """
SELECT event_id, user_id, value FROM events""")
def q_flatten_positional_records(spark, sf):
    ev = table(spark, sf, "events")
    rows = ev.select("event_id", F.array(F.col("event_id").cast("string"), F.col("user_id").cast("string"),
                                         F.concat(F.col("value").cast("string"), F.lit("D"))).alias("C"))
    pages = _pages(rows, "event_id", ["C"]).withColumnRenamed("recs", "rows")
    schema = "page bigint, rows array<struct<C: array<string>>>"
    return PG.flatten_positional_records(
        _as_json_lines(pages, spark, schema), ["event_id", "user_id", "value"],
        types={"event_id": "bigint", "user_id": "bigint", "value": "double"},
        strip_suffix={"value": "D"})


@query("flatten_hierarchy", """
SELECT o_orderkey // 100 AS page, o_orderstatus, o_orderpriority, o_orderkey, o_totalprice
FROM orders""")
def q_flatten_hierarchy(spark, sf):
    o = _orders(spark, sf).withColumn("page", (F.col("o_orderkey") / 100).cast("bigint"))
    lvl2 = (o.groupBy("page", "o_orderstatus", "o_orderpriority")
            .agg(F.collect_list(F.struct("o_orderkey", "o_totalprice")).alias("DM2")))
    lvl1 = (lvl2.groupBy("page", "o_orderstatus")
            .agg(F.collect_list(F.struct("o_orderpriority", F.struct("DM2").alias("M"))).alias("DM1")))
    lvl0 = (lvl1.groupBy("page")
            .agg(F.collect_list(F.struct("o_orderstatus", F.struct("DM1").alias("M"))).alias("DM0")))
    return PG.flatten_hierarchy(lvl0, [("DM0", ["o_orderstatus"]), ("DM1", ["o_orderpriority"]),
                                       ("DM2", ["o_orderkey", "o_totalprice"])], keep=["page"])


#: Levels of objects and arrays in an event document.
DOCUMENT_DEPTH = 3


def _event_documents(spark, sf):
    """Events as nested JSON documents (objects, an array, a parsed object)."""
    ev = table(spark, sf, "events")
    doc = F.to_json(F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.struct(F.col("user_id").alias("id")).alias("user"),
                 F.col("event_type").alias("type")).alias("meta"),
        F.array("value").alias("metrics"),
        F.from_json("props", "k bigint").alias("props")))
    return ev.select("event_id", doc.alias("doc"))


@query("flatten_nested_paths", """
SELECT event_id AS id, 'id' AS path, CAST(event_id AS VARCHAR) AS value FROM events
UNION ALL SELECT event_id, 'meta_user_id', CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT event_id, 'meta_type', event_type FROM events
UNION ALL SELECT event_id, 'metrics_0', CAST(value AS VARCHAR) FROM events
UNION ALL SELECT event_id, 'props_k', json_extract_string(props, '$.k') FROM events""")
def q_flatten_nested_paths(spark, sf):
    long = PG.flatten_json_long(_event_documents(spark, sf), "event_id", "doc", max_depth=DOCUMENT_DEPTH)
    return long.select("id", "path", "value")


@query("pick_by_path_substring", """
SELECT event_id AS id, CAST(user_id AS VARCHAR) AS who, CAST(value AS VARCHAR) AS doses,
       event_type AS kind, json_extract_string(props, '$.k') AS k FROM events""")
def q_pick_by_path_substring(spark, sf):
    long = PG.flatten_json_long(_event_documents(spark, sf), "event_id", "doc", max_depth=DOCUMENT_DEPTH)
    # first path (document order) containing each substring: "user" hits
    # meta_user_id, "_k" hits props_k
    return PG.pick_long_by_path_substring(long, {"who": "user", "doses": "metrics", "kind": "type",
                                                 "k": "_k"})


@query("decode_dictionary_columns", """
SELECT o_orderkey // 100 AS payload, CAST(o_orderkey AS VARCHAR) AS "key-value",
       CAST(o_totalprice AS VARCHAR) AS "price-value", o_orderpriority AS "priority-alias" FROM orders""")
def q_decode_dictionary_columns(spark, sf):
    o = _orders(spark, sf).withColumn("payload", (F.col("o_orderkey") / 100).cast("bigint"))
    per = (o.groupBy("payload")
           .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice", "o_orderpriority")))
                .alias("rows")))
    prios = F.array_sort(F.array_distinct(F.transform("rows", lambda r: r["o_orderpriority"])))
    per = per.withColumn("prios", prios)
    n = F.size("rows")
    seq = F.sequence(F.lit(0), n - 1)
    payload = per.select(
        "payload",
        F.array(
            F.struct(F.lit("cstring").alias("dataType"), F.col("prios").alias("dataValues")),
            F.struct(F.lit("integer").alias("dataType"),
                     F.transform("rows", lambda r: r["o_orderkey"].cast("string")).alias("dataValues")),
            F.struct(F.lit("real").alias("dataType"),
                     F.transform("rows", lambda r: r["o_totalprice"].cast("string")).alias("dataValues")),
        ).alias("dataColumns"),
        F.array(
            F.struct(F.lit("key").alias("fieldCaption"), F.lit("integer").alias("dataType"),
                     seq.alias("valueIndices"), F.array().cast("array<int>").alias("aliasIndices")),
            F.struct(F.lit("price").alias("fieldCaption"), F.lit("real").alias("dataType"),
                     seq.alias("valueIndices"), F.array().cast("array<int>").alias("aliasIndices")),
            # negative alias indices point into the cstring dictionary
            F.struct(F.lit("priority").alias("fieldCaption"), F.lit("real").alias("dataType"),
                     F.array().cast("array<int>").alias("valueIndices"),
                     F.transform("rows", lambda r: -F.array_position(F.col("prios"), r["o_orderpriority"])
                                 .cast("int")).alias("aliasIndices")),
        ).alias("columns"))
    long = PG.decode_dictionary_columns(payload)
    wide = PG.pivot_decoded(long, ["key-value", "price-value", "priority-alias"])
    return wide.drop("pos")


@query("single_pane_metrics", """
SELECT event_id // 100 AS payload,
  CAST(min(event_id) FILTER (WHERE event_type = 'click') AS VARCHAR) AS click,
  CAST(min_by(value, event_id) FILTER (WHERE event_type = 'view') AS VARCHAR) AS view,
  CAST(min(event_id) FILTER (WHERE event_type = 'purchase') AS VARCHAR) AS purchase,
  CASE WHEN event_id // 100 % 7 <> 0 THEN CAST(min_by(value, event_id) FILTER (WHERE event_type = 'signup') AS VARCHAR)
  END AS signup, CAST(NULL AS VARCHAR) AS error, 'page ' || CAST(event_id // 100 AS VARCHAR) AS "Last update"
FROM events GROUP BY event_id // 100""")
def q_single_pane_metrics(spark, sf):
    """A payload per 100 event ids, a pane per event type that points at the type's
    first event: integer panes at its id, real panes at its value. Errors have a
    type that no dictionary serves; some sign-up panes lack an index."""
    kinds = [("click", "integer"), ("view", "real"), ("purchase", "integer"), ("signup", "real"), ("error", "cstring")]
    pages = (table(spark, sf, "events").groupBy((F.col("event_id") / 100).cast("bigint").alias("payload"))
             .agg(F.array_sort(F.collect_list(F.struct("event_id", "value", "event_type"))).alias("rows")))
    text = lambda c: F.transform("rows", lambda r: r[c].cast("string"))
    entry = lambda kind, values: F.struct(F.lit(kind).alias("dataType"), values.alias("dataValues"))
    pages = pages.withColumn("dataColumns", F.array(
        entry("integer", text("event_id")), entry("real", text("value")),
        entry("cstring", F.array(F.lit("x"), F.concat(F.lit("page "), F.col("payload").cast("string"))))))
    panes = pages.withColumn("k", F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(t).alias("dtype"), F.lit(i).alias("ordinal")) for i, (n, t) in enumerate(kinds)])))
    at = F.nullif(F.array_position(F.transform("rows", lambda r: r["event_type"]), F.col("k.name")), F.lit(0)) - 1
    hidden = (F.col("k.name") == "signup") & (F.col("payload") % 7 == 0)
    panes = panes.select("payload", "k.*", "dataColumns", F.when(~hidden, at).cast("int").alias("idx"))
    return PG.single_pane_metrics(panes, [n for n, _ in kinds])


@query("decode_delta_rows", """
SELECT user_id, event_type, CAST(hour(ts) AS VARCHAR) AS hour, CAST(event_id AS VARCHAR) AS event
FROM events""")
def q_decode_delta_rows(spark, sf):
    from pyspark.sql import Window
    # a page holds one user's events within a block of 100 event ids, so a
    # very active user spreads over many bounded pages
    ev = table(spark, sf, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), (F.col("event_id") / 100).cast("bigint")
                    .cast("string")).alias("page"),
        "user_id", "event_type", F.hour("ts").cast("string").alias("hour"),
        F.col("event_id").cast("string").alias("event"), "event_id")
    # delta-encode: per page in (type, hour, id) order, leave out the leading
    # values that equal the previous row's
    w = Window.partitionBy("page").orderBy("event_type", "hour", "event_id")
    same_t = F.coalesce(F.lag("event_type").over(w) == F.col("event_type"), F.lit(False))
    same_h = same_t & F.coalesce(F.lag("hour").over(w) == F.col("hour"), F.lit(False))
    full = F.array("event_type", "hour", "event")
    c = F.when(same_h, F.slice(full, 3, 1)).when(same_t, F.slice(full, 2, 2)).otherwise(full)
    rows = ev.select("page", "user_id", F.struct(F.struct(c.alias("C")).alias("r"), F.col("event_type"),
                                                 F.col("hour"), F.col("event_id")).alias("k"))
    pages = rows.groupBy("page", "user_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(
            F.col("k.event_type"), F.col("k.hour"), F.col("k.event_id"), F.col("k.r")))),
            lambda x: x["r"]).alias("DM1"))
    out = PG.decode_delta_rows(pages, ["event_type", "hour", "event"], initial="0", keep=["user_id"])
    return out.drop("ordinal", "page")


# --------------------------------------------------------------- request log

def _request_log_events(spark, sf):
    ev = table(spark, sf, "events")
    headers = F.when(F.col("event_type") == "click", F.create_map(
        F.lit("x-forwarded-for"), F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")),
        F.lit("user-agent"), F.concat(F.lit("agent/"), F.col("event_type")))).otherwise(
        F.create_map(F.lit("user-agent"), F.concat(F.lit("agent/"), F.col("event_type"))))
    nested = ev.select(
        F.struct(F.lit(0).cast("bigint").alias("created_at"), F.col("user_id").cast("string").alias("id"),
                 F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username")).alias("consumer"),
        F.struct((F.col("value") * 10).cast("bigint").alias("request"),
                 (F.col("value")).cast("bigint").alias("kong"),
                 (F.col("value") * 9).cast("bigint").alias("proxy")).alias("latencies"),
        F.struct(F.concat(F.lit("https://api.example/covid_us?type="), F.col("event_type")).alias("url"),
                 headers.alias("headers"), F.lit("GET").alias("method"),
                 F.lit("120").alias("size")).alias("request"),
        F.concat(F.lit("192.168.0."), F.col("user_id").cast("string")).alias("client_ip"),
        F.struct(F.when(F.col("event_type") == "error", 500).otherwise(200).cast("bigint").alias("status"),
                 (F.col("event_id") * 7).cast("string").alias("size")).alias("response"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("started_at"))
    return nested.select(F.to_json(F.struct(*nested.columns)).alias("value"))


_REQUEST_LOG_SQL = """
SELECT 'user_' || CAST(user_id AS VARCHAR) AS username, CAST(trunc(value * 10) AS BIGINT) AS request_latency,
  CAST(trunc(value) AS BIGINT) AS kong_latency, CAST(trunc(value * 9) AS BIGINT) AS proxy_latency,
  'https://api.example/covid_us?type=' || event_type AS request_url,
  CASE WHEN event_type = 'click' THEN '10.0.0.' || CAST(user_id AS VARCHAR)
       ELSE '192.168.0.' || CAST(user_id AS VARCHAR) END AS client_ip,
  CAST(CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS BIGINT) AS response_status,
  CAST(event_id * 7 AS INTEGER) AS response_size,
  make_timestamp(CAST(floor(epoch_us(ts) / 1000) AS BIGINT) * 1000) AS started_at,
  'agent/' || event_type AS user_agent
FROM events"""


@query("request_log_flatten", _REQUEST_LOG_SQL)
def q_request_log_flatten(spark, sf):
    """Batch and stream share one function: the events land as JSON files and
    a Structured Streaming query (availableNow) flattens them."""
    landing = scratch_path(spark, "request-log-landing")
    out = scratch_path(spark, "request-log-out")
    ckpt = scratch_path(spark, "request-log-ckpt")
    _request_log_events(spark, sf).write.text(landing)
    RL.run_request_log_stream(spark, landing, out, ckpt)
    return spark.read.parquet(out)


# --------------------------------------------------------------- incremental ingest

@query("stream_upsert", "WITH " + C.UPSERTED + " SELECT * FROM upserted")
def q_stream_upsert(spark, sf):
    """Base state written as the fact table; the batch lands as two file
    drops that share keys; the stream upserts them, the newest row of a key wins."""
    from almanac.operators.store import FactTable
    from almanac.streaming.ingest import stream_upsert
    res = TB.resolved(spark, sf)
    base, batch = TB.fact_base(spark, sf, res), TB.fact_batch(spark, sf, res)
    fact_path = scratch_path(spark, "fact")
    landing = scratch_path(spark, "fact-landing")
    ckpt = scratch_path(spark, "fact-ckpt")
    table_ = FactTable(spark, fact_path)
    table_.write_state(base)
    # the first drop holds older figures of part of the keys of the second
    older = (batch.filter(F.dayofmonth("dt") <= 10)
             .withColumns({"value": F.col("value") + 1, "last_updated": F.col("last_updated") - F.expr("INTERVAL 1 DAY")}))
    older.write.parquet(f"{landing}/drop=1")
    batch.write.parquet(f"{landing}/drop=2")
    stream_upsert(spark, landing + "/*", fact_path, ckpt)
    return table_.read()


_GATED_PK = "dt, location_id, variable_id, demographic_id, provider_id"


@query("gated_ingest", "WITH " + C.FACTS + f""",
taken AS (SELECT {_GATED_PK}, value, 1 AS run FROM fact_batch
          UNION ALL SELECT {_GATED_PK}, value * 5, 3 FROM fact_batch WHERE day(dt) <= 10),
newest AS (SELECT {_GATED_PK}, max_by(value, run) AS value FROM taken GROUP BY {_GATED_PK})
SELECT {_GATED_PK}, CASE WHEN n.dt IS NOT NULL THEN n.value ELSE o.value END AS value
FROM fact_base o FULL OUTER JOIN newest n USING ({_GATED_PK})""")
def q_gated_ingest(spark, sf):
    """Drops of one dataset in two runs: the second drop's token is that of the first and
    it is skipped, the third's is new; the second run's only drop is unchanged."""
    from almanac.operators.store import FactTable
    from almanac.streaming.ingest import stream_upsert
    res = TB.resolved(spark, sf)
    base, batch = TB.fact_base(spark, sf, res), TB.fact_batch(spark, sf, res)
    fact_path, landing, ckpt = (scratch_path(spark, n) for n in ("fact", "fact-landing", "fact-ckpt"))
    table_ = FactTable(spark, fact_path)
    table_.write_state(base)
    early = batch.where(F.dayofmonth("dt") <= 10)
    later = lambda df, factor, days: df.withColumns(
        {"value": F.col("value") * factor, "last_updated": F.col("last_updated") + F.expr(f"INTERVAL {days} DAY")})
    drop = lambda df, vintage, token: df.write.parquet(f"{landing}/dataset=orders/vintage={vintage}/token={token}")
    drop(batch, "2024-02-01_05", "a")
    drop(later(early, 100, 1), "2024-02-02_05", "a")
    drop(later(early, 5, 2), "2024-02-03_05", "b")
    stream_upsert(spark, landing, fact_path, ckpt, gate=True)
    drop(later(early, 1000, 3), "2024-02-04_05", "b")
    stream_upsert(spark, landing, fact_path, ckpt, gate=True)
    return table_.read().select("dt", "location_id", "variable_id", "demographic_id", "provider_id", "value")


# --------------------------------------------------------------- windowed request metrics

@query("request_log_windowed", f"""
SELECT time_bucket(INTERVAL 1 HOUR, started_at) AS window_start, time_bucket(INTERVAL 1 HOUR, started_at) + INTERVAL 1 HOUR AS window_end,
       response_status, count(*) AS requests, CAST(sum(request_latency) AS BIGINT) AS latency_sum, max(request_latency) AS latency_max,
       CAST(sum(response_size) AS BIGINT) AS bytes_sent, count(*) FILTER (WHERE response_status >= 500) AS failures
FROM ({_REQUEST_LOG_SQL}) r GROUP BY ALL""")
def q_request_log_windowed(spark, sf):
    """Tumbling hours of the request log, kept up to date by a stateful stream."""
    landing, out, ckpt = (scratch_path(spark, n) for n in ("request-log-landing", "request-metrics", "request-metrics-ckpt"))
    _request_log_events(spark, sf).write.text(landing)
    RL.run_windowed_stream(spark, landing, out, ckpt)
    return RL.current_windows(spark, out)
