"""Request-log events: nested JSON -> one flat row per request.

The same ``flatten_request_log`` runs on a batch DataFrame and on a
Structured Streaming source, so batch output equals stream output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STR_MAP = T.MapType(T.StringType(), T.StringType())

# The layout of a request-log event.
REQUEST_LOG_SCHEMA = T.StructType([
    T.StructField("consumer", T.StructType([
        T.StructField("created_at", T.LongType()), T.StructField("id", T.StringType()),
        T.StructField("username", T.StringType())])),
    T.StructField("latencies", T.StructType([
        T.StructField("request", T.LongType()), T.StructField("kong", T.LongType()),
        T.StructField("proxy", T.LongType())])),
    T.StructField("service", _STR_MAP),
    T.StructField("request", T.StructType([
        T.StructField("querystring", _STR_MAP), T.StructField("size", T.StringType()),
        T.StructField("uri", T.StringType()), T.StructField("url", T.StringType()),
        T.StructField("headers", _STR_MAP), T.StructField("method", T.StringType())])),
    T.StructField("client_ip", T.StringType()),
    T.StructField("tries", T.ArrayType(_STR_MAP)),
    T.StructField("upstream_uri", T.StringType()),
    T.StructField("response", T.StructType([
        T.StructField("headers", _STR_MAP), T.StructField("status", T.LongType()),
        T.StructField("size", T.StringType())])),
    T.StructField("route", _STR_MAP),
    T.StructField("started_at", T.LongType()),
])


def flatten_request_log(events: DataFrame) -> DataFrame:
    """Client ip = ``x-forwarded-for`` header, else ``client_ip``; sizes are
    text -> int; ``started_at`` epoch ms -> timestamp; user agent from the
    request headers."""
    h = F.col("request.headers")
    return events.select(
        F.col("consumer.username").alias("username"),
        F.col("latencies.request").alias("request_latency"),
        F.col("latencies.kong").alias("kong_latency"),
        F.col("latencies.proxy").alias("proxy_latency"),
        F.col("request.url").alias("request_url"),
        F.coalesce(F.element_at(h, F.lit("x-forwarded-for")), F.col("client_ip")).alias("client_ip"),
        F.col("response.status").alias("response_status"),
        F.col("response.size").cast("int").alias("response_size"),
        F.timestamp_millis("started_at").cast("timestamp_ntz").alias("started_at"),
        F.element_at(h, F.lit("user-agent")).alias("user_agent"))


def parse_request_log(text: DataFrame, column: str = "value") -> DataFrame:
    """JSON text lines -> nested events (explicit schema, no inference)."""
    return text.select(F.from_json(column, REQUEST_LOG_SCHEMA).alias("e")).select("e.*")


def request_log_stream(spark: SparkSession, landing: str) -> DataFrame:
    """Streaming source over landed request-log JSON files."""
    return flatten_request_log(spark.readStream.schema(REQUEST_LOG_SCHEMA).json(landing))


def run_request_log_stream(spark: SparkSession, landing: str, out: str, checkpoint: str) -> None:
    """Append flattened requests to Parquet; ``availableNow`` processes what
    has landed and stops; the checkpoint makes reruns incremental."""
    q = (request_log_stream(spark, landing).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


WINDOW = "1 hour"
#: How late a request may come: its window stays open so long behind the latest request.
LATENESS = "10 minutes"


def windowed_metrics(requests: DataFrame, window: str = WINDOW, lateness: str = LATENESS) -> DataFrame:
    """Tumbling windows over flattened requests: per window and status the number of
    requests, their latency (sum and maximum), bytes and failures. On a stream, windows
    are state until the watermark passes them: a late request inside ``lateness`` still
    counts, one for a window that is closed does not. On a batch every request counts.
    Requests without a time have no window."""
    timed = requests.where(F.col("started_at").isNotNull()).withColumn("at", F.col("started_at").cast("timestamp"))
    rows = (timed.withWatermark("at", lateness).groupBy(F.window("at", window).alias("w"), "response_status")
            .agg(F.count(F.lit(1)).alias("requests"), F.sum("request_latency").alias("latency_sum"),
                 F.max("request_latency").alias("latency_max"), F.sum("response_size").alias("bytes_sent"),
                 F.count_if(F.col("response_status") >= 500).alias("failures")))
    return rows.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                       "response_status", "requests", "latency_sum", "latency_max", "bytes_sent", "failures")


def run_windowed_stream(spark: SparkSession, landing: str, out: str, checkpoint: str,
                        window: str = WINDOW, lateness: str = LATENESS) -> None:
    """Take in what has landed and write the windows that changed, a folder per epoch; a
    replayed epoch replaces its own folder."""
    def write(changed: DataFrame, epoch: int) -> None:
        (changed.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out))

    q = (windowed_metrics(request_log_stream(spark, landing), window, lateness).writeStream.outputMode("update")
         .foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def current_windows(spark: SparkSession, out: str) -> DataFrame:
    """The latest figures of every window."""
    rows = spark.read.parquet(out)
    keys = ["window_start", "window_end", "response_status"]
    rest = [c for c in rows.columns if c not in (*keys, "epoch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("m")).select(*keys, "m.*")
