"""Session construction and shared-storage helpers.

Library code never builds its own session; it receives one. ``build_session``
is for tests, the bench and local runs. ``scratch_path`` returns a location
under the cluster's shared checkpoint folder (``spark.checkpoint.dir``); a fresh
local folder stands in on a local master only.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the engine relies on.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


# Settings for a large cluster (1000 executors, ~100 TB inputs); applied by
# the deployment, not by library code. AQE coalesces the many shuffle
# partitions at runtime and splits skewed join partitions.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxRecordsPerFile": "20000000",
}


def apply_engine_conf(spark: SparkSession) -> None:
    """Pin the runtime SQL settings the engine's semantics depend on (UTC,
    ANSI casts, last-wins map keys, dynamic partition overwrite)."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "almanac", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``. Where
    the setting is absent a local folder stands in, on a local master only: the
    executors of a cluster would each write to a disk of their own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="almanac-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "almanac", f"{name}-{uuid.uuid4().hex[:12]}")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so
    a lost executor costs no recomputation of what came before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given (read-only) input tables. The DataFrame -- a plan,
    not data -- is reused within a session, so the file listing and footer
    reads happen once per table rather than once per query."""
    key = (id(spark), sf_dir, name)
    cached = _TABLES.get(key)
    if cached is None or cached.sparkSession is not spark:
        cached = _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return cached


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small literal table (bootstrap lists, correction lists) as an inline
    ``VALUES`` relation: the planner knows its exact size, and repeated builds
    have the same plan. ``schema`` is a DDL string such as ``"name string, n int"``."""
    from pyspark.sql.types import DataType
    st = DataType.fromDDL(schema)
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], st)
    names = [f.name for f in st.fields]
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(`c{i}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                     for i, f in enumerate(st.fields))
    inner = ", ".join(f"c{i}" for i in range(len(names)))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({inner})")
