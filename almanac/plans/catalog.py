"""Query catalog: one entry per operator key of the inventory.

Each entry is a Spark plan over the driver's tables (``(spark, sf_dir) ->
DataFrame``) and, where the operator is SQL-expressible, the equivalent
DuckDB text used as the oracle. Every query reads the whole tables.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from almanac.session import apply_engine_conf, ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_engine_conf(spark)
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from almanac.plans import (queries_core, queries_more, queries_sources,  # noqa: F401
                               queries_state)
