"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Rows are numbered in a total order; a four-round Feistel network over the next
even number of bits, with cycle walking, permutes 0..n-1. The permuted number p
gives shard ``p mod shards`` and slot ``p div shards``, so counts differ by one at
most, slots have no gaps, and the row at any (shard, slot) is computable by the
inverse without a lookup.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import documents, numbered
from almanac.llm.text_arrays import mix64

SHARDS = 24
SEED = 2024
ROUNDS = 4


def _keys(seed: int) -> np.ndarray:
    return mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 8))


def _feistel(x: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    half, mask = np.uint64(bits // 2), np.uint64((1 << (bits // 2)) - 1)
    left, right = x >> half, x & mask
    for key in keys:
        left, right = right, left ^ (mix64(right + key) & mask)
    return (right << half) | left


def _width(n: int) -> int:
    bits = max(2, (n - 1).bit_length())
    return bits + bits % 2


def permute(rows: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 (or its inverse) at ``rows``. The network is its
    own inverse under reversed keys: it returns its halves swapped."""
    bits, keys = _width(n), _keys(seed)
    keys = keys[::-1] if inverse else keys
    out = _feistel(rows.astype(np.uint64), bits, keys)
    while len(walk := np.flatnonzero(out >= np.uint64(n))):
        out[walk] = _feistel(out[walk], bits, keys)
    return out.astype(np.int64)


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """Global row number at a place."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def sharded(df: DataFrame, *order, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with row_number, shard and slot. ``order`` should be total up to
    interchangeable rows; nulls sort first. Rows equal in it (repeated rows) still
    get places of their own. Columns of the three names in ``df`` are replaced; an
    empty table gives an empty result."""
    rows = numbered(df, *order)
    n = rows.count()

    @F.arrow_udf("long")
    def place(number: pa.Array) -> pa.Array:
        return pa.array(permute(number.to_numpy(zero_copy_only=False), n, seed))

    return (rows.withColumn("_p", place("row_number"))
            .withColumn("shard", F.pmod("_p", F.lit(shards)).cast("int"))
            .withColumn("slot", F.floor(F.col("_p") / shards).cast("long")).drop("_p"))


def op6_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``. Null text counts as empty; extra columns are ignored."""
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"))
    return sharded(rows, "doc_id", "text_crc32", "size").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")
