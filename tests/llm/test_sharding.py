"""Feistel shards: a permutation, its inverse, balanced shards."""

import zlib
from collections import Counter

import numpy as np
import pytest

from almanac.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 24, 1000, 4097])
def test_permutation_and_inverse(n):
    rows = np.arange(n)
    there = sharding.permute(rows, n)
    assert sorted(there.tolist()) == rows.tolist()
    assert np.array_equal(sharding.permute(there, n, inverse=True), rows)
    assert n < 100 or (there != rows).mean() > 0.9


def test_seeds_differ():
    rows = np.arange(1000)
    assert (sharding.permute(rows, 1000, 1) != sharding.permute(rows, 1000, 2)).mean() > 0.9


def test_rows(spark):
    rows = [(i % 70, f"t{i % 70}", "x") for i in range(100)] + [(None, "n", "x"), (None, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    got = sharding.sharded(df, "doc_id", "text").collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == 102 and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    for r in got:
        assert sharding.row_at(r.shard, r.slot, 102) == r.row_number
    again = sharding.sharded(df.repartition(2), "doc_id", "text").collect()
    key = lambda r: (str(r.doc_id), str(r.text), r.shard, r.slot)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_empty(spark):
    assert sharding.sharded(spark.createDataFrame([], "doc_id long"), "doc_id").collect() == []


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = sharding.op6_feistel_shards(spark, sf_dir).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {
        i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in docs.items()}
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_query_on_null_and_long_texts(spark, tmp_path):
    rows = [(1, None, "x"), (2, "", "x"), (3, "é" * 400_000, "y"), (3, "é" * 400_000, "y"), (None, "n", None)] + [(i, f"t{i}", "z") for i in range(10, 40)]
    spark.createDataFrame(rows, "doc_id long, text string, law string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sharding.op6_feistel_shards(spark, str(tmp_path)).collect()
    want = sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == want
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    counts = Counter(r.shard for r in got)
    assert set(counts) <= set(range(24)) and max(counts.values()) - min(counts.get(s, 0) for s in range(24)) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
