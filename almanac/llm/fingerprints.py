"""Document fingerprints: MinHash over five-word shingles.

``PERMUTATIONS`` multiply-shift hashes of every shingle, the minimum of each per
document, 16 bits kept of each minimum. The share of equal positions estimates
the Jaccard similarity. ``near_classes`` joins bands of the signature in Spark
and verifies every candidate by the exact Jaccard.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import text_arrays as ta
from almanac.llm.common import cut_points, documents, join_copies, partitions, settle
from almanac.llm.ngram_join import resolved

PERMUTATIONS = 128
BAND_ROWS = 4
SEED = 7

_rng = np.random.default_rng(SEED)
_A = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def signatures(column: pa.Array) -> np.ndarray:
    """MinHash of each value (values x PERMUTATIONS, uint16). A value without words
    has all positions at the maximum."""
    values, off = ta.shingle_hashes(*ta.word_hashes(*ta.utf8(column)))
    out = np.full((len(off) - 1, PERMUTATIONS), 0xFFFF, dtype=np.uint16)
    some = np.flatnonzero(np.diff(off))
    if len(some):
        x, starts = values >> np.uint64(32), off[:-1][some]
        with np.errstate(over="ignore"):
            for k in range(PERMUTATIONS):
                h = x * _A[k]
                h += _B[k]
                h >>= np.uint64(32)
                low = np.minimum.reduceat(h, starts)
                out[some, k] = (ta.mix64(low) >> np.uint64(48)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def _hex(signature: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in signature.astype(">u2")]


def edited_text(text: str, other: str) -> str:
    """The last third of ``text`` replaced by as much of the head of ``other``."""
    n = len(text) // 3
    return text[:len(text) - n] + other[:n]


OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                 ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                 ("near_edited", pa.float64()), ("near_next", pa.float64())])
OUT_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one shard in order, the last being the next shard's first."""
    held: tuple | None = None  # the row before, still without its successor
    for batch in batches:
        for piece in ta.chunks(batch, "text"):
            ids, tails = piece.column("doc_id").to_pylist(), piece.column("tail").to_pylist()
            column = piece.column("text")
            texts, signs = column.to_pylist(), signatures(column)
            if held is not None:
                ids, texts, signs = [held[0], *ids], [held[1], *texts], np.concatenate([held[2], signs])
                tails = [False, *tails]
            if tails[-1]:  # further copies of the tail row are the same text
                first = tails.index(True)
                ids, texts, signs = ids[:first + 1], texts[:first + 1], signs[:first + 1]
            held = (ids[-1], texts[-1], signs[-1:])
            n = len(ids) - 1
            if n:
                edits = [edited_text(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
                esigns = np.concatenate([signatures(c.column("e")) for c in ta.chunks(
                    pa.RecordBatch.from_arrays([pa.array(edits, pa.large_string())], ["e"]), "e")])
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits]),
                    pa.array(_hex(signs[:-1])), pa.array(_hex(esigns)),
                    pa.array(likeness(signs[:-1], esigns)), pa.array(likeness(signs[:-1], signs[1:]))], schema=OUT)
            if tails[-1]:
                return


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The order is descending doc_id (nulls last), rows of one id by text hash; the
    row after the last is the first, so a single row is its own successor. Null
    text is empty; an empty text equals its edited text; texts of any length are read
    whole. Repeated rows each give a row. Extra columns are ignored; an empty table gives an empty result.

    Texts move once: ids alone give exact cut points, rows go to the shard of their
    range, and each shard's first row also goes to the shard before it."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .withColumn("hash", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash")]
    found = cut_points(rows.select("doc_id", "hash"), *order, shards=partitions(spark))
    place = lambda i, h: (i is None, -i if i is not None else 0, h)
    cuts = sorted({place(r.doc_id, r.hash) for r in found})
    n = len(cuts)

    @F.arrow_udf("array<int>")
    def shards(doc_id: pa.Array, hashes: pa.Array) -> pa.Array:
        out = []
        for i, h in zip(doc_id.to_pylist(), hashes.to_pylist(), strict=True):
            key = place(i, h)
            shard = bisect_right(cuts, key) - 1
            out.append([shard, (shard - 1) % n] if cuts[shard] == key else [shard])
        return pa.array(out, pa.list_(pa.int32()))

    return (rows.select("doc_id", "hash", "text", F.posexplode(shards("doc_id", "hash")).alias("copy", "shard"))
            .withColumn("tail", F.col("copy") == 1)
            .repartitionById(max(n, 1), "shard").sortWithinPartitions("tail", *order)
            .select("doc_id", "text", "tail").mapInArrow(_compare, OUT_DDL))


SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("shared", pa.binary()),
                  ("bands", pa.list_(pa.int64()))])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in ta.chunks(batch, "text"):
            column = piece.column("text")
            values, off = ta.shingle_sets(column)
            packed = [values[a:b].view(np.int64).tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            bands = signatures(column).reshape(piece.num_rows, -1, BAND_ROWS).astype(np.uint64)
            code = np.zeros(bands.shape[:2], dtype=np.uint64)
            for i in range(BAND_ROWS):
                code = (code << np.uint64(16)) | bands[:, :, i]
            code = ta.mix64(code ^ ta.mix64(np.arange(code.shape[1], dtype=np.uint64))[None, :]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(np.diff(off)), pa.array([x.tobytes() for x in ta.set_signatures(values, off)], pa.binary()),
                 pa.array(packed, pa.binary()), pa.array(code.tolist(), pa.list_(pa.int64()))], schema=SETS)


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id and class_id (smallest doc_id reachable) of every row: documents whose
    signatures agree in a band and whose exact Jaccard is 0.75 or more link. Texts
    without words link with nothing; equal shingle sets are one class; a null
    doc_id is ignored by the minimum."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = settle(text.mapInArrow(_sets, "doc_id long, n long, sig binary, shared binary, bands array<long>"), "minhash-sets")
    some = rows.where("n > 0")
    sets = settle(some.groupBy("sig").agg(F.first("n").alias("n"), F.first("shared").alias("shared"),
                                          F.first("bands").alias("bands"))
                  .withColumn("set_id", F.monotonically_increasing_id()).withColumn("m", F.col("n")), "minhash-classes")
    posts = sets.select(F.explode("bands").alias("band"), "set_id")
    hubs = posts.groupBy("band").agg(F.count("*").alias("k"), F.min("set_id").alias("hub")).where("k > 1").drop("k")
    near = settle(posts.join(hubs, "band").where("set_id <> hub").select("hub", "set_id").distinct(), "minhash-near")
    found = resolved(near, sets)
    least = some.groupBy("sig").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    linked = sets.select("sig", "set_id").join(found, F.col("set_id") == F.col("node")).join(least, "sig").select("sig", "component", "least")
    lowest = linked.groupBy("component").agg(F.min("least").alias("lowest"))
    named = settle(least.join(linked.join(lowest, "component").select("sig", "lowest"), "sig", "left")
                   .select("sig", "copies", F.coalesce("lowest", "least").alias("class_id")), "minhash-names")
    members = rows.select("doc_id", F.when(F.col("n") > 0, F.col("sig")).alias("sig"))
    return join_copies(members, named, "sig", "copies").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def op5_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(documents(spark, sf_dir))
