"""Best-fit packing of token sequences by minimum bin slack.

The lengths of all pieces form a histogram with one count per length, at most
``capacity`` of them however large the corpus. Minimum bin slack runs on that
histogram: a bin opens with the longest length left, a bitset subset-sum over the
lengths available finds the fullest completion, and that combination is removed
as often as the counts allow. The plan (combinations with multiplicities) is
bounded by the capacity too. Bins may be allowed a little slack; of the plans for
a few such slacks the one with the fewest bins counts. Pieces are then numbered in order of length, and a
piece's number alone gives its sequence and offset.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import documents, numbered, settle

CAPACITY = 1024
END_ID = 2
#: A run of white space of this length goes to the ``tokenizers`` library: the faster
#: engine keeps a place to go back to for each of its characters, and ends at a million.
BLANKS = re.compile(r"\s{50000}")
#: Slacks per bin that are tried.
SLACKS = (0, 1, 2, 4, 8, 16, 32)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def encoder(path: str):
    """Encoder of a byte-level BPE in the ``tokenizers`` JSON format: its ranks,
    split pattern and added tokens in tiktoken's engine, which gives the same ids
    (tests hold it against ``tokenizers``) at four times the speed."""
    import public_tokenizers
    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=added)


@lru_cache(maxsize=2)
def library(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def token_ids(path: str, text: str) -> np.ndarray:
    """Ids of a text of any length."""
    if BLANKS.search(text):
        return np.array(library(path).encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    return encoder(path).encode_to_numpy(text, allowed_special="all")


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64())])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of n ids: full pieces, the first one taking the remainder."""
    first = n % capacity or capacity
    return [0, *range(first, n, capacity)]


def _tokenise(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(token_ids(path, text.as_py() or ""), end_id).astype("<u4")
                starts = cut(len(ids), capacity)
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    rows.append((doc, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            cols = zip(*rows, strict=True) if rows else [[]] * len(PIECES)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, PIECES, strict=True)], schema=PIECES)
    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token pieces of each row of ``docs(doc_id, text)``; null text is empty."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(_tokenise(path, capacity, end_id), PIECES_DDL)


def fullest(counts: dict[int, int], room: int, slack: int = 0) -> list[int]:
    """The combination of available lengths (each at most its count) with the
    largest sum within ``room``, by subset-sum over bitsets. Counts are cut into
    powers of two; longer lengths come first and are preferred. The search ends
    at the first sum within ``slack`` of the room."""
    layers, bits, mask = [], 1, (1 << (room + 1)) - 1
    goal = ((1 << (slack + 1)) - 1) << room - slack if room > slack else mask
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length], room // length if length <= room else 0), 1
        while left > 0 and not bits & goal:
            use = min(step, left)
            layers.append((length, use, bits))
            bits |= bits << (length * use) & mask
            left, step = left - use, step * 2
        if bits & goal:
            break
    target, chosen = bits.bit_length() - 1, []
    for length, use, before in reversed(layers):
        if not before >> target & 1:
            chosen += [length] * use
            target -= length * use
    return sorted(chosen, reverse=True)


def plan(counts: dict[int, int], capacity: int = CAPACITY, slack: int = 0) -> list[tuple[list[int], int]]:
    """Bins as (lengths, number of such bins) until no length is left. A bin may be
    left with ``slack``: exact fits use up the short lengths that later bins need."""
    counts, out = {k: c for k, c in counts.items() if c > 0}, []
    while counts:
        seed = max(counts)
        counts[seed] -= 1
        bin_ = [seed, *fullest({k: c for k, c in counts.items() if c}, capacity - seed, slack)]
        counts[seed] += 1
        need = {k: bin_.count(k) for k in set(bin_)}
        times = min(counts[k] // u for k, u in need.items())
        for k, u in need.items():
            counts[k] -= u * times
            if not counts[k]:
                del counts[k]
        out.append((bin_, times))
    return out


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """The plan with the fewest bins over the allowed slacks."""
    return min((plan(counts, capacity, s) for s in SLACKS), key=lambda bins: sum(times for _, times in bins))


def places(counts: dict[int, int], bins: list[tuple[list[int], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The plan as intervals over pieces numbered by length: first number, first
    sequence and offset of each interval (one piece per sequence)."""
    at, total = {}, 0
    for length in sorted(counts):
        at[length], total = total, total + counts[length]
    rows, sequence = [], 0
    for bin_, times in bins:
        offset = 0
        for length in bin_:
            rows.append((at[length], sequence, offset))
            at[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its sequence_id and offset.

    Null and empty texts have the end id alone; texts of any length are encoded whole, and
    long runs of white space give the ids that the library gives. Repeated rows are packed each by
    itself; a null doc_id is kept. Extra columns are ignored. An empty table gives
    an empty result. What reaches the driver is one count per length (at most
    ``capacity``)."""
    cut_ = settle(pieces(docs, path or tokenizer_path(), capacity, end_id), "pieces")
    rows = numbered(cut_, "length", "doc_id", "piece", "start", "ids_crc32", name="at")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    first, sequence, offset = places(counts, best_plan(counts, capacity))

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(at: pa.Array) -> pa.Array:
        n = at.to_numpy(zero_copy_only=False)
        i = np.searchsorted(first, n, side="right") - 1
        return pa.StructArray.from_arrays([pa.array(sequence[i] + n - first[i]), pa.array(offset[i])],
                                          ["sequence_id", "offset"])

    return (rows.withColumn("_to", place("at"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "_to.sequence_id", "_to.offset"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
