"""Mixing sources to target weights by systematic sampling.

Each source has a target in words. A document's expected copies are its source's
rate (target / size of the source); their prefix sum within the source, shifted
by one random offset, is cut at the integers, and the document is emitted once
for each integer crossed. Documents stand in order of size within the source, so
any stretch of sizes gets its share and the words taken stay within about one
document of the target.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import documents, numbered, settle

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2.0
SEED = 17


def targets(sizes: list[int], weights: list[float], share: float = SHARE,
            most: float = MOST_REPEATS) -> list[float]:
    """``share`` of all sizes split by weight; a target above ``most`` times its
    source's size stops there and the excess is shared by weight among the rest,
    until none is above."""
    left, out = share * sum(sizes), [0.0] * len(sizes)
    open_ = [i for i in range(len(sizes)) if weights[i] > 0]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
        left = max(left, 0.0)
    return out


def offset(source: str | None, seed: int) -> float:
    """The source's random offset in [0, 1)."""
    name = b"\0" if source is None else b"\1" + source.encode()
    return zlib.crc32(name, zlib.crc32(str(seed).encode())) / 2**32


def word_count(text: Column) -> Column:
    """Number of maximal runs other than space and 0x09-0x0D; 0 for null and empty texts.
    Texts of any length are counted whole."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mixed(docs: DataFrame, size: Column, source: Column, tie: tuple[Column, ...],
          weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS,
          seed: int = SEED) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``words`` (its size), ``source_size``, ``target`` and
    ``copies`` (times that the mix takes the row).

    Sources take ``weights`` in turn, in code-point order, the null source last;
    there is one weight and so one driver-side row per source. A null size counts
    as 0; rows of size 0 are copied at their source's rate like others, a source of
    size 0 not at all. Repeated rows each count as a document. ``tie`` orders rows
    of equal size. An empty table gives an empty result. Reruns agree."""
    spark = docs.sparkSession
    keyed = docs.select(F.struct("*").alias("row"), source.cast("string").alias("src"),
                        F.coalesce(size.cast("long"), F.lit(0)).alias("words"),
                        *[c.alias(f"tie{i}") for i, c in enumerate(tie)])
    ties = [f"tie{i}" for i in range(len(tie))]
    rows = numbered(keyed, F.col("src").asc_nulls_last(), F.col("words"), *ties, name="at")
    found = rows.groupBy("src").agg(F.sum("words").alias("words"), F.min("at").alias("first")).collect()
    found = sorted(found, key=lambda r: (r.src is None, r.src or ""))
    wanted = targets([r.words for r in found], [weights[i % len(weights)] for i in range(len(found))], share, most)
    plan = spark.createDataFrame(
        [(r.src, r.words, r.first, t, t / r.words if r.words else 0.0, offset(r.src, seed))
         for r, t in zip(found, wanted, strict=True)],
        "src string, source_size long, first long, target double, rate double, shift double").withColumnRenamed("src", "s")
    at = (F.col("at") - F.col("first")).cast("double")
    crossed = F.floor((at + 1) * F.col("rate") + F.col("shift")) - F.floor(at * F.col("rate") + F.col("shift"))
    # a row per source, which the driver holds anyway; a shuffle would move the texts again
    return (rows.join(F.broadcast(plan), F.col("src").eqNullSafe(F.col("s")))
            .select("row", "words", "source_size", "target", crossed.cast("long").alias("copies")))


def emitted(mix: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns of the input."""
    return (mix.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("row.*"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    # settled: the sort by range looks at its input twice, and the texts are read once
    docs = settle(documents(spark, sf_dir).select("doc_id", "source", word_count(F.col("text").cast("string")).alias("size"),
                                                  F.xxhash64("text").alias("text_hash")), "mix-sizes")
    mix = mixed(docs, F.col("size"), F.col("source"), (F.col("doc_id"), F.col("text_hash")))
    return mix.select("row.doc_id", "row.size", "source_size", "target",
                      (F.col("copies") * F.col("words")).alias("taken"), "copies", "row.source")
