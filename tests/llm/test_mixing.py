"""Mixing: targets against a plain recomputation, copies against the prefix sums."""

import re

import pytest

from almanac.llm import mixing
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights, share=1.5, most=2.0):
    """Pour the whole share out by weight; what runs over is poured again."""
    out, pour = [0.0] * len(sizes), share * sum(sizes)
    while pour > 1e-9:
        free = [i for i in range(len(sizes)) if out[i] < most * sizes[i] - 1e-9]
        if not free:
            break
        total, over = sum(weights[i] for i in free), 0.0
        for i in free:
            out[i] += pour * weights[i] / total
            over += max(0.0, out[i] - most * sizes[i])
            out[i] = min(out[i], most * sizes[i])
        pour = over
    return out


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1, 1000, 1000], [100, 1, 1], [0, 5, 9, 4], [7], [0], []])
def test_targets(sizes):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    assert mixing.targets(sizes, weights) == pytest.approx(plain_targets(sizes, weights))


def mix(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, copies string, row int").repartition(parts)
    out = mixing.mixed(docs, F.col("size"), F.col("source"), (F.col("doc_id"),)).collect()
    return sorted((r.row.source or "~", r.words, r.row.doc_id or -1, r.target, r.copies) for r in out)


def test_mix(spark):
    rows = [(i, "abc"[i * i % 3], (i * 7919) % 400, "x", 1) for i in range(600)]
    rows += [(1000 + i, None, 30, "x", 1) for i in range(50)] + [(None, "b", None, "x", 1), (5, "c", 3, "x", 1), (5, "c", 3, "x", 1)]
    got = mix(spark, rows)
    assert len(got) == len(rows)
    names = ["a", "b", "c", "~"]
    sizes = [sum(s or 0 for _, n, s, _, _ in rows if (n or "~") == k) for k in names]
    names, sizes = zip(*[(n, s) for n, s in zip(names, sizes, strict=True) if any((r[1] or "~") == n for r in rows)], strict=True)
    want = plain_targets(list(sizes), [mixing.WEIGHTS[i % 3] for i in range(len(sizes))])
    for name, size, target in zip(names, sizes, want, strict=True):
        own = [r for r in got if r[0] == name]
        assert own[0][3] == pytest.approx(target)
        taken = sum(r[1] * r[4] for r in own)
        assert abs(taken - target) <= 2 * max(r[1] for r in own)
        # systematic sampling over the rows in order of size
        rate, shift = target / size, mixing.offset(None if name == "~" else name, mixing.SEED)
        assert [r[4] for r in own] == [int((i + 1) * rate + shift) - int(i * rate + shift) for i in range(len(own))]
    assert all(r[4] <= 2 for r in got)
    assert mix(spark, rows, 7) == got


def test_emitted_and_empty(spark):
    docs = spark.createDataFrame([(1, "a", 10, "x")] * 4, "doc_id long, source string, size long, copies string")
    out = mixing.mixed(docs, F.col("size"), F.col("source"), (F.col("doc_id"),))
    assert mixing.emitted(out).columns == docs.columns
    assert mixing.emitted(out).count() == sum(r.copies for r in out.collect()) == 6
    none = mixing.mixed(docs.limit(0), F.col("size"), F.col("source"), (F.col("doc_id"),))
    assert none.collect() == [] and mixing.emitted(none).collect() == []


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = mixing.op7_mix_sources(spark, sf_dir).collect()
    assert {r.doc_id: r.size for r in got} == {r.doc_id: len(WORD.findall(r.text)) for r in docs}
    assert all(r.taken <= 2 * r.size for r in got)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        assert rows[0].source_size == sum(r.size for r in rows)
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 2 * max(r.size for r in rows)


def test_word_count(spark):
    texts = [None, "", " \t\n\x0b\x0c\r", "a", " a  b\nc ", "é\u3000ü \U0001f600", "x" * 300_000, "w " * 200_000, "\x00 \x1c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.n for r in df.select("i", mixing.word_count(df.text).alias("n")).collect()}
    assert got == {i: len([w for w in __import__("re").split("[\x20\x09-\x0d]+", t or "") if w]) for i, t in enumerate(texts)}
