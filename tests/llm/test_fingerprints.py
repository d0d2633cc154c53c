"""MinHash fingerprints against plain Python, classes against brute force."""

import hashlib

import numpy as np
import pyarrow as pa

from almanac.llm import fingerprints, text_arrays
from tests_llm_ngram import brute, planted, thue_morse


def plain_signature(text):
    values, off = text_arrays.shingle_hashes(*text_arrays.word_hashes(*text_arrays.utf8(pa.array([text]))))
    xs = [int(v) >> 32 for v in values]
    if not xs:
        return "ffff" * fingerprints.PERMUTATIONS
    out = []
    for a, b in zip(fingerprints._A.tolist(), fingerprints._B.tolist(), strict=True):
        low = min(((a * x + b) % 2**64) >> 32 for x in xs)
        out.append(f"{int(text_arrays.mix64(np.array([low], np.uint64))[0]) >> 48:04x}")
    return "".join(out)


def plain(rows):
    """doc_id -> what each row should have, in descending order of doc_id."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        n = len(t) // 3
        edited = t[:len(t) - n] + nxt[:n]
        a, b, c = plain_signature(t), plain_signature(edited), plain_signature(nxt)
        like = lambda x, y: sum(x[j:j + 4] == y[j:j + 4] for j in range(0, len(x), 4)) / fingerprints.PERMUTATIONS
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, like(a, b), like(a, c)))
    return sorted(out, key=str)


def run(spark, rows, parts=3):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, shard string").repartition(parts)
    return sorted((tuple(r) for r in fingerprints.compared(docs).collect()), key=str)


def test_compared(spark):
    rows = [(i * 3, t) for i, t in planted(5)[:90]] + [(None, "the last one in order " * 5)]
    got = run(spark, rows)
    assert got == plain(rows)
    by_text = {}
    for (i, t), r in zip(sorted(rows, key=str), sorted(got, key=str), strict=False):
        by_text.setdefault(t or "", set())
    docs = {i: t or "" for i, t in rows}
    for r in got:
        by_text[docs[r[0]]].add(r[3])
    assert all(len(x) == 1 for x in by_text.values())


def test_small_tables(spark):
    one = [(4, "a b c d e f g h i j k l")]
    assert run(spark, one, 1) == plain(one)
    assert run(spark, [], 1) == []
    same = [(1, "p q r s t u v w")] * 4
    assert run(spark, same) == plain(same)
    empty = [(1, ""), (2, None)]
    assert [r[5:] for r in run(spark, empty)] == [(1.0, 1.0)] * 2


def test_likeness_estimates_jaccard():
    words = [f"w{i}" for i in range(400)]
    a, b = " ".join(words), " ".join(words[:300] + [f"v{i}" for i in range(100)])
    s = fingerprints.signatures(pa.array([a, b]))
    exact = 296 / (396 * 2 - 296)
    assert abs(fingerprints.likeness(s[:1], s[1:])[0] - exact) < 0.15


def test_near_classes(spark):
    rows = planted(6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in fingerprints.near_classes(docs).collect())
    want = [(d, c) for d, _, c in brute(rows)]
    agree = sum(g == w for g, w in zip(got, want, strict=True)) / len(want)
    assert agree > 0.97  # banding finds nearly all links at 0.75, and none below
    whole = {d: c for d, c in want}
    assert all(whole[d] == whole[c] for d, c in got)
    assert fingerprints.near_classes(docs.limit(0)).collect() == []


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: r for r in fingerprints.op5_minhash_fingerprints(spark, sf_dir).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        edited = t[:len(t) - len(t) // 3] + nxt[:len(t) // 3]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(t)
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.9


def test_words_that_fool_a_polynomial_hash():
    a, b = fingerprints.signatures(pa.array([thue_morse(1024), thue_morse(1024, turned=True)]))
    assert (a == b).mean() < 0.1


def test_long_texts(spark):
    long = " ".join(f"w{i * i % 7919}" for i in range(20_000))
    rows = [(1, long), (2, long + " é"), (3, "y" * 700_000), (4, None)]
    assert run(spark, rows) == plain(rows)
