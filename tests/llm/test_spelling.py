"""Spelling variants against brute force over the vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from almanac.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int"


def brute_words(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = brute_words(rows)
    form, many = {}, {}
    for w in n:
        found = sorted((-n[v], v) for v in n if v != w and near(w, v))
        many[w] = len(found)
        form[w] = found[0][1] if found and -found[0][0] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], many[w], n[form[w]] if form[w] else None))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "clash", 7) for d, t in rows], SCHEMA).repartition(3)
    got = spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(got) == len({r.word for r in got})
    return {tuple(r) for r in got}


def dense(seed, letters="abé", words=400):
    rng = random.Random(seed)
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(60)]
    return [(i, " ".join(rng.choice(pool) for _ in range(words // 10))) for i in range(60)]


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_vocabulary(spark, seed):
    rows = dense(seed)
    assert run(spark, rows) == brute(rows)


def test_shared_halves_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELL_WORDS", 20)
    monkeypatch.setattr(spelling, "HALF_WORDS", 3)
    rows = dense(3)
    assert run(spark, rows) == brute(rows)


def test_chain_of_forms(spark):
    text = " ".join(["kitten"] * 3 + ["kittenx"] * 6 + ["kittexx"] * 12 + ["kxttexx"] * 24 + ["kxttxxx"] * 48 + ["Kxxtxxx"] * 96)
    rows = [(i, text) for i in range(3)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[0]: r[2] for r in got}["kitten"] == "kxxtxxx"


def test_empty_null_long_and_repeated(spark):
    assert run(spark, []) == set()
    assert run(spark, [(1, None), (2, ""), (None, " 12 ,"), (3, "one two six")]) == set()
    long = "a" * 20_000
    rows = [(None, f"{long} {long}b caféé Caféé CAFéé ÀÉÎÕÜ àéîõü"), (5, f"{long} {long}b {long}c " * 3)] * 3 + [(7, "x " * 100_000 + "words wards words")] * 2
    assert run(spark, rows) == brute_words_only(rows)


def brute_words_only(rows):
    """As ``brute``, without comparing the very long words pair by pair."""
    n = brute_words(rows)
    short = brute([(d, re.sub("[abc]{1000,}", "", t)) for d, t in rows])
    long = sorted(w for w in n if len(w) > 1000)
    assert long
    out = set(short)
    for w in long:
        found = sorted((-n[v], v) for v in long if v != w and (
            (len(v) == len(w) and v[:-1] == w[:-1]) or (abs(len(v) - len(w)) == 1 and min(v, w, key=len) in (max(v, w, key=len)[:-1], max(v, w, key=len)[1:]))))
        taken = bool(found) and -found[0][0] >= 2 * n[w]
        form = found[0][1] if taken else None
        out.add((w, form, form or w, n[w], len(found), n[form] if taken else None))
    return out


def test_suffix_order():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 300):
        text = rng.integers(0, 3, size).astype(np.uint8)
        raw = text.tobytes()
        assert spelling.suffix_array(text).tolist() == sorted(range(size), key=lambda i: raw[i:])


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {tuple(r) for r in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute([(r.doc_id, r.text) for r in df.collect()])
