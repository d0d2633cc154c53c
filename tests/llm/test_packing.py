"""Best-fit packing: ids against the ``tokenizers`` library, bins against brute force."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest

from almanac.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.tokenizer_path())


def test_ids_equal_the_tokenizers_library(reference):
    rng = random.Random(4)
    alphabet = "abcdeABC  \n\t.,!'’019éüñß中文日本😀‍ 　 ǅ²½Ⅷ٣ा́\x00\x1c\x85"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += ["", " ", "   ", "a<|endoftext|>b", "<|endoftext|>", "I'm you'll  don't", "x" * 3000, " " * 3000, "\n" * 50 + "a"]
    enc = packing.encoder(packing.tokenizer_path())
    for t in texts:
        assert enc.encode_to_numpy(t, allowed_special="all").tolist() == reference.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("text", ["a" + " " * 1_000_000 + "b", "\n" * 1_000_000, "x" * 1_000_000, " \u3000" * 200_000 + "<|endoftext|> end"])
def test_megabytes_of_one_character(reference, text):
    assert packing.token_ids(packing.tokenizer_path(), text).tolist() == reference.encode(text, add_special_tokens=False).ids


def test_very_long_texts_are_packed(spark, reference):
    rows = [(1, "a" + " " * 1_000_000 + "b"), (2, "word " * 100_000), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.packed(docs).collect()
    for doc, text in rows:
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        mine = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.piece)
        assert sum(r.length for r in mine) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in mine)


def test_ids_of_every_character(reference):
    enc = packing.encoder(packing.tokenizer_path())
    points = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{c}1{c} {c}{c}" for c in points[i:i + 256]) for i in range(0, len(points), 256)]
    wanted = reference.encode_batch(texts, add_special_tokens=False)
    for t, w in zip(texts, wanted, strict=True):
        assert enc.encode(t, allowed_special="all") == w.ids


@pytest.mark.parametrize("seed", range(30))
def test_fullest_is_the_best_subset(seed):
    rng = random.Random(seed)
    items = [rng.randrange(1, 30) for _ in range(9)]
    room = rng.randrange(0, 80)
    counts = {k: items.count(k) for k in items}
    best = max(sum(c) for n in range(10) for c in combinations(items, n) if sum(c) <= room)
    got = packing.fullest(counts, room)
    assert sum(got) == best
    assert all(got.count(k) <= counts[k] for k in set(got))


def test_plan_uses_every_piece_once():
    rng = random.Random(0)
    counts = {rng.randrange(1, 1025): rng.randrange(1, 10**6) for _ in range(500)}
    bins = packing.best_plan(counts, 1024)
    used = {}
    for lengths, times in bins:
        assert 0 < sum(lengths) <= 1024
        for k in lengths:
            used[k] = used.get(k, 0) + times
    assert used == counts
    total, least = sum(t for _, t in bins), -(-sum(k * c for k, c in counts.items()) // 1024)
    assert least <= total <= 1.2 * least


@pytest.mark.parametrize("seed", range(10))
def test_slack_is_kept(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 60): rng.randrange(1, 4) for _ in range(8)}
    for room in (0, 3, 40, 100):
        best = sum(packing.fullest(counts, room))
        assert best >= sum(packing.fullest(counts, room, 5)) >= min(best, room - 5)


def test_cut():
    assert packing.cut(5, 4) == [0, 1]
    assert packing.cut(8, 4) == [0, 4]
    assert packing.cut(3, 4) == [0]
    assert packing.cut(10, 4) == [0, 2, 6]


def check(rows, reference, texts, capacity):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc, text in texts.items():
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 2]
        got = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(len(got)))
        starts = packing.cut(len(ids), capacity)
        assert [r.start for r in got] == starts
        for r in got:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
        assert sum(r.length for r in got) == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity


def test_packed(spark, reference):
    rng = random.Random(2)
    texts = {i: " ".join(rng.choice(["alpha", "be", "gam", "é"]) for _ in range(rng.choice([0, 1, 5, 20, 90])))
             for i in range(120)} | {200: None, 201: ""}
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in texts.items()],
                                 "doc_id long, text string, length int, sequence_id int").repartition(4)
    rows = packing.packed(docs, capacity=32).collect()
    check(rows, reference, texts, 32)


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b")] * 5 + [(None, "a b")], "doc_id long, text string")
    rows = packing.packed(docs, capacity=8).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1"] * 5 + ["None"]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 6


def test_empty_table(spark):
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark, sf_dir, reference):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = packing.op1_best_fit_packing(spark, sf_dir).collect()
    check(rows, reference, texts, 1024)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= 1.01 * (total / 1024) + 1
