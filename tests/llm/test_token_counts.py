"""Rank-synchronous counts against the sentencepiece library."""

import random

import numpy as np
import pytest

from almanac.llm import token_counts
from tests_llm_ngram import thue_morse

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_equal_to_the_library(library):
    rng = random.Random(1)
    alphabet = "abcdefghij  ▁\n\tABC0189.,!-éüñ中文日本ﬁａ\x00😀<s></s>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["", " ", "  ", " " * 50, "a" * 500, "a" * 3000, "abcab" * 1000, " " * 5000, "<s> x </s>", "▁▁▁▁▁a", "<0x0A><unk>",
              "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8000)), "the quick brown fox " * 300]
    got = token_counts.counts_of(token_counts.merges(PATH), texts, {})
    assert got.tolist() == [len(x) for x in library.encode(texts)]


def test_long_and_short_ways_agree(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdeort") for _ in range(rng.randrange(1, 200))) for _ in range(300)]
    model = token_counts.merges(PATH)
    whole = token_counts.counts_of(model, texts, {})
    monkeypatch.setattr(token_counts, "LONG", 3)
    assert np.array_equal(whole, token_counts.counts_of(model, texts, {}))


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO", 5)
    memo = {}
    model = token_counts.merges(PATH)
    for i in range(20):
        token_counts.counts_of(model, [f"word{i} other{i}"], memo)
    assert len(memo) <= 5


def test_edges(spark, library):
    rows = [(1, "a b", 5), (1, "a b", 5), (2, None, 5), (3, "", 5), (None, "x" * 10000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, limit=100).collect()), key=str)
    want = sorted(((d, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 100) for d, t, _ in rows), key=str)
    assert got == want
    assert token_counts.token_counts(docs.limit(0)).collect() == []


def test_query(spark, sf_dir, library):
    want = {r.doc_id: (len(r.text.encode()), len(library.encode(r.text)))
            for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.op9_token_counts(spark, sf_dir).collect()}
    assert got == want


def test_words_that_fool_a_polynomial_hash(library):
    texts = [thue_morse(2048, "in"), thue_morse(2048, "in", turned=True), thue_morse(1000, "in"), thue_morse(1000, "in", turned=True)]
    memo = {}
    for t in texts:  # one after the other, through the memo
        assert token_counts.counts_of(token_counts.merges(PATH), [t], memo).tolist() == [len(library.encode(t))]
    assert token_counts.counts_of(token_counts.merges(PATH), texts, memo).tolist() == [len(x) for x in library.encode(texts)]


def test_equal_hashes_are_told_apart(library, monkeypatch):
    monkeypatch.setattr(token_counts.ta, "span_hashes", lambda data, starts, ends: (ends - starts) % 3)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdet") for _ in range(rng.randrange(1, 9))) for _ in range(30)) for _ in range(40)]
    assert token_counts.counts_of(token_counts.merges(PATH), texts, {}).tolist() == [len(x) for x in library.encode(texts)]
