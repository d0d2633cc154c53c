"""N-gram Jaccard join against a brute force over Python sets."""

import pytest

from almanac.llm import ngram_join, text_arrays
from tests_llm_ngram import brute, planted, shingles, thue_morse


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows],
                                 "doc_id long, text string, component_id int, n string")
    near = ngram_join.near_duplicates(docs.repartition(3))
    return sorted(tuple(r) for r in near.select("doc_id", "n_shingles", "component_id").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 7)  # several blocks per hub
    rows = planted(seed)
    assert run(spark, rows) == brute(rows)


def test_edge_rows(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (1, ""), (1, None), (7, "a b c d e f")]
    assert run(spark, rows) == [(1, 0, 1), (1, 0, 1), (3, 2, 3), (3, 2, 3), (7, 2, 3)]


def test_words_that_fool_a_polynomial_hash(spark):
    rows = [(1, thue_morse(1024)), (2, thue_morse(1024, turned=True)), (3, f"a b c d {thue_morse(2048)}"),
            (4, f"a b c d {thue_morse(2048, turned=True)}"), (5, f"A b c d {thue_morse(2048)}")]
    assert run(spark, rows) == brute(rows) == [(1, 1, 1), (2, 1, 2), (3, 1, 3), (4, 1, 4), (5, 1, 3)]


def test_long_texts_and_hot_copies(spark, monkeypatch):
    """Texts of several chunks, and copies beyond the bound of a shuffled join."""
    from almanac.llm import common
    monkeypatch.setattr(common, "HEAVY_ROWS", 20)
    monkeypatch.setattr(ngram_join, "CHUNK_ENTRIES", 5_000)
    long = " ".join(f"w{i * i % 7919}" for i in range(30_000))
    rows = planted(5) + [(1000, long), (1001, long + " tail"), (1002, long[:len(long) // 2]), (1003, "x" * 300_000), (1004, "x" * 300_000)]
    rows += [(2000 + i, "one text that stands here often enough") for i in range(60)] + [(3000 + i, None) for i in range(40)]
    assert run(spark, rows) == brute(rows)


def test_blocks_follow_the_text(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_COLUMNS", 1)
    rows = planted(6)
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_overlaps_in_strips(monkeypatch):
    import numpy as np
    monkeypatch.setattr(ngram_join, "STRIP", 3)
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 40, 20)) for _ in range(9)]
    got = ngram_join.overlaps(sets[:4], sets[4:])
    assert got.tolist() == [[len(set(a) & set(b)) for b in sets[4:]] for a in sets[:4]]


def test_sets_equal_python_sets():
    import numpy as np
    import pyarrow as pa
    texts = [t for _, t in planted(3)]
    values, off = text_arrays.shingle_sets(pa.array(texts))
    assert np.diff(off).tolist() == [len(shingles(t)) for t in texts]


def test_one_of_each(spark):
    rows = [(3, "a b c d e f", "x"), (3, "a b c d e f", "y"), (9, "A b c d e  f", "z"), (1, "", "x"), (1, None, "x"), (1, "", "x"),
            (3, "other words stand here now", "x"), (None, "p q r", "x"), (5, "p q r", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    got = sorted((tuple(r)[:2] for r in ngram_join.one_of_each(docs).collect()), key=str)
    assert got == sorted([(3, "a b c d e f"), (1, ""), (1, None), (3, "other words stand here now"), (None, "p q r")], key=str)
