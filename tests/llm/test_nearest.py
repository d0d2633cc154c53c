"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from almanac.llm import nearest


def brute(ids, x, query, own, k):
    use = ids != own
    score = (x[use] * query).sum(axis=1)
    order = np.lexsort((ids[use], -score))[:k]
    return list(zip(ids[use][order].tolist(), score[order].tolist(), strict=True))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, rank int").repartition(3)
    out = {}
    for r in sorted(nearest.search(df, **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_small_table_is_exact_with_ties(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(60, 4)), 1).astype(np.float32)
    x[30:50] = x[7]  # equal vectors
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x) if v.any()]
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    got = run(spark, rows, k=12, recall=1.0)
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    for q, found in got.items():
        want = brute(ids, m, m[list(ids).index(q)], q, 12)
        assert [f[0] for f in found] == list(range(1, 13))
        assert [f[1] for f in found] == [w[0] for w in want]
        assert [f[2] for f in found] == pytest.approx([w[1] for w in want], abs=1e-12)


def test_recall_on_clusters(spark, monkeypatch):
    monkeypatch.setattr(nearest, "LEAF_ROWS", 40)
    monkeypatch.setattr(nearest, "CELL_MEMBERS", 16)  # several cells per leaf
    monkeypatch.setattr(nearest, "CELL_QUERIES", 3)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(12, 8))
    x = (centre[rng.integers(0, 12, 1500)] + 0.3 * rng.normal(size=(1500, 8))) * rng.uniform(0.5, 2, (1500, 1))
    x = x.astype(np.float32).astype(np.float64)
    got = run(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    ids, hit = np.arange(1500), 0
    for q in range(0, 1500, 20):
        want = {w[0] for w in brute(ids, x, x[q], q, 20)}
        assert len(got[q]) == 20 and len({f[1] for f in got[q]}) == 20
        hit += len(want & {f[1] for f in got[q]})
    assert hit / (20 * 75) >= 0.95


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, [1.0, 2.0, 3.0]), (8, []), (20, [0.0, 2.0]), (40, None), (None, [9.0, 9.0])]
    got = run(spark, rows)
    assert got == {0: [(1, 1, 0.5), (2, 20, 0.0)], 20: [(1, 1, 1.0), (2, 0, 0.0)]}


def test_empty_and_tiny(spark):
    assert run(spark, []) == {}
    assert run(spark, [(20, None)]) == {}
    assert run(spark, [(20, [1.0])]) == {}
    assert run(spark, [(1, [1.0])]) == {}
    assert run(spark, [(20, [1.0]), (20, [2.0]), (3, [4.0])]) == {20: [(1, 3, 4.0)]}


def test_tree_visits_every_leaf_once():
    x = np.random.default_rng(3).normal(size=(500, 5))
    tree = nearest.Tree(x, 20)
    assert sorted(tree.visits(x[0], tree.leaves + 5)) == list(range(tree.leaves))
    assert tree.visits(x[0], 3) == tree.visits(x[0], 10)[:3]
    assert set(tree.leaf_of(x).tolist()) <= set(range(tree.leaves))


def test_small_leaves_do_not_cut_results_short(spark, monkeypatch):
    # groups of copies settle the pooled recall in one visit; rows far from them lie in leaves of few rows
    monkeypatch.setattr(nearest, "LEAF_ROWS", 16)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(20, 8)), 100, axis=0)
    far = np.append(np.arange(3, 2000, 40), [0, 700, 1400])  # three queries of a hundred among them
    x[far] = rng.normal(size=(len(far), 8))
    x /= np.sqrt((x**2).sum(axis=1))[:, None]  # a copy's best products are its copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist())] * 30  # an id's own rows do not count
    got = run(spark, rows)
    assert set(got) == set(range(0, 2000, 20))
    assert {len(found) for found in got.values()} == {20}
    assert all(q not in {f[1] for f in found} for q, found in got.items())


def test_recall_is_calibrated_per_query():
    # nine queries with many neighbours in their first leaf, one in ten with its own in the last
    x = np.random.default_rng(6).normal(size=(400, 5))
    tree = nearest.Tree(nearest.augmented(x, float((x**2).sum(1).max())), 20)
    ids, order = np.arange(10), [tree.visits(q, tree.leaves) for q in nearest.augmented(x[:10], 0.0)]
    truth = [(i, order[i][0]) for i in range(9) for _ in range(20)] + [(9, order[9][-1])]
    assert nearest.calibrated(tree, x[:10], ids, truth, 0.95) == tree.leaves
    assert nearest.calibrated(tree, x[:10], ids, truth, 0.9) == 1


def test_calibration_is_drawn_apart_from_the_sample(spark, monkeypatch):
    class Stop(Exception):
        pass

    fitted, asked, tree = [], [], nearest.Tree

    def calibrated(_, queries, *rest):
        asked.append(queries)
        raise Stop
    monkeypatch.setattr(nearest, "SAMPLE", 200)
    monkeypatch.setattr(nearest, "CALIBRATION", 20)
    monkeypatch.setattr(nearest, "Tree", lambda x, leaf: fitted.append(x) or tree(x, leaf))
    monkeypatch.setattr(nearest, "calibrated", calibrated)
    x = np.random.default_rng(7).normal(size=(1000, 4))
    with pytest.raises(Stop):
        run(spark, [(i, v.tolist()) for i, v in enumerate(x)], step=4)
    known = {tuple(v[:4]) for v in fitted[0].tolist()}
    assert len(asked[0]) > 5 and sum(tuple(q) in known for q in asked[0].tolist()) <= len(asked[0]) / 2


def test_query_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    found, total = 0, 0
    got = {}
    for r in nearest.op8_nearest_neighbours(spark, sf_dir).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for q, v in zip(ids.tolist(), x, strict=True):
        if q % 20 == 0:
            want = {w[0] for w in brute(ids, x, v, q, 20)}
            found, total = found + len(want & got[q]), total + len(want)
    assert found / total >= 0.9


def test_rows_of_one_id_keep_their_own_leaves(spark, monkeypatch):
    """Two far-apart rows of one id: both are candidates, each found in its own leaf."""
    monkeypatch.setattr(nearest, "LEAF_ROWS", 16)
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(4, 0.1, (60, 3)), rng.normal(-4, 0.1, (60, 3))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(500, [4.0, 4.0, 4.2]), (500, [-4.0, -4.0, -4.2])]
    got = run(spark, rows, k=120, recall=1.0)
    for q in (0, 20, 60, 80, 100):
        want = brute(np.array([i for i, _ in rows]), np.array([v for _, v in rows]), x[q], q, 120)
        assert [f[1] for f in got[q]] == [w[0] for w in want] and [f[1] for f in got[q]].count(500) == 2


def test_large_leaves_have_trees_of_their_own(spark, monkeypatch):
    """Few leaves in the outer tree: they are split, and recall holds over both trees."""
    monkeypatch.setattr(nearest, "SAMPLE", 64)
    monkeypatch.setattr(nearest, "LEAF_ROWS", 24)
    monkeypatch.setattr(nearest, "SPLIT_ROWS", 100)
    monkeypatch.setattr(nearest, "SPLIT_SAMPLE", 200)
    monkeypatch.setattr(nearest, "SPLIT_BLOCK", 150)  # several blocks per leaf
    opened = []
    split = nearest._split
    monkeypatch.setattr(nearest, "_split", lambda members, large, *a: opened.append(large) or split(members, large, *a))
    rng = np.random.default_rng(12)
    centre = rng.normal(size=(20, 6))
    x = centre[rng.integers(0, 20, 2400)] + 0.25 * rng.normal(size=(2400, 6))
    x[100:160] = x[40]  # equal vectors
    got = run(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    assert opened and sum(opened[0].values()) > 1200
    ids, hit = np.arange(2400), 0
    for q in range(0, 2400, 20):
        want = brute(ids, x, x[q], q, 20)
        assert [f[0] for f in got[q]] == list(range(1, 21)) and len({f[1] for f in got[q]}) == 20
        hit += len({w[0] for w in want} & {f[1] for f in got[q]})
    assert hit / (20 * 120) >= 0.93
    exact = run(spark, [(i, v.tolist()) for i, v in enumerate(x)], recall=1.0)
    missed = sum([f[1] for f in exact[q]] != [w[0] for w in brute(ids, x, x[q], q, 20)] for q in range(0, 2400, 20))
    assert missed <= 6
