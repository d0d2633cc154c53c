"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from almanac.llm import vector_dedup as V

DDL = "vec_id long, embedding array<{}>, label int, hub long, v string"


def brute(rows, cosine=0.93):
    """vec_id, n_links, component_id per row, over all pairs."""
    n = len(rows)
    root = list(range(n))

    def top(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    usable = [r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(c is not None and np.isfinite(c) for c in r[1]) and any(r[1]) for r in rows]
    links = [0] * n
    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1]), np.array(rows[j][1])
                if a.tobytes() == b.tobytes() or (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    root[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(r[0], least.get(top(i), r[0]))
    return sorted(((r[0], links[i], least.get(top(i))) for i, r in enumerate(rows)), key=str)


def run(spark, rows, kind="double"):
    df = spark.createDataFrame([(i, v, lab, 5, "clash") for i, v, lab in rows], DDL.format(kind)).repartition(3)
    got = V.near_duplicates(df).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


def clouds(seed, dim, groups):
    """Vectors around centres: (number, spread) per group, and some without likeness."""
    rng = np.random.default_rng(seed)
    out = []
    for size, spread in groups:
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        out += list(centre + spread * rng.normal(size=(size, dim)) / np.sqrt(dim))
    out += list(rng.normal(size=(60, dim)))
    order = rng.permutation(len(out))
    return [(int(i), [float(c) for c in out[i]], 1 + (int(i) % 7 == 0)) for i in order]


@pytest.mark.parametrize(("seed", "spread"), [(1, 0.1), (2, 0.25), (3, 0.3)])
def test_groups(spark, seed, spread):
    """Tight groups link throughout; at a spread of 0.25 and more cosines straddle the threshold."""
    rows = clouds(seed, 32, [(80, spread), (40, spread), (5, spread)])
    got, want = run(spark, rows), brute(rows)
    if spread < 0.2:
        assert got == want
    most = sum(w[1] for w in want)
    assert most and 0.98 * most <= sum(g[1] for g in got) <= most
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[2] == w[2] for g, w in zip(got, want, strict=True)) >= 0.98 * len(rows)


def test_small_blocks(spark, monkeypatch):
    """Many blocks, primaries of their own and several tasks change nothing."""
    rows = clouds(4, 16, [(70, 0.28), (60, 0.12), (30, 0.35)])
    whole = run(spark, rows)
    monkeypatch.setattr(V, "BLOCK", 6)
    monkeypatch.setattr(V, "TASK_ROWS", 20)
    assert run(spark, rows) == whole


def test_copies_and_scaled_vectors(spark, monkeypatch):
    from almanac.llm import common
    monkeypatch.setattr(common, "HEAVY_ROWS", 10)
    x = [0.3, -0.5, 0.25, 1.0]
    rows = [(i, x, 1) for i in range(10, 60)] + [(5, [2 * c for c in x], 1), (6, x, 2), (7, x, None), (7, x, 1), (7, [-c for c in x], 1), (None, x, 2)]
    assert run(spark, rows) == brute(rows)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 0.0], None),
            (8, [1.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1), (10, [1.0, -0.0], 1), (11, [1.0], 1), (12, [3.0], 1), (13, [-3.0], 1), (None, [0.0], 1), (None, [1.0, 0.1], 1)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, "float")[0][1] == brute(rows)[0][1]
    assert run(spark, []) == [] and run(spark, rows[:3]) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_hadamard_keeps_lengths():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(20, 16))
    y = V.rotated(x, rng.choice([-1.0, 1.0], size=(3, 16)))
    assert np.allclose(x @ x.T, y @ y.T) and not np.allclose(x, y)


def test_tables_follow_the_simulation():
    few, many = V.chosen(64, 100), V.chosen(64, 100_000)
    assert few.size < many.size
    for h in (few, many):
        assert 1 - (1 - V.met(64, h.size)[h.probes]) ** h.tables >= V.RECALL - 1e-9
        assert h.codes(np.eye(64)[:3]).shape == (3, h.tables, 1 + h.probes)
    assert 100_000 * many.tables * (1 + many.probes) ** 2 / 128.0**many.size <= V.CHANCE


def test_given_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in V.near_duplicates(df).collect()), key=str)
    assert got == brute(rows)
