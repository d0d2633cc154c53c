"""The pipeline: each stage against a plain version on its own input."""

import pytest

import corpus_pipeline
from almanac.llm import mixing, packing, quality
from almanac.llm.common import documents, settle
from tests_llm_ngram import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = documents(spark, SF), []
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, docs, SF), f"test-{name}")
        out.append((docs, after))
        docs = after
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "mix_sources", "best_fit_packing"]


def test_columns(stages, spark):
    for _, after in stages[:-1]:
        assert after.columns == documents(spark, SF).columns


def test_quality(stages, spark):
    before, after = stages[0]
    want = {r.doc_id for r in quality.scored(before, documents(spark, SF, "labels")).collect() if r.predicted}
    assert {r.doc_id for r in after.collect()} == want
    good = {r.doc_id for r in documents(spark, SF, "labels").where("quality = 1").collect()}
    bad = {r.doc_id for r in documents(spark, SF, "labels").where("quality = 0").collect()}
    assert len(want & good) > 0.95 * len(good) and len(want & bad) < 0.2 * max(1, len(bad))


def test_near_duplicates(stages):
    before, after = stages[1]
    want = brute([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, _, c in want if d == c)


def test_mix(stages):
    before, after = stages[2]
    rows = before.collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, mixing.targets([sizes[n] for n in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))]), strict=True))
    taken, times = {}, {}
    for r in after.collect():
        taken[r.source] = taken.get(r.source, 0) + len((r.text or "").split())
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    longest = max(len((r.text or "").split()) for r in rows)
    assert all(abs(taken.get(n, 0) - want[n]) <= 2 * longest for n in names)
    assert set(times) <= {r.doc_id for r in rows} and max(times.values()) <= 2


def test_pack(stages):
    before, after = stages[3]
    rows = after.collect()
    assert sum(r.length for r in rows) == sum(r.length for r in packing.pieces(before, packing.tokenizer_path()).collect())
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages[-1][1].count()


def test_empty_documents(spark, tmp_path):
    documents(spark, SF).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    documents(spark, SF, "labels").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def edge_tables(spark, root, labels):
    long = " ".join(f"w{i * i % 7919}" for i in range(60_000))
    plain = "Plain words number {0} stand in a row here. And more follow them, {0} of them in all."
    rows = [(i, plain.format(i), "a" if i % 3 else None) for i in range(60)]
    rows += [(100, None, "a"), (101, "", "b"), (102, " \n", "b"), (103, long, "a"), (104, long, "b"), (105, "a" + " " * 200_000 + "b", "a"),
             (None, "no id stands here at all today", "b"), (5, plain.format(5), "a"), (5, plain.format(5), "a"), (106, "x" * 500_000, None)]
    rows += [(200 + i, "one text that many rows here do share", "b") for i in range(30)]
    docs = spark.createDataFrame([(i, t, "en", s, 7, "clash", 1, 2.5) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars int, component string, copies int, score double")
    docs.repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return rows


@pytest.mark.parametrize("labels", [[(i, 1, 0) for i in range(30)], [(i, int(i % 2), 0) for i in range(60)], [(None, 1, 0), (3, None, 0)]])
def test_edge_rows_in_every_stage(spark, tmp_path, labels):
    rows = edge_tables(spark, str(tmp_path), labels)
    docs = documents(spark, str(tmp_path))
    columns, kept = docs.columns, {t for _, t, _ in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, str(tmp_path)), f"edge-{name}")
        assert docs.columns == columns
        got = docs.collect()
        assert {r.text for r in got} <= kept and {(r.component, r.copies, r.score, r.n_chars) for r in got} <= {("clash", 1, 2.5, 7)}
        kept = {r.text for r in got}
        if name == "quality_classifier":
            assert len([r for r in got if (r.text or "").startswith("Plain")]) >= 0.9 * 62
        if name == "ngram_jaccard_join":
            assert len([r for r in got if r.text and len(r.text) > 100_000]) == len({r.text for r in got if r.text and len(r.text) > 100_000})
            assert len([r for r in got if r.text and r.text.startswith("one text")]) <= 1
    out = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted({r.doc_id for r in out}, key=str) == sorted({r.doc_id for r in got}, key=str)
    ends = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length


def test_a_model_that_rejects_all(spark, tmp_path, monkeypatch):
    import numpy as np
    edge_tables(spark, str(tmp_path), [(i, 1, 0) for i in range(30)])
    monkeypatch.setattr(quality.Model, "score", lambda self, x: np.zeros(len(x)))
    monkeypatch.setattr(quality, "THRESHOLD", 1.5)
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
