"""Quality classifier: held-out accuracy, fold discipline, edge rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from almanac.llm import quality
from tests_llm_ngram import thue_morse


def scores(spark, sf_dir, labels=None):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet") if labels is None else labels
    return {r.doc_id: r for r in quality.scored(docs, labels).collect()}


@pytest.fixture(scope="module")
def got(spark):
    return scores(spark, "/root/testdata/sf0.01")


def test_held_out_accuracy(spark, got):
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    held = [r for r in marks if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out for r in held)
    assert np.mean([got[r.doc_id].predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_held_out_labels_teach_nothing(spark, got):
    from pyspark.sql import functions as F
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = scores(spark, "/root/testdata/sf0.01", turned)
    assert all(again[i].score == r.score for i, r in got.items())


def test_edges(spark):
    docs = spark.createDataFrame(
        [(i, f"Plain words number {i} stand in a row here. And more follow them." if i % 3 else "JUNK!! JUNK!! " * 9, "x") for i in range(60)]
        + [(100, None, "x"), (101, "", "x"), (102, " \n", "x"), (103, "w" * 200_000, "x"), (None, "a b", "x"), (1, "again", "x")],
        "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(30)] + [(None, 1, 0), (3, None, 0), (999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.scored(docs, labels).collect()
    assert len(rows) == 66 and all(0 <= r.score <= 1 for r in rows)
    assert not next(r for r in rows if r.doc_id is None).held_out
    blank = {r.score for r in rows if r.doc_id in (100, 101)}
    assert len(blank) == 1
    assert quality.scored(docs.limit(0), labels).collect() == []
    assert {r.score for r in quality.scored(docs, labels.limit(0)).collect()} == {0.5}


def test_one_row_of_a_repeated_id_teaches(spark):
    docs = spark.createDataFrame([(i % 7 if i > 20 else i, f"text number {i}") for i in range(60)], "doc_id long, text string")
    rows = quality.prepared(docs, spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int"))
    taught = [i for i in range(10) if zlib.crc32(str(i).encode()) % 5 != 0]
    assert quality._taught(rows).good.tolist() == [bool(i % 2) for i in taught]
    u, n, half = quality._cells(rows.where("quality is null"))(lambda x: x, np.zeros((len(quality.FEATURES), quality.PLANES)), np.zeros(quality.PLANES))
    assert n.sum() == 60 - rows.where("quality is not null").count() and len(n) == len(half) == len(u) <= 2


def test_labels_without_signal(spark):
    """Marks that the text does not explain: scores near the marks' share, nothing rejected."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(500)]
    for docs_n, labelled in ((1500, 600), (120, 60)):
        docs = spark.createDataFrame([(i, " ".join(rng.choice(words, rng.integers(5, 120)))) for i in range(docs_n)], "doc_id long, text string")
        labels = spark.createDataFrame([(i, int(rng.random() < 0.76)) for i in range(labelled)], "doc_id long, quality int")
        got = np.array([r.score for r in quality.scored(docs, labels).collect()])
        assert (got >= 0.3).mean() > 0.98 and abs(got.mean() - 0.76) < 0.15


def test_a_held_out_label_is_not_even_seen(spark, got):
    from pyspark.sql import functions as F
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    again = scores(spark, "/root/testdata/sf0.01", labels.where(~quality.held_out(F.col("doc_id"))))
    assert all(again[i].score == r.score for i, r in got.items())


def plain_risk(zp, zu, weights, prior):
    """The non-negative risk, row by row."""
    s = lambda z: 1 / (1 + np.exp(-z))
    positive = sum(1 - s(z) for z in zp) / len(zp)
    negative = sum(w * s(z) for w, z in zip(weights, zu, strict=True)) / sum(weights) - prior * sum(s(z) for z in zp) / len(zp)
    return prior * positive, negative


@pytest.mark.parametrize("shift", [-1.0, 2.5])
def test_risk_and_its_gradient(shift):
    rng = np.random.default_rng(4)
    zp, zu, n = rng.normal(shift, 1, 30), rng.normal(0, 1, 40), rng.integers(1, 9, 40).astype(float)
    share, prior = n / n.sum(), 0.7
    assert quality.risk(zp, zu, share, prior) == pytest.approx(plain_risk(zp, zu, n, prior))
    repeated = np.repeat(zu, n.astype(int))
    assert quality.risk(zp, zu, share, prior) == pytest.approx(plain_risk(zp, repeated, np.ones(len(repeated)), prior))
    below = plain_risk(zp, zu, n, prior)[1] < 0
    assert below == (shift > 0)  # both branches are met

    def value(zp, zu):  # what a step goes down: both parts, or back up on the negatives' part
        positive, negative = plain_risk(zp, zu, n, prior)
        return -negative if below else positive + negative

    got, eps = quality.pull_of(share, prior)(zp, zu), 1e-6
    for i in range(len(zp)):
        a, b = zp.copy(), zp.copy()
        a[i], b[i] = a[i] + eps, b[i] - eps
        assert got[i] == pytest.approx((value(a, zu) - value(b, zu)) / 2 / eps, abs=1e-7)
    for i in range(len(zu)):
        a, b = zu.copy(), zu.copy()
        a[i], b[i] = a[i] + eps, b[i] - eps
        assert got[len(zp) + i] == pytest.approx((value(zp, a) - value(zp, b)) / 2 / eps, abs=1e-7)


def test_passes_against_whole_arrays(spark):
    """Cells and bins against the same from all rows at once."""
    rng = np.random.default_rng(6)
    x, half = rng.normal(size=(500, len(quality.FEATURES))), rng.integers(0, 2, 500)
    free = spark.createDataFrame([(int(h), bytearray(v.tobytes())) for h, v in zip(half, x, strict=True)], "half int, x binary").repartition(4)
    planes, heights = rng.normal(size=(len(quality.FEATURES), quality.PLANES)), np.zeros(quality.PLANES)
    u, n, uh = quality._cells(free)(lambda v: v, planes, heights)
    code = [(h, *(v @ planes > 0)) for h, v in zip(half, x, strict=True)]
    assert sorted(n) == sorted(np.unique(code, axis=0, return_counts=True)[1])
    assert np.allclose((u * n[:, None]).sum(0), x.sum(0), atol=1e-4) and [n[uh == h].sum() for h in (0, 1)] == [(half == h).sum() for h in (0, 1)]
    weights = lambda: [rng.normal(size=(len(quality.FEATURES), 3)), np.zeros(3), rng.normal(size=(3, 1)), np.zeros(1)]
    models = [quality.Model(np.zeros(len(quality.FEATURES)), np.ones(len(quality.FEATURES)), weights(), 0.5) for _ in range(2)]
    z = np.where(half == 0, models[1].margin(x), models[0].margin(x))
    cuts = np.array([-1.0, 0.0, 0.5])
    assert quality._bins(free)(models, cuts).tolist() == [(z < -1).sum(), ((z >= -1) & (z < 0)).sum(), ((z >= 0) & (z < 0.5)).sum(), (z >= 0.5).sum()]


@pytest.mark.parametrize("kept", ["quality >= 0", "quality = 0"])
def test_every_document_labelled(spark, kept):
    # no unlabelled text, or bad marks alone beside few unlabelled ones: still no constant score
    docs = spark.createDataFrame([(i, f"Plain words number {i} stand in a row here. And more follow them." if i % 3 else
                                   f"JUNK!! {i} JUNK!! " * 9) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int").where(kept)
    got = {r.doc_id: r.score for r in quality.scored(docs, labels).collect()}
    plain, junk = [s for i, s in got.items() if i % 3], [s for i, s in got.items() if i % 3 == 0]
    assert min(plain) > 0.3 > max(junk)


def test_prior():
    rng = np.random.default_rng(0)
    p = rng.normal(2, 1, 4000)
    u = np.concatenate([rng.normal(2, 1, 3000), rng.normal(-2, 1, 1000)])
    assert abs(quality.prior_of(p, u) - 0.75) < 0.05


def test_features_do_not_depend_on_neighbours():
    texts = ["a b c\nd", "", None, "To To To To", "X" * 900_000, "é ü\n\n", "last."]
    whole = quality.all_features(pa.array(texts))
    alone = np.concatenate([quality.all_features(pa.array([t], pa.string())) for t in texts])
    assert np.array_equal(whole, alone)
    named = dict(zip(quality.FEATURES, whole[3], strict=True))
    assert named["distinct"] == 0.25 and named["top_word"] == 1 and named["echo"] == 0.75


def test_words_that_fool_a_polynomial_hash():
    x = quality.all_features(pa.array([f"{thue_morse(1024)} {thue_morse(1024, turned=True)}"]))[0]
    assert dict(zip(quality.FEATURES, x, strict=True))["distinct"] == 1
