"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; the unlabelled side is all text without
a label outside the held-out fold. The share of positives in it is estimated (best bin
of a positive-against-unlabelled ranking), and a small network minimises the
non-negative unbiased risk ``prior * R(P, +) + max(0, R(U, -) - prior * R(P, -))``.
Its margin is mapped to a score by a logistic fit on the labelled training rows.

The unlabelled side counts whole: the ranking's margins of all its rows go into a
histogram, and its part of the risk is taken over cells. A cell holds the rows on the
same side of PLANES planes through the features; their number and the sum of their
features come from one pass, so what reaches the driver is bounded however large the
table. Labelled rows are the only ones that are sampled.

Features are statistics of the whole text (characters, words, repetition, lines),
computed in numpy over Arrow batches. Nothing but the text enters a score.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm import text_arrays as ta
from almanac.llm.common import documents, settle

#: Bound of the labelled training sample (documents), drawn by a hash of doc_id.
MOST_LABELLED = 8_000
#: Planes that cut the unlabelled rows into cells, and the fixed point of their sums.
PLANES = 14
POINT = 1 << 24
CUTS = 200
FOLDS = 5
THRESHOLD = 0.3
HIDDEN = 12
EPOCHS = 150
RANK_EPOCHS = 40
SEED = 5


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


UPPER = _flags(bytes(range(0x41, 0x5B)))
LETTER = UPPER | _flags(bytes(range(0x61, 0x7B)))
DIGIT = _flags(b"0123456789")
PUNCT = _flags(bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum()))
PLAIN = _flags(b".,;:'\"-()?")
HIGH = _flags(bytes(range(0x80, 0x100)))
FEATURES = ("log_bytes", "log_words", "upper", "digit", "punct", "odd_punct", "high", "mean_word", "long_words",
            "capital_words", "marked_words", "bare_marks", "distinct", "log_distinct", "top_word", "echo", "echo_case",
            "distinct_shingles", "top_shingle", "lines_per_word", "distinct_lines", "stops", "starts")


def _sums(flags: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64 if len(flags) >> 31 else np.int32)
    np.cumsum(flags, out=total[1:])
    return (total[b] - total[a]).astype(np.float64)


def _repeats(values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the largest number of equal values, per segment."""
    n = len(off) - 1
    values = values.copy()
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[off[:-1][off[:-1] < len(values)]] = True
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(values)))
    place = np.searchsorted(at, off)
    most, some = np.zeros(n), np.flatnonzero(np.diff(off))
    if len(some):
        most[some] = np.maximum.reduceat(run, place[:-1][some])
    return np.diff(place).astype(np.float64), most


def features(column: pa.Array) -> np.ndarray:
    """Rows x FEATURES. A text without words has zeros but for its length."""
    data, off = ta.utf8(column)
    a, b = off[:-1], off[1:]
    n = len(a)
    starts, ends, words = ta.word_spans(data, off)
    wa, wb = words[:-1], words[1:]
    n_bytes, n_words = (b - a).astype(float), (wb - wa).astype(float)
    per_byte, per_word = 1 / np.maximum(n_bytes, 1), 1 / np.maximum(n_words, 1)
    hashes = ta.span_hashes(data, starts, ends)
    cased = ta.span_hashes(ta.LOWER[data], starts, ends)
    shingles, soff = ta.shingle_hashes(cased, words)
    length = ends - starts
    letters = _sums(LETTER[data], starts, ends)
    capitals = _sums(UPPER[data], starts, ends)
    odd = _sums((PUNCT & ~PLAIN)[data], starts, ends)
    same = np.zeros(len(starts), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[wa[wa < len(starts)]] = False
    alike = np.zeros(len(starts), dtype=bool)
    alike[1:] = cased[1:] == cased[:-1]
    alike[wa[wa < len(starts)]] = False
    distinct, top = _repeats(cased, words)
    sdistinct, stop = _repeats(shingles, soff)
    # lines
    newline = data == 0x0A
    cut = np.unique(np.concatenate([a, np.flatnonzero(newline) + 1]))
    cut = cut[cut < len(data)]
    lends = np.append(cut[1:], len(data))
    lhash = ta.span_hashes(data, cut, lends)
    loff = np.searchsorted(cut, off)
    lines = np.diff(loff).astype(float)
    ldistinct, _ = _repeats(lhash, loff)
    n_shingles = np.maximum(np.diff(soff), 1)
    cols = [
        np.log1p(n_bytes), np.log1p(n_words), _sums(UPPER[data], a, b) * per_byte, _sums(DIGIT[data], a, b) * per_byte,
        _sums(PUNCT[data], a, b) * per_byte, _sums((PUNCT & ~PLAIN)[data], a, b) * per_byte, _sums(HIGH[data], a, b) * per_byte,
        _sums(~ta.SEPARATOR[data], a, b) * per_word / 10, _sums(length > 20, wa, wb) * per_word,
        _sums((capitals >= 2) & (capitals == letters), wa, wb) * per_word, _sums((odd > 0) & (odd < length), wa, wb) * per_word,
        _sums(odd == length, wa, wb) * per_word, distinct * per_word, np.log1p(distinct), top * per_word,
        _sums(same, wa, wb) * per_word, _sums(alike & ~same, wa, wb) * per_word, sdistinct / n_shingles, stop / n_shingles,
        lines * per_word, ldistinct / np.maximum(lines, 1),
        _sums(data[ends - 1] == 0x2E, wa, wb) * per_word if len(ends) else np.zeros(n),
        _sums(UPPER[data[starts]], wa, wb) * per_word if len(starts) else np.zeros(n)]
    return np.column_stack(cols) if n else np.zeros((0, len(FEATURES)))


def all_features(column: pa.Array) -> np.ndarray:
    out = [features(c.column("t")) for c in ta.chunks(pa.RecordBatch.from_arrays([column], ["t"]), "t")]
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def cuts_of(positive: np.ndarray) -> np.ndarray:
    return np.unique(np.quantile(positive, np.linspace(0, 0.99, CUTS)))


def prior_at(positive: np.ndarray, cuts: np.ndarray, bins: np.ndarray) -> float:
    """Share of positives among unlabelled margins, from the margins of positives and the
    numbers ``bins`` of unlabelled ones by the number of cuts that they reach: over all
    cuts the least ratio of the unlabelled to the positive share above, with a confidence
    margin that keeps nearly empty bins from winning."""
    n = bins.sum()
    above_p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    above_u = (n - np.cumsum(bins)[:len(cuts)]) / n
    margin = np.sqrt(np.log(40) / 2 / n) + np.sqrt(np.log(40) / 2 / len(positive))
    some = above_p > 0.05
    at = np.argmin((above_u[some] + margin) / above_p[some])
    return float(np.clip(above_u[some][at] / above_p[some][at], 0.01, 0.99))


def prior_of(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    cuts = cuts_of(positive)
    return prior_at(positive, cuts, np.bincount(np.searchsorted(cuts, unlabelled, side="right"), minlength=len(cuts) + 1))


@dataclass
class Model:
    """Network over standardised features, and the map from margin to score."""
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float
    slope: float = 1.0
    shift: float = 0.0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def of_inputs(self, inputs: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return (np.tanh(inputs @ w1 + b1) @ w2 + b2)[:, 0]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.of_inputs(self.inputs(x))

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(x) + self.shift)


def _train(weights: list[np.ndarray], p: np.ndarray, u: np.ndarray, pull, epochs: int = EPOCHS) -> list[np.ndarray]:
    """Adam over all inputs at once; ``pull`` turns margins into their gradients."""
    x = np.concatenate([p, u])
    w, m, v = list(weights), [0.0] * 4, [0.0] * 4
    for step in range(1, epochs + 1):
        h = np.tanh(x @ w[0] + w[1])
        z = (h @ w[2] + w[3])[:, 0]
        g = pull(z[:len(p)], z[len(p):])[:, None]
        back = (g @ w[2].T) * (1 - h * h)
        grads = [x.T @ back, back.sum(0), h.T @ g, g.sum(0)]
        for i, grad in enumerate(grads):
            grad = grad + 1e-4 * w[i]
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad * grad
            w[i] = w[i] - 0.02 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return w


def risk(zp: np.ndarray, zu: np.ndarray, share: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the unbiased risk under the sigmoid loss (l(z, +) = 1 - s(z),
    l(z, -) = s(z)): that of positives, and that of negatives, which may turn negative.
    ``share`` is the weight of each unlabelled margin."""
    sp = _sigmoid(zp)
    return prior * (1 - sp).mean(), float((share * _sigmoid(zu)).sum() - prior * sp.mean())


def pull_of(share: np.ndarray, prior: float):
    """Gradient of the non-negative risk by the margins: where the negatives' part is
    below zero, a step back on that part alone."""
    def pull(zp: np.ndarray, zu: np.ndarray) -> np.ndarray:
        sp, su = _sigmoid(zp), _sigmoid(zu)
        dp, du = sp * (1 - sp) / len(zp), share * su * (1 - su)
        if risk(zp, zu, share, prior)[1] >= 0:
            return np.concatenate([-2 * prior * dp, du])
        return np.concatenate([prior * dp, -du])
    return pull


@dataclass
class Taught:
    """Labelled rows: features, marks, and the half that each is dealt to."""
    x: np.ndarray
    good: np.ndarray
    half: np.ndarray


def fit(taught: Taught, cells, bins) -> Model:
    """Model from labelled rows and two passes over the unlabelled ones.

    ``cells(inputs, planes, heights)`` gives the unlabelled rows' mean inputs, numbers
    and half by cell; ``bins(models, cuts)`` the numbers of their margins between the
    cuts, each by the model of the other half. The trusted class is the good one; where
    all marks are bad, they are, and the margin is turned round. Without labelled or
    unlabelled rows all scores are 0.5."""
    flat = [np.zeros((len(FEATURES), 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)]
    if not len(taught.good):
        return Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), flat, 0.5)
    model = Model(taught.x.mean(0), taught.x.std(0) + 1e-6, flat, 0.5)
    trusted = taught.good if taught.good.any() else ~taught.good
    labelled = model.inputs(taught.x)
    rng = np.random.default_rng(SEED)
    planes = rng.normal(0, 1, (len(FEATURES), PLANES))
    u, n, uh = cells(model.inputs, planes, np.median(labelled @ planes, axis=0))
    if not len(n):
        return model
    p, ph = labelled[trusted], taught.half[trusted]
    fresh = lambda: [rng.normal(0, 0.3, (len(FEATURES), HIDDEN)), np.zeros(HIDDEN),
                     rng.normal(0, 0.3, (HIDDEN, 1)), np.zeros(1)]
    # the prior: positives ranked against unlabelled text, each half by the other's model
    rankers = []
    for part in range(2):
        a, b, share = p[ph == part], u[uh == part], n[uh == part]
        weights = fresh()
        if len(a) and len(b):
            share = share / share.sum()
            weights = _train(weights, a, b, lambda zp, zu, share=share: np.concatenate([-_sigmoid(-zp) / len(zp), share * _sigmoid(zu)]), RANK_EPOCHS)
        rankers.append(replace(model, weights=weights))
    ranked = np.concatenate([rankers[1 - part].of_inputs(p[ph == part]) for part in range(2)])
    cuts = cuts_of(ranked)
    model.prior = prior_at(ranked, cuts, bins(rankers, cuts))
    model.weights = _train(fresh(), p, u, pull_of(n / n.sum(), model.prior))
    if not taught.good.any():
        model.weights = [*model.weights[:2], -model.weights[2], -model.weights[3]]
        model.prior = 1 - model.prior
    model.slope, model.shift = _logistic(model.of_inputs(labelled), taught.good)
    return model


def _logistic(z: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(good | margin): the least logistic loss, with a weak pull of
    the slope to zero. The loss is convex; Newton steps are halved until it falls. Marks
    of one class say nothing about the map, which then stays the identity."""
    y = good.astype(float)
    if y.min(initial=1) == y.max(initial=0):
        return 1.0, 0.0
    middle, spread = z.mean(), z.std() + 1e-9
    t = (z - middle) / spread
    # targets a little inside 0 and 1, so that separable marks have a least loss too
    y = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    loss = lambda a, b: (np.logaddexp(0, a * t + b) - y * (a * t + b)).mean() + 1e-4 * a * a
    a, b = 0.0, float(np.log(y.mean() / (1 - y.mean())))
    for _ in range(100):
        s = _sigmoid(a * t + b)
        r, c = s - y, s * (1 - s) + 1e-9
        grad = np.array([(r * t).mean() + 2e-4 * a, r.mean()])
        hess = np.array([[(c * t * t).mean() + 2e-4, (c * t).mean()], [(c * t).mean(), c.mean()]])
        step, scale = np.linalg.solve(hess + 1e-9 * np.eye(2), grad), 1.0
        while scale > 1e-6 and loss(a - scale * step[0], b - scale * step[1]) > loss(a, b):
            scale /= 2
        a, b = a - scale * step[0], b - scale * step[1]
        if np.abs(scale * step).max() < 1e-9:
            break
    return float(a / spread), float(b - a * middle / spread)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@F.arrow_udf(T.BinaryType())
def text_features(text: pa.Array) -> pa.Array:
    return pa.array([row.tobytes() for row in all_features(text)], pa.binary())


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, len(FEATURES))


def prepared(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, half, quality, hash, x) of every document: features, and the mark if one
    outside the held-out fold is known. A document labelled twice has its lowest mark;
    null marks are none."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("marked"), F.col("quality").cast("int").alias("quality"))
             .where(F.col("marked").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("marked")))
             .groupBy("marked").agg(F.min("quality").alias("quality")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("hash"), text_features("text").alias("x"))
    return settle(rows.join(marks, F.col("doc_id") == F.col("marked"), "left").select(
        "doc_id", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(2)).cast("int").alias("half"), "quality", "hash", "x"), "quality-rows")


def _taught(rows: DataFrame) -> Taught:
    """About MOST_LABELLED labelled documents at most; one row of a repeated id."""
    marked = rows.where("quality is not null")
    n = marked.select(F.approx_count_distinct("doc_id", 0.01)).first()[0]
    share = min(1.0, MOST_LABELLED / max(n, 1))
    drawn = (marked.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(1 << 30)) < int(share * (1 << 30)))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("half").alias("half"), F.min_by("x", "hash").alias("x"))).toArrow()
    order = np.argsort(drawn.column("doc_id").to_numpy(), kind="stable")
    return Taught(_rows(drawn.column("x"))[order], drawn.column("quality").to_numpy()[order] == 1, drawn.column("half").to_numpy()[order])


def _cells(free: DataFrame):
    """One pass: numbers and sums of inputs by cell, as integers, so any order of adding
    gives the same; at most 2 << PLANES cells reach the driver."""
    def run(inputs, planes: np.ndarray, heights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = 1 + len(FEATURES)

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2 << PLANES, width), dtype=np.int64)
            for b in batches:
                x = inputs(_rows(b.column("x")))
                cell = (x @ planes > heights) @ (1 << np.arange(PLANES)) + (b.column("half").to_numpy().astype(np.int64) << PLANES)
                np.add.at(sums, cell, np.column_stack([np.ones(len(x), np.int64), np.rint(x * POINT).astype(np.int64)]))
            some = np.flatnonzero(sums[:, 0])
            yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(sums[some, i]) for i in range(width))],
                                             ["cell", *(f"s{i}" for i in range(width))])

        found = (free.select("half", "x").mapInArrow(collect, "cell long, " + ", ".join(f"s{i} long" for i in range(width)))
                 .groupBy("cell").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(width))).toArrow())
        cell = found.column("cell").to_numpy()
        order = np.argsort(cell)
        sums = np.column_stack([found.column(f"s{i}").to_numpy() for i in range(width)])[order].astype(np.float64)
        return sums[:, 1:] / POINT / np.maximum(sums[:, :1], 1), sums[:, 0], cell[order] >> PLANES
    return run


def _bins(free: DataFrame):
    """One pass: numbers of margins by the number of cuts that they reach."""
    def run(rankers: list[Model], cuts: np.ndarray) -> np.ndarray:
        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(cuts) + 1, dtype=np.int64)
            for b in batches:
                x, half = _rows(b.column("x")), b.column("half").to_numpy()
                z = np.where(half == 0, rankers[1].margin(x), rankers[0].margin(x))
                total += np.bincount(np.searchsorted(cuts, z, side="right"), minlength=len(total))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["bin", "n"])

        out = np.zeros(len(cuts) + 1, dtype=np.int64)
        for r in free.select("half", "x").mapInArrow(collect, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
            out[r.bin] = r.n
        return out
    return run


def learn(rows: DataFrame) -> Model:
    """Model from ``prepared`` rows: marked ones teach (a bounded sample of them), all
    others are the unlabelled side."""
    free = rows.where("quality is null")
    return fit(_taught(rows), _cells(free), _bins(free))


def scorer(model: Model):
    """The model as a column function of the text."""
    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(model.score(all_features(text)))
    return score


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs(doc_id, text)``.

    Null and empty texts are scored like any text without words, texts of any length
    whole. Repeated rows stay, equal texts score alike; a null doc_id is never held out.
    Labels without a document teach nothing; labels that the text doesn't explain give
    scores near the labels' share; without any label all scores are 0.5. Extra columns
    are ignored; an empty table gives an empty result."""
    rows = prepared(docs, labels)
    model = learn(rows)

    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        return pa.array(model.score(_rows(x)))

    return (rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("x").alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
