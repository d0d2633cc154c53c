"""Near-duplicate vectors by cross-polytope hashing.

A hash is the largest coordinate (with its sign) of a vector after three rounds of
random signs and a fast Hadamard transform; several hashes make the code of a table.
A vector also stands under the codes that cost the least to change to (multiprobe).
The number of hashes grows with the logarithm of the number of vectors, so that
vectors that have nothing in common rarely meet; the numbers of probes and tables are
those with the fewest codes that bring together the wanted share of simulated pairs
exactly at the threshold.

Vectors that share a code get the smallest of them as their hub, and every hub-member
pair is verified. Pairs of members are not listed:

- Members within half the threshold's angle of a hub are near each other by the
  triangle inequality. They are counted by number: each vector counts in the group of
  the smallest such hub, its *core*.
- Other pairs of members of a hub are verified in blocks of bounded size. A block
  gives one number per vector and a spanning forest of its links. A pair of common
  hubs counts at the smallest.

Equal vectors are one class throughout.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.common import components, documents, join_copies, settle
from almanac.llm.text_arrays import mix64

COSINE = 0.93
PROBES = (0, 2, 4, 6, 8, 12, 16)
#: Coordinates of a hash that probes may change to, and the most hashes of a code.
ALTERNATIVES = 3
MOST_HASHES = 6
#: Vectors without likeness that a vector may meet, on average.
CHANCE = 0.5
#: Share of the pairs at the threshold that share a code.
RECALL = 0.995
MOST_TABLES = 64
SIMULATED = 4000
BLOCK = 1024
#: Rows of a task that verifies blocks, on average.
TASK_ROWS = 8192
SEED = 13
EDGE = 1e-9


def rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Rows after rounds of signs and a Hadamard transform; the length is a power of two."""
    n, d = x.shape
    for s in signs:
        x = x * s
        h = 1
        while h < d:
            y = x.reshape(n, -1, 2, h)
            x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
            h *= 2
        x = x / np.sqrt(d)
    return x


class Hashes:
    """Codes of unit vectors: ``tables`` of ``size`` hashes each, under which a vector
    stands once and ``probes`` times more."""

    def __init__(self, dim: int, size: int, tables: int, probes: int):
        self.dim, self.size, self.tables, self.probes = dim, size, tables, probes
        self.width = 1 << max(dim - 1, 0).bit_length()
        rng = np.random.default_rng([SEED, dim, size])
        self.signs = rng.choice([-1.0, 1.0], size=(MOST_TABLES, size, 3, self.width))[:tables]

    def codes(self, x: np.ndarray) -> np.ndarray:
        """rows x tables x (1 + probes) codes; the first is the vector's own."""
        n = len(x)
        padded = np.zeros((n, self.width))
        padded[:, :self.dim] = x
        few = min(ALTERNATIVES, self.width)
        combos = np.array(list(itertools.product(range(few), repeat=self.size)))
        out = np.empty((n, self.tables, min(1 + self.probes, len(combos))), dtype=np.int64)
        for t in range(self.tables):
            code, loss = np.zeros((n, len(combos)), np.int64), np.zeros((n, len(combos)))
            for i in range(self.size):
                y = rotated(padded, self.signs[t, i])
                top = np.argpartition(-np.abs(y), few - 1, axis=1)[:, :few]
                size = np.abs(np.take_along_axis(y, top, axis=1))
                top = np.take_along_axis(top, np.lexsort((top, -size), axis=1), axis=1)
                value = np.take_along_axis(y, top, axis=1)
                mark = top * 2 + (value < 0)
                short = (np.abs(value[:, :1]) - np.abs(value)) ** 2
                code = code * (2 * self.width) + mark[:, combos[:, i]]
                loss += short[:, combos[:, i]]
            best = np.argsort(loss, axis=1, kind="stable")[:, :out.shape[2]]
            out[:, t] = np.take_along_axis(code, best, axis=1)
        return out


def met(dim: int, size: int, cosine: float = COSINE) -> dict[int, float]:
    """Share of the pairs of the given cosine that one table brings together, by probes."""
    if dim < 2:
        return {0: 1.0}
    rng = np.random.default_rng(SEED)
    a, b = rng.normal(size=(2, SIMULATED, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1)[:, None]
    hashes = Hashes(dim, size, 1, max(PROBES))
    x, y = hashes.codes(a)[:, 0], hashes.codes(b)[:, 0]
    same = x[:, :, None] == y[:, None, :]  # in the order of their cost: fewer probes are a head of them
    return {p: float(same[:, :1 + p, :1 + p].any((1, 2)).mean()) for p in PROBES}


def chosen(dim: int, rows: int, cosine: float = COSINE) -> Hashes:
    """Hashes, probes and tables with the fewest codes per vector, of those that reach the
    wanted recall and keep chance meetings among ``rows`` vectors rare; where none does,
    those with the fewest chance meetings."""
    options = []
    for size in range(1, MOST_HASHES + 1):
        for probes, p in met(dim, size, cosine).items():
            tables = 1 if p >= RECALL else MOST_TABLES + 1 if p <= 0 else int(np.ceil(np.log(1 - RECALL) / np.log(1 - p)))
            if tables <= MOST_TABLES:
                hashes = Hashes(dim, size, tables, probes)
                chance = rows * tables * (1 + probes) ** 2 / (2.0 * hashes.width) ** size
                options.append((max(chance, CHANCE), tables * (1 + probes), size, hashes))
    return min(options, key=lambda o: o[:3])[3]


PACKED = pa.schema([("vec_id", pa.int64()), ("key", pa.binary()), ("label", pa.string()), ("v", pa.binary())])
PACKED_DDL = "vec_id long, key binary, label string, v binary"


def _packed(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, vectors = [], []
            column = b.column("v")
            bare = column.flatten()
            holes = bare.is_null().to_numpy(zero_copy_only=False)
            flat = bare.to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)  # one zero
            size = np.array([len(x) if x.is_valid else 0 for x in column], dtype=np.int64)
            off = np.concatenate([[0], np.cumsum(size)])
            fine = np.concatenate([[0], np.cumsum(~np.isfinite(flat) | holes)])
            some = np.concatenate([[0], np.cumsum(np.where(holes, 0, flat != 0))])
            usable = (fine[off[1:]] == fine[off[:-1]]) & (some[off[1:]] > some[off[:-1]])
            for i, label in enumerate(b.column("label").to_pylist()):
                v = flat[off[i]:off[i + 1]].tobytes() if usable[i] and label is not None else None
                vectors.append(v)
                keys.append(None if v is None else hashlib.blake2b(f"{label}:".encode() + v, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(keys, pa.binary()), b.column("label"), pa.array(vectors, pa.binary())],
                                             schema=PACKED)
    return run


def _matrix(column, kind: str) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=kind).astype(np.float64).reshape(len(rows), -1)


def _entries(kind: str, hashes: dict[int, Hashes]):
    """Cells of each class: hashes of (label, length, table, code)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, salts = np.dtype(kind).itemsize, {}

        def salt(label: str, dim: int) -> int:
            if (label, dim) not in salts:
                salts[label, dim] = int.from_bytes(hashlib.blake2b(f"{dim}:{label}".encode(), digest_size=8).digest())
            return salts[label, dim]

        for b in batches:
            sizes = np.array([len(v) // item for v in b.column("v").to_pylist()], dtype=np.int64)
            for dim in np.unique(sizes).tolist():
                some = b.filter(pa.array(sizes == dim))
                for a in range(0, some.num_rows, 512):
                    part = some.slice(a, 512)
                    x = _matrix(part.column("v"), kind)
                    x = x / np.abs(x).max(axis=1)[:, None]
                    codes = hashes[dim].codes(x / np.linalg.norm(x, axis=1)[:, None])
                    n, tables, each = codes.shape
                    own = np.array([salt(label, dim) for label in part.column("label").to_pylist()], dtype=np.uint64)
                    with np.errstate(over="ignore"):
                        cells = mix64(codes.astype(np.uint64) + np.arange(tables, dtype=np.uint64)[None, :, None] * np.uint64(0x9E3779B97F4A7C15))
                        cells = mix64(cells ^ own[:, None, None])
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column("class").to_numpy(), tables * each)),
                                                      pa.array(cells.ravel().view(np.int64))], ["class", "cell"])
    return run


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def cosines(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosine of x[i], y[j], pair by pair."""
    return (x[i] * y[j]).sum(axis=1) / (_norms(x[i]) * _norms(y[j]))


FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Enough of the links to connect what they connect."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _meet(kind: str, cosine: float):
    def block(hub: int, part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Links of one pair of blocks: classes and copies of both sides."""
        cls, primary, n, side = (part.column(c).to_numpy() for c in ("class", "primary", "n", "side"))
        x = _matrix(part.column("v"), kind)
        unit = x / _norms(x)[:, None]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(right)
        right = left if alone else right
        lists = part.column("hubs").to_pylist()
        hubs = np.full((len(lists), max(map(len, lists))), -1, dtype=np.int64)
        for at, own in enumerate(lists):
            hubs[at, :len(own)] = own
        i, j = np.nonzero(unit[left] @ unit[right].T >= cosine - EDGE)
        if alone:
            i, j = i[i < j], j[i < j]
        i, j = left[i], right[j]
        other = primary[i] != primary[j]
        i, j = i[other], j[other]
        keep = np.zeros(len(i), dtype=bool)
        for a in range(0, len(i), 8192):
            p, q = i[a:a + 8192], j[a:a + 8192]
            hi, hj = hubs[p], hubs[q]
            apart = ~((hi == cls[q][:, None]).any(1) | (hj == cls[p][:, None]).any(1))
            common = (hi[:, :, None] == hj[:, None, :]).any(2) & (hi >= 0)
            keep[a:a + 8192] = (apart & (np.where(common, hi, np.iinfo(np.int64).max).min(1) == hub)
                                & (cosines(x, x, p, q) >= cosine))
        i, j = i[keep], j[keep]
        return cls[i], cls[j], n[i], n[j]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("hub", "ascending"), ("lo", "ascending"), ("hi", "ascending")])
        key = np.column_stack([table.column(c).to_numpy() for c in ("hub", "lo", "hi")])
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
        a, b, na, nb = [], [], [], []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], strict=True):
            if e - s > 1:
                for out, got in zip((a, b, na, nb), block(int(key[s, 0]), table.slice(s, e - s)), strict=True):
                    out.append(got)
        if not a:
            return FOUND.empty_table()
        a, b, na, nb = (np.concatenate(x) for x in (a, b, na, nb))
        ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        links = np.zeros(len(ids), dtype=np.int64)
        np.add.at(links, place, np.concatenate([nb, na]))
        tree = _forest(a, b)
        return pa.Table.from_arrays(
            [pa.array(ids.tolist() + [x for x, _ in tree], pa.int64()), pa.array([None] * len(ids) + [y for _, y in tree], pa.int64()),
             pa.array(links.tolist() + [0] * len(tree), pa.int64())], schema=FOUND)
    return run


def _stars(classes: DataFrame, hashes: dict[int, Hashes], kind: str, cosine: float) -> DataFrame:
    """(hub, class, cosine) of all vectors that share a code with a smaller one."""
    entries = settle(classes.mapInArrow(_entries(kind, hashes), "class long, cell long"), "vector-cells")
    hubs = entries.groupBy("cell").agg(F.min("class").alias("hub"), F.max("class").alias("last")).where("hub < last").select("cell", "hub")
    near = settle(entries.join(hubs, "cell").where("class <> hub").select("hub", "class").distinct(), "vector-neighbours")

    @F.arrow_udf("double")
    def likeness(v: pa.Array, w: pa.Array) -> pa.Array:
        out = np.full(len(v), -1.0)
        v, w = v.to_pylist(), w.to_pylist()
        same = np.array([len(a) == len(b) for a, b in zip(v, w, strict=True)], dtype=bool)
        for dim in {len(v[i]) for i in np.flatnonzero(same).tolist()}:
            at = [i for i in np.flatnonzero(same).tolist() if len(v[i]) == dim]
            x, y = (_matrix(pa.array([z[i] for i in at], pa.binary()), kind) for z in (v, w))
            out[at] = cosines(x, y, np.arange(len(at)), np.arange(len(at)))
        return pa.array(out)

    vectors = classes.select("class", "v", "label")
    rows = (near.join(vectors, "class").join(vectors.select(F.col("class").alias("hub"), F.col("v").alias("w"), F.col("label").alias("hub_label")), "hub")
            .where("label = hub_label"))  # cells are hashes
    return settle(rows.select("hub", "class", likeness("v", "w").alias("cosine")), "vector-stars")


def _members(classes: DataFrame, stars: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """(hub, class, primary) with the hubs themselves, and (class, primary, hubs)."""
    core = float(np.cos(np.arccos(cosine) / 2)) + EDGE
    every = stars.unionByName(stars.select("hub").distinct().select("hub", F.col("hub").alias("class"), F.lit(1.0).alias("cosine")))
    homes = settle(every.groupBy("class").agg(
        F.coalesce(F.min(F.when(F.col("cosine") >= core, F.col("hub"))), F.col("class")).alias("primary"),
        F.sort_array(F.collect_set("hub")).alias("hubs")), "vector-homes")  # as many hubs as a vector has codes
    return every.select("hub", "class").join(homes.select("class", "primary"), "class"), homes


def _blocks(members: DataFrame, homes: DataFrame, classes: DataFrame, kind: str, cosine: float) -> DataFrame:
    """(a, b, links) of pairs of members, hubs apart, of different primaries."""
    members = settle(members.where("hub <> class"), "vector-members")
    shape = members.groupBy("hub", "primary").agg(F.count("*").alias("k"))
    mixed = shape.groupBy("hub").agg(F.count("*").alias("primaries")).where("primaries > 1").select("hub")
    shape = shape.join(mixed, "hub").withColumn("own", F.when(F.col("k") >= BLOCK // 2, F.col("primary")))
    # large primaries have blocks of their own, which needn't be compared with each other
    kinds = shape.groupBy("hub", "own").agg(F.ceil(F.sum("k") / BLOCK).cast("long").alias("blocks"))
    by_hub = Window.partitionBy("hub")
    kinds = kinds.withColumn("base", F.sum("blocks").over(by_hub.orderBy("own")) - F.col("blocks")).withColumn("all", F.sum("blocks").over(by_hub))
    dealt = (shape.select("hub", "primary", "own").join(kinds.select("hub", F.col("own").alias("o"), "blocks", "base", "all")
                                                        .withColumnRenamed("hub", "h"), (F.col("hub") == F.col("h")) & F.col("own").eqNullSafe(F.col("o")))
             .select("hub", "primary", "own", "blocks", "base", "all"))
    rows = members.join(dealt, ["hub", "primary"]).withColumn("x", F.col("base") + F.pmod(F.xxhash64("class"), F.col("blocks")))
    zero = F.lit(0).cast("long")
    partners = F.filter(F.sequence(zero, F.col("all") - 1),
                        lambda y: F.col("own").isNull() | (y < F.col("base")) | (y >= F.col("base") + F.col("blocks")))
    rows = rows.withColumn("y", F.explode(partners)).select(
        "hub", "class", F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"), (F.col("x") > F.col("y")).cast("int").alias("side"))
    rows = settle(rows, "vector-blocks")
    tasks = max(1, -(-rows.count() // TASK_ROWS))
    full = (rows.join(homes, "class").join(classes.select("class", "n", "v"), "class")
            .withColumn("task", F.pmod(F.xxhash64("hub", "lo", "hi"), F.lit(tasks))))
    return full.groupBy("task").applyInArrow(_meet(kind, cosine), "a long, b long, links long")


def near_duplicates(rows: DataFrame, cosine: float = COSINE, vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``rows(vec_id, embedding,
    label)``; two link when their labels are equal and their cosine is at least ``cosine``.

    Vectors that are null, empty, zero or hold null or non-finite components and rows
    without a label have no links; neither do vectors of different lengths with each
    other. Rows that repeat a vector link with each other, rows that repeat an id count
    as rows. A null vec_id is ignored by the smallest id. Extra columns are ignored;
    an empty table gives an empty result."""
    kind = "<f4" if rows.schema[vector].dataType.elementType == T.FloatType() else "<f8"
    array = "array<float>" if kind == "<f4" else "array<double>"
    plain = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast(array).alias("v"))
    packed = plain.mapInArrow(_packed(kind), PACKED_DDL)
    ids = settle(packed.select("vec_id", "key"), "vector-ids")
    classes = settle(packed.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
        .withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    item = np.dtype(kind).itemsize
    sizes = classes.groupBy((F.octet_length("v") / item).cast("int").alias("dim"), "label").count().groupBy("dim").agg(F.max("count").alias("n"))
    hashes = {r.dim: chosen(r.dim, r.n, cosine) for r in sizes.collect()}  # one row per length of vector
    stars = _stars(classes, hashes, kind, cosine)
    members, homes = _members(classes, stars, cosine)

    copies = classes.select("class", "n")
    of = homes.select("class", "primary").join(copies, "class")
    core = of.groupBy("primary").agg(F.sum("n").alias("all"))
    counted = of.join(core, "primary").select("class", (F.col("all") - F.col("n")).alias("links"))
    here = lambda name: of.select(F.col("class").alias(name), F.col("primary").alias(f"{name}_home"), F.col("n").alias(f"{name}_n"))
    hits = settle(stars.where(F.col("cosine") >= cosine).select("hub", "class").join(here("hub"), "hub").join(here("class"), "class")
                  .where("hub_home <> class_home").drop("hub_home", "class_home"), "vector-links")
    blocks = settle(_blocks(members, homes, classes, kind, cosine), "vector-found")
    links = (counted.unionByName(hits.select("class", F.col("hub_n").alias("links")))
             .unionByName(hits.select(F.col("hub").alias("class"), F.col("class_n").alias("links")))
             .unionByName(blocks.where("b is null").select(F.col("a").alias("class"), "links"))
             .groupBy("class").agg(F.sum("links").alias("links")))
    edges = (of.where("class <> primary").select(F.col("primary").alias("a"), F.col("class").alias("b"))
             .unionByName(hits.select(F.col("hub").alias("a"), F.col("class").alias("b")))
             .unionByName(blocks.where("b is not null").select("a", "b")))
    found = components(edges, "vector-components")
    named = classes.select("class", "key", "least", "n").join(found, F.col("class") == F.col("node"), "left").join(links, "class", "left")
    named = settle(named.select("key", "least", "n", F.coalesce("component", "class").alias("component"),
                                (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "vector-named")
    lowest = settle(named.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("sets")), "vector-lowest")
    names = settle(join_copies(named, lowest, "component", "sets").select("key", "n", "n_links", "component_id"), "vector-names")
    return (join_copies(ids, names, "key", "n")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir, "embeddings"))


#: The same rows from all pairs, for small tables.
OP13_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
          WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS node, vec_id AS least FROM embeddings UNION SELECT l.b, r.least FROM reach r JOIN links l ON l.a = r.node),
named AS (SELECT node, min(least) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, n.component_id, e.vec_id = n.component_id AS kept
FROM embeddings e JOIN named n ON n.node = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""
