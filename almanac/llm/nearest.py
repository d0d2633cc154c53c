"""Approximate nearest neighbours by inner product: a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is then assigned to a leaf. A leaf
that comes to hold many rows gets a tree of its own, fitted in a task on a bounded sample
of the leaf, so leaves stay small in large tables (up to some million of them). These trees
stay in a table: rows and queries meet the tree of their leaf in blocks. An added coordinate (the root of the largest squared norm minus the vector's own)
turns the largest inner product into the smallest distance. A query walks the
tree best bin first through a priority queue. How many leaves it visits at least
is calibrated: for a bounded set of queries the true neighbours are found by brute
force over all rows, and visits widen until their leaves cover the wanted recall,
of all pairs and of as large a share of the queries each (in the outer tree, then in those
of the leaves it opens). A query whose leaves
hold fewer rows than it wants walks on until they do.

Queries meet the members of their leaves in cells of bounded size on both sides,
so neither a crowded leaf nor a popular one lands in a single task.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.common import documents, settle

K = 20
QUERY_STEP = 20
#: Bounds of the sample that fits the tree, and of the queries that calibrate it.
SAMPLE = 65_536
CALIBRATION = 256
RECALL = 0.95
BRANCH = 16
LEAF_ROWS = 256
CELL_MEMBERS = 4096
CELL_QUERIES = 2048
#: Rows from which a leaf is split, the sample that splits it, and the rows (or queries) that
#: meet its tree in one task.
SPLIT_ROWS = 16 * LEAF_ROWS
SPLIT_SAMPLE = 16_384
SPLIT_BLOCK = 65_536
#: A place is a leaf of the outer tree and one of its own tree, in so many bits.
INNER_BITS = 20


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centres and the nearest centre of each row; empty centres move to far rows."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        d = (centres**2).sum(1)[None, :] - 2 * x @ centres.T
        near = d.argmin(1)
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        if (count == 0).any():
            far = np.argsort(d.min(1) + (x**2).sum(1))[::-1][:int((count == 0).sum())]
            total[count == 0], count[count == 0] = x[far], 1
        centres = total / count[:, None]
    return centres, ((centres**2).sum(1)[None, :] - 2 * x @ centres.T).argmin(1)


class Tree:
    """Inner nodes hold centres and children (node, or leaf number below zero)."""

    def __init__(self, x: np.ndarray, leaf: int, seed: int = 0):
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.leaves = 0
        self.root = self._grow(x, max(leaf, 2), np.random.default_rng(seed))

    def _grow(self, x: np.ndarray, leaf: int, rng) -> int:
        if len(x) <= leaf or not np.ptp(x, axis=0).any():
            self.leaves += 1
            return -self.leaves
        centres, near = kmeans(x, min(BRANCH, len(x)), rng)
        used = np.unique(near)
        if len(used) == 1:
            self.leaves += 1
            return -self.leaves
        me = len(self.nodes)
        self.nodes.append((centres[used], []))
        self.nodes[me] = (centres[used], [self._grow(x[near == c], leaf, rng) for c in used])
        return me

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
                continue
            centres, below = self.nodes[node]
            near = ((centres**2).sum(1)[None, :] - 2 * x[rows] @ centres.T).argmin(1)
            todo += [(below[c], rows[near == c]) for c in np.unique(near)]
        return out

    def visits(self, q: np.ndarray, least: int, held: dict[int, int] | None = None, rows: int = 0) -> list[int]:
        """Leaves in the order of best-bin-first traversal: ``least`` of them, and
        more until they hold ``rows`` rows by the counts ``held``."""
        out, queue, seen = [], [(0.0, self.root)], 0
        while queue and (len(out) < least or seen < rows):
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-node - 1)
                seen += held.get(-node - 1, 0) if held else 0
                continue
            centres, below = self.nodes[node]
            for d, child in zip(((centres - q) ** 2).sum(1).tolist(), below, strict=True):
                heapq.heappush(queue, (d, child))
        return out


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a column of vectors, arrays of doubles or packed ones."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dim)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def packed(x: np.ndarray) -> pa.Array:
    """Rows as packed doubles: one value each, where an array would be 64 and more."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(x, dtype=np.float64)], pa.binary())


def augmented(x: np.ndarray, most: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(most - (x**2).sum(1), 0))[:, None]], axis=1)


def best(q: np.ndarray, x: np.ndarray, ids: np.ndarray, own: int, scores: np.ndarray, k: int):
    """Places and scores of the k best rows for one query. ``scores`` choose the candidates;
    those kept are scored again one by one, so equal vectors have equal scores."""
    use = ids != own
    if not use.any():
        return np.zeros(0, np.int64), scores[:0]
    scores = np.where(use, scores, -np.inf)
    n = min(k, int(use.sum()))
    edge = np.partition(scores, len(scores) - n)[len(scores) - n]
    at = np.flatnonzero(use & (scores >= edge - 1e-9 * max(1.0, abs(edge))))
    exact = (x[at] * q).sum(axis=1)
    order = np.lexsort((ids[at], -exact))[:n]
    return at[order], exact[order]


HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("place", pa.int64())])
HITS_DDL = "query_id long, vec_id long, score double, place long"


def _hits(queries: np.ndarray, owns: np.ndarray, x: np.ndarray, ids: np.ndarray, places: np.ndarray, k: int) -> pa.Table:
    out = []
    for a in range(0, len(queries), 256):
        scores = queries[a:a + 256] @ x.T
        for q, own, s in zip(queries[a:a + 256], owns[a:a + 256].tolist(), scores, strict=True):
            found, score = best(q, x, ids, own, s, k)
            out.append((np.full(len(found), own), ids[found], score, places[found]))
    cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0)] * 4
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, HITS, strict=True)], schema=HITS)


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """Rows with an id and a finite, non-zero vector of the table's commonest length."""
    e = F.col(vector).cast("array<double>")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = rows.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))
        & F.exists(e, lambda x: x != 0))
    sizes = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    dim = sizes[0].d if sizes else 0
    return good.where(F.size("v") == dim), dim


def search(rows: DataFrame, k: int = K, step: int = QUERY_STEP, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by
    ``step`` its ``k`` nearest of the other rows found; fewer only where there are
    fewer other rows.

    Vectors that are null, zero, of another length than most, or hold null or
    non-finite components take no part, nor do rows without an id. Rows that repeat
    an id are candidates each, but none for the query of that id; as a query an id
    counts once, with its smallest vector. Ties go to the smaller vec_id. Extra columns are ignored;
    an empty table gives an empty result."""
    spark = rows.sparkSession
    good, dim = usable(rows)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, most = good.agg(F.count("*"), F.max(norm)).first()
    if not n:
        return empty
    part = lambda size, total, seed: (F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 30))
                                      < int(min(1.0, size / total) * (1 << 30)))
    sample = matrix(good.where(part(SAMPLE, n, 0)).select("v").toArrow().column("v"), dim)
    if not len(sample):
        sample = matrix(good.limit(BRANCH).select("v").toArrow().column("v"), dim)
    tree = Tree(augmented(sample, most), int(max(BRANCH, LEAF_ROWS * len(sample) / n)))
    del sample

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("v"), dim)
            leaf = tree.leaf_of(augmented(x, most))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), packed(x), pa.array(leaf)], ["vec_id", "v", "leaf"])

    members = settle(good.mapInArrow(assign, "vec_id long, v binary, leaf long"), "ann-members")
    held = {r.leaf: r["count"] for r in members.groupBy("leaf").count().collect()}  # one row per leaf of the tree
    large = {leaf: rows for leaf, rows in held.items() if rows > SPLIT_ROWS}
    members, trees = _split(members, large, dim, most) if large else (members.select("vec_id", "v", _place("leaf").alias("place")), None)
    queries = (good.where(F.col("vec_id") % step == 0).groupBy("vec_id")
               .agg(F.min("v").alias("v"), F.count("*").alias("own")))  # own: rows of the id, no candidates
    total = queries.count()
    if not total:
        return empty

    # calibration: how many visits cover the true neighbours of some queries, drawn
    # independently of the rows that the tree was fitted on
    some = queries.where(part(CALIBRATION, total, 1)).toArrow()
    some = some if some.num_rows else queries.limit(CALIBRATION).toArrow()
    cq, cid = matrix(some.column("v"), dim), some.column("vec_id").to_numpy()

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _hits(cq, cid, matrix(b.column("v"), dim), b.column("vec_id").to_numpy(),
                             b.column("place").to_numpy(), k).to_batches()

    truth = [(r.query_id, r.place) for r in _top(members.mapInArrow(brute, HITS_DDL), k).select("query_id", "place").collect()]
    each = recall if trees is None else recall**0.5
    visit = calibrated(tree, cq, cid, [(q, place >> INNER_BITS) for q, place in truth], each)
    inner = 1 if trees is None else _inner_visits(trees, large, dict(zip(cid.tolist(), cq, strict=True)), truth, each)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("v"), dim)
            leaves = [tree.visits(q, visit, held, k + own)
                      for q, own in zip(augmented(x, 0.0), b.column("own").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), packed(x), b.column("own"), pa.array(leaves, pa.list_(pa.int64()))],
                ["vec_id", "v", "own", "leaves"])

    probes = (queries.mapInArrow(probe, "vec_id long, v binary, own long, leaves array<long>")
              .withColumn("leaf", F.explode("leaves")).drop("leaves"))
    if trees is None:
        probes = probes.select("vec_id", "v", _place("leaf").alias("place"))
    else:
        probes = _inner_probes(settle(probes, "ann-leaves"), trees, large, dim, inner, k)
    probes = settle(probes, "ann-probes")
    shape = settle(members.groupBy("place").agg(F.ceil(F.count("*") / CELL_MEMBERS).alias("mb"))
                   .join(probes.groupBy("place").agg(F.ceil(F.count("*") / CELL_QUERIES).alias("qb")), "place"), "ann-shape")
    zero, block = F.lit(0).cast("long"), lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n))
    left = (members.join(shape, "place").withColumn("m", block("mb")).withColumn("q", F.explode(F.sequence(zero, F.col("qb") - 1))))
    right = (probes.join(shape, "place")
             .withColumn("q", block("qb")).withColumn("m", F.explode(F.sequence(zero, F.col("mb") - 1))))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return HITS.empty_table()
        return _hits(matrix(b.column("v"), dim), b.column("vec_id").to_numpy(), matrix(a.column("v"), dim),
                     a.column("vec_id").to_numpy(), a.column("place").to_numpy(), k)

    cell = ("place", "m", "q")
    hits = (left.select(*cell, "vec_id", "v").groupBy(*cell)
            .cogroup(right.select(*cell, "vec_id", "v").groupBy(*cell)).applyInArrow(meet, HITS_DDL))
    return _top(hits, k).select("query_id", "rank", "vec_id", "score")


def _place(leaf: str) -> Column:
    return F.shiftleft(F.col(leaf), INNER_BITS)


def _sizes(spark: SparkSession, large: dict[int, int]) -> DataFrame:
    """Large leaves and their rows; the outer tree bounds their number."""
    return F.broadcast(spark.createDataFrame(list(large.items()), "leaf long, rows long"))


def _spread(rows: DataFrame, blocks: Column) -> DataFrame:
    return rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(blocks).cast("long") - 1)))


def _split(members: DataFrame, large: dict[int, int], dim: int, most: float) -> tuple[DataFrame, DataFrame]:
    """Members with their places, and the trees of large leaves: (leaf, tree, held), the last
    being the rows of each of its leaves."""
    sizes = _sizes(members.sparkSession, large)
    inside = members.join(sizes, "leaf")
    share = F.least(F.lit(1.0), F.lit(SPLIT_SAMPLE) / F.col("rows"))
    drawn = inside.where(F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(1 << 30)) < share * (1 << 30))

    def fit(table: pa.Table) -> pa.Table:
        x = augmented(matrix(table.column("v"), dim), most)
        tree = Tree(x, int(max(BRANCH, LEAF_ROWS * len(x) / table.column("rows")[0].as_py())))
        return pa.table({"leaf": table.column("leaf").slice(0, 1), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    trees = settle(drawn.groupBy("leaf").applyInArrow(fit, "leaf long, tree binary"), "ann-trees")

    def assign(rows: pa.Table, own: pa.Table) -> pa.Table:
        leaf = np.zeros(rows.num_rows, np.int64)
        if own.num_rows and rows.num_rows:
            leaf = pickle.loads(own.column("tree")[0].as_py()).leaf_of(augmented(matrix(rows.column("v"), dim), most))
        return pa.table({"vec_id": rows.column("vec_id"), "v": rows.column("v"),
                         "place": pa.array((rows.column("leaf").to_numpy() << INNER_BITS) + leaf)})

    blocks = F.col("rows") / SPLIT_BLOCK
    rows = inside.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.ceil(blocks).cast("long"))).select("leaf", "block", "vec_id", "v")
    placed = (rows.groupBy("leaf", "block").cogroup(_spread(trees.join(sizes, "leaf"), blocks).select("leaf", "block", "tree").groupBy("leaf", "block"))
              .applyInArrow(assign, "vec_id long, v binary, place long"))
    rest = members.join(sizes, "leaf", "left_anti").select("vec_id", "v", _place("leaf").alias("place"))
    members = settle(placed.unionByName(rest), "ann-places")
    held = (members.groupBy("place").count().select(F.shiftright("place", INNER_BITS).alias("leaf"), F.struct(
        F.col("place").bitwiseAND((1 << INNER_BITS) - 1).alias("inner"), "count").alias("c")).groupBy("leaf").agg(F.collect_list("c").alias("held")))
    return members, settle(trees.join(held, "leaf"), "ann-trees")  # as many as a tree has leaves


def _opened(own: pa.Table) -> tuple[Tree, dict[int, int]]:
    return pickle.loads(own.column("tree")[0].as_py()), {c["inner"]: c["count"] for c in own.column("held")[0].as_py()}


def _inner_visits(trees: DataFrame, large: dict[int, int], queries: dict[int, np.ndarray], truth: list[tuple[int, int]], recall: float) -> int:
    """Fewest visits within a large leaf at which the true neighbours that lie there are
    reached, for a share ``recall`` of them and of the queries each."""
    spark = trees.sparkSession
    rows = [(place >> INNER_BITS, q, place & ((1 << INNER_BITS) - 1), queries[q].tobytes()) for q, place in truth if place >> INNER_BITS in large]
    if not rows:
        return 1

    def rank(wanted: pa.Table, own: pa.Table) -> pa.Table:
        out, order, tree = [], {}, _opened(own)[0] if own.num_rows and wanted.num_rows else None
        for q, inner, v in zip(*(wanted.column(c).to_pylist() for c in ("query_id", "inner", "v")), strict=True):
            if tree is not None and q not in order:
                x = augmented(np.frombuffer(v)[None, :], 0.0)[0]
                order[q] = {leaf: at + 1 for at, leaf in enumerate(tree.visits(x, tree.leaves))}
            out.append((q, order[q][inner] if q in order else 1))
        return pa.table({"query_id": pa.array([q for q, _ in out], pa.int64()), "rank": pa.array([r for _, r in out], pa.int64())})

    wanted = spark.createDataFrame(rows, "leaf long, query_id long, inner long, v binary")
    found: dict[int, list[int]] = {}
    for r in wanted.groupBy("leaf").cogroup(trees.groupBy("leaf")).applyInArrow(rank, "query_id long, rank long").collect():
        found.setdefault(r.query_id, []).append(r["rank"])
    reached = lambda needed: sorted(needed)[max(0, int(np.ceil(recall * len(needed))) - 1)]
    return max(reached([at for each in found.values() for at in each]), reached([reached(each) for each in found.values()]))


def _inner_probes(probes: DataFrame, trees: DataFrame, large: dict[int, int], dim: int, visit: int, k: int) -> DataFrame:
    """Places that the queries visit; in a large leaf its tree says which."""
    sizes = _sizes(probes.sparkSession, large)
    asked = probes.groupBy("leaf").agg(F.ceil(F.count("*") / SPLIT_BLOCK).alias("blocks"))  # a row per leaf of the outer tree
    inside = probes.join(sizes, "leaf", "left_semi").join(F.broadcast(asked), "leaf")

    def visits(rows: pa.Table, own: pa.Table) -> pa.Table:
        ids, vectors, places = [], [], []
        tree, held = _opened(own) if own.num_rows and rows.num_rows else (None, {})
        x = matrix(rows.column("v"), dim) if rows.num_rows else np.zeros((0, dim))
        for q, i, v, own_rows, leaf in zip(augmented(x, 0.0), *(rows.column(c).to_pylist() for c in ("vec_id", "v", "own", "leaf")), strict=True):
            inner = [0] if tree is None else tree.visits(q, visit, held, k + own_rows)
            ids += [i] * len(inner)
            vectors += [v] * len(inner)
            places += [(leaf << INNER_BITS) + at for at in inner]
        return pa.table({"vec_id": pa.array(ids, pa.int64()), "v": pa.array(vectors, pa.binary()), "place": pa.array(places, pa.int64())})

    rows = inside.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks"))).select("leaf", "block", "vec_id", "v", "own")
    own = _spread(trees.join(F.broadcast(asked), "leaf"), F.col("blocks")).select("leaf", "block", "tree", "held")
    placed = rows.groupBy("leaf", "block").cogroup(own.groupBy("leaf", "block")).applyInArrow(visits, "vec_id long, v binary, place long")
    return placed.unionByName(probes.join(sizes, "leaf", "left_anti").select("vec_id", "v", _place("leaf").alias("place")))


def calibrated(tree: Tree, queries: np.ndarray, ids: np.ndarray, truth: list[tuple[int, int]], recall: float) -> int:
    """Fewest leaf visits at which the share of true neighbours in visited leaves
    reaches ``recall`` over all pairs, and for a share ``recall`` of the queries
    each; visits double until they do."""
    wanted: dict[int, list[int]] = {}
    for query, leaf in truth:
        wanted.setdefault(query, []).append(leaf)
    reached = lambda needed: sorted(needed)[max(0, int(np.ceil(recall * len(needed))) - 1)]
    most = 1
    while True:
        most = min(2 * most, tree.leaves)
        needed = []
        for q, i in zip(augmented(queries, 0.0), ids.tolist(), strict=True):
            order = {leaf: at + 1 for at, leaf in enumerate(tree.visits(q, most))}
            if i in wanted:
                needed.append([order.get(leaf, tree.leaves + 1) for leaf in wanted[i]])
        if not needed:
            return most
        least = max(reached([at for each in needed for at in each]), reached([reached(each) for each in needed]))
        if least <= most or most == tree.leaves:
            return min(least, tree.leaves)


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir, "embeddings"))
