"""N-gram Jaccard join: exact near-duplicate links by a blocked sparse matrix
product of the document x n-gram incidence.

The incidence matrix is never stored: it is cut into row chunks (documents of a
task) and column blocks (ranges of the n-gram hash).

1. *Columns.* Each chunk sends every distinct column it holds once to the task of
   the column's block, which answers with the number of documents that hold it.
   A column held by a third of all documents costs one entry per chunk.
2. *Bounds.* A document whose shared columns number less than 75 % of its size
   can link with nothing and is discarded; for the rest only the columns shared
   with others are kept (unshared ones add nothing to an overlap).
3. *Candidates.* Columns are ordered by (documents holding them, hash). Two
   documents that link share one of the first ``shared - ceil(0.75 n) + 1``
   shared columns of each (prefix bound), so only those are posted. Each posted
   column names one hub; all its documents become neighbours of that hub, which
   keeps postings linear in the group (no pairs).
4. *Product.* Overlaps are accumulated over column strips for hub x neighbours,
   in blocks of bounded size; then, only where a hub's neighbours still lie in
   several components, for those blocks of neighbours too. A block returns a
   spanning forest of its links.

Copies (equal shingle sets) are one class throughout, told apart by signatures of 128
bits. Nothing is capped: but for shingles whose hashes agree by chance (48 bits within
the two documents compared) the result is the set of components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm import text_arrays as ta
from almanac.llm.common import components, documents, join_copies, settle

CHUNK_ENTRIES = 500_000
CHUNK_ROWS = 1 << 16
KEY_BITS = 48
LOW_BITS = 40
STRIP = 2048
BLOCK_DOCS = 256
BLOCK_ENTRIES = 1_000_000
#: Entries of a column block on average, and bytes of text for one of them.
BLOCK_COLUMNS = 2_000_000
TEXT_BYTES = 6
#: Bytes of text whose columns meet in one task.
TASK_TEXT = 16 << 20

DOC, SETS, LOCAL, QUERY, REPLY = range(5)
FLOW = pa.schema([("dest", pa.int64()), ("kind", pa.int32()), ("chunk", pa.int64()), ("doc_id", pa.int64()),
                  ("key", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("payload", pa.binary())])
FLOW_DDL = "dest long, kind int, chunk long, doc_id long, key long, n long, sig binary, payload binary"
ROWS_DDL = "kind int, doc_id long, key long, n long, sig binary, set_id long, m long, shared binary"
ROWS = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()),
                  ("set_id", pa.int64()), ("m", pa.int64()), ("shared", pa.binary())])


def least_overlap(n):
    """Smallest overlap a set of n members can have with a set it links to."""
    return (75 * n + 99) // 100


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays)] + [a.nbytes for a in arrays], dtype=np.int64)
    return head.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(payload, *types) -> list[np.ndarray]:
    buf = memoryview(payload)
    sizes = np.frombuffer(buf, dtype=np.int64, count=1 + len(types))[1:]
    out, at = [], 8 * (1 + len(types))
    for size, t in zip(sizes.tolist(), types, strict=True):
        out.append(np.frombuffer(buf, dtype=t, count=size // np.dtype(t).itemsize, offset=at))
        at += size
    return out


def _segments(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of equal values, and their lengths."""
    starts = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return starts, np.diff(np.append(starts, len(sorted_values)))


def _names(sigs: np.ndarray, use: np.ndarray) -> pa.Array:
    """Signatures as 16 bytes each; null where there is no set."""
    return pa.array([s.tobytes() if u else None for s, u in zip(sigs, use.tolist(), strict=True)], pa.binary())


def _flow(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), FLOW, strict=True)],
                                      schema=FLOW)


def _chunk_rows(chunk: int, ids: list, row_keys: list, values: np.ndarray, n: np.ndarray, sigs: np.ndarray,
                block_bits: int) -> Iterator[pa.RecordBatch]:
    """What a chunk of documents sends: its documents, its distinct sets, the
    columns that it holds more than once, and one query per column block."""
    pass_on = -1 - chunk
    spread = -1 - ((np.int64(chunk) << 6) + np.arange(len(n)) % 64)  # these rows need no one place
    yield pa.RecordBatch.from_arrays(
        [pa.array(spread), pa.array(np.full(len(n), DOC, np.int32)), pa.array(spread),
         pa.concat_arrays(ids), pa.concat_arrays(row_keys), pa.array(n), _names(sigs, n > 0), pa.nulls(len(n), pa.binary())], schema=FLOW)
    keep = np.flatnonzero(n > 0)
    if not len(keep):
        return
    order = np.lexsort((sigs[keep, 1], sigs[keep, 0]))  # stable: the first of equal sets leads
    ranked = sigs[keep][order]
    first = np.sort(keep[order[np.r_[True, (ranked[1:] != ranked[:-1]).any(axis=1)]]])
    off = np.concatenate([[0], np.cumsum(n)])
    chosen = np.zeros(len(n), bool)
    chosen[first] = True
    member = np.repeat(chosen, n)
    keys = (values[member] >> np.uint64(64 - KEY_BITS)).astype(np.int64)
    idx = np.repeat(np.arange(len(first), dtype=np.uint16), n[first])
    del off, member
    yield _flow([(pass_on, SETS, chunk, None, None, None, None, _pack(sigs[first].ravel(), n[first].astype(np.int64)))])
    order = np.argsort(keys, kind="stable")
    keys, idx = keys[order], idx[order]
    starts, counts = _segments(keys)
    often = np.repeat(counts > 1, counts)
    if often.any():
        yield _flow([(pass_on, LOCAL, chunk, None, None, None, None, _pack(keys[often], idx[often]))])
    keys, idx = keys[starts], idx[starts]
    counts = np.minimum(counts, 255).astype(np.uint8)
    block = keys >> (KEY_BITS - block_bits)
    order = np.lexsort((idx, block))
    keys, idx, counts, block = keys[order], idx[order], counts[order], block[order]
    low = (keys & ((1 << LOW_BITS) - 1)).view(np.uint8).reshape(-1, 8)[:, :LOW_BITS // 8]
    starts, sizes = _segments(block)
    rows = [(int(block[a]), QUERY, chunk, None, None, None, None, _pack(low[a:a + k], idx[a:a + k], counts[a:a + k]))
            for a, k in zip(starts.tolist(), sizes.tolist(), strict=True)]
    for a in range(0, len(rows), 64):
        yield _flow(rows[a:a + 64])


def _incidence(block_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        entries = rows = 0

        def flush():
            nonlocal held, entries, rows, seq
            if held:
                ids, row_keys, values, n, sigs = zip(*held, strict=True)
                yield from _chunk_rows((part << 24) + seq, list(ids), list(row_keys), np.concatenate(values),
                                       np.concatenate(n), np.concatenate(sigs), block_bits)
                held, entries, rows, seq = [], 0, 0, seq + 1

        for batch in batches:
            for piece in ta.chunks(batch, "text"):
                values, off = ta.shingle_sets(piece.column("text"))
                if rows + piece.num_rows >= CHUNK_ROWS or entries + len(values) > CHUNK_ENTRIES:
                    yield from flush()
                held.append((piece.column("doc_id"), piece.column("key"), values, np.diff(off), ta.set_signatures(values, off)))
                entries, rows = entries + len(values), rows + piece.num_rows
        yield from flush()
    return run


def _answer(table: pa.Table) -> pa.Table:
    """One column block: for each query row the columns that several documents
    hold, with their number. Other rows pass on unchanged."""
    kind = table.column("kind").to_numpy()
    rest = table.filter(pa.array(kind != QUERY))
    queries = table.filter(pa.array(kind == QUERY))
    if not queries.num_rows:
        return rest
    chunks = queries.column("chunk").to_numpy()
    block = int(queries.column("dest")[0].as_py())
    parts = [_unpack(p.as_buffer(), np.uint8, np.uint16, np.uint8) for p in queries.column("payload")]
    sizes = [len(x[1]) for x in parts]
    keys = np.zeros((sum(sizes), 8), dtype=np.uint8)
    keys[:, :LOW_BITS // 8] = np.concatenate([x[0].reshape(-1, LOW_BITS // 8) for x in parts])
    keys = keys.view(np.int64).ravel()
    idx, counts = (np.concatenate([x[i] for x in parts]) for i in (1, 2))
    order = np.argsort(keys, kind="stable")
    starts, runs = _segments(keys[order])
    held = np.empty(len(keys), dtype=np.int64)
    held[order] = np.repeat(np.add.reduceat(counts[order].astype(np.int64), starts), runs)
    off = np.concatenate([[0], np.cumsum(sizes)])
    rows = []
    for r, chunk in enumerate(chunks.tolist()):
        at = np.flatnonzero(held[off[r]:off[r + 1]] > 1) + off[r]
        if len(at):
            rows.append((block, REPLY, chunk, None, None, None, None,
                         _pack(keys[at], held[at].astype(np.uint32), idx[at], counts[at])))
    return pa.concat_tables([rest, pa.Table.from_batches([_flow(rows)])]) if rows else rest


def _bounded(block_bits: int):
    def run(table: pa.Table) -> pa.Table:
        """One chunk: shared columns per set in global order, kept where the
        size-derived bound allows a link."""
        kind = table.column("kind").to_numpy()
        docs = table.filter(pa.array(kind == DOC))
        none = lambda t: pa.nulls(docs.num_rows, t)
        out = [pa.Table.from_arrays(
            [docs.column("kind"), docs.column("doc_id"), docs.column("key"), docs.column("n"), docs.column("sig"),
             none(pa.int64()), none(pa.int64()), none(pa.binary())], schema=ROWS)]
        payload = {k: [p.as_buffer() for p in table.filter(pa.array(kind == k)).column("payload")]
                   for k in (SETS, LOCAL)}
        if not payload[SETS]:
            return out[0]
        sigs, n = _unpack(payload[SETS][0], np.uint64, np.int64)
        sigs = sigs.reshape(-1, 2)
        chunk = int(table.column("chunk")[0].as_py())
        replies = table.filter(pa.array(kind == REPLY))
        keys, held, idx = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if replies.num_rows:
            parts = [_unpack(p.as_buffer(), np.int64, np.uint32, np.uint16, np.uint8) for p in replies.column("payload")]
            high = np.repeat(replies.column("dest").to_numpy() >> max(0, block_bits - (KEY_BITS - LOW_BITS)),
                             [len(x[0]) for x in parts])
            low, h, i, counts = (np.concatenate([x[j] for x in parts]).astype(np.int64) for j in range(4))
            full = (high << LOW_BITS) | low
            once = counts == 1
            keys, held, idx = full[once], h[once], i[once]
            if payload[LOCAL]:
                often, oheld = full[~once], h[~once]
                order = np.argsort(often)
                often, oheld = often[order], oheld[order]
                lk, li = _unpack(payload[LOCAL][0], np.int64, np.uint16)
                keys = np.concatenate([keys, lk])
                held = np.concatenate([held, oheld[np.searchsorted(often, lk)]])
                idx = np.concatenate([idx, li.astype(np.int64)])
        m = np.bincount(idx, minlength=len(n))
        alive = m >= least_overlap(n)
        use = alive[idx]
        keys, held, idx = keys[use], held[use], idx[use]
        order = np.lexsort((keys, held, idx))
        keys, at = keys[order], np.flatnonzero(alive)
        off = np.concatenate([[0], np.cumsum(m[at])])
        shared = [keys[a:b].tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        out.append(pa.Table.from_arrays(
            [pa.array(np.full(len(at), SETS, np.int32)), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64()), pa.array(n[at]),
             _names(sigs[at], np.ones(len(at), bool)), pa.array((chunk << 16) + at), pa.array(m[at]),
             pa.array(shared, pa.binary())], schema=ROWS))
        return pa.concat_tables(out)
    return run


POSTS = pa.schema([("col", pa.int64()), ("set_id", pa.int64()), ("unshared", pa.float64())])


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix columns of each set."""
    for batch in batches:
        n, m, ids = (batch.column(c).to_numpy() for c in ("n", "m", "set_id"))
        prefix = m - least_overlap(n) + 1
        cols = [np.frombuffer(s.as_buffer(), dtype=np.int64, count=int(p))
                for s, p in zip(batch.column("shared"), prefix, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(cols) if cols else np.zeros(0, np.int64)),
             pa.array(np.repeat(ids, prefix)), pa.array(np.repeat(1 - m / n, prefix))], schema=POSTS)


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of two lists of sets: dense strips of the sparse incidence,
    accumulated strip by strip."""
    every = np.concatenate(left + right) if left or right else np.zeros(0, np.int64)
    cols, place = np.unique(every, return_inverse=True)
    split = sum(map(len, left))
    lrow = np.repeat(np.arange(len(left)), [len(x) for x in left])
    rrow = np.repeat(np.arange(len(right)), [len(x) for x in right])
    lcol, rcol = place[:split], place[split:]
    both = np.zeros(len(cols), dtype=np.int64)
    both[lcol] = 1
    two = np.zeros(len(cols), dtype=np.int64)
    two[rcol] = 1
    live = (both & two).astype(bool)
    new = np.cumsum(live) - 1
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    sides = []
    for row, col in ((lrow, lcol), (rrow, rcol)):
        use = live[col]
        row, col = row[use], new[col[use]]
        order = np.argsort(col, kind="stable")
        sides.append((row[order], col[order]))
    for a in range(0, int(live.sum()), STRIP):
        strips = []
        for (row, col), height in zip(sides, (len(left), len(right)), strict=True):
            x, y = np.searchsorted(col, (a, a + STRIP))
            dense = np.zeros((height, STRIP), dtype=np.float32)
            dense[row[x:y], col[x:y] - a] = 1
            strips.append(dense)
        total += strips[0] @ strips[1].T
    return total.astype(np.int64)


def _product(table: pa.Table) -> pa.Table:
    """One block of the product: a spanning forest of the links between the left
    and right sets that lie in different components."""
    side, ids, n, comp = (table.column(c).to_numpy() for c in ("side", "set_id", "n", "component"))
    sets = [np.frombuffer(s.as_buffer(), dtype=np.int64) for s in table.column("shared")]
    right = np.flatnonzero(side == 1)
    left = np.flatnonzero(side == 0)
    if not len(right):
        right = left
    bound = 100 * np.minimum.outer(n[left], n[right]) >= 75 * np.maximum.outer(n[left], n[right])
    bound &= comp[left][:, None] != comp[right][None, :]
    left, right, bound = left[bound.any(1)], right[bound.any(0)], bound[np.ix_(bound.any(1), bound.any(0))]
    if not len(left):
        return LINKS.empty_table()
    o = overlaps([sets[i] for i in left], [sets[i] for i in right])
    hit = bound & (100 * o >= 75 * (n[left][:, None] + n[right][None, :] - o))
    root = {int(c): int(c) for c in comp}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    found = []
    for i, j in np.argwhere(hit).tolist():
        x, y = top(int(comp[left[i]])), top(int(comp[right[j]]))
        if x != y:
            root[max(x, y)] = min(x, y)
            found.append((int(ids[left[i]]), int(ids[right[j]])))
    if not found:
        return LINKS.empty_table()
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=LINKS)


def _links(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Links found in ``cells(cell, side, set_id, component)``."""
    rows = cells.join(sets.select("set_id", "n", "shared"), "set_id")
    return (rows.select("cell", "side", "set_id", "n", "component", "shared")
            .groupBy("cell").applyInArrow(_product, "a long, b long"))


def resolved(near: DataFrame, sets: DataFrame) -> DataFrame:
    """Components (node, component) of the sets that link, from candidate groups
    ``near(hub, set_id)``: any two sets that may link are neighbours of one hub, or
    one is the other's hub. ``sets(set_id, n, m, shared)``: size, members given and
    the members as packed int64."""
    # hub x neighbours
    sizes = (near.join(sets.select("set_id", "m"), "set_id").groupBy("hub")
             .agg(_blocks(F.count("*"), F.sum("m")).alias("blocks")))
    placed = near.join(sizes, "hub").withColumn("block", F.pmod(F.xxhash64("set_id"), "blocks"))
    cell = F.xxhash64("hub", "block").alias("cell")
    stars = placed.select(cell, F.lit(1).alias("side"), "set_id", F.col("set_id").alias("component")).unionAll(
        placed.select("hub", "block").distinct()
        .select(cell, F.lit(0).alias("side"), F.col("hub").alias("set_id"), F.col("hub").alias("component")))
    links = settle(_links(stars, sets), "ngram-links")
    first = components(links)

    # neighbours x neighbours where components still differ
    label = lambda df, key: (df.join(first.select(F.col("node").alias(key), F.col("component").alias(f"{key}_c")),
                                     key, "left").withColumn(f"{key}_c", F.coalesce(f"{key}_c", key)))
    marked = label(label(near, "set_id"), "hub").withColumn("out", F.col("set_id_c") != F.col("hub_c"))
    # a hub whose neighbours outside its own component form one set with no inside one needs no block
    marked = settle(marked.join(sets.select("set_id", "m"), "set_id"), "ngram-marked")
    shape = marked.groupBy("hub").agg(
        F.count_if("out").alias("outs"), F.count("*").alias("all"),
        _blocks(F.count_if("out"), F.sum(F.when(F.col("out"), F.col("m")).otherwise(0))).alias("bo"),
        _blocks(F.count_if(~F.col("out")), F.sum(F.when(~F.col("out"), F.col("m")).otherwise(0))).alias("bi"),
    ).where("outs > 0 and all > 1")
    split = marked.join(shape, "hub").withColumn(
        "block", F.pmod(F.xxhash64("set_id"), F.when(F.col("out"), F.col("bo")).otherwise(F.col("bi"))))
    seq = lambda a, b: F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))
    zero = F.lit(0).cast("long")
    outs, ins = split.where("out"), split.where("not out")
    pair = lambda df, kind, x, y, side: df.select(
        F.xxhash64("hub", F.lit(kind), x, y).alias("cell"), F.lit(side).alias("side"), "set_id",
        F.col("set_id_c").alias("component"))
    block = F.col("block")
    cells = (pair(outs.withColumn("o", F.explode(seq(block, F.col("bo") - 1))), "out", block, F.col("o"), 0)
             .unionAll(pair(outs.withColumn("o", F.explode(seq(zero, block - 1))), "out", F.col("o"), block, 1))
             .unionAll(pair(outs.withColumn("o", F.explode(seq(zero, F.col("bi") - 1))), "in", block, F.col("o"), 0))
             .unionAll(pair(ins.withColumn("o", F.explode(seq(zero, F.col("bo") - 1))), "in", F.col("o"), block, 1)))
    more = _links(cells, sets)
    return components(links.unionAll(more))


def near_duplicates(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """Components of documents whose 5-word shingle sets have Jaccard >= 0.75.

    Takes ``doc_id long, text string`` (other columns are ignored). Returns one row
    per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by
    links), component (a name of the component that holds also where doc_ids repeat;
    null without shingles) and key (a long of the caller's that tells rows apart). Null or wordless text: no shingles, linked with nothing, component_id
    is the row's own doc_id. Fewer than five words: the whole sequence is the one
    shingle. Texts of any length are read whole, one chunk of documents at a time.
    Repeated rows and equal texts are one class and link. A null doc_id
    is ignored by the minimum (a component of only such rows has a null id). An
    empty table gives an empty result."""
    # columns, less than one per two bytes, in blocks that hold so many on average
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    bits = min(LOW_BITS, max(KEY_BITS - LOW_BITS, (size // TEXT_BYTES // BLOCK_COLUMNS).bit_length()))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (F.lit(None) if key is None else key).cast("long").alias("key"))
    tasks = size // TASK_TEXT + 1
    flow = text.mapInArrow(_incidence(bits), FLOW_DDL).repartition(tasks, "dest")
    replied = flow.groupBy("dest").applyInArrow(_answer, FLOW_DDL).repartition(tasks, "chunk")
    rows = settle(replied.groupBy("chunk").applyInArrow(_bounded(bits), ROWS_DDL), "ngram-rows")
    documents_ = rows.where(F.col("kind") == DOC).select("doc_id", "key", "n", "sig")
    every = rows.where(F.col("kind") == SETS)
    # one set per class of copies
    chosen = every.groupBy("sig").agg(F.min("set_id").alias("set_id")).select("set_id")
    sets = settle(every.join(chosen, "set_id", "left_semi").select("set_id", "sig", "n", "m", "shared"), "ngram-sets")

    posts = sets.mapInArrow(_post, "col long, set_id long, unshared double")
    hubs = (posts.groupBy("col").agg(F.count("*").alias("k"), F.min(F.struct("unshared", "set_id")).alias("h"))
            .where("k > 1").select("col", F.col("h.set_id").alias("hub")))
    near = settle(posts.select("col", "set_id").join(hubs, "col").where("set_id <> hub")
                  .select("hub", "set_id").distinct(), "ngram-neighbours")

    found = resolved(near, sets)

    # classes of copies -> components of documents
    classes = documents_.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    linked = settle(sets.join(found, sets.set_id == found.node).select("sig", "component").join(classes, "sig"), "ngram-linked")
    lowest = settle(linked.groupBy("component").agg(F.min("least").alias("lowest"), F.count("*").alias("sets")), "ngram-lowest")
    linked = join_copies(linked, lowest, "component", "sets").select("sig", "component", "lowest")
    named = settle(classes.join(linked, "sig", "left").select(
        "sig", "copies", F.coalesce("lowest", "least").alias("component_id"),
        F.coalesce(F.concat(F.lit("linked "), "component"), F.concat(F.lit("alone "), F.hex("sig"))).alias("component")), "ngram-names")
    return (join_copies(documents_, named, "sig", "copies")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    "component", "key"))


def _blocks(count, entries):
    return F.greatest(F.ceil(count / BLOCK_DOCS), F.ceil(entries / BLOCK_ENTRIES)).cast("long")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, then the
    smallest hash of the text; identical (doc_id, text) rows stay once. Rows without
    shingles stay."""
    row_key = F.xxhash64("doc_id", "text")
    near = near_duplicates(docs, row_key)
    keep = (near.where("component is not null").groupBy("component")
            .agg(F.min(F.struct("doc_id", "key")).alias("kept")).select("kept.*")
            .unionByName(near.where("component is null").select("doc_id", "key").distinct()))
    keep = settle(keep.select(F.col("key").alias("_kept_key"), F.col("doc_id").alias("_kept_id")), "ngram-kept")
    rows = docs.withColumn("_kept_key", row_key).withColumn("_kept_id", F.col("doc_id").cast("long"))
    one = Window.partitionBy("_kept_key").orderBy("_kept_id")
    same = (rows["_kept_key"] == keep["_kept_key"]) & rows["_kept_id"].eqNullSafe(keep["_kept_id"])
    return (rows.join(keep, same, "left_semi").withColumn("_kept_place", F.row_number().over(one))
            .where("_kept_place = 1").select(*docs.columns))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("key", "component")


#: The same rows by joining all shingles, for small tables.
OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s FROM words),
classes AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
grams AS (SELECT rep, n, unnest(s) AS g FROM classes),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM grams a JOIN grams b ON a.g = b.g AND a.rep < b.rep
   AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS node, rep AS least FROM classes
  UNION SELECT e.b, r.least FROM reach r JOIN both_ways e ON e.a = r.node),
named AS (SELECT node, min(least) AS component FROM reach GROUP BY node)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(n.component, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes c ON len(d.s) > 0 AND c.s = d.s LEFT JOIN named n ON n.node = c.rep
"""
