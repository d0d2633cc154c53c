"""Spelling variant grouping: FM-index search schemes over the vocabulary.

A word within one edit of another keeps one of its halves: either its left half
stands at the start of the other and the error lies right of it, or its right half
stands at the end and the error lies left. Every word is therefore posted under its
halves; words of one half meet in one cell, and each cell builds an index of its
delimited words. The search matches a half exactly and extends across the other,
allowing one error, on intervals of suffix ranks. The scheme runs in both directions
on a pair of indexes: one over the reversed words (extends to the right), one over
the words as they are (extends to the left).

A search inserts or replaces; what it finds by insertion counts for both words, so
no deletions are searched. Cells give one row per word, with the number of its near
words and the best of them: pairs never leave a cell. A half that very many words
share is dealt to several cells, which each of its words asks in turn.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import documents, settle

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: One run in so many loses a code point.
DAMAGE = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: Words of a cell on average, and the most that one half brings to a cell.
CELL_WORDS = 8192
HALF_WORDS = 32_768
#: Distinct words that a task holds before it passes them on.
HELD = 200_000


def damaged(run: str, doc: bytes) -> str:
    """The run as it counts in a document: some lose a code point."""
    h = zlib.crc32(run.encode(), zlib.crc32(doc + b":"))
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return batch

    for batch in batches:
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
            # lower() of bytes knows A-Z only
            for run, n in Counter(RUN.findall((text.as_py() or "").encode().lower().decode())).items():
                word = damaged(run, (doc or "").encode())
                if len(word) >= LEAST_LENGTH:
                    held[word] += n
            if len(held) > HELD:
                yield out()
    if held:
        yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """Distinct words of at least LEAST_LENGTH code points with their number of
    occurrences ``n``, LEAST_COUNT at least. Null and empty texts have none; a null
    doc_id is the empty string in the damage; repeated rows count each; texts of any
    length are read whole. Extra columns are ignored."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc"), F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling."""
    rank, step = text.astype(np.int64), 1
    while True:
        key = rank * (len(text) + 257)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.ones(len(text), dtype=np.int64)
        new[0] = 0
        new[1:] = key[order[1:]] != key[order[:-1]]
        new = np.cumsum(new)
        if new[-1] == len(text) - 1 or step >= len(text):
            return order
        rank = np.empty_like(rank)
        rank[order] = new
        step = min(2 * step, len(text))


class Index:
    """FM-index of distinct words, read from their first symbol on: the text holds
    them reversed with a delimiter (0) around each, so a backward step goes one symbol
    to the right. Ranks come from one sorted list of (symbol, place in the transform)."""

    def __init__(self, flat: np.ndarray, off: np.ndarray):
        n, length = len(off) - 1, np.diff(off)
        text = np.zeros(len(flat) + n + 1, dtype=np.uint8)
        place = np.arange(len(flat)) - np.repeat(off[:-1], length)
        ends = off[1:] + np.arange(1, n + 1)  # delimiter behind each reversed word
        text[np.repeat(ends, length) - 1 - place] = flat
        order = suffix_array(text)
        self.size = len(text)
        bwt = text[order - 1]
        by_symbol = np.argsort(bwt, kind="stable")
        self.bwt = bwt
        self.ranks = bwt[by_symbol].astype(np.int64) * self.size + by_symbol
        self.symbols = np.unique(flat)
        self.start = (0, n + 1)  # the interval of the delimiter
        # a delimiter's row tells the word that follows it in the text
        self.word = np.searchsorted(ends, order[:n + 1], side="right")

    def step(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = symbol.astype(np.int64) * self.size
        return np.searchsorted(self.ranks, base + lo), np.searchsorted(self.ranks, base + hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, symbol) of every extension by a symbol other than the delimiter."""
        width = hi - lo
        wide = np.flatnonzero(width > len(self.symbols))
        state, symbol = np.repeat(wide, len(self.symbols)), np.tile(self.symbols, len(wide))
        narrow = np.flatnonzero(width <= len(self.symbols))
        many = width[narrow]
        inner = np.concatenate([[0], np.cumsum(many)])
        seen = self.bwt[np.repeat(lo[narrow] - inner[:-1], many) + np.arange(inner[-1])]
        pairs = np.unique(np.repeat(narrow, many) * 256 + seen)
        pairs = pairs[pairs % 256 > 0]
        return np.concatenate([state, pairs // 256]), np.concatenate([symbol, (pairs % 256).astype(np.uint8)])


def near_pairs(flat: np.ndarray, off: np.ndarray, exact: np.ndarray, asks: np.ndarray, indexed: np.ndarray,
               second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(word, found): indexed words that one replaced or inserted symbol behind the
    first ``exact`` symbols makes of each asking word. ``second`` leaves out what the
    search from the other end finds: insertions that keep all symbols behind them."""
    length = np.diff(off)
    held = np.flatnonzero(indexed)
    inner = np.concatenate([[0], np.cumsum(length[held])])
    index = Index(flat[np.repeat(off[held] - inner[:-1], length[held]) + np.arange(inner[-1])], inner)
    at = lambda q, i: flat[off[q] + i]
    q0 = np.flatnonzero(asks)
    lo0, hi0 = (np.full(len(q0), x, dtype=np.int64) for x in index.start)
    none = np.zeros(0, np.int64)
    q1, lo1, hi1 = none, none, none
    same = np.ones(len(length), dtype=bool)  # all symbols since the exact part are equal
    words, found = [], []
    i = 0
    while len(q0) or len(q1):
        later = (none, none, none)
        b = np.flatnonzero(exact[q0] <= i)
        if len(b):
            q, lo, hi = q0[b], lo0[b], hi0[b]
            s, c = index.branches(lo, hi)
            new_lo, new_hi = index.step(lo[s], hi[s], c)
            live = new_lo < new_hi
            s, c, new_lo, new_hi = s[live], c[live], new_lo[live], new_hi[live]
            owner = q[s]
            inside = i < length[owner]
            other = np.ones(len(owner), dtype=bool)
            other[inside] = at(owner[inside], i) != c[inside]
            replaced = inside & other
            later = (owner[replaced], new_lo[replaced], new_hi[replaced])
            if second:
                first = exact[owner] == i
                run = same[owner] & ~first
                run[run] = at(owner[run], exact[owner[run]]) == c[run]
                other &= ~(first | run)
            q1, lo1, hi1 = (np.concatenate(x) for x in ((q1, owner[other]), (lo1, new_lo[other]), (hi1, new_hi[other])))
        # words at their end close with the delimiter, the rest reads its next symbol
        done = length[q1] == i
        if done.any():
            lo, hi = index.step(lo1[done], hi1[done], np.zeros(int(done.sum()), np.uint8))
            hit = lo < hi
            words.append(q1[done][hit])
            found.append(held[index.word[lo[hit]]])
        q1, lo1, hi1 = q1[~done], lo1[~done], hi1[~done]
        lo1, hi1 = index.step(lo1, hi1, at(q1, i))
        go = lo1 < hi1
        q1, lo1, hi1 = (np.concatenate(x) for x in zip((q1[go], lo1[go], hi1[go]), later, strict=True))
        go = length[q0] > i
        q0, lo0, hi0 = q0[go], lo0[go], hi0[go]
        lo0, hi0 = index.step(lo0, hi0, at(q0, i))
        past = q0[exact[q0] < i]
        same[past] &= at(past, i) == at(past, exact[past])
        go = lo0 < hi0
        q0, lo0, hi0 = q0[go], lo0[go], hi0[go]
        i += 1
    return (np.concatenate(words), np.concatenate(found)) if words else (none, none)


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
NEAR_DDL = "word string, n_near long, best_n long, best string"


def _cell(table: pa.Table) -> pa.Table:
    """One cell: near words of its words, one row per word that has any."""
    from_right = table.column("from_right")[0].as_py()
    text = table.column("word").to_pylist()
    words = sorted(set(text))
    place = {w: i for i, w in enumerate(words)}
    at = np.array([place[w] for w in text], dtype=np.int64)
    n, asks, indexed = np.zeros(len(words), np.int64), np.zeros(len(words), bool), np.zeros(len(words), bool)
    n[at] = table.column("n").to_numpy()
    asks[at[table.column("asks").to_numpy()]] = True
    indexed[at[table.column("indexed").to_numpy()]] = True
    if not indexed.any():
        return NEAR.empty_table()
    raw = [w.encode("latin-1") for w in words]
    raw = [w[::-1] for w in raw] if from_right else raw
    off = np.concatenate([[0], np.cumsum([len(w) for w in raw])]).astype(np.int64)
    length = np.diff(off)
    left = length // 2
    word, found = near_pairs(np.frombuffer(b"".join(raw), np.uint8), off, length - left if from_right else left, asks, indexed, from_right)
    if not len(word):
        return NEAR.empty_table()
    grown = length[found] > length[word]
    of, near = np.concatenate([word, found[grown]]), np.concatenate([found, word[grown]])
    order = np.lexsort((near, -n[near], of))
    of, near = of[order], near[order]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    many = np.diff(np.append(first, len(of)))
    name = pa.array(words, pa.string())
    return pa.Table.from_arrays([name.take(pa.array(of[first])), pa.array(many), pa.array(n[near[first]]),
                                 name.take(pa.array(near[first]))], schema=NEAR)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of ``words(word, n)`` that have near words: their
    number, and the near word of largest n (ties: smallest in code-point order)."""
    size, left = F.length("word"), (F.length("word") / 2).cast("int")
    shorter = ((F.length("word") - 1) / 2).cast("int")  # left half of a partner one symbol shorter
    post = lambda length, half, right, asks: F.struct(
        F.xxhash64(length, half, F.lit(right)).alias("half"), F.lit(right).alias("from_right"), F.lit(asks).alias("asks"))
    cut = lambda start, n: F.substring(F.col("word"), start, n)
    posts = words.select("word", "n", F.explode(F.array(
        post(size, cut(F.lit(1), left), False, True),
        post(size - 1, cut(F.lit(1), shorter), False, False),
        post(size, cut(left + 1, size - left), True, True),
        post(size - 1, cut(size - (size - 1 - shorter) + 1, size - 1 - shorter), True, False))).alias("p")).select("word", "n", "p.*")
    posts = settle(posts, "spelling-posts")
    # halves that many words share: fewer than posts / HALF_WORDS of them
    heavy = (posts.groupBy("half").count().where(F.col("count") > HALF_WORDS)
             .select("half", F.ceil(F.col("count") / HALF_WORDS).alias("parts")))
    total = posts.count()
    cells = max(1, -(-total // CELL_WORDS))
    dealt = posts.join(F.broadcast(heavy), "half", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    own = F.pmod(F.xxhash64("word"), F.col("parts"))
    dealt = (dealt.withColumn("own", own)
             .withColumn("part", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array("own"))))
             .select("word", "n", "from_right", "asks", (F.col("part") == F.col("own")).alias("indexed"), "half", "part", "parts"))
    # light halves share cells, parts of a heavy one stand alone: a word meets another in one place per direction
    alone = F.col("parts") > 1
    dealt = dealt.select("word", "n", "from_right", "asks", "indexed",
                         F.when(alone, F.col("half")).otherwise(F.pmod("half", F.lit(cells))).alias("cell"),
                         F.when(alone, F.col("part")).otherwise(-1).alias("part"))
    found = dealt.groupBy("from_right", "cell", "part").applyInArrow(_cell, NEAR_DDL)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms(word, form)``: the last word that forms lead to. A
    form's n at least doubles, so paths have no cycle and are short; they are
    followed by doubling."""
    ways = settle(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = settle(ways.join(onward, "root", "left")
                      .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-forms")
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of ``vocabulary(docs)``.

    ``form`` is the near word of largest n (ties: smallest in code-point order) if its
    n is at least twice the word's, else null; ``root`` follows forms to the last word.
    Null, empty and very long texts, repeated rows and extra columns as in
    ``vocabulary``; an empty table gives an empty result."""
    words = settle(vocabulary(docs), "spelling-words")
    near = settle(near_words(words), "spelling-near")
    taken = F.col("best_n") >= 2 * F.col("n")
    rows = settle(words.join(near, "word", "left").select(
        "word", F.when(taken, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("best_n")).alias("form_n")), "spelling-rows")
    found = roots(rows.where("form is not null"))
    return (rows.join(found, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir))
