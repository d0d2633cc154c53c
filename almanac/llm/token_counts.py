"""Token counts by rank-synchronous merging over ragged numpy arrays.

The model is a byte-fallback BPE whose pieces hold the word mark only at their
start, so text falls into pre-tokens (marks followed by other characters) that
never merge across. All distinct pre-tokens of a batch stand in one flat symbol
array; in each round every sequence applies its lowest-rank, leftmost pair at
once, until none is left. What survives is counted: a known symbol is one token,
an unknown character one token per UTF-8 byte.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import text_arrays as ta
from almanac.llm.common import documents

MARK = 0x2581
LIMIT = 4096
#: Pre-tokens kept with their counts by each Python worker.
MEMO = 1 << 20
#: Longer sequences merge through a priority queue: there a round per merge over the
#: whole array would cost the square of the length.
LONG = 1024
_NONE = np.int64(1 << 62)


class Merges:
    """Symbols, pair ranks and token counts of a sentencepiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                plain[sp.id_to_piece(i)] = sp.get_score(i)
        self.symbol = {p: i for i, p in enumerate(plain)}
        for p in plain:
            for c in p:
                self.symbol.setdefault(c, len(self.symbol))
        self.size = len(self.symbol) + 1  # the last stands for characters of no piece
        other = self.size - 1
        self.of_char = np.full(0x110000, other, dtype=np.int32)
        self.tokens = np.ones(self.size, dtype=np.int64)
        for s, i in self.symbol.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
            if s not in plain:
                self.tokens[i] = len(s.encode())
        rank_of = {score: r for r, score in enumerate(sorted(set(plain.values()), reverse=True))}
        pairs = {}
        for p, score in plain.items():
            for cut in range(1, len(p)):
                a, b = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = (rank_of[score], self.symbol[p])
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.rank = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int64)
        self.into = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)
        marks = [p for p in plain if chr(MARK) in p.lstrip(chr(MARK))]
        if marks:
            raise ValueError(f"pieces with an inner word mark can't be split into pre-tokens: {marks[:3]}")

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (_NONE if it doesn't merge) and its place in the table."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE), at


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def utf8_bytes(code_points: np.ndarray) -> np.ndarray:
    return 1 + (code_points >= 0x80) + (code_points >= 0x800) + (code_points >= 0x10000).astype(np.int64)


def merged_counts(model: Merges, chars: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Surviving tokens of each sequence ``chars[off[i]:off[i + 1]]`` of code points."""
    n = len(off) - 1
    sym = model.of_char[chars].astype(np.int64)
    unknown = sym == model.size - 1
    extra = np.concatenate([[0], np.cumsum(np.where(unknown, utf8_bytes(chars) - 1, 0))])
    total = extra[off[1:]] - extra[off[:-1]]
    length = np.diff(off)
    for i in np.flatnonzero(length > LONG).tolist():
        total[i] += _long_count(model, sym[off[i]:off[i + 1]].tolist())
    seq = np.repeat(np.arange(n), length)
    use = (length <= LONG)[seq]
    sym, seq = sym[use], seq[use]
    rank = np.full(len(sym), _NONE)
    into = np.zeros(len(sym), dtype=np.int64)

    def look(at: np.ndarray) -> None:
        inside = (at >= 0) & (at + 1 < len(sym))
        at = at[inside]
        at = at[seq[at] == seq[at + 1]] if len(at) else at
        r, t = model.lookup(sym[at], sym[at + 1])
        rank[at], into[at] = r, model.into[t]

    look(np.arange(len(sym)))
    while len(sym):
        starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
        # lowest rank, leftmost: one minimum over (rank, place)
        code = np.where(rank < _NONE, (rank << 32) | np.arange(len(sym)), _NONE)
        best = np.minimum.reduceat(code, starts)
        merging = best < _NONE
        if not merging.all():  # finished sequences leave
            ends = np.append(starts[1:], len(sym))
            done = np.repeat(~merging, ends - starts)
            np.add.at(total, seq[done], model.tokens[sym[done]])
            shift = np.cumsum(done)[starts[merging]] if merging.any() else 0
            sym, seq, rank, into = sym[~done], seq[~done], rank[~done], into[~done]
            if not len(sym):
                break
            best = best[merging] - shift
        at = best & 0xFFFFFFFF
        sym[at] = into[at]
        stay = np.ones(len(sym), dtype=bool)
        stay[at + 1] = False
        at = at - np.arange(len(at))  # one symbol of each earlier sequence goes
        sym, seq, rank, into = sym[stay], seq[stay], rank[stay], into[stay]
        rank[at] = _NONE
        look(at)
        before = at - 1
        before = before[before >= 0]
        before = before[seq[before] == seq[before + 1]] if len(before) else before
        rank[before] = _NONE
        look(before)
    return total


def _long_count(model: Merges, sym: list[int]) -> int:
    """The same merges for one long sequence, through a queue of (rank, place)."""
    n = len(sym)
    after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    queue: list[tuple[int, int, int, int]] = []

    def push(i: int) -> None:
        j = after[i]
        if j < n and (hit := model.pairs.get(sym[i] * model.size + sym[j])):
            heapq.heappush(queue, (hit[0], i, sym[i], sym[j]))

    for i in range(n):
        push(i)
    while queue:
        _, i, a, b = heapq.heappop(queue)
        j = after[i]
        if not live[i] or sym[i] != a or j >= n or sym[j] != b:
            continue
        sym[i] = model.pairs[a * model.size + b][1]
        live[j], after[i] = False, after[j]
        if after[i] < n:
            before[after[i]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return int(model.tokens[[s for s, x in zip(sym, live, strict=True) if x]].sum())


def distinct_spans(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one span of each kind, and the kind of every span. ``chars`` is covered
    by the spans. Hashes group them; the characters are compared with those of the one
    that stands for the kind, so that no two words pass for one."""
    _, where, back = np.unique(ta.span_hashes(chars, starts, ends), return_index=True, return_inverse=True)
    length, one = ends - starts, where[back]
    if (length == length[one]).all():
        shift = np.repeat(starts[one] - starts, length)
        if (chars[np.arange(len(chars)) + shift] == chars).all():
            return where, back
    raw, kinds, where = chars.tobytes(), {}, []
    back = np.empty(len(starts), dtype=np.int64)
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        name = raw[a * chars.itemsize:b * chars.itemsize]
        back[i] = kinds.setdefault(name, len(kinds))
        if back[i] == len(where):
            where.append(i)
    return np.array(where, dtype=np.int64), back


def counts_of(model: Merges, texts: list[str], memo: dict[bytes, int]) -> np.ndarray:
    """Tokens of each text (mark in front of any non-empty text, space as mark)."""
    n_chars = np.array([len(t) + bool(t) for t in texts], dtype=np.int64)
    off = np.concatenate([[0], np.cumsum(n_chars)])
    joined = "".join(chr(MARK) + t for t in texts if t)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    if not len(chars):
        return np.zeros(len(texts), dtype=np.int64)
    chars[chars == 0x20] = MARK
    mark = chars == MARK
    first = mark.copy()
    first[1:] &= ~mark[:-1]
    first[off[:-1][n_chars > 0]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(chars))
    where, back = distinct_spans(chars, starts, ends)
    raw = chars.tobytes()
    names = [raw[4 * a:4 * b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
    known = np.array([memo.get(name, -1) for name in names], dtype=np.int64)
    new = np.flatnonzero(known < 0)
    if len(new):
        a, b = starts[where[new]], ends[where[new]]
        inner = np.concatenate([[0], np.cumsum(b - a)])
        flat = chars[np.repeat(a - inner[:-1], b - a) + np.arange(inner[-1])]
        known[new] = merged_counts(model, flat, inner)
        short = [i for i in new.tolist() if len(names[i]) <= 4 * LONG]
        if len(memo) + len(short) > MEMO:
            memo.clear()
        memo.update((names[i], int(known[i])) for i in short)
    sums = np.concatenate([[0], np.cumsum(known[back])])
    place = np.searchsorted(starts, off)
    return sums[place[1:]] - sums[place[:-1]]


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for each row of ``docs(doc_id, text)``.

    Null and empty texts have no tokens; texts of any length are counted whole. Repeated rows stay repeated, a null doc_id
    stays null, extra columns are ignored, an empty table gives an empty result."""
    import public_tokenizers
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memo = merges(path), {}
        for batch in batches:
            for piece in ta.chunks(batch, "text"):
                texts = [t or "" for t in piece.column("text").to_pylist()]
                n_bytes = np.diff(ta.utf8(piece.column("text"))[1])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(n_bytes), pa.array(counts_of(model, texts, memo))], schema=SCHEMA)

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (text.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
