"""Conversation structure repair by Four-Russians block tables.

The cheapest edits that give a conversation the roles ``(s?(ua)+)?`` are a shortest
path through (rows read, role state). Seen from the end, a column of it is a vector
of four costs to go. Less its minimum such a vector is one of few, so the step over a
block of rows is a table: (vector behind the block, block's symbols) gives the vector
before it and the cost that is added. The tables are computed once, for every block of
BLOCK symbols. A conversation is read backward block by block through them, with one
vector kept per block; then block after block is expanded backward to the vectors of
its rows, and the path is traced forward. With the costs to go at hand the least
letter of all cheapest edits is taken at each step, so ties need no search.

In Spark: rows that are equal in (conversation, turn, role, text) become one with a
number of copies, and small facts about them (a symbol, no text) are range-sorted and
packed to one byte a row before they meet in a task per conversation. The texts pass
once, sorted, through the task that knows their edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import documents, settle

BLOCK = 4
#: Costs of the edits; an undeleted truncated row costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state behind a kept row, by role class (system, user, assistant, other) and state.
KEEP = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
#: The state behind a row that is rerolled or inserted: only one role fits.
TURN = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Symbols: 0 must go, 1 + 2 * class + truncated, PAD changes nothing.
PAD = 9
SYMBOLS = 10
FINE, BLANK, DUPLICATE, CUT = range(4)
#: Space and 0x09-0x0D.
WHITE = " \t\n\x0b\x0c\r"


def _inserted(costs: list[float]) -> tuple:
    """Costs to go when rows may be inserted first."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[TURN[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


END = _inserted([0, float("inf"), float("inf"), 0])


def _choices(symbol: int, after: tuple, state: int) -> list[tuple[str, float, int]]:
    """(letter, cost to go, state behind it) of the edits of one row, in the order of
    their letters."""
    out = [("D", DELETE + after[state], state)]
    if symbol:
        extra = TRUNCATED * ((symbol - 1) % 2)
        to = KEEP[(symbol - 1) // 2].get(state)
        if to is not None:
            out.append(("K", extra + after[to], to))
        out.append(("R", REROLE + extra + after[TURN[state]], TURN[state]))
    return out


def _before(symbol: int, after: tuple) -> tuple:
    if symbol == PAD:
        return after
    return _inserted([min(c for _, c, _ in _choices(symbol, after, s)) for s in range(4)])


class Tables:
    """Vectors of costs to go less their minimum, the steps over a symbol and over a
    block, and the letters that a row takes."""

    def __init__(self):
        known, self.vectors = {END: 0}, [END]
        step, added = [], []
        for vector in self.vectors:  # grows
            to, more = [], []
            for symbol in range(SYMBOLS):
                costs = _before(symbol, vector)
                least = min(costs)
                costs = tuple(c - least for c in costs)
                if costs not in known:
                    known[costs] = len(self.vectors)
                    self.vectors.append(costs)
                to.append(known[costs])
                more.append(int(least))
            step.append(to)
            added.append(more)
        self.one = step
        one, cost = np.array(step), np.array(added)
        before, total = one, cost
        for _ in range(BLOCK - 1):  # one more symbol in front
            total = (total[:, None, :] + cost[before].transpose(0, 2, 1)).reshape(len(one), -1)
            before = one[before].transpose(0, 2, 1).reshape(len(one), -1)
        self.block, self.cost = before.tolist(), total.tolist()
        self.letters = [[[self._letters(symbol, v, s) for s in range(4)] for symbol in range(SYMBOLS)]
                        for v in self.vectors]

    @staticmethod
    def _letters(symbol: int, after: tuple, state: int) -> tuple[str, int]:
        """Least letters of the cheapest edits up to and with this row, and the state behind it."""
        if symbol == PAD:
            return "", state
        now, out = _before(symbol, after), ""
        while True:
            cheapest = {letter: to for letter, cost, to in _choices(symbol, after, state) if cost == now[state]}
            if INSERT + now[TURN[state]] == now[state]:
                cheapest["I"] = TURN[state]
            letter = min(cheapest)
            out, state = out + letter, cheapest[letter]
            if letter != "I":
                return out, state


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def edits(symbols: bytes) -> tuple[int, list[str]]:
    """Cost of the cheapest edits, and their letters: one string per row, which ends with
    the row's own edit, and one for rows inserted at the end."""
    t = tables()
    padded = symbols + bytes([PAD]) * (-len(symbols) % BLOCK)
    codes = np.frombuffer(padded, np.uint8).reshape(-1, BLOCK).astype(np.int64) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
    vector, cost, behind = 0, 0, bytearray()
    wide = len(t.vectors) > 256
    behind = [] if wide else behind
    for code in codes[::-1].tolist():
        behind.append(vector)
        cost += t.cost[vector][code]
        vector = t.block[vector][code]
    cost += int(t.vectors[vector][START])
    out, state = [], START
    for at, vector in zip(range(0, len(padded), BLOCK), reversed(behind), strict=True):
        rows = padded[at:at + BLOCK]
        after = [vector]
        for symbol in rows[:0:-1]:
            after.append(t.one[after[-1]][symbol])
        for symbol, v in zip(rows, reversed(after), strict=True):
            letters, state = t.letters[v][symbol][state]
            out.append(letters)
    del out[len(symbols):]
    tail = ""
    while state in (SYSTEM, USER):
        tail, state = tail + "I", TURN[state]
    return cost, [*out, tail]


_short_edits = lru_cache(maxsize=1 << 16)(edits)


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows by crc32(``conv_id:turn``) % 20 dropped
    (0 copies), emptied, without ``[.!?]``, doubled (2 copies) or given to the user.
    Nulls stand as one space, but for a null conv_id or turn as a value."""
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    name = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(
        conv.alias("conv_id"), turn.alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def _facts(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, n, code): one row per different row, with its number
    and its code (class + 4 * first fault); text stays behind."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    small = rows.select("conv_id", "turn", "role", "digest", "copies", (bare == "").alias("blank"),
                        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
                        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("class"))
    facts = small.groupBy("conv_id", "turn", "role", "digest").agg(
        F.sum("copies").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"), F.first("class").alias("class"))
    facts = settle(facts, "conversation-rows")
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = (facts.where("n > 0 and not blank").groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"))
             .agg(F.min(order).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    fault = (F.when(F.col("blank"), BLANK).when(F.col("_first").isNotNull() & ~F.col("_first.turn").eqNullSafe(F.col("turn")), DUPLICATE)
             .when(F.col("cut"), CUT).otherwise(FINE))
    return (facts.join(again, same, "left")
            .select("conv_id", "turn", "role", "digest", "n", (F.col("class") + 4 * fault).cast("int").alias("code")))


SEGMENT = pa.schema([("conv_id", pa.int64()), ("ordinal", pa.int64()), ("codes", pa.binary()), ("copies", pa.binary()),
                     ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64())])
SEGMENT_DDL = "conv_id long, ordinal long, codes binary, copies binary, first_turn long, last_turn long, turns long"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted facts -> runs of one conversation within a batch: a byte per row, the
    numbers of copies where any is not 1, and the turns."""
    ordinal = TaskContext.get().partitionId() << 40
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "n", "code")), strict=True)
        out = []
        for conv, run in groupby(rows, key=lambda r: r[0]):
            run = [r for r in run if r[2]]
            copies = [r[2] for r in run]
            turns = [r[1] for r in run if r[1] is not None]
            out.append((conv, ordinal, bytes(r[3] for r in run), b"" if all(n == 1 for n in copies) else np.array(copies, np.int64).tobytes(),
                        turns[0] if turns else None, turns[-1] if turns else None, len(set(turns))))
            ordinal += 1
        cols = zip(*out, strict=True) if out else [[]] * len(SEGMENT)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, SEGMENT, strict=True)], schema=SEGMENT)


#: Code -> symbol.
_SYMBOL = bytes(0 if code // 4 in (BLANK, DUPLICATE) else 1 + 2 * (code % 4) + (code // 4 == CUT) for code in range(16)) + bytes(240)
_LEGAL = {(0, 1), (1, 2), (2, 1)}


class _Conversation:
    """What is known of a conversation once its segments are read, and the repaired
    rows as its texts come in."""

    def __init__(self, segments: list[tuple]):
        codes = b"".join(s[0] for s in segments)
        copies = np.ones(len(codes), np.int64) if not any(s[1] for s in segments) else np.concatenate(
            [np.frombuffer(s[1], np.int64) if s[1] else np.ones(len(s[0]), np.int64) for s in segments])
        turns = [s[2:] for s in segments if s[2] is not None]
        distinct = sum(t[2] for t in turns) - sum(a[1] == b[0] for a, b in zip(turns, turns[1:], strict=False))
        self.gaps = turns[-1][1] - turns[0][0] + 1 - distinct if turns else 0
        seen = {code: codes.count(code) for code in set(codes)}
        fault = lambda kind: sum(n for code, n in seen.items() if code // 4 == kind)
        self.blank, self.duplicate, self.truncated, more = fault(BLANK), fault(DUPLICATE), fault(CUT), np.zeros(0, np.int64)
        self.illegal = sum((a % 4, b % 4) not in _LEGAL for a, b in zip(codes, codes[1:], strict=False))
        repeated = np.flatnonzero(copies > 1)
        if len(repeated):  # further copies: blank or duplicate, beside a row of the same role, deleted
            more = copies[repeated] - 1
            blank = np.frombuffer(codes, np.uint8)[repeated] // 4 == BLANK
            self.blank += int(more[blank].sum())
            self.duplicate += int(more[~blank].sum())
            self.illegal += int(more.sum())
        symbols = codes.translate(_SYMBOL)
        self.cost, letters = (_short_edits if len(symbols) <= 32 else edits)(symbols)
        self.cost += DELETE * int(more.sum())
        self.letters = letters
        if len(repeated):
            letters = list(letters)
            for at, n in zip(repeated.tolist(), more.tolist(), strict=True):
                letters[at] += "D" * n
        self.audit = "".join(letters)
        self.row, self.state, self.last = 0, START, None

    def lines(self, letters: str, role: str = "", text: str = "") -> Iterator[tuple[str, str]]:
        """Repaired rows (role, text) of a row's letters."""
        for letter in letters:
            if letter == "K":
                self.state = KEEP["sua".find(role[:1])][self.state]
                yield role, text
            elif letter in "RI":
                self.state = TURN[self.state]
                yield NAMES[self.state], text if letter == "R" else ""

    def read(self, key: tuple, role: str, text: str) -> Iterator[tuple[str, str]]:
        """Repaired rows at the next row; further copies of a row give none."""
        if key != self.last:
            self.last = key
            yield from self.lines(self.letters[self.row], role, text)
            self.row += 1


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(event, conv_id, conversation, payload) over rows sorted by conversation, its segments
    first: ``line`` for each repaired row, ``end`` behind the last."""
    conv, segments, now, begun = None, [], None, False

    def close():
        at = now or _Conversation(segments)
        for line in at.lines(at.letters[-1]):
            yield "line", conv, at, line
        yield "end", conv, at, None

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
            if not begun or row[0] != conv:
                if begun:
                    yield from close()
                conv, segments, now, begun = row[0], [], None, True
            if row[1] == 0:
                segments.append(row[3:8])
                continue
            now = now or _Conversation(segments)
            turn, role, digest, text = row[8:12]
            for line in now.read((turn, role, digest), role, text):
                yield "line", conv, now, line
    if begun:
        yield from close()


AUDIT = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                   ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
                   ("repaired_sha256", pa.string())])
AUDIT_DDL = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
             "repaired_sha256 string")
LINE = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
LINE_DDL = "conv_id long, place long, role string, text string"


def _rows(found: Iterator[tuple], schema: pa.Schema, most: int, size) -> Iterator[pa.RecordBatch]:
    """Batches of rows, cut by their number of bytes."""
    held, weight = [], 0
    for row in found:
        held.append(row)
        weight += 64 + size(row)
        if weight > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        digest, first = hashlib.sha256(), True
        for event, conv, c, line in _stream(batches):
            if event == "line":
                digest.update(f"{'' if first else chr(10)}{line[0]}:{line[1]}".encode())
                first = False
                continue
            yield conv, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, c.cost, c.audit, digest.hexdigest()
            digest, first = hashlib.sha256(), True
    yield from _rows(found(), AUDIT, 1 << 20, lambda r: len(r[7]))


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        place = 0
        for event, conv, _, line in _stream(batches):
            if event == "line":
                yield conv, place, *line
                place += 1
            else:
                place = 0
    yield from _rows(found(), LINE, 1 << 22, lambda r: len(r[3]))


def _sorted(rows: DataFrame, copies: Column) -> DataFrame:
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), copies.cast("long").alias("copies"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    order = ("conv_id", "turn", "role", "digest")
    facts = settle(_facts(rows), "conversation-facts")
    segments = facts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_segments, SEGMENT_DDL)
    none = lambda kind: F.lit(None).cast(kind)
    head = segments.select("conv_id", F.lit(0).alias("kind"), "ordinal", "codes", "copies", "first_turn", "last_turn", "turns",
                           none("long").alias("turn"), none("string").alias("role"), none("binary").alias("digest"), none("string").alias("text"))
    body = rows.where("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), none("long").alias("ordinal"), none("binary").alias("codes"), none("binary").alias("copies"),
        none("long").alias("first_turn"), none("long").alias("last_turn"), none("long").alias("turns"), "turn", "role", "digest", "text")
    return (head.unionByName(body).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", "ordinal", "turn", "role", "digest"))


def audits(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """One row per conv_id of ``rows(conv_id, turn, role, text)``: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows of a conversation stand by turn (nulls first), then by role, then by the SHA-256
    of the text. Null roles and texts are one space; a null conv_id is a conversation of
    its own. Repeated rows are duplicates (blank ones are blank). ``copies`` gives how
    often a row counts; one that counts 0 times is absent but names its conversation.
    Texts of any length are read whole, one at a time; a conversation's letters, a byte
    per row, are held in one task. Extra columns are ignored; an empty table gives an
    empty result."""
    return _sorted(rows, F.lit(1) if copies is None else copies).mapInArrow(_audits, AUDIT_DDL)


def repaired(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text. Rows, nulls, ties,
    repeated rows and long texts as in ``audits``; a conversation whose cheapest repair
    is to delete all gives no row."""
    return _sorted(rows, F.lit(1) if copies is None else copies).mapInArrow(_repaired, LINE_DDL)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits(damaged(documents(spark, sf_dir, "conversations")), F.col("copies"))
