"""Conversation repair against a plain search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from almanac.llm import conversations as C

WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, repaired rows) by Dijkstra over (cost, letters); rows are (role, text, must go, truncated)."""
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, roles, out = heapq.heappop(queue)
        state = (at, roles[-1:] if roles != "s" else "s", bool(roles))
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, list(out)
        if state in seen:
            continue
        seen.add(state)
        fits = lambda r: re.fullmatch("s?(ua)*u?", r)
        for role in ("user", "assistant"):
            if fits(roles + role[0]):
                heapq.heappush(queue, (cost + 5, audit + "I", at, roles + role[0], (*out, (role, ""))))
        if at < len(rows):
            role, text, gone, cut = rows[at]
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, roles, out))
            if not gone:
                if role[:1] in ("s", "u", "a") and fits(roles + role[0]):
                    heapq.heappush(queue, (cost + 5 * cut, audit + "K", at + 1, roles + role[0], (*out, (role, text))))
                for new in ("user", "assistant"):
                    if fits(roles + new[0]):
                        heapq.heappush(queue, (cost + 1 + 5 * cut, audit + "R", at + 1, roles + new[0], (*out, (new, text))))
    raise AssertionError


def expected(conv, rows):
    """The result row of damaged ``rows`` (turn, role, text) in order."""
    marks, seen, counts, prev = [], set(), dict(blank=0, duplicate=0, truncated=0, illegal=0), None
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        fault = ("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marks.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        if prev is not None and prev[:1] + role[:1] not in ("su", "ua", "au"):
            counts["illegal"] += 1
        prev = role
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, out = cheapest(marks)
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost, audit,
            hashlib.sha256(text.encode()).hexdigest()), [(conv, i, r, t) for i, (r, t) in enumerate(out)]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: in_order(r) for c, r in out.items()}


def frame(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], "conv_id long, turn long, role string, text string, digest string, copies int")
    return df.repartition(4)


def same(spark, rows):
    got = sorted((tuple(r) for r in C.audits(C.damaged(frame(spark, rows)), C.F.col("copies")).collect()), key=str)
    assert got == sorted((expected(c, r)[0] for c, r in damage(rows).items()), key=str)


def test_edits_against_search():
    rng = random.Random(1)
    for _ in range(3000):
        symbols = bytes(rng.randrange(9) for _ in range(rng.randrange(11)))
        rows = [("x", "", True, False) if s == 0 else (("system", "user", "assistant", "tool")[(s - 1) // 2], "t.", False, (s - 1) % 2 == 1)
                for s in symbols]
        cost, letters = C.edits(symbols)
        assert (cost, "".join(letters)) == cheapest(rows)[:2], symbols


@pytest.mark.parametrize("block", [1, 2, 3])
def test_block_length_changes_nothing(monkeypatch, block):
    rng = random.Random(2)
    cases = [bytes(rng.randrange(9) for _ in range(rng.randrange(40))) for _ in range(200)]
    whole = [C.edits(c) for c in cases]
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "tables", C.lru_cache(C.Tables))
    assert [C.edits(c) for c in cases] == whole


def test_random_conversations(spark):
    rng = random.Random(3)
    texts = ["Yes.", "No", "", " ", "Why? ", "So!\n", "\x0b\x0c", None, "a.b", "Été."]
    rows = [(conv if conv else None, rng.choice([None, *range(8)]), rng.choice(["user", "assistant", "system", "u", "tool", "", None]), rng.choice(texts))
            for conv in range(120) for _ in range(rng.randrange(1, 8))]
    same(spark, rows)


def test_repaired_rows(spark):
    rng = random.Random(4)
    rows = [(conv, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No", "", "Why?"])) for conv in range(60) for t in range(6)]
    got = [tuple(r) for r in C.repaired(frame(spark, rows)).orderBy("conv_id", "place").collect()]
    plain = {}
    for conv, *rest in rows:
        plain.setdefault(conv, []).append(tuple(rest))
    want = [line for conv in sorted(plain) for line in expected(conv, in_order(plain[conv]))[1]]
    assert got == want


def test_long_conversation_over_partitions(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No", f"So {t}.", "x" * 50_000 + "."])) for t in range(3000)]
    rows += [(7, 10, "user", "again.")] * 500 + [(8, 1, "user", "a.")]
    kept = damage(rows)[7]
    got = {r.conv_id: r for r in C.audits(C.damaged(frame(spark, rows)), C.F.col("copies")).collect()}
    assert got[7].gaps == max(t for t, _, _ in kept) - min(t for t, _, _ in kept) + 1 - len({t for t, _, _ in kept})
    assert tuple(got[7]) == expected(7, kept)[0]


def test_dropped_and_empty(spark):
    dropped = [t for t in range(400) if zlib.crc32(f"5:{t}".encode()) % 20 == 0][:3]
    rows = [(5, t, "user", "Hello.") for t in dropped]
    (row,) = C.audits(C.damaged(frame(spark, rows)), C.F.col("copies")).collect()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert C.audits(frame(spark, [])).collect() == [] and C.repaired(frame(spark, [])).collect() == []


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    same(spark, [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
