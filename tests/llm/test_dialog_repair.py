"""Conversation repair against a brute-force search over whole edit strings."""

import hashlib
import heapq
import random

import pytest

from promoscope.llm import dialog_repair as dr


def cheapest(marks, enter=0, leave=(0, 3)):
    """Dijkstra over (cost, edits): the least pair that is accepted."""
    heap, seen = [(0, "", 0, enter)], set()
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if i == len(marks) and q in leave:
            return cost, audit
        if cost > 2 * len(marks) + 10:
            return None
        if (i, q) in seen:
            continue
        seen.add((i, q))
        goal = {0: 2, 1: 2, 2: 3, 3: 2}[q]
        heapq.heappush(heap, (cost + 5, audit + "I", i, goal))
        if i < len(marks):
            who, fault = divmod(ord(marks[i]) - 65, 4)
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q))
            if fault in (0, 3):
                more = 5 if fault == 3 else 0
                heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, goal))
                if who + 1 == goal or (who, q) == (0, 0):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, who + 1))


def test_search_is_cheapest_and_least():
    rng = random.Random(7)
    for _ in range(1500):
        marks = "".join(chr(65 + 4 * rng.choice([0, 1, 1, 2, 2, 3]) + rng.choice([0, 0, 0, 1, 2, 3]))
                        for _ in range(rng.randint(1, 14)))
        assert dr.search(marks) == cheapest(marks), marks
        enter = rng.randrange(4)
        leave = (rng.choice(dr._LEAVES[enter]),)
        assert dr.search(marks, enter, leave) == cheapest(marks, enter, leave), (marks, enter, leave)


def test_long_block():
    rng = random.Random(1)
    marks = "".join(chr(65 + 4 * rng.randrange(4) + rng.randrange(4)) for _ in range(dr.BLOCK))
    assert dr.search(marks) == cheapest(marks)


def brute(rows):
    """rows: (conv, turn, role, text) -> per conversation report."""
    out = {}
    for conv in {r[0] for r in rows}:
        some = [(t, r if r is not None else " ", x if x is not None else " ")
                for c, t, r, x in rows if c == conv]
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode(),
                                 hashlib.md5(r[2].encode()).hexdigest()))
        seen, marks, n = set(), "", [0, 0, 0, 0]
        for k, (_, role, text) in enumerate(some):
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0
            seen.add((role, text))
            marks += chr(65 + 4 * ("sua" + role[:1]).index(role[:1]) + fault if role[:1] else 77 + fault)
            if fault:
                n[fault - 1] += 1
            if k and some[k - 1][1][:1] + role[:1] not in ("su", "ua", "au"):
                n[3] += 1
        turns = [t for t, _, _ in some if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = cheapest(marks)
        kept, i, last = [], 0, ""
        for e in audit:
            to = "assistant" if last == "u" else "user"
            if e == "I":
                kept.append((to, "", e))
            else:
                _, role, text = some[i]
                i += 1
                if e == "D":
                    continue
                kept.append((to if e == "R" else role, text, e))
            last = kept[-1][0][0]
        sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x, _ in kept).encode()).hexdigest()
        out[conv] = (gaps, *n, cost, audit, sha, kept)
    return out


def corpus(seed, hot=0):
    rng = random.Random(seed)
    texts = ["Hello.", "Yes!", "no", "", " \t", "Why?  ", "long " * 40 + "end.", "long " * 40 + "other.", None, "é è."]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"]) if rng.random() < .4 else ("user", "assistant")[turn % 2]
            if turn == 0 and rng.random() < .3:
                role = "system"
            role = rng.choice([role] * 12 + [None, "", "tool", "User"])
            text = rng.choice(texts) if rng.random() < .4 else f"Text {turn} of {conv}."
            times = rng.choice([1] * 8 + [0, 2])
            rows += [(conv, rng.choice([turn] * 9 + [None, turn + 3]), role, text)] * times
    rows += [(99, None, "user", "a."), (99, None, "user", "b"), (None, 1, "user", "c."), (None, 2, "assistant", "d.")]
    rows += [(77, rng.randrange(hot), rng.choice(["user", "assistant", "x"]),
              rng.choice(["", "t", "u.", f"{i}.", f"{i} v"])) for i in range(hot)]
    return rows


@pytest.mark.parametrize("hot", [0, 900])
def test_reports_digests_and_rows_match_brute_force(spark, hot, monkeypatch):
    rows = corpus(3, hot)
    want = brute(rows)
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, audit string").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in dr.repair_digests(df).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == {c: w[:8] for c, w in want.items()}
    if not hot:
        rows = {}
        for r in sorted(dr.repaired_turns(df).collect(), key=lambda r: r["place"]):
            rows.setdefault(r["conv_id"], []).append((r["role"], r["text"], r["edit"]))
        assert rows == {c: w[8] for c, w in want.items() if w[8]}


def test_blocks_of_a_conversation_join(monkeypatch):
    """Cut anywhere, the joined blocks give the search over the whole."""
    rng = random.Random(5)
    for _ in range(150):
        marks = "".join(chr(65 + 4 * rng.choice([0, 1, 2, 3]) + rng.choice([0, 0, 1, 2, 3]))
                        for _ in range(rng.randint(3, 12)))
        a, b = sorted(rng.sample(range(1, len(marks)), 2))
        cut = [marks[:a], marks[a:b], marks[b:]]
        tables = []
        for k, piece in enumerate(cut):
            enters = (0,) if k == 0 else range(4)
            tables.append({(q, to): found for q in enters for to in dr._LEAVES[q]
                           if (found := dr.search(piece, q, (to,)))})
        whole = dr.join_blocks(dr.join_blocks(tables[0], tables[1]), tables[2])
        best = min(v for (_, to), v in whole.items() if to in (0, 3))
        assert best == cheapest(marks)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert dr.repair_digests(df).collect() == [] and dr.repaired_turns(df).collect() == []
