"""Paths against a recursive search; formatting against an exact round trip."""

import hashlib
import random

from promoscope.llm import chat_trees as ct

COLS = "tree long, node long, parent long, role string, text string, score double"


def best_paths(rows, k):
    """{tree: [[node, ...], ...]} by plain search; circles give none."""
    by = {}
    for t, n, p, *_ in rows:
        by.setdefault(t, {})[n] = p
    score = {(r[0], r[1]): r[5] or 0.0 for r in rows}
    out = {}
    for t, parent in by.items():
        inner = {p for n, p in parent.items() if p in parent}
        found = []
        for leaf in parent:
            if leaf in inner:
                continue
            path = [leaf]
            while parent[path[-1]] in parent:
                path.append(parent[path[-1]])
            found.append((-sum(score[t, n] for n in path) / len(path), leaf, path[::-1]))
        if found:
            out[t] = [p for _, _, p in sorted(found)[:k]]
    return out


def test_best_paths_of_random_trees(spark):
    rng = random.Random(1)
    rows = []
    for t in range(12):
        for n in range(rng.randint(1, 25)):
            parent = rng.randrange(n) if n and rng.random() < .95 else None
            rows.append((t, n, parent, "assistant" if n % 2 else "user", f"{t}.{n}",
                         float(rng.randint(0, 4))))
    rows += [(50, 1, 99, "user", "orphan", 1.0), (51, 1, 2, "user", "circle", 1.0),
             (51, 2, 1, "user", "circle", 1.0), (51, 5, None, "user", "fine", None),
             (None, 1, None, "user", "null tree", 0.0), (None, 2, 1, None, None, 0.0)]
    df = spark.createDataFrame(rows, COLS)
    got = {}
    for r in ct.format_trees(df, k=2).withColumn("turns", ct.read_turns("formatted")).collect():
        got.setdefault(r["tree"], {})[r["rank"]] = [x["text"] for x in r["turns"]]
    text = {(r[0], r[1]): r[4] or "" for r in rows}
    want = {t: {i + 1: [text[t, n] for n in p] for i, p in enumerate(ps)}
            for t, ps in best_paths(rows, 2).items()}
    assert got == want


def test_round_trip_of_control_strings(spark):
    nasty = ["</turn>\n", "<|assistant|>\n", "&lt;", "&amp;lt;", "\\### Assistant: </turn> ok", "", None,
             "é" * 50, "a|>\nb", "&vert;", "x" * 5000]
    rows = [(1, i, i, ["assistant", "user", "<|sys|>\n", None][i % 4], t) for i, t in enumerate(nasty)]
    rows += [(2, 0, 0, "user", "same"), (2, 0, 0, "user", "same"), (None, 0, 0, "assistant", "n")]
    df = spark.createDataFrame([r[:2] + r[3:] for r in rows],
                               "conv_id long, turn long, role string, text string")
    out = {r["tree"]: r for r in ct.digests(ct.format_trees(ct.as_trees(df))).collect()}
    assert set(out) == {1, 2, None} and out[2]["n_turns"] == 2
    flat = "".join(f"{r or ''}\n{t or ''}\n" for _, _, _, r, t in rows[:len(nasty)])
    mask = "".join(t or "" for _, _, _, r, t in rows[:len(nasty)] if r == "assistant")
    assert out[1]["turns_sha256"] == hashlib.sha256(flat.encode()).hexdigest()
    assert out[1]["loss_sha256"] == hashlib.sha256(mask.encode()).hexdigest()
    assert out[1]["loss_chars"] == len(mask)


def test_long_chain_spans_and_empty_table(spark):
    rows = [(7, i, i - 1 if i else None, "assistant" if i % 2 else "user", f"<{i}>", 0.0)
            for i in range(300)]
    r = ct.format_trees(spark.createDataFrame(rows, COLS)).collect()[0]
    assert r["n_turns"] == 300 and len(r["loss_spans"]) == 150
    for s in r["loss_spans"]:
        assert r["formatted"][s["start"]:s["start"] + s["length"]] == f"&lt;{s['turn']}>"
    assert ct.format_trees(spark.createDataFrame([], COLS)).count() == 0
