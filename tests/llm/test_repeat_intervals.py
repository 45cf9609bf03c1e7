"""Repeat spans against a brute-force search of every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from promoscope.llm import repeat_intervals as ri

SF_SMALL = "/root/testdata/sf0.001"


def brute(rows, m):
    """Row lists of (key, text): digest rows by counting every window."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + m] for t in texts for i in range(len(t) - m + 1))
    out = []
    for (key, _), t in zip(rows, texts):
        cover = np.zeros(len(t), bool)
        for i in range(len(t) - m + 1):
            if seen[t[i:i + m]] > 1:
                cover[i:i + m] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~cover])
        spans = int((np.diff(np.concatenate(([0], cover.astype(np.int8)))) == 1).sum())
        out.append((key, len(t), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_hashed(rows, m):
    """As ``brute``, but windows are kept as 16-byte digests."""
    texts = [(t or "").encode() for _, t in rows]

    def windows(t):
        return [hashlib.blake2b(t[i:i + m], digest_size=16).digest() for i in range(len(t) - m + 1)]
    seen = Counter(w for t in texts for w in windows(t))
    out = []
    for (key, _), t in zip(rows, texts):
        edge = np.zeros(len(t) + 1, int)
        for i, w in enumerate(windows(t)):
            if seen[w] > 1:
                edge[i] += 1
                edge[i + m] -= 1
        cover = np.cumsum(edge)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~cover])
        spans = int((np.diff(np.concatenate(([0], cover.astype(np.int8)))) == 1).sum())
        out.append((key, len(t), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, m, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ri.repeated_spans(df, m, **kw).drop("spans").collect()
    return sorted((tuple(r) for r in got), key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 5))) for _ in range(40)]
    shared = [" ".join(rng.choice(vocab) for _ in range(rng.randint(6, 40))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts.append(rng.choice(shared) if rng.random() < .5 else
                         " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 30))))
        if rng.random() < .1:
            parts.append("ha " * rng.randint(5, 60))
        t = " ".join(parts)
        if rows and rng.random() < .2:  # a near copy
            t = list(rng.choice(rows)[1] or "")
            for _ in range(rng.randint(0, 3)):
                if t:
                    t[rng.randrange(len(t))] = "X"
            t = "".join(t)
        rows.append((i, t))
    return rows + [(900, None), (901, ""), (902, "short"), (None, "n" * 90), (None, "n" * 90)]


@pytest.mark.parametrize("m", [20, 50])
def test_spans_match_every_window(spark, m):
    rows = corpus(m)
    want = brute(rows, m)
    assert run(spark, rows, m) == want
    assert any(r[2] for r in want) and any(r[1] and not r[2] for r in want)


@pytest.mark.parametrize("limit", [1, 2])
def test_hot_grams_give_the_same_spans(spark, limit):
    rows = corpus(3)
    assert run(spark, rows, 20, hot_contexts=limit) == brute(rows, 20)


def groups_of(spark, rows, m, **kw):
    """The listed groups as sets of places, whatever their names."""
    by = {}
    for r in ri.maximal_repeats(spark.createDataFrame(rows, "doc_id long, text string"), m, **kw).collect():
        by.setdefault((r["group_1"], r["group_2"]), set()).add((r["doc_id"], r["lo"], r["hi"]))
    return {frozenset(g) for g in by.values()}


@pytest.mark.parametrize("limit", [3])
def test_hot_grams_give_the_same_groups(spark, limit):
    rows = [r for r in corpus(4, 25) if r[0] is not None]
    want = groups_of(spark, rows, 20)
    assert want and groups_of(spark, rows, 20, hot_contexts=limit) == want


def test_maximal_groups_are_listed_whole(spark):
    rows = [r for r in corpus(6, 25) if r[0] is not None]
    texts, m = {k: (t or "").encode() for k, t in rows}, 20
    groups = groups_of(spark, rows, m)
    for g in groups:
        assert len(g) > 1 and len({texts[k][lo:hi] for k, lo, hi in g}) == 1
        assert all(hi - lo >= m for _, lo, hi in g)
    places = {}
    for k, t in texts.items():
        for i in range(len(t) - m + 1):
            places.setdefault(t[i:i + m], set()).add((k, i, i + m))
    diverse = 0
    for g in places.values():
        after = {texts[k][hi:hi + 1] or (k, hi) for k, _, hi in g}
        prior = {texts[k][lo - 1:lo] if lo else (k, lo) for k, lo, _ in g}
        if len(after) > 1 and len(prior) > 1:
            diverse += 1
            assert frozenset(g) in groups
    assert diverse


@pytest.mark.parametrize("limit", [ri.HOT_CONTEXTS, 2])
def test_driver_documents_at_200_bytes(spark, limit):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in table.collect()]
    want = brute_hashed(rows, 200)
    got = ri.repeated_spans(table, 200, hot_contexts=limit).drop("spans").collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    assert any(r[2] for r in want) and any(r[1] and not r[2] for r in want)


def test_reach_counts_only_beyond_an_edge():
    rng = np.random.default_rng(8)
    for _ in range(200):
        n = int(rng.integers(2, 12))
        lc, child = rng.integers(0, 6, n - 1), rng.integers(0, 3, n)
        edge = child[1:] != child[:-1]
        want = []
        for k in range(n):
            seen = [lc[x:k].min() for x in range(k) if (edge[x:k]).any()]
            want.append(max(seen, default=-1))
        assert ri._reach(lc, edge).tolist() == want


def test_long_text_cut_into_chunks(spark, monkeypatch):
    rng = random.Random(5)
    part = "".join(rng.choice("abcdefgh") for _ in range(700))
    rows = [(1, part + "".join(rng.choice("xyz") for _ in range(9000)) + part), (2, part[100:500])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    run_batches = ri._anchor_batches(200, 48)
    table = df.selectExpr("doc_id AS key", "xxhash64(text) AS th", "CAST(text AS BINARY) AS bytes").toArrow()
    whole = [b.to_pylist() for b in run_batches(table.to_batches())]
    monkeypatch.setattr(ri, "CHUNK", 1000)
    cut = [b.to_pylist() for b in run_batches(table.to_batches())]

    def ranges(batches):
        return sorted((r["gram"], r["ctx"], r["lo"], r["hi"], r["cnt"]) for b in batches for r in b)
    assert ranges(whole) == ranges(cut)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "q" * 300), (1, "q" * 300), (2, "w" * 199)]
    assert run(spark, rows, 200) == brute(rows, 200)
    assert run(spark, [], 200) == []


def test_maximal_repeats_list_all_occurrences(spark):
    a = "The quick brown fox jumps over the lazy dog today"
    rows = [(1, "111 " + a + " one"), (2, "222 " + a + " two"), (3, "333 " + a + " six")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts, by = dict(rows), {}
    for r in ri.maximal_repeats(df, 20).collect():
        by.setdefault((r["group_1"], r["group_2"]), []).append(r)
    assert by
    for members in by.values():
        assert len({texts[r["doc_id"]][r["lo"]:r["hi"]] for r in members}) == 1
    full = [m for m in by.values() if {r["doc_id"] for r in m} == {1, 2, 3}]
    span = {k: (min(r["lo"] for m in full for r in m if r["doc_id"] == k),
                max(r["hi"] for m in full for r in m if r["doc_id"] == k)) for k in texts}
    # " " + a + " " is what all three share.
    assert {texts[k][lo:hi] for k, (lo, hi) in span.items()} == {" " + a + " "}


def test_lcp_intervals():
    got = sorted(ri.lcp_intervals([1, 3, 1, 0, 2]))
    assert got == [(0, 0, 5), (1, 0, 3), (2, 4, 5), (3, 1, 2)]
