"""The token-group join against brute force, its bound and signatures."""

import random

import numpy as np
import pytest

from promoscope.llm import token_groups as tg

from test_setsketch import brute, corpus


def run(spark, rows, k, pct):
    df = spark.createDataFrame([(*r, b"x") for r in rows], "doc_id long, text string, node binary").repartition(3)
    return sorted((tuple(r) for r in tg.jaccard_join(df, k, pct).collect()), key=str)


@pytest.mark.parametrize("k,pct,group", [(3, 90, 4), (5, 80, 64), (2, 60, 3)])
def test_components_match_brute_force(spark, k, pct, group, monkeypatch):
    monkeypatch.setattr(tg, "GROUP", group)
    monkeypatch.setattr(tg, "OWN_GROUPS", group)
    rows = corpus(k + pct, 160)
    want = sorted((r[:3] for r in brute(rows, k, pct)), key=str)
    assert run(spark, rows, k, pct) == want
    assert len({r[2] for r in want}) < len(want) - 10


def test_links_do_not_hang_on_the_first_ones(spark, monkeypatch):
    """Without any first pairs, in groups of few, the search finds them all."""
    monkeypatch.setattr(tg, "_first_pairs", lambda led, pct: led.select("a", led.a.alias("b")).where("false"))
    monkeypatch.setattr(tg, "GROUP", 2)
    rows = corpus(8, 140)
    assert run(spark, rows, 3, 90) == sorted((r[:3] for r in brute(rows, 3, 90)), key=str)


def test_sets_that_reach_the_threshold_share_a_signature():
    rng = np.random.default_rng(3)
    for pct in (60, 80, 90, 95):
        for n in [*range(1, 60), 100, 333, 5000]:
            for _ in range(4):
                a = rng.integers(0, 2**63, n).astype(np.uint64)
                # As many differences as the threshold allows.
                gone = int(rng.integers(0, n + 1))
                extra = 0
                while gone and 100 * (n - gone) < pct * n:
                    gone -= 1
                while 100 * (n - gone) >= pct * (n + extra + 1):
                    extra += 1
                b = np.concatenate((a[gone:], rng.integers(0, 2**63, extra).astype(np.uint64)))
                if not gone and not extra:
                    continue
                text = np.repeat([0, 1], [len(a), len(b)])
                sets, sigs = tg.signatures(text, np.concatenate((a, b)), 2, pct)
                assert set(sigs[sets == 0].tolist()) & set(sigs[sets == 1].tolist()), (pct, n, gone, extra)


def test_a_group_opens_only_where_its_union_holds_enough():
    def group():
        return tg.Group([("x", 1, np.arange(0, 100, dtype=np.uint64)), ("y", 2, np.arange(50, 150, dtype=np.uint64))])
    assert group().links(3, np.arange(40, 140, dtype=np.uint64), 90) == []      # open, no member
    assert group().links(3, np.arange(70, 200, dtype=np.uint64), 90) is None    # shut
    assert group().links(3, np.arange(2, 100, dtype=np.uint64), 90) == ["x"]
    assert group().links(1, np.arange(2, 100, dtype=np.uint64), 90) == []       # linked already


def test_long_text_and_empty_table(spark):
    word = "w" * 1_500_000
    body = " ".join(f"t{i}" for i in range(60))
    rows = [(1, f"a {word} b {body}"), (2, f"a {word} b {body} c"), (3, body), (4, None)]
    assert run(spark, rows, 3, 90) == [(1, 61, 1), (2, 62, 1), (3, 58, 1), (4, 0, 4)]
    assert run(spark, [], 3, 90) == []


def test_hot_group_of_unlinked_copies(spark, monkeypatch):
    """Copies that agree in most but too few shingles, all in one group."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 6])):
            w[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    assert run(spark, rows, 3, 90) == sorted((r[:3] for r in brute(rows, 3, 90)), key=str)


def test_copies_with_tokens_of_their_own_meet_no_group(spark, monkeypatch):
    """Rows of the cells in which groups meet follow the links, not the
    square of the number of unlinked copies."""
    monkeypatch.setattr(tg, "GROUP", 8)
    tables, real = {}, tg.materialize

    def kept(df, folder, name):
        tables[name] = real(df, folder, name)
        return tables[name]
    monkeypatch.setattr(tg, "materialize", kept)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        w = list(base)
        for at in rng.sample(range(200), 8):
            w[at] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(w)))
        if i % 10 == 0:  # one that is linked to it, and one more to that
            for k in (1, 2):
                w[rng.randrange(200)] = f"y{rng.randrange(10**9)}"
                rows.append((i + 1000 * k, " ".join(w)))
    want = sorted((r[:3] for r in brute(rows, 3, 90)), key=str)
    assert run(spark, rows, 3, 90) == want
    assert len({r[2] for r in want}) == 300
    size = {r["group"]: r["count"] for r in tables["active"].groupBy("group").count().collect()}
    cells = [(r["group1"], r["group2"]) for r in tables["meet"].collect()]
    assert sum(size[a] + size[b] * (a != b) for a, b in cells) < 4 * len(rows)
