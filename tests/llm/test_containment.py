"""Contained items against brute force on whole shingle sets."""

import random

from promoscope.llm import containment as cn


def shingles(t, k=5):
    w = (t or "").lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def item(t):
    return min(5, len((t or "").split()))


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = ["v%d" % i for i in range(200)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([3, 4, 5, 6, 7, 14, 37, 59])))) for i in range(30)]
    items += [(100, "only four words here"), (101, None), (102, ""), (5, items[5][1]), (None, items[6][1])]
    docs = []
    for i in range(150):
        w = [rng.choice(vocab) for _ in range(rng.choice([3, 40, 300, 3000]))]
        if rng.random() < .5:
            part = rng.choice(items[:30])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                part[rng.randrange(len(part))] = "edit"
            at = rng.randrange(len(w))
            w[at:at] = part if rng.random() < .8 else part[:len(part) * 9 // 10]
        docs.append((i, " ".join(w).upper() if rng.random() < .1 else " ".join(w)))
    return docs + [(500, None), (501, ""), (502, "a b c d"), (3, docs[3][1]), (None, docs[4][1])], items


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(items, "item_id long, text string"))


def brute(docs, items):
    sets = {k: [(d, shingles(t, k)) for d, t in docs] for k in range(1, 6)}
    out = set()
    for q, t in items:
        if not item(t):
            continue
        s = shingles(t, item(t))
        for d, x in sets[item(t)]:
            if s and 100 * len(s & x) >= 80 * len(s):
                out.add((d, q, len(s & x), len(s)))
    return out


def test_pairs_match_brute_force(spark, monkeypatch):
    docs, items = corpus()
    want = brute(docs, items)
    got = cn.contained_items(*frames(spark, docs, items)).drop("text_hash").collect()
    assert {tuple(r) for r in got} == want and len(want) > 20
    monkeypatch.setattr(cn, "BROADCAST_ROWS", 0)
    got = cn.contained_items(*frames(spark, docs, items)).drop("text_hash").collect()
    assert {tuple(r) for r in got} == want


def test_decontaminated_rows_keep_their_columns(spark):
    docs, items = corpus(2)
    d, q = frames(spark, docs, items)
    bad = {x[0] for x in brute(docs, items)}
    out = cn.decontaminate(d.selectExpr("*", "1 AS text_hash", "'k' AS __r"), q)
    assert out.columns == ["doc_id", "text", "text_hash", "__r"]
    assert sorted(r["doc_id"] for r in out.where("doc_id IS NOT NULL").collect()) == sorted(
        i for i, _ in docs if i is not None and i not in bad)


def test_empty_tables(spark):
    docs, items = corpus(3)
    d, q = frames(spark, docs, items)
    none_d, none_q = frames(spark, [], [])
    assert cn.contained_items(none_d, q).collect() == []
    assert cn.contained_items(d, none_q).collect() == []
    assert cn.decontaminate(d, none_q).count() == len(docs)


def test_items_of_one_to_six_words_are_all_found(spark):
    """Every item that stands verbatim in a long document is found."""
    rng = random.Random(9)
    items = [(n * 100 + i, " ".join(f"q{n}_{i}_{j}" for j in range(n))) for n in range(1, 7) for i in range(20)]
    docs = []
    for i, (_, t) in enumerate(items):
        w = [f"w{rng.randrange(4000)}" for _ in range(4000)]
        w[1000:1000] = t.split()
        docs.append((i, " ".join(w)))
    d, q = frames(spark, docs, items)
    got = {(r["doc_id"], r["item_id"]) for r in cn.contained_items(d, q).collect()}
    assert got == {(i, k) for i, (k, _) in enumerate(items)}
    only = q.where("item_id < 600")  # nothing but items of one shingle
    assert cn.contained_items(d, only).count() == 100


def test_miss_rate_holds_for_every_size():
    import math
    for n in range(2, 200):
        least = -(-cn.THRESHOLD_PCT * n // 100)
        x = cn.bins_per_shingle(least)
        assert (1 - x * (1 - math.exp(-1 / x))) ** least <= cn.MISS * 1.0001, n
