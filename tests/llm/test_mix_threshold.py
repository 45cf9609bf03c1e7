"""Targets against step-by-step resharing; what is taken comes near them."""

import random
from collections import Counter

from pyspark.sql import functions as F

from promoscope.llm import mix_threshold as mt


def plain_targets(size, weights=(3, 1, 2), share=1.5, cap=2):
    """Share by weight; cap; reshare the excess until none is above."""
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(size.values()), set(order), {}
    while open_:
        per = left / sum(w[s] for s in open_)
        full = {s for s in open_ if per * w[s] > cap * size[s]}
        if not full:
            target |= {s: per * w[s] for s in open_}
            break
        target |= {s: cap * size[s] for s in full}
        left -= sum(cap * size[s] for s in full)
        open_ -= full
    return target


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    sources = ["s1", "S2", "é", "z", None, "tiny"]
    rows = [(i, rng.choices(sources, [30, 10, 5, 5, 5, 1])[0], " ".join(["w"] * rng.randint(0, 30)))
            for i in range(n)]
    return rows + [(None, "s1", "a b"), (1, rows[1][1], rows[1][2]), (900, "s1", None), (901, "zero", "")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_targets_and_what_is_taken(spark):
    rows = corpus()
    out = mt.mix(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    size = Counter()
    for _, s, t in rows:
        size[s] += len((t or "").split())
    target = plain_targets(size)
    taken = Counter()
    for r in out:
        assert r["source_size"] == size[r["source"]] and r["copies"] <= 2
        assert abs(r["target"] - target[r["source"]]) < 1e-6
        taken[r["source"]] += r["size"] * r["copies"]
    for s in size:
        assert abs(taken[s] - target[s]) <= 31  # two equal rows at the cut at most
    again = mt.mix(frame(spark, rows).repartition(7)).collect()
    key = lambda r: str((r["doc_id"], r["source"], r["size"], r["copies"]))
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_budgets_are_nested(spark):
    df = frame(spark, corpus(2))
    small, large = (
        {r["doc_id"]: r["copies"] for r in mt.mix(df, share=s).collect() if r["doc_id"] is not None}
        for s in (0.4, 0.9))
    assert all(small[i] <= large[i] for i in small) and sum(small.values()) < sum(large.values())


def test_mixed_rows_keep_clashing_columns(spark):
    df = frame(spark, corpus(3)).withColumn("size", F.lit("mine")).withColumn("copies", F.lit(-1))
    copies = {(r["doc_id"], r["source"]): r["copies"] for r in mt.mix(frame(spark, corpus(3))).collect()}
    out = mt.mixed(df)
    assert out.columns == df.columns
    n = Counter((r["doc_id"], r["source"]) for r in out.collect())
    rows = Counter((d, s) for d, s, _ in corpus(3))
    assert all(n[k] == copies[k] * rows[k] for k in copies)
    assert {r["size"] for r in out.collect()} == {"mine"}


def test_empty_table(spark):
    df = frame(spark, [])
    assert mt.mix(df).collect() == [] and mt.mixed(df).collect() == []


def test_empty_texts_of_a_capped_source_are_not_repeated(spark):
    """A source at its cap takes every row twice and no row more often."""
    rows = [(i, "small", "w " * 5) for i in range(4)] + [(100 + i, "small", ["", " ", None][i % 3]) for i in range(60)]
    rows += [(1000 + i, "large", "w " * 500) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    taken = {r["doc_id"]: r["copies"] for r in mt.mix(df).collect()}
    assert all(taken[i] == 2 for i in range(4)) and all(taken[100 + i] == 0 for i in range(60))
    assert max(taken.values()) <= 2
    times = mt.mixed(df).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in times} == {k: v for k, v in taken.items() if v}
