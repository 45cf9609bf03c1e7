"""Metrics against plain counting; the cascade's order changes no verdict."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from promoscope.llm import rule_cascade as rc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def plain(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    cover = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines),
            len(lines) - len(set(lines)), len(cover))


def corpus(seed=1, n=150):
    rng = random.Random(seed)
    vocab = ["a", "b", "cé", "ddd", "#x", "<b>", "\U0001F600"]
    texts = [None, "", "   ", "\n\n", "one", "a a a", "a a a a", "\t lead and trail \r\n", "x" * 20000]
    for _ in range(n):
        texts.append(rng.choice([" ", "\n", "\x0b ", "  "]).join(
            rng.choice(vocab[:rng.randint(1, 7)]) for _ in range(rng.randint(1, 120))))
    texts += [" ".join(f"word{rng.randint(0, 999)}" for _ in range(60)) for _ in range(20)]
    return [(i, t) for i, t in enumerate(texts)] + [(3, "\n\n"), (None, "null id")]


def test_metrics_match_plain_counting(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in rc.with_metrics(df).select("doc_id", *NAMES).collect()), key=str)
    assert got == sorted(((i, *plain(t)) for i, t in rows), key=str)
    direct = df.select("doc_id", *[c.alias(n) for n, c in rc.text_metrics(F.col("text")).items()])
    assert sorted((tuple(r) for r in direct.select("doc_id", *NAMES).collect()), key=str) == got


def test_cascade_verdict_is_the_rules_together(spark):
    rows = corpus(2)
    df = spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, rejected_by string")
    out = rc.cascade(df, rc.rules(min_words=20))
    kept = sorted((r["doc_id"], r["text"]) for r in out.where("rejected_by IS NULL").collect())
    m = rc.with_metrics(df)
    cols = {n: F.col(n) for n in NAMES}
    want = m
    for r in rc.rules(min_words=20):
        want = want.where(~r.reject(cols))
    assert kept == sorted((r["doc_id"], r["text"]) for r in want.collect()) and 0 < len(kept) < len(rows)
    stay = rc.accepted(df, rc.rules(min_words=20))
    assert stay.columns == df.columns and stay.count() == len(kept)


def test_rules_are_ordered_by_rejection_per_cost(spark):
    df = spark.createDataFrame(corpus(3), "doc_id long, text string")
    never = rc.Rule("never", lambda m: F.lit(False))
    always = rc.Rule("always", lambda m: m["n_words"] >= 0)
    order = [e.rule.name for e in rc.order_rules(df, (never, *rc.RULES, always))]
    assert order[-1] == "never" or order.index("always") < order.index("never")


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert rc.cascade(df).collect() == [] and rc.accepted(df).collect() == []
