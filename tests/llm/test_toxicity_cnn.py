"""Held-out accuracy, determinism and defined results of the classifier."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from promoscope.llm import toxicity_cnn as tc

BAD = ["idiot", "scum", "loser", "moronen", "moronic"]


def corpus(n=900, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
             for _ in range(rng.randint(5, 80))]
        toxic = int(rng.random() < .15)
        if toxic:
            for _ in range(rng.randint(2, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(BAD).upper() + ",")
        docs.append((i, " ".join(w), rng.choice(["en", "de", None])))
        labels.append((i, toxic))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy_and_reruns(spark):
    docs, labels = corpus()
    labels += [(0, None), (None, 1), (10_000, 1)]
    d, y = frames(spark, docs + [(950, None, "en"), (951, "", None), (None, "idiot scum", "en")], labels)
    model, cuts = tc.train(d, y)
    got = {r["doc_id"]: r for r in tc.score(d, model, cuts).withColumn("out", tc.held_out()).collect()}
    truth = dict(labels)
    out = [i for i, _, _ in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r["out"]} - {950, 951} == set(out)
    hits = [got[i]["predicted"] == (truth[i] or 0) for i in out if i]
    assert np.mean(hits) > 0.97
    assert sum(got[i]["predicted"] for i in out if truth[i]) > 0.9 * sum(truth[i] or 0 for i in out)
    assert got[950]["score"] == got[951]["score"] and got[950]["predicted"] == 0
    assert set(cuts) <= {"", "en", "de"} and all(0 <= r["score"] <= 1 for r in got.values())
    again, _ = tc.train(d.repartition(5), y)
    assert (again.embed == model.embed).all() and again.scale == model.scale
    # Neither language nor source enters a score.
    other = tc.score(d.withColumn("lang", F.lit("xx")).withColumn("score", F.lit("old")), model, cuts)
    assert {r["doc_id"]: r["score"] for r in other.collect()} == {i: r["score"] for i, r in got.items()}


def test_no_labels_and_empty_table(spark):
    d, y = frames(spark, [(1, "some words", "en")], [])
    model, cuts = tc.train(d, y)
    row = tc.score(d, model, cuts).collect()[0]
    assert 0 <= row["score"] < 0.3 and row["predicted"] == 0
    empty, _ = frames(spark, [], [])
    assert tc.score(empty, model, cuts).collect() == []


def test_one_class_only(spark):
    docs, _ = corpus(60)
    d, y = frames(spark, docs, [(i, 0) for i, _, _ in docs])
    model, cuts = tc.train(d, y)
    assert all(r["predicted"] == 0 for r in tc.score(d, model, cuts).collect())


def test_pooling_is_the_greatest_response():
    rng = np.random.default_rng(3)
    m = tc.Model(rng.normal(size=(tc.BUCKETS, tc.DIM)).astype(np.float32),
                 [rng.normal(size=(w, tc.DIM, tc.FILTERS)).astype(np.float32) for w in tc.WIDTHS],
                 np.zeros(len(tc.WIDTHS) * tc.FILTERS, np.float32),
                 np.ones(len(tc.WIDTHS) * tc.FILTERS, np.float32), 0.0)
    m.embed[0] = 0
    docs = [rng.integers(1, tc.BUCKETS, (n, tc.IDS)).astype(np.int32) for n in (0, 1, 7, 30)]
    got, _, _ = m.pooled(*tc._concat(docs), len(docs))
    for d, row in zip(docs, got):
        e = np.concatenate((m.embed[d].sum(1), np.zeros((max(tc.WIDTHS) * 2, tc.DIM))))
        want = np.concatenate([np.max([sum(e[t + k] @ f[k] for k in range(w)) for t in range(len(d) + 3)],
                                      axis=0) for w, f in zip(tc.WIDTHS, m.filters)])
        assert np.allclose(row, want, atol=1e-3)


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(5)
    m = tc.Model(None, [rng.normal(size=(w, tc.DIM, tc.FILTERS)).astype(np.float32) for w in tc.WIDTHS],
                 rng.normal(0, .1, len(tc.WIDTHS) * tc.FILTERS).astype(np.float32),
                 rng.normal(0, .3, len(tc.WIDTHS) * tc.FILTERS).astype(np.float32), -0.2)
    m._track = True
    table = rng.normal(0, .3, (20, tc.DIM)).astype(np.float32)
    table[0] = 0
    docs = [rng.integers(1, 20, (n, tc.IDS)).astype(np.int32) for n in (0, 1, 4, 9, 15)]
    text, ids = tc._concat(docs)
    labels = [0, 1, 1, 0, 1]
    _, rest, of_table, of_shift = tc.gradients(m, table, text, ids, labels)

    def loss():
        return tc.gradients(m, table, text, ids, labels)[0]
    step = 1e-3
    places = [(x, g, i) for x, g in zip((*m.filters, m.bias, m.out, table), (*rest, of_table))
              for i in rng.choice(x.size, 12) if x is not table or i >= tc.DIM]
    close = 0
    for x, g, i in places:
        flat = x.reshape(-1)
        was = flat[i]
        flat[i] = was + step
        up = loss()
        flat[i] = was - step
        down = loss()
        flat[i] = was
        close += abs((up - down) / (2 * step) - g.reshape(-1)[i]) < 2e-3
    assert close >= 0.95 * len(places)  # the rest step over a kink of max or ReLU
    m.shift += step
    up = loss()
    m.shift -= 2 * step
    assert abs((up - loss()) / (2 * step) - of_shift) < 2e-3
    assert sum(np.abs(g).sum() > 0 for g in (*rest, of_table)) == len(rest) + 1


def test_sample_stays_within_its_bounds(spark, monkeypatch):
    """No more texts or bytes than stated, long texts and copies included."""
    seen = []
    real = tc.fit

    def fit(docs, labels, seed):
        seen.append(sum(len(d) for d in docs))
        return real(docs, labels, seed, epochs=1)
    monkeypatch.setattr(tc, "fit", fit)
    docs, labels = corpus(300)
    docs = [(i, t + " x%d" % i, g) for i, t, g in docs]
    docs += [(1000, "w " * 40_000, "en")] + [(1001, "copy of one text", None)] * 50
    labels += [(1000, 1), (1001, 1)] + [(i, 1) for i in range(5000, 9000)]  # no such documents
    d, y = frames(spark, docs, labels)
    tc.train(d, y, max_bytes=40_000)
    tc.train(d, y, max_texts=20)
    tc.train(d, y, max_bytes=1 << 24)
    assert seen[0] * 2 <= 40_000 and seen[1] <= 20 * 90 and seen[2] >= 40_000 * 0.2
    plan = tc.train(d.limit(0), y)
    assert plan[1] == {}


def test_very_long_text_scores_like_its_words(spark):
    text = "plain words " * 200_000
    docs, labels = corpus(300)
    d, y = frames(spark, docs + [(5000, text, "en"), (5001, text + "idiot scum", "en")], labels)
    model, cuts = tc.train(d, y)
    got = {r["doc_id"]: r["score"] for r in tc.score(d.where("doc_id >= 5000"), model, cuts).collect()}
    assert got[5000] < 0.3 < got[5001]
