"""Beyond the first fit every labelled row is counted, learnt from and calibrated on."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from promoscope.llm import toxicity_cnn as tc
from test_toxicity_cnn import corpus, frames


def test_rows_beyond_the_first_fit_are_learnt_from(spark):
    docs, labels = corpus()
    d, y = frames(spark, docs, labels)
    model, cuts = tc.train(d, y, max_texts=40)
    got = {r["doc_id"]: r["predicted"] for r in tc.score(d, model, cuts).collect()}
    truth = dict(labels)
    out = [i for i, _, _ in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i] == truth[i] for i in out]) > 0.97
    assert sum(got[i] for i in out if truth[i]) > 0.9 * sum(truth[i] for i in out)
    assert set(cuts) == {"", "en", "de"}
    again, same = tc.train(d.repartition(5), y, max_texts=40)
    assert (again.embed == model.embed).all() and again.scale == model.scale and same == cuts


def test_a_row_the_first_fit_leaves_out_changes_the_model(spark):
    docs, labels = corpus(120)
    long = [(i, "zork " * 300, "en") for i in range(1000, 1040) if zlib.crc32(str(i).encode()) % 4 != 2]
    # Over a sixteenth of the bytes, each with a word of its own besides.
    long = [(i, t + f"own{i}", g) for i, t, g in long]
    d, y = frames(spark, docs + long, labels + [(i, 1) for i, _, _ in long])
    model, cuts = tc.train(d, y, max_bytes=1 << 14)
    got = {r["doc_id"]: r["score"] for r in tc.score(
        spark.createDataFrame([(1, "zork", "en"), (2, "abc def", "en")], "doc_id long, text string, lang string"),
        model, cuts).collect()}
    assert got[1] > 0.5 > got[2]


def test_counts_calibration_and_thresholds_are_those_of_all_rows(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["", "en", "de"]), int(rng.random() < .3)) for _ in range(700)]
    rows = [(g, y, round(rng.gauss(2 * y - 1, 1.5), 2)) for g, y in rows] + [("fr", 0, z / 3) for z in range(9)]
    table = spark.createDataFrame(rows, "l string, y int, z double").repartition(7)
    g, y, z = (np.array(c) for c in zip(*rows))
    a, b = tc.calibrate(z, y)
    assert np.allclose(tc._calibrate_rows(table), (a, b), atol=1e-6)
    assert tc._calibrate_rows(table.limit(0)) == (1.0, 0.0)
    s = 1 / (1 + np.exp(-z))
    cuts = tc._best_thresholds(table.select("l", "y", (1 / (1 + F.exp(-F.col("z")))).alias("s")))
    want = {x: tc.best_threshold(s[g == x], y[g == x]) for x in ("", "en", "de", "fr")}
    assert set(cuts) == set(want) and all(abs(cuts[x] - want[x]) < 1e-12 for x in want)
