"""Shards fit their limit and split only where they must."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from promoscope.llm import extendible as ex


def run(spark, rows, limit):
    return ex.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), limit).collect()


def test_every_shard_fits_and_no_split_is_idle(spark):
    rng = random.Random(1)
    rows = [(i, "é" * rng.randint(0, 200)) for i in range(500)] + [(None, "n"), (900, None), (901, "")]
    rows += [(1000, "L" * 5000)]  # larger than the limit by itself
    out = run(spark, rows, 2000)
    assert len(out) == len(rows)
    load, n = defaultdict(int), defaultdict(int)
    for r in out:
        load[r["shard"]] += r["n_bytes"]
        n[r["shard"]] += 1
        assert len(r["shard"]) == r["shard_depth"]
    assert all(b <= 2000 or n[s] == 1 for s, b in load.items())
    assert all(load[r["shard"]] == r["shard_bytes"] for r in out)
    # Prefix-free, and each split was of a bucket over the limit.
    shards = sorted(load)
    assert not any(b.startswith(a) for a in shards for b in shards if a != b)
    for s in shards:
        if s:
            assert sum(b for t, b in load.items() if t.startswith(s[:-1])) > 2000


def test_one_shard_repeated_rows_and_empty_table(spark):
    assert {r["shard"] for r in run(spark, [(1, "a"), (2, "b")], 100)} == {""}
    rows = [(7, "x" * 100)] * 40 + [(8, "y")]
    out = run(spark, rows, 1000)
    load = defaultdict(int)
    for r in out:
        load[r["shard"]] += r["n_bytes"]
    assert len(out) == 41 and max(load.values()) <= 1000
    assert run(spark, [], 10) == []


def test_deep_split_over_several_passes(spark, monkeypatch):
    monkeypatch.setattr(ex, "PASS_BITS", 2)
    out = run(spark, [(i, "z" * 50) for i in range(300)], 120)
    load = defaultdict(int)
    for r in out:
        load[r["shard"]] += r["n_bytes"]
    assert len(out) == 300 and max(load.values()) <= 120


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string").withColumn("shard", F.lit(5))
    out = ex.shard(df)
    assert out.columns == ["doc_id", "text", "n_bytes", "shard", "shard_depth", "shard_bytes"]
    assert out.collect()[0]["shard"] == ""


def test_equal_rows_in_many_partitions_fit_the_limit(spark):
    """One row per partition: ids with gaps would put many in one part."""
    rows = spark.range(64, numPartitions=64).select(
        F.lit(7).cast("long").alias("doc_id"), F.lit("x" * 100).alias("text"), F.col("id").alias("copy"))
    more = spark.createDataFrame([(1, "a" * 30, 100), (None, None, 101), (2, "L" * 999, 102), (2, "L" * 999, 103)],
                                 "doc_id long, text string, copy long")
    out = ex.shard(rows.unionByName(more), 400).collect()
    load, n = defaultdict(int), defaultdict(int)
    for r in out:
        load[r["shard"]] += r["n_bytes"]
        n[r["shard"]] += 1
    assert len(out) == 68 and len({r["copy"] for r in out}) == 68
    assert all(b <= 400 or n[s] == 1 for s, b in load.items())
    assert all(load[r["shard"]] == r["shard_bytes"] for r in out)
    assert sum(1 for s in load if n[s] == 4) == 16  # no more parts than needed
