"""The rows of the distinct counts stay many small tasks, with exact results."""

import datetime
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from promoscope.operators import features as feat
from promoscope.sources.driver_tables import Tables

SCHEMA = "user_id long, item_id long, cat_id string, seller_id long, time_stamp int, action_type int"


def rows(n=4000, seed=5):
    rng = random.Random(seed)
    some = lambda x: None if rng.random() < .05 else x
    # Half of the rows are one pair's, of one category.
    return [(1, rng.randrange(300), "c", 1, rng.randrange(101, 131), rng.randrange(4)) if rng.random() < .5 else
            (some(rng.randrange(30)), some(rng.randrange(40)), some(f"c{rng.randrange(9)}"), some(rng.randrange(5)),
             some(rng.randrange(101, 131)), some(rng.randrange(4))) for _ in range(n)]


def test_counted_values_are_not_coalesced_by_compressed_bytes(spark):
    log = spark.createDataFrame(rows(400), SCHEMA)
    plan = feat.behaviour_features(log)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Expand")]
    shuffles = re.findall(r"Exchange hashpartitioning\((.*)\), (\w+)", above)
    assert [kind for _, kind in shuffles] == ["ENSURE_REQUIREMENTS", "REPARTITION_BY_NUM", "REPARTITION_BY_NUM"]
    assert "_part" not in shuffles[1][0] and "_part" in shuffles[2][0]


def test_features_of_null_keys_and_values_and_a_hot_pair(spark):
    data = rows()
    got = feat.behaviour_features(spark.createDataFrame(data, SCHEMA)).toPandas()
    log = pd.DataFrame(data, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    g = log.groupby(["user_id", "seller_id"], dropna=False)
    want = pd.DataFrame({"total_logs": g.item_id.count(), "unique_item_ids": g.item_id.nunique(),
                         "categories": g.cat_id.nunique(), "browse_days": g.time_stamp.nunique()})
    for name, code in feat.ACTION_FEATURES:
        log[name] = (log.action_type == code) & log.item_id.notna()
        want[name] = log.groupby(["user_id", "seller_id"], dropna=False)[name].sum()
    want.index.names = ["user_id", "merchant_id"]
    as_rows = lambda df: sorted(tuple(-1 if pd.isna(x) else int(x) for x in r)
                                for r in df.itertuples(index=False))
    columns = ["user_id", "merchant_id", *want.columns]
    assert as_rows(got[columns]) == as_rows(want.reset_index()[columns])


def test_rows_of_one_value_are_spread(spark):
    log = spark.createDataFrame(rows(), SCHEMA)
    hot = log.where("user_id = 1 AND cat_id = 'c'").select(
        F.pmod(F.xxhash64("item_id", "cat_id", "time_stamp"), F.lit(feat.VALUE_PARTS)).alias("p"))
    assert hot.distinct().count() == feat.VALUE_PARTS


@pytest.fixture()
def large_sides(spark):
    """No table is small enough to be broadcast."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def tasks(df):
    return len({r.task for r in df.withColumn("task", F.spark_partition_id()).collect()})


def test_lines_and_orders_are_joined_in_many_tasks(spark, tmp_out, large_sides):
    orders = [(i, i % 7, datetime.datetime(1996, 1 + i % 12, 5)) for i in range(300)]
    lines = [(i % 310, i % 11, i % 5, i % 6, "ARN"[i % 3], "OF"[i % 2]) for i in range(900)]
    spark.createDataFrame(orders + [(None, 1, None)], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(
        f"{tmp_out}/orders.parquet")
    spark.createDataFrame(lines + [(None, 1, 1, 1, "A", "O")], "l_orderkey long, l_partkey long, l_suppkey long, "
                          "l_linenumber int, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_out}/lineitem.parquet")
    log = Tables(spark, tmp_out).user_log(("user_id", "item_id", "seller_id"))
    assert tasks(log) == large_sides
    want = [(x[0] % 7, x[1], x[2]) for x in lines if x[0] < 300 for _ in range(1 + (x[3] == 5))]
    assert sorted(map(tuple, log.collect())) == sorted(want)


def test_pairs_and_features_are_joined_in_many_tasks(spark, large_sides):
    log = spark.createDataFrame(rows(), SCHEMA)
    pairs = [(u, m) for u in (*range(40), None) for m in range(7)]
    users = spark.createDataFrame([(u, 3, u % 2) for u in range(30)], "user_id long, age_range int, gender int")
    table = feat.feature_table(spark.createDataFrame(pairs, "user_id long, merchant_id long"), F.broadcast(users),
                               feat.behaviour_features(log))
    assert tasks(table) == large_sides
    key = lambda r: (str(r[0]), str(r[1]))
    got = [(r.user_id, r.merchant_id, r.age_range, r.total_logs) for r in table.collect()]
    total = {}
    for r in rows():
        if r[0] is not None and r[3] is not None:
            total[r[0], r[3]] = total.get((r[0], r[3]), 0) + (r[1] is not None)
    want = [(u, m, 3 if u is not None and u < 30 else None, total.get((u, m))) for u, m in pairs]
    assert sorted(got, key=key) == sorted(want, key=key)


def shuffled(plan):
    """Rows written by each shuffle of an executed plan, the last one first."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return shuffled(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return shuffled(plan.plan())
    own = [plan.metrics().apply("shuffleRecordsWritten").value()] if plan.nodeName() == "Exchange" else []
    return own + [n for i in range(plan.children().size()) for n in shuffled(plan.children().apply(i))]


def test_no_shuffle_writes_a_row_of_the_log_more_than_once(spark):
    n = 600
    log = spark.createDataFrame([(i % 90, i, f"c{i % 7}", i, 101 + i % 28, i % 4) for i in range(n)], SCHEMA)
    features = feat.behaviour_features(log)
    assert all(r.total_logs == r.unique_item_ids == r.categories == r.browse_days == 1 for r in features.collect())
    assert shuffled(features._jdf.queryExecution().executedPlan()) == [n] * 4


def test_items_of_a_hot_category_are_merged_before_it_meets(spark):
    days = 5
    log = spark.createDataFrame([(1, i, "c", 1, 101 + i % days, 0) for i in range(2000)], SCHEMA)
    features = feat.behaviour_features(log)
    assert [tuple(r) for r in features.collect()] == [(1, 1, 2000, 2000, 1, days, 2000, 0, 0, 0)]
    _, category, part, _ = shuffled(features._jdf.queryExecution().executedPlan())
    assert (category, part) == (feat.VALUE_PARTS * days, 2000)


def test_an_item_of_two_categories_days_and_actions_is_counted_once(spark):
    data = [(1, 5, c, 2, d, a) for c in ("x", "y", None) for d in (101, 102, None) for a in (0, 2, None, 9)]
    data += [(1, None, "z", 2, 103, 1), (1, 6, None, 2, None, 3), (None, None, None, None, None, None)]
    got = {tuple(r) for r in feat.behaviour_features(spark.createDataFrame(data * 3, SCHEMA)).collect()}
    assert got == {(1, 2, 111, 2, 3, 3, 27, 0, 27, 3), (None, None, 0, 0, 0, 0, 0, 0, 0, 0)}


def test_lines_logged_twice_are_shuffled_once(spark, tmp_out, large_sides):
    orders = [(i, i % 7, datetime.datetime(1996, 1 + i % 12, 5)) for i in range(50)]
    lines = [(i % 50, i % 11, i % 5, i % 7, "A", "O") for i in range(700)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp_out}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                          "l_returnflag string, l_linestatus string").write.parquet(f"{tmp_out}/lineitem.parquet")
    log = Tables(spark, tmp_out).user_log(("user_id", "item_id", "time_stamp", "action_type"))
    assert len(log.collect()) == 800
    assert sorted(shuffled(log._jdf.queryExecution().executedPlan())) == [50, 700]
