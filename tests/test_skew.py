"""Operators stay exact when one key holds about a third of all rows.

The log of the sf0.01 driver tables is skewed on purpose: a third of its
rows are moved to one user, and a third (a different cut) to one item.
Results are checked against a pandas brute force over the same rows.
"""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK

from promoscope.operators import demographics as demo
from promoscope.operators import features as feat
from promoscope.operators import popularity as pop
from promoscope.sources.driver_tables import Tables

HOT_USER, HOT_ITEM = 7, 11
# Day window wide enough for every operator to see many rows.
DAYS = (1001, 1231)


@pytest.fixture(scope="module")
def skewed(spark):
    t = Tables(spark, SF_CHECK)
    log = t.user_log()
    h = F.abs(F.xxhash64("item_id", "seller_id", "time_stamp", "action_type")) % 3
    log = log.select(
        F.when(h == 0, F.lit(HOT_USER).cast("long")).otherwise(F.col("user_id")).alias("user_id"),
        F.when(h == 1, F.lit(HOT_ITEM).cast("long")).otherwise(F.col("item_id")).alias("item_id"),
        "cat_id", "seller_id", "brand_id", "time_stamp", "action_type")
    log = log.checkpoint(eager=True)
    users = t.user_info()
    return log, users, log.toPandas(), users.toPandas()


def test_skew_is_real(skewed):
    _, _, pl, _ = skewed
    assert (pl.user_id == HOT_USER).mean() > 0.3
    assert (pl.item_id == HOT_ITEM).mean() > 0.3


def test_top_items_under_skew(skewed):
    log, _, pl, _ = skewed
    got = [tuple(r) for r in pop.top_items(log, *DAYS, k=50).collect()]
    w = pl[(pl.time_stamp.between(*DAYS)) & (pl.action_type != 0)]
    w = w[["user_id", "item_id", "action_type"]].drop_duplicates()
    c = w.groupby("item_id").size().reset_index(name="number")
    c = c.sort_values(["number", "item_id"], ascending=[False, True]).head(50)
    assert got == [tuple(x) for x in c.itertuples(index=False)]
    assert got[0][0] == HOT_ITEM


def test_young_merchants_under_skew(skewed):
    log, users, pl, pu = skewed
    got = {r.merchant_id: r.number for r in pop.merchant_counts(log, users, *DAYS).collect()}
    young = set(pu[pu.age_range.isin([1, 2, 3])].user_id)
    w = pl[(pl.time_stamp.between(*DAYS)) & (pl.action_type != 0) & pl.user_id.isin(young)]
    w = w[["user_id", "item_id", "seller_id", "action_type"]].drop_duplicates()
    assert got == w.groupby("seller_id").size().to_dict()


def test_buyers_under_skew(skewed):
    log, users, pl, pu = skewed
    got = {r.gender: r["count"] for r in demo.buyers_by_gender(demo.buyers(log, users, *DAYS)).collect()}
    ids = set(pl[(pl.time_stamp.between(*DAYS)) & (pl.action_type == 2)].user_id)
    b = pu[pu.user_id.isin(ids) & pu.gender.isin([0, 1])]
    assert got == b.groupby("gender").size().to_dict()


def test_features_under_skew(skewed):
    log, _, pl, _ = skewed
    got = feat.behaviour_features(log).toPandas().set_index(["user_id", "merchant_id"]).sort_index()
    g = pl.groupby(["user_id", "seller_id"])
    want = pd.DataFrame({
        "total_logs": g.item_id.count(),
        "unique_item_ids": g.item_id.nunique(),
        "categories": g.cat_id.nunique(),
        "browse_days": g.time_stamp.nunique(),
    })
    for name, code in feat.ACTION_FEATURES:
        want[name] = pl.assign(x=(pl.action_type == code) & pl.item_id.notna()).groupby(
            ["user_id", "seller_id"]).x.sum()
    want.index.names = ["user_id", "merchant_id"]
    want = want.sort_index()
    assert len(got) == len(want)
    for c in want.columns:
        assert got[c].astype("int64").tolist() == want[c].astype("int64").tolist(), c


@pytest.fixture()
def stock_session(spark):
    """No broadcast and low thresholds; nothing that this library sets."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"
    yield spark
    for k in conf:
        spark.conf.unset(k)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _over_several_tasks(log):
    # A skewed partition is split by the map tasks that wrote it.
    spread = log.repartition(6, F.xxhash64("user_id", "item_id", "seller_id", "time_stamp"))
    return spread.checkpoint(eager=True)


def test_hot_user_is_split_on_a_stock_session(stock_session, skewed):
    log, users, _, _ = skewed
    young = 12  # the hot user of the fixture is not young
    log = _over_several_tasks(log.withColumn(
        "user_id", F.when(F.col("user_id") == HOT_USER, young).otherwise(F.col("user_id"))))
    assert "skew=true" in _final_plan(pop.merchant_counts(log, users, *DAYS))
    assert "skew=true" in _final_plan(pop.top_merchants(log, users, *DAYS))


def test_hot_item_is_split_on_a_stock_session(stock_session, skewed):
    log, _, pl, _ = skewed
    parts = Tables(stock_session, SF_CHECK).table("part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_type").alias("cat_id"))
    joined = _over_several_tasks(log.drop("cat_id")).join(parts, "item_id", "left")
    assert "skew=true" in _final_plan(feat.behaviour_features(joined))


def test_least_row_does_not_depend_on_partitioning(spark):
    from promoscope.operators.demographics import least_row
    rows = [(1, 3, 1), (1, 3, 0), (1, 2, 5), (2, None, 4), (2, 1, 0), (3, 1, None), (3, 1, 1), (None, 2, 2), (None, 1, 9)]
    want = {(1, 2, 5), (2, None, 4), (3, 1, None), (None, 1, 9)}
    for n in (1, 3, 9):
        df = spark.createDataFrame(rows[n % 4:] + rows[:n % 4], "user_id int, age_range int, gender int").repartition(n)
        assert {tuple(r) for r in least_row(df, "user_id").collect()} == want
    assert least_row(spark.createDataFrame([(1,), (1,)], "user_id int"), "user_id").count() == 1
