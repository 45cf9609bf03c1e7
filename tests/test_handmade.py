"""Operators on hand-made rows: the edge cases of FIXTURES.md section 4."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from promoscope.operators import demographics as demo
from promoscope.operators import features as feat
from promoscope.operators import fill
from promoscope.operators import popularity as pop
from promoscope.schemas import TEXT_CODED_LOG, USER_INFO

DAY = 1111


def log_df(spark, rows):
    # (user, item, cat, seller, brand, day, action)
    return spark.createDataFrame(rows, TEXT_CODED_LOG)


def users_df(spark, rows):
    return spark.createDataFrame(rows, USER_INFO)


def test_dedup_counts_each_user_item_action_once(spark):
    log = log_df(spark, [
        (1, 10, "c", 7, "b", DAY, 1),
        (1, 10, "c", 7, "b", DAY, 1),   # duplicate event
        (1, 10, "c", 7, "b", DAY, 2),   # same user+item, other action
        (2, 10, "c", 7, "b", DAY, 3),
        (3, 10, "c", 7, "b", DAY, 0),   # click: never counted
        (4, 10, "c", 7, "b", 1110, 1),  # other day
        (5, 10, "c", 7, "b", DAY, None),  # no action: dropped
    ])
    got = {r.item_id: r.number for r in pop.item_counts(log, DAY).collect()}
    assert got == {10: 3}
    raw = {r.item_id: r.number for r in pop.item_counts(log, DAY, dedup=False).collect()}
    assert raw == {10: 4}


def test_top_k_breaks_ties_by_id_and_ranks(spark):
    rows = []
    for item, n in [(30, 3), (20, 2), (21, 2), (5, 1)]:
        rows += [(u, item, "c", 1, "b", DAY, 1) for u in range(n)]
    top = pop.top_items(log_df(spark, rows), DAY, k=3, with_rank=True)
    assert [tuple(r) for r in top.orderBy("rank").collect()] == [(1, 30, 3), (2, 20, 2), (3, 21, 2)]


def test_semi_join_counts_duplicate_user_once_inner_twice(spark):
    log = log_df(spark, [(1, 10, "c", 7, "b", DAY, 1), (2, 11, "c", 8, "b", DAY, 2)])
    users = users_df(spark, [(1, 2, 0), (1, 2, 0), (2, 5, 1)])  # user 1 twice; user 2 not young
    semi = {r.merchant_id: r.number for r in pop.merchant_counts(log, users, DAY, join="semi").collect()}
    inner = {r.merchant_id: r.number for r in pop.merchant_counts(log, users, DAY, join="inner").collect()}
    assert semi == {7: 1}
    assert inner == {7: 2}


def _buyers(spark, ages_genders):
    users = users_df(spark, [(i, a, g) for i, (a, g) in enumerate(ages_genders)])
    log = log_df(spark, [(i, 1, "c", 1, "b", DAY, 2) for i in range(len(ages_genders))])
    return demo.buyers(log, users, DAY)


def test_age_strict_and_lenient(spark):
    b = _buyers(spark, [(0, 0), (None, 0), (3, 1), (4, 1)])
    strict = {r.age_range for r in demo.buyers_by_age(b, "drop").collect()}
    lenient = {r.age_range for r in demo.buyers_by_age(b, "keep_zero").collect()}
    assert strict == {3, 4}
    assert lenient == {0, 3, 4}
    shares = {r.age_range: (r.proportion, r.percent) for r in demo.age_share(b, "drop").collect()}
    assert shares == {3: (0.5, "50.00%"), 4: (0.5, "50.00%")}


def test_gender_ratio_and_no_female(spark):
    b = _buyers(spark, [(1, 0), (1, 1), (1, 1), (1, 2), (1, None)])
    r = demo.gender_ratio(b).collect()[0]
    assert (r.male, r.female, r.ratio) == (2, 1, 2.0)
    none_female = _buyers(spark, [(1, 1), (1, 2)])
    r = demo.gender_ratio(none_female).collect()[0]
    assert (r.male, r.female, r.ratio) == (1, 0, None)
    counts = {r.gender: r["count"] for r in demo.buyers_by_gender(b).collect()}
    assert counts == {0: 1, 1: 2}


def test_duplicate_user_rows_counted_twice_or_collapsed(spark):
    users = users_df(spark, [(1, 3, 1), (1, 3, 1), (2, 4, 0)])
    log = log_df(spark, [(1, 9, "c", 1, "b", DAY, 2), (2, 9, "c", 1, "b", DAY, 2)])
    twice = {r.gender: r["count"] for r in demo.buyers_by_gender(demo.buyers(log, users, DAY)).collect()}
    once = {r.gender: r["count"] for r in demo.buyers_by_gender(
        demo.buyers(log, users, DAY, one_row_per_user=True)).collect()}
    assert twice == {1: 2, 0: 1}
    assert once == {1: 1, 0: 1}


def test_buyer_counted_once_however_often_they_buy(spark):
    users = users_df(spark, [(1, 3, 1)])
    log = log_df(spark, [(1, i, "c", 1, "b", DAY, 2) for i in range(5)])
    assert demo.buyers(log, users, DAY).count() == 1


def test_percent_text_rounds_exact_ratio_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (1, 32), (0, 5)], "c long, t long")
    from promoscope.functions.text import percent_text
    got = [r.p for r in df.select(percent_text("c", "t").alias("p")).collect()]
    assert got == ["12.50%", "33.33%", "66.67%", "3.13%", "0.00%"]


def test_distinct_counts_ignore_null(spark):
    log = log_df(spark, [
        (1, None, "c", 7, "b", 1, 0),
        (1, 5, "c", 7, "b", 1, 0),
        (1, 5, "d", 7, "b", 2, 2),
    ])
    r = feat.behaviour_features(log).collect()[0]
    assert r.unique_item_ids == 1
    assert r.total_logs == 2
    assert r.categories == 2
    assert r.browse_days == 2
    assert (r.one_clicks, r.shopping_carts, r.purchase_times, r.favourite_times) == (1, 0, 1, 0)


def test_pair_not_in_log_has_null_features(spark):
    log = log_df(spark, [(1, 5, "c", 7, "b", 1, 0)])
    users = users_df(spark, [(1, 0, 2), (2, 4, 1)])
    pairs = spark.createDataFrame([(1, 7, 0), (2, 9, 1)], "user_id long, merchant_id long, label int")
    table = feat.feature_table(pairs, users, feat.behaviour_features(log))
    rows = {r.user_id: r for r in table.collect()}
    assert rows[1].age_range is None and rows[1].gender is None  # unknown codes -> NULL
    assert rows[1].total_logs == 1
    assert rows[2].age_range == 4 and rows[2].total_logs is None


def _brute_fill(pdf, cols, directions):
    pdf = pdf.sort_values(["k1", "k2"]).reset_index(drop=True)
    for d in directions:
        pdf[cols] = pdf[cols].ffill() if d == "forward" else pdf[cols].bfill()
    return pdf


@pytest.mark.parametrize("num_ranges", [1, 3, 7])
@pytest.mark.parametrize("directions", [("forward",), ("backward", "forward"), ("backward",),
                                        ("forward", "backward"),
                                        ("forward", "forward", "backward", "forward")])
def test_ordered_fill_matches_single_window_brute_force(spark, num_ranges, directions):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        a = None if (i < 5 or rnd.random() < 0.7) else rnd.randint(0, 9)   # leading NULLs
        b = None if (i > 390 or rnd.random() < 0.5) else rnd.random()      # trailing NULLs
        rows.append((i // 13, (i * 7919) % 1000, a, b, None))
    rnd.shuffle(rows)
    schema = "k1 long, k2 long, a int, b double, z int"
    df = spark.createDataFrame(rows, schema)
    got = fill.ordered_fill(df, ["k1", "k2"], ["a", "b", "z"], directions, num_ranges=num_ranges)
    got = got.toPandas().sort_values(["k1", "k2"]).reset_index(drop=True)
    want = _brute_fill(pd.DataFrame(rows, columns=["k1", "k2", "a", "b", "z"]), ["a", "b", "z"],
                       directions)
    pd.testing.assert_frame_equal(got[["k1", "k2"]], want[["k1", "k2"]], check_dtype=False)
    for c in ["a", "b", "z"]:
        assert got[c].isna().tolist() == want[c].isna().tolist(), c
        assert got[c].dropna().tolist() == pytest.approx(want[c].dropna().tolist()), c


def test_scaler_constant_column_and_sample_std(spark):
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, c double")
    v = VectorAssembler(inputCols=["x", "c"], outputCol="f").transform(df)
    m = StandardScaler(inputCol="f", outputCol="s", withMean=False, withStd=True).fit(v)
    assert m.std[0] == pytest.approx(1.5275252316519468)
    out = m.transform(v).select(vector_to_array("s").alias("s")).collect()
    assert [r.s[1] for r in out] == [0.0, 0.0, 0.0]
    assert out[2].s[0] == pytest.approx(4 / 1.5275252316519468)
