"""Physical-plan checks: the plans have the shape the design relies on."""

import pytest

from conftest import SF_SMALL

from promoscope.plans.catalog import QUERIES
from promoscope.sources.driver_tables import Tables

# Queries that fit a model or write files before they return.
ROWS_ONLY_ML = {"train_scores", "train_accuracy", "test_scores", "test_scores_refit",
                "assembled_features", "scaled_features", "test_scaled_refit"} | {
    n for n in QUERIES if n.endswith(("_check", "_roundtrip"))}


def queries():
    return QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(set(queries()) - ROWS_ONLY_ML))
def test_no_python_no_cartesian(spark, name):
    plan = formatted(queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_top_items_is_take_ordered_with_pruned_scan(spark):
    plan = formatted(queries()["top_items"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan
    assert "Sort " not in plan.replace("SortAggregate", "")  # no total sort
    # Only the columns used reach the lineitem scan.
    scan = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema") and "l_orderkey" in ln][0]
    assert "l_quantity" not in scan and "l_extendedprice" not in scan
    assert "l_returnflag" in scan


def test_log_without_category_skips_part_table(spark):
    t = Tables(spark, SF_SMALL)
    assert "part.parquet" not in formatted(t.user_log(("user_id", "item_id", "time_stamp")))
    assert "part.parquet" in formatted(t.user_log(("user_id", "cat_id")))


def test_features_one_pass_over_the_log(spark):
    plan = formatted(queries()["behaviour_features"](spark, SF_SMALL))
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("Expand") >= 1


def test_buyers_is_a_semi_join(spark):
    plan = formatted(queries()["buyers"](spark, SF_SMALL))
    assert "LeftSemi" in plan


def test_merchants_semi_join_not_forced_broadcast(spark):
    # The user table grows with the data: no broadcast hint, Spark's size
    # check decides.
    df = queries()["merchants_young_semi"](spark, SF_SMALL)
    assert "broadcast" not in df._jdf.queryExecution().analyzed().toString().lower()
    assert "LeftSemi" in formatted(df)


def test_promo_filter_reaches_orders_before_join(spark):
    plan = formatted(queries()["promo_purchases"](spark, SF_SMALL))
    # The month/day filter is evaluated on orders, below the join.
    lines = plan.splitlines()
    filt = [i for i, ln in enumerate(lines) if ln.startswith("Condition") and "month" in ln]
    assert filt, plan


@pytest.mark.parametrize("name", ["top_items", "top_merchants_young", "merchants_young_semi",
                                  "dedup_user_item_seller_action", "buyers", "gender_share"])
def test_popularity_and_buyer_plans_skip_part_table(spark, name):
    assert "part.parquet" not in formatted(queries()[name](spark, SF_SMALL))


def test_merchant_dedup_has_a_shuffle_of_its_own(spark):
    # Broadcast off: the shape a cluster gets when user_info is large.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = formatted(queries()["merchants_young_semi"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Exchanges: lineitem + orders (log join), log + users (semi join), the
    # four dedup keys, partial counts by seller.
    assert plan.count("Arguments: hashpartitioning(") == 6, plan


def test_fill_plan_has_no_sort_aggregate_and_no_hash_of_ranges(spark):
    plan = formatted(queries()["test_filled"](spark, SF_SMALL))
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert "rangepartitioning(_fill_range" in plan
    hashed = [ln for ln in plan.splitlines()
              if ln.startswith("Arguments: hashpartitioning(_fill_range") and "REPARTITION" in ln]
    assert not hashed


UNUSED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
          "o_totalprice", "o_orderstatus", "o_orderpriority", "c_name", "c_acctbal")


@pytest.mark.parametrize("name", sorted(set(queries()) - ROWS_ONLY_ML))
def test_scans_read_only_used_columns(spark, name):
    plan = formatted(queries()[name](spark, SF_SMALL))
    # Queries that write a table first (the fills) scan the log in that job.
    schemas = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")]
    for ln in schemas:
        for col in UNUSED:
            assert col not in ln, f"{name} reads {col}: {ln}"


def _below_exchange(plan: str, keys: str):
    """Node names under the shuffle by ``keys`` in an explain tree."""
    lines = plan.split("\n")
    at = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning(" + keys in ln)
    return lines[at + 1:at + 3]


@pytest.mark.parametrize("name,keys", [("behaviour_features", "_groupingexpression"), ("merchants_young_semi", "_row")])
def test_rows_are_combined_below_the_wide_shuffle(spark, name, keys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = _below_exchange(plan, keys)
    assert any("HashAggregate" in ln for ln in below), plan
