"""Per (user, merchant) behaviour features and the feature table (A5).

All eight log features come from one scan of the log, aggregated in
levels (see ``behaviour_features``).  Each level hands on at most one row
per row it gets; every shuffle on the way is keyed by more than the pair,
except the last, which carries one partial row per pair and task, so a hot
(user, merchant) pair is spread over many tasks.  That is one scan of the
log instead of the five the per-feature form would need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoscope.schemas import (
    AGE_UNKNOWN, CART, CLICK, FAVOURITE, FEATURES, GENDER_UNKNOWN, PURCHASE,
)
from promoscope.session import spread


def _pair_group():
    """Group key of every feature: (user_id, seller_id as merchant_id)."""
    return (F.col("user_id"), F.col("seller_id").alias("merchant_id"))

# Feature name -> action code it counts (FEAT-6).
ACTION_FEATURES = (
    ("one_clicks", CLICK),
    ("shopping_carts", CART),
    ("purchase_times", PURCHASE),
    ("favourite_times", FAVOURITE),
)


def _action_count(code: int):
    # A row counts when it has an item (pandas counted non-NULL item_id).
    return F.count_if((F.col("action_type") == code) & F.col("item_id").isNotNull())


def total_logs(log: DataFrame) -> DataFrame:
    """FEAT-1: log rows (with an item) per pair."""
    return log.groupBy(*_pair_group()).agg(F.count("item_id").alias("total_logs"))


def unique_items(log: DataFrame) -> DataFrame:
    """FEAT-2: distinct items per pair (NULL not counted)."""
    return log.groupBy(*_pair_group()).agg(F.count_distinct("item_id").alias("unique_item_ids"))


def categories(log: DataFrame) -> DataFrame:
    """FEAT-3: distinct categories per pair."""
    return log.groupBy(*_pair_group()).agg(F.count_distinct("cat_id").alias("categories"))


def browse_days(log: DataFrame) -> DataFrame:
    """FEAT-4: distinct days per pair."""
    return log.groupBy(*_pair_group()).agg(F.count_distinct("time_stamp").alias("browse_days"))


def action_counts(log: DataFrame) -> DataFrame:
    """FEAT-5: long form (user_id, merchant_id, action_type, times)."""
    return (log.groupBy(*_pair_group(), F.col("action_type"))
            .agg(F.count("item_id").alias("times")))


def action_features(log: DataFrame) -> DataFrame:
    """FEAT-6: the four action counts side by side, one pass."""
    return log.groupBy(*_pair_group()).agg(
        *[_action_count(code).alias(name) for name, code in ACTION_FEATURES])


#: Tasks over which the rows of one pair are spread by their items, at most.
VALUE_PARTS = 16


def _first(*group: str):
    """True in one row of each group."""
    return F.row_number().over(Window.partitionBy(*group).orderBy(group[-1])) == 1


def behaviour_features(log: DataFrame) -> DataFrame:
    """FEAT-1..6 in one pass: user_id, merchant_id + 8 features.

    Four aggregation levels; each hands on at most one row per row it gets
    and no copy per distinct count, which would multiply the disk that a
    large log's shuffles take.  The first groups by every column of use
    (pair, item, category, day, action) and counts rows.  Grouped as one
    struct, those columns need a shuffle of their own: a partitioning by
    item or user that the log happens to come with would otherwise be reused
    and keep a hot one in a single task.  Rows equal in them are combined
    before that shuffle.
    The next two levels count a column's values, marking one row of each
    where all of them have met, and then drop it: the second the item, the
    third the category, in long form as a value.  AQE would size their
    shuffles by compressed bytes and put millions of rows into one task, so
    they are dealt over the session's number of shuffle partitions.  A
    category of a pair may be hot, so the second level deals the pair by a
    part of its items and leaves one row per part, category, day and action.
    The last level has one row per pair, with the set of its days, which is
    no longer than the calendar.
    """
    pair = ("user_id", "seller_id")
    keys = (*pair, "item_id", "cat_id", "time_stamp", "action_type")
    events = log.groupBy(F.struct(*keys).alias("_event")).agg(F.count("item_id").alias("_rows"))
    events = events.select("_event.*", "_rows", F.pmod(F.xxhash64("item_id"), F.lit(VALUE_PARTS)).alias("_part"))
    values = events.unpivot([c for c in events.columns if c != "cat_id"], ["cat_id"], "_feature", "_value")
    by = (*pair, "_part", "_value", "time_stamp", "action_type")
    values = spread(values, *pair, "_part").withColumn("_item", _first(*pair, "_part", "item_id"))
    values = values.groupBy(*by).agg(
        F.sum("_rows").alias("_rows"),
        F.count(F.when(F.col("_item"), F.col("item_id"))).alias("_items"))
    values = spread(values.drop("_part"), *pair, "_value").withColumn("_first", _first(*pair, "_value"))
    return values.groupBy(*_pair_group()).agg(
        F.sum("_rows").alias("total_logs"),
        F.sum("_items").alias("unique_item_ids"),
        F.count(F.when(F.col("_first"), F.col("_value"))).alias("categories"),
        F.size(F.collect_set("time_stamp")).cast("long").alias("browse_days"),
        *[F.sum(F.when(F.col("action_type") == code, F.col("_rows")).otherwise(0)).alias(name)
          for name, code in ACTION_FEATURES])


def clean_demographics(users: DataFrame) -> DataFrame:
    """FEAT-7: unknown codes (age 0, gender 2) become NULL."""
    return users.select(
        "user_id",
        F.nullif(F.col("age_range"), F.lit(AGE_UNKNOWN)).alias("age_range"),
        F.nullif(F.col("gender"), F.lit(GENDER_UNKNOWN)).alias("gender"))


def feature_table(pairs: DataFrame, users: DataFrame, features: DataFrame) -> DataFrame:
    """FEAT-8: pairs + age, gender + 8 log features (left joins, JOIN-4/5).

    The pair join runs first: pairs and features are both keyed by
    (user_id, merchant_id), and the features come out of an aggregation on
    those keys.  The pairs are spread, so that neither is coalesced by its
    compressed bytes: one task would aggregate and sort millions of rows.
    The user join follows on user_id; a user with many pairs is a skewed
    left side, which AQE's skew-join split handles for left outer joins.
    """
    head = [c for c in pairs.columns if c not in FEATURES]
    joined = (spread(pairs, "user_id", "merchant_id").join(features, ["user_id", "merchant_id"], "left")
              .join(clean_demographics(users), "user_id", "left"))
    return joined.select(*head, *[F.col(c).cast("long").alias(c) if c not in ("age_range", "gender")
                                  else F.col(c) for c in FEATURES])
