"""Popular items and merchants watched by young users (A1, A2).

Plan shape (A1): scan -> filter -> partial distinct on (user, item,
action) -> shuffle on the three keys -> final distinct + partial count
per item -> shuffle on item -> final count -> TakeOrderedAndProject.
The first shuffle is keyed by all three columns, so a hot item is spread
over many tasks; the second carries one partial count per item and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoscope.operators.filters import promo_non_click, young_users
from promoscope.operators.topk import ranked, top_k
from promoscope.schemas import TOP_K, YOUNG_AGES

ITEM_KEYS = ("user_id", "item_id", "action_type")
MERCHANT_KEYS = ("user_id", "item_id", "seller_id", "action_type")


def dedup_user_item_action(log: DataFrame, day_from: int, day_to: int | None = None) -> DataFrame:
    """DED-1: one row per (user, item, action) among non-click rows."""
    return promo_non_click(log, day_from, day_to).select(*ITEM_KEYS).distinct()


def dedup_user_item_seller_action(log: DataFrame, day_from: int,
                                  day_to: int | None = None) -> DataFrame:
    """DED-2: one row per (user, item, seller, action) among non-click rows."""
    return promo_non_click(log, day_from, day_to).select(*MERCHANT_KEYS).distinct()


def item_counts(log: DataFrame, day_from: int, day_to: int | None = None,
                dedup: bool = True) -> DataFrame:
    """AGG-1 (or DED-5 with ``dedup=False``): (item_id, number)."""
    if dedup:
        rows = dedup_user_item_action(log, day_from, day_to)
    else:
        rows = promo_non_click(log, day_from, day_to).select("item_id")
    return rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("number"))


def top_items(log: DataFrame, day_from: int, day_to: int | None = None,
              k: int = TOP_K, dedup: bool = True, with_rank: bool = False) -> DataFrame:
    """A1: the k items with the most (deduplicated) cart/buy/favourite actions."""
    top = top_k(item_counts(log, day_from, day_to, dedup), "item_id", "number", k)
    return ranked(top, "item_id") if with_rank else top


def merchant_counts(log: DataFrame, users: DataFrame, day_from: int,
                    day_to: int | None = None, ages=YOUNG_AGES,
                    join: str = "semi") -> DataFrame:
    """AGG-2: (merchant_id, number) over young users' deduplicated actions.

    ``join="semi"`` keeps log rows whose user is young (set membership,
    JOIN-2); ``join="inner"`` joins the user rows (JOIN-1) and so repeats
    log rows when a user id occurs twice in ``users``.  No broadcast is
    forced: the user table grows with the data, so Spark's size check
    (autoBroadcastJoinThreshold, AQE at runtime) picks the strategy.
    """
    young = young_users(users, ages).select("user_id")
    rows = promo_non_click(log, day_from, day_to).select(*MERCHANT_KEYS)
    # The dedup gets a shuffle of its own, on all four keys as one struct: on
    # the join's partitioning by user it would pin every row of a hot user to
    # one task, and AQE could not split the join's skewed partitions.  Equal
    # rows meet before that shuffle already.
    if join == "semi":
        kept = (rows.join(young, "user_id", "left_semi")
                .select(F.struct(*MERCHANT_KEYS).alias("_row")).distinct().select("_row.*"))
    elif join == "inner":
        # Set semantics of the dedup are kept per joined user row: a user
        # listed twice contributes twice.
        kept = (rows.distinct().join(young, "user_id", "inner"))
    else:
        raise ValueError("join must be 'semi' or 'inner'")
    return (kept.groupBy(F.col("seller_id").alias("merchant_id"))
            .agg(F.count(F.lit(1)).alias("number")))


def top_merchants(log: DataFrame, users: DataFrame, day_from: int,
                  day_to: int | None = None, ages=YOUNG_AGES, k: int = TOP_K,
                  with_rank: bool = True) -> DataFrame:
    """A2: the k merchants most watched by young users."""
    top = top_k(merchant_counts(log, users, day_from, day_to, ages), "merchant_id", "number", k)
    return ranked(top, "merchant_id") if with_rank else top
