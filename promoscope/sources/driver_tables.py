"""Adapter: the shopper tables as views over the driver's parquet tables.

The driver ships TPC-H-like tables, not a shop log.  The views below
stand in for the four inputs (user log, user info, training pairs, pairs
to score); FIXTURES.md holds the same text as SQL for the DuckDB oracle.

    user_log   one row per line item, the fifth line of an order twice
               (a repeated event): user = order's customer, item = part,
               seller = supplier, category/brand = part type/brand,
               time_stamp = month*100 + day of the order date,
               action from return flag / line status
    user_info  one row per customer; codes from the key, with NULLs
    user_info_twice  the same, every seventh customer listed twice
    user_info_differing  the same, the second row with another age and gender
    pairs      (user, merchant) pairs with a purchase from 1 June to 31
               August.  Features come from the log before the split day
               (1 July), so pairs first seen after it have none.  Label 1:
               from the split day on the user buys at least twice from
               merchants of the pair's class (merchant id modulo 10), a
               rule whose share of ones does not depend on the scale.
               Users with an even id train, the others are scored.

Every view is lazy and column-pruned: the part table is joined only
when a category or brand column is asked for (p_partkey is unique, so a
left join to it never changes the row count).

Where the orders are too many to broadcast, their join with the lines runs
over the session's number of shuffle partitions: AQE sizes tasks by
compressed bytes, and 64 MB of these narrow rows are millions to be sorted
and grouped in one task.  The joins shuffle the action and the day instead
of the columns they come from, and a line that is logged twice once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoscope.schemas import LOG_COLUMNS, PURCHASE
from promoscope.session import spread

# Features before, labels from this day on (mmdd).
SPLIT_DAY = 701
PAIR_DAYS = (601, 831)
MERCHANT_CLASSES = 10
REPEAT_PURCHASES = 2
# An order's line of this number is logged twice.
TWICE_LINE = 5


class Tables:
    """Parquet tables of one scale-factor folder, plus the adapter views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- user_log -----------------------------------------------------------
    def user_log(self, columns: Iterable[str] = LOG_COLUMNS) -> DataFrame:
        columns = tuple(columns)
        unknown = set(columns) - set(LOG_COLUMNS)
        if unknown:
            raise ValueError(f"not log columns: {sorted(unknown)}")
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey",
            (F.when(F.col("l_returnflag") == "A", F.lit(1))
             .when(F.col("l_returnflag") == "R", F.lit(3))
             .when(F.col("l_linestatus") == "O", F.lit(2))
             .otherwise(F.lit(0))).alias("_action"),
            F.col("l_linenumber").eqNullSafe(TWICE_LINE).alias("_twice"))
        orders = spread(self.table("orders").select(
            "o_orderkey", "o_custkey",
            (F.month("o_orderdate") * 100 + F.dayofmonth("o_orderdate")).cast("int").alias("_day")), "o_orderkey")
        log = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")
        if {"cat_id", "brand_id"} & set(columns):
            part = self.table("part").select("p_partkey", "p_type", "p_brand")
            log = log.join(part, log.l_partkey == part.p_partkey, "left")
        exprs = {
            "user_id": "o_custkey",
            "item_id": "l_partkey",
            "cat_id": "p_type",
            "seller_id": "l_suppkey",
            "brand_id": "p_brand",
            "time_stamp": "_day",
            "action_type": "_action",
        }
        return log.select(*[F.col(exprs[c]).alias(c) for c in columns], "_twice").select(
            *columns, F.explode(F.when(F.col("_twice"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")
        ).drop("_copy")

    # -- user_info ----------------------------------------------------------
    def user_info(self) -> DataFrame:
        key = F.col("c_custkey")
        age = F.when(key % 10 == 9, F.lit(None)).otherwise((key % 10).cast("int"))
        gender = F.when(key % 4 == 3, F.lit(None)).otherwise((key % 4).cast("int"))
        return self.table("customer").select(
            key.alias("user_id"), age.cast("int").alias("age_range"),
            gender.cast("int").alias("gender"))

    def user_info_twice(self) -> DataFrame:
        """Users in which every seventh id occurs twice (equal rows)."""
        users = self.user_info()
        return users.unionByName(users.where(F.col("user_id") % 7 == 0))

    def user_info_differing(self) -> DataFrame:
        """Users in which every seventh id occurs again with another age and gender."""
        users = self.user_info()
        again = users.where(F.col("user_id") % 7 == 0).select(
            "user_id", ((F.coalesce("age_range", F.lit(0)) + 3) % 9).alias("age_range"),
            (1 - F.col("gender") % 2).alias("gender"))
        return users.unionByName(again)

    # -- pairs ----------------------------------------------------------------
    def log_before_split(self, columns: Iterable[str] = LOG_COLUMNS) -> DataFrame:
        """The log that the features of the pairs are taken from."""
        return self.user_log(columns).where(F.col("time_stamp") < SPLIT_DAY)

    def labelled_pairs(self) -> DataFrame:
        """All pairs with their label."""
        log = self.user_log(("user_id", "seller_id", "time_stamp", "action_type"))
        bought = log.where(F.col("action_type") == PURCHASE)
        pairs = (bought.where(F.col("time_stamp").between(*PAIR_DAYS))
                 .select("user_id", F.col("seller_id").alias("merchant_id")).distinct())
        later = (bought.where(F.col("time_stamp") >= SPLIT_DAY)
                 .groupBy("user_id", (F.col("seller_id") % MERCHANT_CLASSES).alias("_class"))
                 .agg(F.count(F.lit(1)).alias("_later")))
        keyed = pairs.withColumn("_class", F.col("merchant_id") % MERCHANT_CLASSES)
        return keyed.join(later, ["user_id", "_class"], "left").select(
            "user_id", "merchant_id",
            (F.coalesce("_later", F.lit(0)) >= REPEAT_PURCHASES).cast("int").alias("label"))

    def train_pairs(self) -> DataFrame:
        """Labelled pairs of the users with an even id."""
        return self.labelled_pairs().where(F.col("user_id") % 2 == 0)

    def test_pairs(self) -> DataFrame:
        """Pairs of the other users, to be scored."""
        return (self.labelled_pairs().where(F.col("user_id") % 2 == 1)
                .select("user_id", "merchant_id", F.lit(None).cast("double").alias("prob")))

    def register_views(self) -> None:
        """Temp views user_log, user_info, train, test for ``spark.sql``."""
        self.user_log().createOrReplaceTempView("user_log")
        self.user_info().createOrReplaceTempView("user_info")
        self.train_pairs().createOrReplaceTempView("train")
        self.test_pairs().createOrReplaceTempView("test")
