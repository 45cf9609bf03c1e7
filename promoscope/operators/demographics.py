"""Who bought on the promo day: gender and age splits (A3, A4).

``buyers`` is a left-semi join of the user table with the distinct ids
of purchasers.  The distinct is aggregated map-side first, so a user
holding a third of all purchase rows leaves each map task as one row;
the semi join then needs no further shuffle of the buyer side (it is
already hash-partitioned on user_id by the aggregate).  A semi join can
not repeat a user, so no dedup is needed after it (DED-3, DED-4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoscope.functions.text import percent_text, safe_ratio
from promoscope.operators.filters import promo_purchases, with_known_age, with_known_gender
from promoscope.schemas import FEMALE, MALE


def buyers(log: DataFrame, users: DataFrame, day_from: int, day_to: int | None = None,
           one_row_per_user: bool = False) -> DataFrame:
    """User rows of everyone who bought in the window (JOIN-3).

    A user listed twice in ``users`` keeps both rows (counted twice, the
    DataFrame variant's rule).  ``one_row_per_user=True`` keeps one row
    per user (DED-4, the RDD variant's rule): the least by the other
    columns in order, nulls first.  That is a mergeable aggregate, so the
    row does not depend on the partitioning; the semi join leaves the
    rows hash-partitioned on user_id, so it runs without another shuffle.
    """
    ids = promo_purchases(log, day_from, day_to).select("user_id").distinct()
    rows = users.join(ids, "user_id", "left_semi")
    return least_row(rows, "user_id") if one_row_per_user else rows


def least_row(df: DataFrame, key: str) -> DataFrame:
    """One row per ``key``: the least by the other columns, in their order."""
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.select(key).distinct()
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(
        *[key if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def count_by(df: DataFrame, column: str) -> DataFrame:
    """AGG-3: (column, count)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def share_by(df: DataFrame, column: str) -> DataFrame:
    """AGG-4 + AGG-6: (column, count, proportion, percent).

    ``column`` must have few distinct values, as the code columns do.  The total is a window over the grouped rows, whose number is bounded
    by the code domain of ``column`` (a handful), so the unpartitioned
    window moves only those few rows to one task.
    """
    counts = count_by(df, column)
    total = F.sum("count").over(Window.partitionBy())
    return (counts.withColumn("_total", total)
            .select(column, "count",
                    safe_ratio("count", "_total").alias("proportion"),
                    percent_text(F.col("count"), F.col("_total")).alias("percent")))


def buyers_by_gender(buyer_rows: DataFrame) -> DataFrame:
    return count_by(with_known_gender(buyer_rows), "gender")


def buyers_by_age(buyer_rows: DataFrame, unknown: str = "drop") -> DataFrame:
    return count_by(with_known_age(buyer_rows, unknown), "age_range")


def gender_share(buyer_rows: DataFrame) -> DataFrame:
    return share_by(with_known_gender(buyer_rows), "gender")


def age_share(buyer_rows: DataFrame, unknown: str = "keep_zero") -> DataFrame:
    return share_by(with_known_age(buyer_rows, unknown), "age_range")


def gender_ratio(buyer_rows: DataFrame) -> DataFrame:
    """AGG-5: one row (male, female, ratio); ratio NULL with no female buyer."""
    known = with_known_gender(buyer_rows)
    counts = known.agg(
        F.count_if(F.col("gender") == MALE).alias("male"),
        F.count_if(F.col("gender") == FEMALE).alias("female"))
    return counts.select("male", "female", safe_ratio("male", "female").alias("ratio"))
