"""Result writers (SNK-1..4).

Ranked lists are at most k rows, so they are written as one file in rank
order.  Score tables grow with the data and are written by every task in
parallel.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoscope.functions.text import ranked_line
from promoscope.functions.vectors import vector_values


def write_ranked_csv(ranked: DataFrame, path: str, key: str, mode: str = "overwrite") -> None:
    """`key,Number` CSV with header, rows in rank order (k rows, one file)."""
    (ranked.select("rank", key, F.col("number").alias("Number"))
     .repartition(1).sortWithinPartitions("rank").drop("rank")
     .write.mode(mode).option("header", True).csv(path))


def write_ranked_text(ranked: DataFrame, path: str, key: str, mode: str = "overwrite") -> None:
    """`rank<TAB>key, count` lines in rank order (k rows, one file)."""
    (ranked.select("rank", ranked_line("rank", key, "number").alias("value"))
     .repartition(1).sortWithinPartitions("rank").drop("rank")
     .write.mode(mode).text(path))


def write_table(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A small result table as CSV with header."""
    table.coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_train_scores(scored: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Scored training rows as CSV; vector columns become JSON arrays."""
    cols = []
    for f in scored.schema.fields:
        if isinstance(f.dataType, VectorUDT):
            cols.append(F.to_json(vector_values(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    scored.select(*cols).write.mode(mode).option("header", True).csv(path)


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Final `user_id,merchant_id,prob` table, written by all tasks."""
    (scores.select("user_id", "merchant_id", "prob")
     .write.mode(mode).option("header", True).csv(path))
