"""Top-k by count with a deterministic tie-break, and ranks (TOP-1, TOP-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(counts: DataFrame, key: str, number: str = "number", k: int = 100) -> DataFrame:
    """The k rows with the largest ``number``; ties broken by ``key`` ascending.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task
    keeps its own k best rows and only k x tasks rows meet in the final
    merge; no total sort of the counts.
    """
    return counts.orderBy(F.desc(number), F.asc(key)).limit(k)


def ranked(top: DataFrame, key: str, number: str = "number") -> DataFrame:
    """Add ``rank`` 1..k beside each of the (at most k) rows of a top-k.

    The window has no partition key on purpose: its input is the k-row
    result of ``top_k``, so the single partition holds at most k rows.
    """
    order = Window.orderBy(F.desc(number), F.asc(key))
    return top.select(F.row_number().over(order).alias("rank"), key, number)
