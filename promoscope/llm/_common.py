"""Helpers the operators of this package share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promoscope.session import ensure_checkpoint_dir

# ASCII white space as the contracts define it: \x20 and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
HASH_BITS = 60
WORD = "[^\\x20\\x09-\\x0D]+"


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


def materialize(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``folder`` and read it back.

    Cuts the lineage with files every executor can read, and gives the
    planner the table's real size: it broadcasts the table only where
    that size is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def findable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where
    the driver did, whatever folder they start in.  On a cluster the
    package is installed or shipped with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def let(value: Column, body) -> Column:
    """``body(x)`` with ``value`` evaluated once per row and bound to x."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text in order; none for null, empty and blank texts."""
    t = F.btrim(text, F.lit(BLANKS))
    return F.when(t != "", F.split(t, BLANK_RUN)).otherwise(F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def long_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def row_hash(*columns: Column) -> Column:
    """60-bit hash of a row's columns (nulls count as empty strings).

    Taken from MD5, so any engine can compute it; rows equal in these
    columns share it.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    hexed = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.conv(F.substring(hexed, 1, 15), 16, 10).cast("long")
