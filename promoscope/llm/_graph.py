"""Connected components of a link table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoscope.llm._common import materialize


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, comp): the least node of the component of every node of
    ``links`` (a, b) that is not itself the least.

    Alternates large-star and small-star steps on the edge table; each
    joins an edge to the least neighbour of one end, found by a partial
    aggregate, so a node of any degree is spread over tasks.  The number
    of rounds grows with the logarithm of the longest chain; they end
    when every component is a star around its least node.
    """
    def oriented(df):
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(
            F.col("u") != F.col("v"))

    def only_stars(df):
        ends = df.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            df.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        found = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return found.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()

    edges = materialize(oriented(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).distinct(),
                        folder, "edges0")
    step = 0
    while not only_stars(edges):
        step += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: larger neighbours move to the least neighbour.
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(oriented(large), folder, f"large{step}")
        # Small star: a node and its smaller neighbours do likewise.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(oriented(small).distinct(), folder, f"edges{step}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
