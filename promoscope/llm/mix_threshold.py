"""Mixing sources to target weights (operator 8).

Hash-threshold histograms: every row has a hash; per source the sizes
are summed by hash bucket, the bucket in which the budget runs out is
found from the running sums, and only that boundary bucket is split
into finer buckets, until it holds rows of one hash.  What the mix takes
is then a filter on the hash.  Rows are never sorted and thresholds are
nested: a larger budget takes a superset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promoscope.llm._common import HASH_BITS, materialize, n_words, row_hash, scratch_dir

STEP_BITS = 12


def source_targets(sizes: DataFrame, weights, share: float, max_repeat: float) -> DataFrame:
    """Per source: source_size, rank, weight and target.

    ``sizes`` has (source, source_size).  Sources by code point, null
    last, take ``weights`` in turn.  They share ``share`` of all sizes by
    weight; a target stops at ``max_repeat`` times its source's size and
    the excess goes to the others by weight.  One row per source: the
    windows below run over the source list, not over documents.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = (sizes.withColumn("rank", F.row_number().over(everything) - 1)
              .withColumn("weight", F.get(w, F.col("rank") % len(weights)))
              .withColumn("cap", F.col("source_size") * F.lit(float(max_repeat))))
    # Water level: with sources by cap per weight, the first one that its
    # share does not fill up sets the level of all that follow.
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = ((F.sum("source_size").over(whole) * F.lit(float(share))
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(whole)
                - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    leveled = (ranked.withColumn("at", F.row_number().over(order))
               .withColumn("level", level))
    first_open = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"),
                              F.struct("at", "level"))).over(whole)
    return (leveled.withColumn("lev", first_open["level"])
            .withColumn("target", F.when(F.col("lev").isNull(), F.col("cap"))
                        .otherwise(F.least("cap", F.col("lev") * F.col("weight"))))
            .select("source", "rank", "source_size", "target"))


def _cut(rows: DataFrame, needs: DataFrame, folder: str) -> DataFrame:
    """Per source the hash ``below``: rows under it fill ``need``.

    ``rows``: (rank, h, size), ``needs``: (rank, need).
    """
    state = needs.select("rank", F.lit(0).cast("long").alias("lo"), F.col("need"),
                         F.lit(False).alias("done"))
    for used in range(0, HASH_BITS, STEP_BITS):
        left = HASH_BITS - used - STEP_BITS  # bits below this step's buckets
        parent = F.lit(1 << (left + STEP_BITS)).cast("long")
        open_ = state.where(~F.col("done"))
        inside = rows.join(open_, "rank").where(
            (F.col("h") >= F.col("lo")) & (F.col("h") < F.col("lo") + parent))
        hist = (inside.groupBy("rank", F.call_function("shiftright", F.col("h"), F.lit(left))
                               .alias("bucket"))
                .agg(F.sum("size").alias("size"), F.min("h").alias("h0"),
                     F.max("h").alias("h1"), F.first("need").alias("need")))
        upto = Window.partitionBy("rank").orderBy("bucket")
        hist = (hist.withColumn("cum", F.sum("size").over(upto))
                .where(F.col("cum") > F.col("need"))
                .withColumn("rest", F.col("need") - (F.col("cum") - F.col("size"))))
        edge = hist.groupBy("rank").agg(F.min(F.struct(
            "bucket", "size", "h0", "h1", "rest")).alias("b"))
        one = F.col("b.h0") == F.col("b.h1")
        edge = edge.select(
            "rank",
            # One hash left: take it if that comes nearer to the target.
            F.when(one, F.when(2 * F.col("b.rest") >= F.col("b.size"), F.col("b.h0") + 1)
                   .otherwise(F.col("b.h0")))
            .otherwise(F.call_function("shiftleft", F.col("b.bucket"), F.lit(left))).alias("n_lo"),
            F.col("b.rest").alias("n_need"), one.alias("n_done"))
        # A source whose rows never exceed its need takes all of them.
        everything = F.lit(1 << HASH_BITS).cast("long")
        state = state.join(edge, "rank", "left").select(
            "rank",
            F.when(F.col("done"), F.col("lo")).otherwise(
                F.coalesce("n_lo", everything)).alias("lo"),
            F.when(F.col("done"), F.col("need")).otherwise(
                F.coalesce("n_need", F.lit(0.0))).alias("need"),
            (F.col("done") | F.coalesce("n_done", F.lit(True))).alias("done"))
        state = materialize(state, folder, f"state{used}")
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("rank", F.col("lo").alias("below"))


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_repeat: int = 2,
        text: str = "text", source: str = "source", key: str = "doc_id",
        size: Column | None = None, keep_text: bool = False) -> DataFrame:
    """Rows of ``docs`` with the number of copies the mix takes, at most
    ``max_repeat``.

    Returns the key column, ``source``, size, source_size, target and
    copies (and all columns of ``docs`` with ``keep_text``; existing
    columns of the added names are replaced).  A row is as large as its
    number of words (null text: 0) unless ``size`` says otherwise; rows
    of size 0 add nothing and are not taken.  Whole copies are taken of every row, and one more of the rows whose hash is
    below the source's threshold.  The hash covers key and text, so rows
    equal in both are taken or left together and reruns agree.  A null
    source is a source of its own, ranked last; an empty table gives an
    empty table.
    """
    folder = scratch_dir(docs.sparkSession)
    added = ("size", "source_size", "target", "copies", "__h", "__rank")
    if keep_text:
        base = docs.drop(*[c for c in added if c not in (text, source, key)])
    else:
        base = docs.select(key, source, text)
    sized = (base.withColumn("size", size if size is not None else n_words(F.col(text)))
             .withColumn("__h", row_hash(F.col(key), F.col(text))))
    if not keep_text:
        # (key, source, size, hash): read several times, computed once.
        sized = sized.drop(text) if text not in (key, source) else sized
        sized = materialize(sized, folder, "sized")
        narrow = sized
    else:
        narrow = materialize(sized.select(source, "size", "__h"), folder, "sized")
    sizes = narrow.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    targets = source_targets(materialize(sizes, folder, "sources"), weights, share, max_repeat)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = (targets.withColumn("whole", F.floor(ratio).cast("long"))
               .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")))
    targets = materialize(targets.withColumnRenamed("source", "__plan_source"), folder, "targets")

    ranked = narrow.join(targets, F.col(source).eqNullSafe(F.col("__plan_source"))).select(
        "rank", F.col("__h").alias("h"), "size")
    cuts = _cut(ranked, targets.select("rank", "need"), folder)
    plan = materialize(targets.join(cuts, "rank").select(
        "__plan_source", "source_size", "target", "whole", "below"), folder, "plan")
    return (sized.join(plan, F.col(source).eqNullSafe(F.col("__plan_source")))
            .withColumn("copies", F.when(F.col("size") > 0, F.least(
                F.lit(max_repeat).cast("long"), F.col("whole") + (F.col("__h") < F.col("below")).cast("long")))
                .otherwise(0).cast("long"))
            .drop("__plan_source", "whole", "below", "__h"))


def mixed(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_repeat: int = 2,
          text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    packed = docs.select(F.struct("*").alias("__row"), F.col(key).alias("__key"),
                         F.col(source).alias("__source"), F.col(text).alias("__text"))
    out = mix(packed, weights, share, max_repeat, "__text", "__source", "__key", keep_text=True)
    taken = out.where(F.col("copies") > 0)
    return taken.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
                        .alias("__copy")).select("__row.*")
