"""Benchmark decontamination by MinHash containment search (operator 9).

Test items are short, documents may be very long, so the Jaccard
similarity that an item of given containment has depends on the
document's size.  Documents are therefore partitioned by size (powers
of two of their number of shingles) and every size class gets as many
one-permutation MinHash registers as keep the chance to miss an item
under ``MISS``: the hash range is cut into bins, a register is the least
shingle hash in its bin, and the number of bins grows with the class.  An
item is a candidate for a document if they agree in a register; each
candidate is then verified on the exact shingle sets.

An item of one shingle has one register or none, which no number of bins
makes sure of.  Such items (fewer than six words, mostly) are looked up
among all shingles of their length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoscope.llm._common import let, materialize, scratch_dir, words

SHINGLE = 5
THRESHOLD_PCT = 80
MISS = 1e-4
#: Item registers up to this many rows are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def shingle_set(text: Column, size: int = SHINGLE) -> Column:
    """Distinct hashes of a text's word shingles, sorted (lower case).

    Texts with fewer words than ``size`` have none.
    """
    def hashed(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - size),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))

    def distinct(s):
        return F.filter(s, lambda x, k: (k == 0) | (x != F.get(s, k - 1)))

    return let(words(F.lower(text)), lambda w: F.when(
        F.size(w) >= size, let(F.sort_array(hashed(w)), distinct))
        .otherwise(F.array().cast("array<bigint>")))


def _registers(s: Column, bits: Column) -> Column:
    """Least hash of each of 2**bits bins; ``s`` sorted, bits 1 to 63."""
    def bin_of(x):
        return F.call_function("shiftrightunsigned", x, F.lit(64) - bits)

    return F.filter(s, lambda x, k: (k == 0) | (bin_of(x) != bin_of(F.get(s, k - 1))))


def bins_per_shingle(least_shared: int, miss: float = MISS) -> float:
    """Bins per document shingle so that at least one of ``least_shared``
    shingles is its bin's least with probability 1 - miss."""
    p = 1 - miss ** (1 / max(1, least_shared))
    x = 0.01
    while x * (1 - math.exp(-1 / x)) < p:
        x *= 1.05
    return x


def item_shingles(text: Column) -> Column:
    """(size, shingles) of an item: of five words, or of all if it has fewer."""
    def of(w):
        n = F.size(w)
        sets = F.when(n >= SHINGLE, shingle_set(text))
        for k in range(SHINGLE - 1, 0, -1):
            sets = sets.when(n == k, shingle_set(text, k))
        return F.struct(F.least(n, F.lit(SHINGLE)).alias("size"), sets.alias("shingles"))

    return let(words(F.lower(text)), of)


def contained_items(docs: DataFrame, items: DataFrame, threshold_pct: int = THRESHOLD_PCT,
                    text: str = "text", key: str = "doc_id", item_text: str = "text",
                    item_key: str = "item_id") -> DataFrame:
    """(key, text_hash, item_key, n_shared, n_item) of contained items.

    An item is contained if the document has at least ``threshold_pct``
    percent of its distinct 5-word shingles; an item of fewer words is one
    shingle of all its words.  Items without words (nulls, empty texts)
    match nothing, nor do documents shorter than an item's shingle.  Rows
    equal in key and text (text_hash) give one pair per item; very long
    texts are searched whole; empty tables give an empty table.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark)
    keyed = docs.select(F.col(key).alias("__key"), F.xxhash64(text).alias("__th"),
                        F.col(text).alias("__text"))
    q = (items.select(F.col(item_key).alias("__item"), item_shingles(F.col(item_text)).alias("__s"))
         .select("__item", F.col("__s.size").alias("__size"), F.col("__s.shingles").alias("__q"))
         .where(F.size("__q") > 0).distinct())
    q = materialize(q, folder, "items")
    short = _short_items(keyed, q.where(F.size("__q") == 1), folder)
    q = q.where(F.size("__q") > 1)
    bound = q.agg(F.min(F.size("__q")).alias("least"), F.sum(F.size("__q")).alias("total")).first()
    pairs_schema = "__key {}, __th bigint, __item {}".format(
        docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString())
    if not bound["total"]:
        short = spark.createDataFrame([], pairs_schema) if short is None else short
        return _one_shared(short, key, item_key)
    per = bins_per_shingle(-(-threshold_pct * bound["least"] // 100))

    def size_class(n):  # log2 of the number of bins
        return F.greatest(F.lit(1), F.least(F.lit(48), F.ceil(F.log2(n * F.lit(per))).cast("int")))

    sketched = (keyed.select("__key", "__th", shingle_set(F.col("__text")).alias("__s"))
                .where(F.size("__s") > 0)
                .select("__key", "__th", "__s", size_class(F.size("__s")).alias("__class")))
    doc_regs = sketched.select("__key", "__th", "__class", F.explode(let(
        F.col("__s"), lambda s: _registers(s, F.col("__class")))).alias("__r"))
    item_regs = (q.withColumn("__class", F.explode(F.sequence(F.lit(1), F.lit(48))))
                 .select("__item", "__class", F.explode(let(
                     F.col("__q"), lambda s: _registers(s, F.col("__class")))).alias("__r")))
    # Nested bins: beyond the class that tells all of an item's shingles
    # apart the registers stay the same, so the size has a bound.
    if bound["total"] * 48 <= BROADCAST_ROWS:
        item_regs = F.broadcast(item_regs)
    found = doc_regs.join(item_regs, ["__class", "__r"]).select("__key", "__th", "__item").distinct()
    by_doc = materialize(found.groupBy("__key", "__th").agg(
        F.collect_list(F.struct("__item")).alias("__items")), folder, "candidates")  # at most the item list

    c = by_doc.withColumnsRenamed({"__key": "__ckey", "__th": "__cth"})
    texts = keyed.join(c, F.col("__key").eqNullSafe(F.col("__ckey"))
                       & (F.col("__th") == F.col("__cth")))
    sets = texts.select("__key", "__th", shingle_set(F.col("__text")).alias("__s"),
                        F.explode("__items.__item").alias("__item"))
    q = q.withColumnRenamed("__item", "__qitem")
    shared = (sets.join(q, F.col("__item").eqNullSafe(F.col("__qitem"))).select(
        F.col("__key").alias(key), F.col("__th").alias("text_hash"),
        F.col("__item").alias(item_key), F.size(F.array_intersect("__s", "__q")).alias("n_shared"),
        F.size("__q").alias("n_item")))
    found = shared.where(100 * F.col("n_shared") >= threshold_pct * F.col("n_item")).distinct()
    return found if short is None else found.unionByName(_one_shared(short, key, item_key))


def _one_shared(pairs: DataFrame, key: str, item_key: str) -> DataFrame:
    return pairs.select(F.col("__key").alias(key), F.col("__th").alias("text_hash"),
                        F.col("__item").alias(item_key), F.lit(1).alias("n_shared"),
                        F.lit(1).alias("n_item"))


def _short_items(keyed: DataFrame, q: DataFrame, folder: str) -> DataFrame | None:
    """(__key, __th, __item) of the items of one shingle that a document
    has; None if there are no such items."""
    sizes = [r[0] for r in q.select("__size").distinct().collect()]  # at most SHINGLE
    if not sizes:
        return None

    def of(k):
        return F.transform(shingle_set(F.col("__text"), k),
                           lambda x: F.struct(F.lit(k).alias("size"), x.alias("hash")))

    grams = F.concat(*[of(k) for k in sorted(sizes)])
    wanted = q.select("__item", F.col("__size").alias("__k"), F.get("__q", F.lit(0)).alias("__r"))
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    grams = keyed.select("__key", "__th", F.explode(grams).alias("__g"))
    found = grams.join(wanted, (F.col("__g.size") == F.col("__k")) & (F.col("__g.hash") == F.col("__r")))
    return materialize(found.select("__key", "__th", "__item").distinct(), folder, "short")


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text",
                  key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that contain an item; all columns stay."""
    hits = contained_items(docs, items, text=text, key=key).select(
        F.col(key).alias("__key"), F.col("text_hash").alias("__th")).distinct()
    hits = materialize(hits, scratch_dir(docs.sparkSession), "hits")
    return docs.join(hits, F.col(key).eqNullSafe(F.col("__key"))
                     & (F.xxhash64(text) == F.col("__th")), "left_anti")
