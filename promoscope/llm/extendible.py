"""Byte-bounded shards by extendible hashing (operator 2).

A directory maps hash prefixes to shards.  It starts with one bucket;
only buckets over the byte limit are split on one more hash bit, until
every shard fits.  Each pass reads bucket sums for the next bits of the
oversized buckets alone, so the rows themselves are never sorted and the
directory grows with the number of shards, not of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promoscope.llm._common import HASH_BITS, materialize, row_hash, scratch_dir

SHARD_BYTES = 16 << 20
PASS_BITS = 10


def _prefix(h, depth):
    """The first ``depth`` of the hash's bits (0 for depth 0)."""
    return F.call_function("shiftright", h, (F.lit(HASH_BITS) - depth).cast("int"))


def build_directory(rows: DataFrame, limit: int, folder: str) -> list[tuple[int, DataFrame]]:
    """One (bits, pages) per pass; ``rows``: (h, n_bytes).

    ``pages`` maps each cell (hash prefix of ``bits`` bits) whose bucket
    is settled in this pass to the bucket's depth, shard_bytes and parts.
    ``parts`` is 1, or for a bucket of rows that all share one hash yet
    exceed the limit, the number of parts to deal them into: as many
    rows a part as fit the limit, at least one.
    """
    passes = []
    over = None  # prefixes at depth ``start`` still over the limit
    for start in range(0, HASH_BITS, PASS_BITS):
        end = start + PASS_BITS
        inside = rows if over is None else rows.join(
            over, _prefix(F.col("h"), F.lit(start)) == F.col("over"), "left_semi")
        cells = inside.groupBy(_prefix(F.col("h"), F.lit(end)).alias("cell")).agg(
            F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("r"),
            F.min("h").alias("h0"), F.max("h").alias("h1"))
        cells = materialize(cells, folder, f"cells{start}")
        depths = cells.withColumn("depth", F.explode(F.sequence(
            F.lit(start + 1 if start else 0), F.lit(end))))
        depths = depths.withColumn("prefix", F.call_function(
            "shiftright", F.col("cell"), F.lit(end) - F.col("depth")))
        sums = depths.groupBy("depth", "prefix").agg(
            F.sum("b").alias("b"), F.sum("r").alias("r"),
            F.min("h0").alias("h0"), F.max("h1").alias("h1"))
        # A bucket of one hash cannot be split by further bits.
        fits = sums.where((F.col("b") <= limit) | (F.col("h0") == F.col("h1"))).select(
            "depth", "prefix", F.col("b").alias("shard_bytes"),
            F.when((F.col("b") <= limit) | (F.col("r") == 1), F.lit(1)).otherwise(
                F.ceil(F.col("r") / F.greatest(F.lit(1), F.floor(F.lit(limit) * F.col("r") / F.col("b")))))
            .cast("long").alias("parts"), F.col("r").alias("rows"))
        # The first depth at which a cell's bucket fits is its shard's depth.
        pages = depths.join(fits, ["depth", "prefix"]).groupBy("cell").agg(
            F.min(F.struct("depth", "shard_bytes", "parts", "rows")).alias("page"))
        pages = materialize(pages, folder, f"pages{start}")
        passes.append((end, pages))
        over = materialize(cells.join(pages, "cell", "left_anti")
                           .select(F.col("cell").alias("over")), folder, f"over{start}")
        if over.isEmpty():
            break
    return passes


def shard(docs: DataFrame, limit: int = SHARD_BYTES, text: str = "text",
          key: str = "doc_id") -> DataFrame:
    """``docs`` with n_bytes, shard, shard_depth and shard_bytes.

    ``shard`` is the bucket's hash prefix as bits ("" while one shard
    holds everything).  Existing columns of these names are replaced.
    Bytes are those of the text in UTF-8 (null: 0).  No shard exceeds
    ``limit`` unless it is one row that does so by itself.  Rows equal in
    key and text share their hash; should such rows alone exceed the
    limit, they are dealt by a row number without gaps over the parts that
    they need (suffix "-p"), each with its own shard_bytes.  Very long
    texts count by their bytes and are never split; an empty table gives
    an empty table.
    """
    folder = scratch_dir(docs.sparkSession)
    added = ("n_bytes", "shard", "shard_depth", "shard_bytes", "__h")
    base = docs.drop(*[c for c in added if c not in (text, key)])
    hashed = (base.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
              .withColumn("__h", row_hash(F.col(key), F.col(text))))
    rows = materialize(hashed.select(F.col("__h").alias("h"), "n_bytes"), folder, "rows")
    placed, page = hashed, None
    passes = build_directory(rows, limit, folder)
    for end, pages in passes:
        found = pages.select(F.col("cell").alias(f"__cell{end}"), F.col("page").alias(f"__page{end}"))
        placed = placed.join(
            found, _prefix(F.col("__h"), F.lit(end)) == F.col(f"__cell{end}"), "left")
        here = F.col(f"__page{end}")
        page = here if page is None else F.coalesce(page, here)
    placed = placed.withColumn("__page", page)
    depth, parts, rows_ = (F.col(f"__page.{c}") for c in ("depth", "parts", "rows"))
    dealt = any(not pages.where("page.parts > 1").isEmpty() for _, pages in passes)
    placed = _numbered(placed, folder) if dealt else placed.withColumn("__number", F.lit(None).cast("long"))
    mine = F.pmod("__number", parts)
    bits = F.when(depth == 0, F.lit("")).otherwise(
        F.lpad(F.bin(_prefix(F.col("__h"), depth)), depth, F.lit("0")))
    part = F.when(parts > 1, F.concat(F.lit("-"), mine.cast("string"))).otherwise(F.lit(""))
    # Equal rows are equally large: part p has every ``parts``-th of them.
    part_bytes = F.col("n_bytes") * F.ceil((rows_ - mine) / parts)
    return placed.select(*base.columns, "n_bytes", F.concat(bits, part).alias("shard"),
                         depth.alias("shard_depth"),
                         F.when(parts > 1, part_bytes).otherwise(F.col("__page.shard_bytes"))
                         .cast("long").alias("shard_bytes"))


def _numbered(placed: DataFrame, folder: str) -> DataFrame:
    """``placed`` with __number: 0, 1, ... over the rows of each hash that
    is dealt into parts, null in other rows.

    Such rows are written with an id; rows are counted per hash and
    partition, and numbered from where the partitions before end.  So no
    task takes all rows of a hash.
    """
    dealt = F.coalesce(F.col("__page.parts") > 1, F.lit(False))
    many = materialize(placed.where(dealt).withColumn("__id", F.monotonically_increasing_id()), folder, "many")
    many = many.withColumn("__part", F.shiftright("__id", 33))
    counts = many.groupBy("__h", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__h").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("__h").alias("__ch"), F.col("__part").alias("__cp"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__h", "__part").orderBy("__id")
    many = many.withColumn("__place", F.row_number().over(inside) - 1).join(
        counts, (F.col("__h") == F.col("__ch")) & (F.col("__part") == F.col("__cp")))
    many = many.select(*placed.columns, (F.col("__start") + F.col("__place")).cast("long").alias("__number"))
    return placed.where(~dealt).withColumn("__number", F.lit(None).cast("long")).unionByName(many)
