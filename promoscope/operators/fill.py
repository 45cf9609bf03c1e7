"""Ordered fill of missing values (WIN-1 forward, WIN-2 backward).

A forward fill is a prefix scan over a global row order.  A single
``Window.orderBy`` would pull every row into one task, so the scan runs
in two levels:

1. ``repartitionByRange`` on the (unique) order key cuts the rows into
   balanced, ordered ranges; sorted inside their range, rows are numbered
   with one LONG that grows in order over all ranges.  The numbered table
   is written to the shared checkpoint folder, so the numbers stay fixed
   if a task is re-run after an executor loss.  From here on rows are
   ordered by the LONG, whatever the key's columns.
2. Per range and column, the last (first) non-NULL value by order is one
   row of a summary table (a hash aggregate): one row per range.
3. A window over that summary (bounded by the number of ranges, not by
   the data) gives each range the value carried in from the ranges
   before (after) it; the carry table is broadcast back.
4. Inside each range a ``partitionBy(range)`` window fills locally; a
   value still NULL takes the carry.

Because the key is unique, range sampling balances the ranges even when
one user owns a large share of the pairs.  The result does not depend on
where the range boundaries fall.

Cost: one range shuffle before the table is written and one after it, on
the range number, which keeps the ranges apart (a hash of it would put
several into one task).  Opposite passes are fused, so a
backward-then-forward fill is still one window pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoscope.session import written

RANGE = "_fill_range"
ORDINAL = "_fill_ordinal"
# monotonically_increasing_id holds the partition in the bits above these.
_PARTITION_SHIFT = 33


def tag_ranges(df: DataFrame, order_cols: Sequence[str],
               num_ranges: int | None = None) -> DataFrame:
    """Number the rows in order and tag them with their range."""
    n = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                .withColumn(ORDINAL, F.monotonically_increasing_id()))
    return written(numbered, "fill").withColumn(RANGE, F.shiftright(ORDINAL, _PARTITION_SHIFT))


def _fill_pass(df: DataFrame, fill_cols: Sequence[str], direction: str,
               then_opposite: bool = False) -> DataFrame:
    """One window pass in ``direction``.

    ``then_opposite`` also applies the opposite pass, exactly, without a
    second window: after a backward pass the only NULLs left are the rows
    after the column's last non-NULL value, and a forward pass fills all
    of them with that value (mirror for forward-then-backward).  That
    value is the edge of the per-range summary, so it costs one more
    column of the small summary table, not a second scan of the data.
    """
    order_key = F.col(ORDINAL)
    forward = direction == "forward"
    if not forward and direction != "backward":
        raise ValueError("direction must be 'forward' or 'backward'")
    edge, other_edge = (F.max_by, F.min_by) if forward else (F.min_by, F.max_by)
    # Last (first) non-NULL value of each range, by order: NULL rows have a
    # NULL ordering value and are skipped by max_by / min_by.
    aggs = [edge(F.col(c), F.when(F.col(c).isNotNull(), order_key)).alias(c) for c in fill_cols]
    if then_opposite:
        aggs += [other_edge(F.col(c), F.when(F.col(c).isNotNull(), order_key)).alias(f"_o_{c}")
                 for c in fill_cols]
    summary = df.groupBy(RANGE).agg(*aggs)
    # Both directions use a running frame (unbounded preceding .. current),
    # which Spark evaluates in one pass; a backward fill is a forward fill
    # over the reversed order.  (A current .. unbounded-following frame is
    # re-aggregated for every row: quadratic in the range size.)
    if forward:
        range_order, row_order = [F.asc(RANGE)], [F.asc(ORDINAL)]
    else:
        range_order, row_order = [F.desc(RANGE)], [F.desc(ORDINAL)]
    across = Window.orderBy(*range_order).rowsBetween(Window.unboundedPreceding, -1)
    within = (Window.partitionBy(RANGE).orderBy(*row_order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # One row per range: the unpartitioned windows and the broadcast are
    # bounded by the range count.
    carry_cols = [F.last(F.col(c), ignorenulls=True).over(across).alias(f"_carry_{c}")
                  for c in fill_cols]
    if then_opposite:
        # The opposite pass's value: the column's edge in the other direction,
        # i.e. its last non-NULL value in the direction of this pass.
        everything = Window.orderBy(*range_order).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)
        carry_cols += [F.first(F.col(f"_o_{c}"), ignorenulls=True).over(everything)
                       .alias(f"_back_{c}") for c in fill_cols]
    carry = summary.select(RANGE, *carry_cols)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = df.repartitionByRange(ranges, RANGE).join(F.broadcast(carry), RANGE, "left")
    out = []
    for c in df.columns:
        if c in fill_cols:
            parts = [F.last(F.col(c), ignorenulls=True).over(within), F.col(f"_carry_{c}")]
            if then_opposite:
                parts.append(F.col(f"_back_{c}"))
            out.append(F.coalesce(*parts).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def ordered_fill(df: DataFrame, order_cols: Sequence[str], fill_cols: Sequence[str],
                 directions: Sequence[str] = ("forward",), num_ranges: int | None = None) -> DataFrame:
    """Fill NULLs of ``fill_cols`` from neighbours in ``order_cols`` order.

    ``directions`` run in sequence, e.g. ``("backward", "forward")``.  The
    order key must be unique, or the fill is as arbitrary as the order of
    tied rows.  Leading (trailing) NULLs stay NULL after a forward
    (backward) pass.  The numbered table stays in the checkpoint folder
    until ``session.clear_scratch``.
    """
    return fill_tagged(tag_ranges(df, order_cols, num_ranges), fill_cols, directions)


def fill_tagged(tagged: DataFrame, fill_cols: Sequence[str],
                directions: Sequence[str]) -> DataFrame:
    """``ordered_fill`` of a table that ``tag_ranges`` has numbered, or of
    some of its rows."""
    out = tagged
    steps = list(directions)
    while steps:
        direction = steps.pop(0)
        opposite = "backward" if direction == "forward" else "forward"
        fuse = bool(steps) and steps[0] == opposite
        if fuse:
            steps.pop(0)
        out = _fill_pass(out, list(fill_cols), direction, then_opposite=fuse)
    return out.drop(RANGE, ORDINAL)
