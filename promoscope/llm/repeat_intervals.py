"""Removal of long repeated byte strings (operator 10).

A corpus-wide suffix array would sort every byte position; here only
anchors are sorted.  An anchor is a position whose 48-byte gram has the
least hash in some 200-byte window (winnowing), so equal 200-byte strings
have an anchor at the same place, wherever they occur.  The suffix array
is partitioned by the anchor's gram, and only grams found twice matter:

1. anchors are counted by (gram, context), the context being the at most
   352 bytes that windows over the anchor can reach.  Equal contexts are
   repeats as they stand: both are covered, without comparing bytes.
2. Distinct contexts of one gram form an enhanced suffix array: sorted by
   the bytes after the anchor, with the common prefixes of neighbours.  A
   stack scan yields its common-prefix intervals; in each, the bytes
   before the anchor are sorted likewise.  Members that agree there, but
   lie in different children of the interval, differ on both sides: they
   are a maximal repeat through the anchor, with all its occurrences.
3. A gram with more distinct contexts than one task should hold is cut
   into cells, each for the repeats that reach between some numbers of
   bytes to the right and to the left of the anchor.  A cell's contexts
   agree in the least of these, so they are dealt by those bytes, and
   cells that stay too large are halved again.  Every maximal repeat
   belongs to one cell, which holds all its occurrences: the result is
   the same whatever the limit.

Repeats longer than a context come out as the overlapping pieces that
each anchor sees; their union is the whole repeat.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promoscope.llm._bytes import CHUNK, PART, Rolling, U, binary, mix, parts
from promoscope.llm._common import materialize, scratch_dir

MIN_LEN = 200
GRAM = 48
#: Distinct contexts of one gram that a task holds (352 bytes each);
#: larger groups are cut into cells.
HOT_CONTEXTS = 50_000
#: Least and greatest reach of a cell's repeats, left and right.
BOX = ("la", "lb", "ra", "rb")


def _slide(a, width, f):
    """f over every run of ``width`` neighbours, in log2(width) passes."""
    size = 1
    while 2 * size <= width:
        a = f(a[:-size], a[size:])
        size *= 2
    rest = width - size
    return f(a[:len(a) - rest], a[rest:]) if rest else a


def _anchors(buf, starts, ends, min_len, gram):
    """Anchors of the texts at [starts, ends) of a buffer.

    Returns positions, text numbers, gram hashes, context hashes and
    context bounds.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(buf) < min_len:
        return none, none, none.astype(U), none.astype(U), none, none
    roll = Rolling(buf)
    n, width = len(buf), min_len - gram + 1
    with np.errstate(over="ignore"):
        grams = mix((roll.sums[gram:] - roll.sums[:-gram]) * roll.inverse[:n - gram + 1])
    order = (grams >> U(32)).astype(np.uint32) | np.uint32(1)
    edge = np.zeros(n + 2, dtype=np.int32)  # windows wholly inside one text
    ok = ends - starts >= min_len
    np.add.at(edge, starts[ok], 1)
    np.add.at(edge, ends[ok] - min_len + 1, -1)
    least = np.where(np.cumsum(edge[:n - min_len + 1]) > 0,
                     _slide(order, width, np.minimum), np.uint32(0))
    pad = np.zeros(width - 1, dtype=np.uint32)
    pos = np.flatnonzero(_slide(np.concatenate((pad, least, pad)), width, np.maximum) == order)
    text = np.searchsorted(starts, pos, side="right") - 1
    lo = np.maximum(pos - (min_len - gram), starts[text])
    hi = np.minimum(pos + min_len, ends[text])
    shape = mix(((pos - lo) * 4096 + (hi - lo)).astype(U))
    return pos, text, grams[pos], mix(roll.of(lo, hi) ^ shape), lo, hi


def _chunks(offsets, margin):
    """(first text, last text, core) runs of texts of about CHUNK bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = i + 1
        if offsets[j] - offsets[i] > CHUNK:
            for at in range(offsets[i], offsets[j], CHUNK):
                yield i, j, (max(offsets[i], at - margin), min(offsets[j], at + CHUNK + margin),
                             at, min(offsets[j], at + CHUNK))
            i = j
            continue
        while j < n and offsets[j + 1] - offsets[i] <= CHUNK:
            j += 1
        yield i, j, None
        i = j


def _merge(rows, lo, hi):
    """Union of the intervals of each row."""
    o = np.lexsort((lo, rows))
    rows, lo, hi = rows[o], lo[o], hi[o]
    if not len(rows):
        return rows, lo, hi
    base = rows.astype(np.int64) * (int(hi.max()) + 2)  # rows apart on one line
    reach = np.maximum.accumulate(base + hi)
    first = np.concatenate(([True], (base + lo)[1:] > reach[:-1]))
    at = np.flatnonzero(first)
    last = np.concatenate((at[1:], [len(rows)])) - 1
    return rows[at], lo[at], reach[last] - base[last]


def _anchor_batches(min_len, gram, combine=True):
    """Anchors of the texts; ``combine`` counts equal contexts of a batch
    as one row and merges what they cover (rows of count 0)."""
    def run(batches):
        for b in parts(batches, 2):
            offsets, data = binary(b.column(2))
            found = []
            for i, j, piece in _chunks(offsets, 2 * min_len):
                if piece is None:
                    lo0, hi0 = offsets[i], offsets[j]
                    starts, ends = offsets[i:j] - lo0, offsets[i + 1:j + 1] - lo0
                    keep = starts < ends
                    ids = np.arange(i, j)[keep]
                    pos, t, g, c, lo, hi = _anchors(
                        data[lo0:hi0], starts[keep], ends[keep], min_len, gram)
                else:
                    lo0, hi0, core0, core1 = piece
                    ids = np.array([i])
                    pos, t, g, c, lo, hi = _anchors(
                        data[lo0:hi0], np.array([0]), np.array([hi0 - lo0]), min_len, gram)
                    own = (pos + lo0 >= core0) & (pos + lo0 < core1)
                    pos, t, g, c, lo, hi = (x[own] for x in (pos, t, g, c, lo, hi))
                row = ids[t]
                shift = lo0 - offsets[row]
                found.append((row, g, c, lo + shift, hi + shift, pos + shift))
            if not found:
                continue
            row, g, c, lo, hi, pos = (np.concatenate(x) for x in zip(*found))
            # Contexts met twice in this batch: count them here, once.
            o = np.lexsort((c, g))
            new = np.ones(len(o), dtype=bool)
            new[1:] = (g[o][1:] != g[o][:-1]) | (c[o][1:] != c[o][:-1])
            first = np.flatnonzero(new) if combine else np.arange(len(o))
            count = np.diff(np.concatenate((first, [len(o)])))
            one = o[first]
            twice = o[np.repeat(count > 1, count)]
            m_row, m_lo, m_hi = _merge(row[twice], lo[twice], hi[twice])
            none = np.zeros(len(m_row), dtype=np.int64)
            rows = np.concatenate((row[one], m_row))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((g[one].view(np.int64), none))),
                pa.array(np.concatenate((c[one].view(np.int64), none))),
                pa.array(np.concatenate((count, none)).astype(np.int32)),
                b.column(0).take(pa.array(rows)), b.column(1).take(pa.array(rows)),
                pa.array(np.concatenate((lo[one], m_lo)).astype(np.int64)),
                pa.array(np.concatenate((hi[one], m_hi)).astype(np.int64)),
                pa.array(np.concatenate((pos[one], m_lo)).astype(np.int64)),
            ], names=["gram", "ctx", "cnt", "key", "th", "lo", "hi", "pos"])
    return run


def _cut_contexts(batches):
    """One row per wanted context of a text, with its bytes."""
    for b in parts(batches, 2):
        wants = b.column(3).to_pylist()
        texts = b.column(2).to_pylist()
        rows = [i for i, w in enumerate(wants) for _ in w]
        flat = [w for ws in wants for w in ws]
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array([w["gram"] for w in flat], pa.int64()),
            pa.array([w["ctx"] for w in flat], pa.int64()),
            pa.array([w["n"] for w in flat], pa.int64()),
            b.column(0).take(take), b.column(1).take(take),
            pa.array([w["lo"] for w in flat], pa.int64()),
            pa.array([w["pos"] - w["lo"] for w in flat], pa.int32()),
            pa.array([texts[i][w["lo"]:w["hi"]] for i, w in zip(rows, flat)], pa.binary()),
        ], names=["gram", "ctx", "n", "key", "th", "lo", "before", "bytes"])


def _side(data, at, step, length, width):
    """Matrix of ``width`` bytes from ``at`` on in direction ``step``."""
    k, at = np.arange(width, dtype=np.int32), at.astype(np.int32)
    inside = k < length[:, None]
    index = at[:, None] + step * k
    index[~inside] = 0
    out = data[index] if len(data) else np.zeros(index.shape, dtype=np.uint8)
    out[~inside] = 0
    return out


def _common(matrix, length, a, b):
    """Common prefix lengths of rows a and rows b."""
    differ = matrix[a] != matrix[b]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
    return np.minimum(first, np.minimum(length[a], length[b]))


def _ranked(matrix, group):
    return np.lexsort((np.ascontiguousarray(matrix).view(f"S{matrix.shape[1]}").ravel(), group))


def lcp_intervals(lcp):
    """(depth, first, last) of the common-prefix intervals of sorted
    suffixes; lcp[i] is the common prefix of suffixes i and i + 1."""
    stack = []  # (depth, first suffix)
    for i, d in enumerate(list(lcp) + [-1]):
        first = i
        while stack and stack[-1][0] > d:
            depth, first = stack.pop()
            yield depth, first, i
        if d >= 0 and (not stack or stack[-1][0] < d):
            stack.append((d, first))


def _reach(lc, edge):
    """For each of a row of sorted neighbours, the longest prefix it
    shares with one before it that lies beyond an edge (-1: none)."""
    run = np.cumsum(edge)
    apart = run * (int(lc.max()) + 2)  # a minimum never passes an edge
    least = np.minimum.accumulate(lc - apart) + apart
    return np.concatenate(([-1], np.where(run > 0, least, -1)))


def _scan(gram, before, offsets, data, min_len, listing=False, box=None):
    """Maximal repeats of the contexts: (member, left, right, repeat).

    ``left`` and ``right`` are the bytes before and after the anchor;
    with ``listing`` every repeat is given with all members, which share
    its number, if it lies in its group's ``box`` (columns of BOX).
    Nested repeats make that long, so without it each member comes once,
    with the union of its repeats: all of them span the anchor, so that
    is the longest on either side.
    """
    size = np.diff(offsets)
    right = _side(data, offsets[:-1] + before, 1, size - before, min_len)
    rlen = size - before
    left = _side(data, offsets[:-1] + before - 1, -1, before, min_len)
    alive = np.arange(len(gram))
    while True:  # contexts whose best prefixes cannot make a repeat go
        if len(alive) < 2:
            return []
        bound = np.zeros(len(gram), dtype=np.int64)
        orders = []
        for matrix, length in ((right, rlen), (left, before)):
            o = alive[_ranked(matrix[alive], gram[alive])]
            common = np.where(gram[o[1:]] == gram[o[:-1]],
                              _common(matrix, length, o[1:], o[:-1]), -10 * min_len)
            best = np.full(len(gram), -10 * min_len)
            np.maximum.at(best, o[1:], common)
            np.maximum.at(best, o[:-1], common)
            bound += best
            orders.append((o, common))
        rest = alive[bound[alive] >= min_len]
        if len(rest) == len(alive):
            break
        alive = rest
    (o, rcp), (ol, _) = orders
    lrank = np.empty(len(gram), dtype=np.int64)
    lrank[ol] = np.arange(len(ol))
    cut = np.flatnonzero(gram[o[1:]] != gram[o[:-1]]) + 1
    begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(o)]))
    out, repeat = [], 0
    two = np.flatnonzero(end - begin == 2)
    if len(two):  # two contexts: one interval, no scan needed
        a, b = o[begin[two]], o[begin[two] + 1]
        lcp = _common(left, before, a, b)
        d = rcp[begin[two]]
        hit = lcp + d >= min_len
        if listing:
            la, lb, ra, rb = (x[a] for x in box)
            hit &= (la <= lcp) & (lcp <= lb) & (ra <= d) & (d <= rb)
        k = np.arange(hit.sum())
        for x in (a[hit], b[hit]):
            out.append((x, lcp[hit], d[hit], k))
        repeat = len(k)
    far_left = np.zeros(len(gram), dtype=np.int64)
    far_right = np.zeros(len(gram), dtype=np.int64)
    for g in np.flatnonzero(end - begin > 2):
        members, lcp = o[begin[g]:end[g]], rcp[begin[g]:end[g] - 1]
        for d, i, j in lcp_intervals(lcp.tolist()):
            s = members[i:j + 1]
            child = np.concatenate(([0], np.cumsum(lcp[i:j] == d)))  # below this interval
            by_left = np.argsort(lrank[s], kind="stable")
            s, child = s[by_left], child[by_left]
            lc = _common(left, before, s[1:], s[:-1])
            if int(lc.max()) + d < min_len:
                continue
            if not listing:
                # Alike in one child only: extends to the right, found deeper.
                edge = child[1:] != child[:-1]
                longest = np.maximum(_reach(lc, edge), _reach(lc[::-1], edge[::-1])[::-1])
                hit = longest + d >= min_len
                who = s[hit]
                far_left[who] = np.maximum(far_left[who], longest[hit])
                far_right[who] = np.maximum(far_right[who], d)
                continue
            la, lb, ra, rb = (int(x[s[0]]) for x in box)
            if not ra <= d <= rb:
                continue
            for depth, x, y in lcp_intervals(lc.tolist()):
                if depth + d < min_len or not la <= depth <= lb:
                    continue
                if (child[x:y + 1] == child[x]).all():
                    continue
                who = s[x:y + 1]
                out.append((who, np.full(len(who), depth), np.full(len(who), d),
                            np.full(len(who), repeat)))
                repeat += 1
    if not listing and (who := np.flatnonzero(far_right)).size:
        out.append((who, far_left[who], far_right[who], np.zeros(len(who), dtype=np.int64)))
    return out


def _repeat_batches(min_len, listing):
    """Scans runs of whole cells; rows come sorted by cell."""
    def solve(t):
        cell = t.column(0).to_numpy()
        offsets, data = binary(t.column(7))
        found = _scan(cell, t.column(6).to_numpy().astype(np.int64), offsets, data, min_len,
                      listing, [t.column(c).to_numpy() for c in BOX] if listing else None)
        if not found:
            return None
        who, left, right, repeat = (np.concatenate(x) for x in zip(*found))
        at = t.column(5).to_numpy()[who] + t.column(6).to_numpy()[who]
        pick = pa.array(who)
        return pa.RecordBatch.from_arrays([
            pa.array(cell[who]), pa.array(repeat.astype(np.int64)),
            *(t.column(c).combine_chunks().take(pick) for c in ("gram", "ctx", "key", "th")),
            pa.array((at - left).astype(np.int64)), pa.array((at + right).astype(np.int64)),
        ], names=["cell", "repeat", "gram", "ctx", "key", "th", "lo", "hi"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.nbytes
            if size < PART:
                continue
            t = pa.Table.from_batches(held)
            g = t.column(0).to_numpy()
            cut = int(np.searchsorted(g, g[-1], side="left"))  # the last group may go on
            if cut:
                if (out := solve(t.slice(0, cut))) is not None:
                    yield out
                t = t.slice(cut)
            held, size = t.to_batches(), t.nbytes
        if held and (out := solve(pa.Table.from_batches(held))) is not None:
            yield out
    return run


def _halves(min_len):
    """The two halves of a cell's box: by the right reach until that is
    one number, then by the left."""
    la, lb, ra, rb = (F.col(c) for c in BOX)
    right, left = F.shiftright(ra + rb, 1), F.shiftright(la + lb, 1)

    def least(r):  # what a repeat of right reach r or less has on the left
        return F.greatest(la, F.lit(min_len) - r)

    def box(*bounds):
        return F.struct(*[b.alias(c) for b, c in zip(bounds, BOX)])

    return F.when(ra < rb, F.array(box(least(right), lb, ra, right),
                                   box(least(rb), lb, right + 1, rb))).otherwise(
        F.array(box(la, left, ra, rb), box(left + 1, lb, ra, rb)))


def _sized(cells, hot_contexts, folder, name):
    """(cells that a task can scan, the others); lone contexts go."""
    sizes = materialize(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
                        .where("size > 1"), folder, f"{name}_sizes")
    large = sizes.where(F.col("size") > hot_contexts).select("cell")
    small = sizes.where(F.col("size") <= hot_contexts).select("cell")
    return (cells.join(small, "cell", "left_semi").select(cells.columns),
            cells.join(large, "cell", "left_semi").select(cells.columns), large.isEmpty())


def _cells(hot, folder, min_len, hot_contexts, listing):
    """Cuts hot cells until each can be scanned: (cells, done).

    ``done`` are the repeats of cells whose box is a single reach, so that
    all members share it; without ``listing`` one right reach is enough,
    as other cells find what lies further left.  Boxes halve, so the
    rounds are at most two logarithms of ``min_len``.
    """
    single = F.col("ra") == F.col("rb")
    if listing:
        single &= F.col("la") == F.col("lb")
    cells, done, turn = [], [], 0
    while True:
        done.append(hot.where(single))
        split = (hot.where(~single).withColumn("box", F.explode(_halves(min_len))).drop(*BOX)
                 .select("*", "box.*").drop("box")
                 .where((F.col("before") >= F.col("la"))
                        & (F.octet_length("bytes") - F.col("before") >= F.col("ra"))))
        shared = F.col("bytes").substr(F.col("before") - F.col("la") + 1, F.col("la") + F.col("ra"))
        split = materialize(split.withColumn("cell", F.xxhash64("cell", *BOX, shared))
                            .select(hot.columns), folder, f"cells_{turn}")
        small, hot, none_left = _sized(split, hot_contexts, folder, f"cells_{turn}")
        cells.append(small)
        turn += 1
        if none_left:
            break
    out = cells[0]
    for c in cells[1:]:
        out = out.unionByName(c)
    ready = done[0]
    for d in done[1:]:
        ready = ready.unionByName(d)
    return out, ready


def _shared_by_all(done, listing):
    """The repeats of cells whose members share one reach: with
    ``listing`` those that differ in the next byte on both sides."""
    at = F.col("lo") + F.col("before")
    if listing:
        def differs(byte):
            # Ends of texts and of contexts differ from all else.
            return (F.count(byte) < F.count(F.lit(1))) | (F.min(byte) != F.max(byte))

        size = F.octet_length("bytes")
        after = F.when(F.col("before") + F.col("ra") < size,
                       F.col("bytes").substr(F.col("before") + F.col("ra") + 1, F.lit(1)))
        prior = F.when(F.col("before") > F.col("la"),
                       F.col("bytes").substr(F.col("before") - F.col("la"), F.lit(1)))
        diverse = done.groupBy("cell").agg(differs(after).alias("r"), differs(prior).alias("l"))
        done = done.join(diverse.where("r AND l"), "cell", "left_semi")
    return done.select("cell", F.lit(0).cast("long").alias("repeat"), "gram", "ctx", "key", "th",
                       (at - F.col("la")).alias("lo"), (at + F.col("ra")).alias("hi"))


def _keyed(docs, text, key):
    return docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))


def _same(left, right):
    return (F.col(f"{left}key").eqNullSafe(F.col(f"{right}key"))
            & (F.col(f"{left}th") == F.col(f"{right}th")))


def _find(docs, folder, min_len, text, key, hot_contexts, combine=True):
    """Steps 1 to 3 of the module's text: (known, marked, groups)."""
    gram = min(GRAM, min_len // 2)
    kind = docs.schema[key].dataType.simpleString()
    base = _keyed(docs, text, key)
    anchors = materialize(base.where(F.octet_length("bytes") >= min_len).mapInArrow(
        _anchor_batches(min_len, gram, combine),
        f"gram long, ctx long, cnt int, key {kind}, th long, lo long, hi long, pos long"),
        folder, "anchors")
    known = anchors.where(F.col("cnt") == 0).select("key", "th", "lo", "hi")
    counted = anchors.where(F.col("cnt") > 0)
    grams = counted.groupBy("gram").agg(F.sum("cnt").alias("total")).where("total > 1")
    some = materialize(counted.join(grams.select("gram"), "gram"), folder, "repeated")
    same = Window.partitionBy("gram", "ctx")
    marked = (some.withColumn("n", F.sum("cnt").over(same))
              .withColumn("rn", F.row_number().over(same.orderBy("key", "th", "lo"))))
    marked = materialize(marked, folder, "marked")
    distinct = marked.where("rn = 1")
    # Grams whose contexts differ, at least one of them found once only.
    open_ = distinct.groupBy("gram").agg(
        F.count(F.lit(1)).alias("contexts"), F.min("n").alias("least")).where("contexts > 1")
    if combine:
        open_ = open_.where("least = 1")
    todo = distinct.join(open_.select("gram", "contexts"), "gram")
    wants = todo.groupBy(F.col("key").alias("wkey"), F.col("th").alias("wth")).agg(
        F.collect_list(F.struct("gram", "ctx", "n", "lo", "hi", "pos")).alias("wants"))
    # Of rows equal in key and text, one is cut.
    contexts = (base.join(wants, _same("", "w")).select("key", "th", "bytes", "wants")
                .mapInArrow(_cut_contexts, f"gram long, ctx long, n long, key {kind}, th long, "
                                           "lo long, before int, bytes binary"))
    contexts = materialize(contexts, folder, "contexts")
    box = (0, min_len - gram, gram, min_len)
    contexts = contexts.select(
        F.col("gram").alias("cell"), "ctx", "n", "key", "th", "lo", "before", "bytes", "gram",
        *[F.lit(v).alias(c) for v, c in zip(box, BOX)])
    hot = materialize(open_.where(F.col("contexts") > hot_contexts)
                      .select(F.col("gram").alias("cell")), folder, "hot")
    cells, done = contexts, None
    if not hot.isEmpty():
        cut, done = _cells(contexts.join(hot, "cell", "left_semi").select(contexts.columns),
                           folder, min_len, hot_contexts, not combine)
        cells = contexts.join(hot, "cell", "left_anti").select(contexts.columns).unionByName(cut)
    groups = cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        _repeat_batches(min_len, listing=not combine),
        f"cell long, repeat long, gram long, ctx long, key {kind}, th long, lo long, hi long")
    if done is not None:
        groups = groups.unionByName(_shared_by_all(done, not combine))
    return known, marked, materialize(groups, folder, "groups")


def covered_ranges(docs: DataFrame, min_len: int = MIN_LEN, text: str = "text",
                   key: str = "doc_id", hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(key, th, lo, hi): byte ranges equal to a range elsewhere, of
    ``min_len`` bytes or more; ``th`` is xxhash64 of the text."""
    folder = scratch_dir(docs.sparkSession)
    known, marked, groups = _find(docs, folder, min_len, text, key, hot_contexts)
    place = ("key", "th", "lo", "hi")
    return known.unionByName(marked.where("n > 1").select(*place)).unionByName(
        groups.select(*place))


def maximal_repeats(docs: DataFrame, min_len: int = MIN_LEN, text: str = "text",
                    key: str = "doc_id", hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(group_1, group_2, key, th, lo, hi): maximal repeats, all occurrences.

    Rows of one group are the places of one string.  Repeats longer than
    a context are listed by the pieces that their anchors see; so are
    equal contexts (group_1 the gram, group_2 the context).  Every window
    of a repeat has an anchor that all its occurrences chose, whose group
    lists them all; an anchor that only some chose adds a group of those.
    The groups do not depend on ``hot_contexts``, only their names do.
    """
    folder = scratch_dir(docs.sparkSession)
    _, marked, groups = _find(docs, folder, min_len, text, key, hot_contexts, False)
    places = marked.select("gram", "ctx", F.col("key").alias("pkey"), F.col("th").alias("pth"),
                           F.col("lo").alias("plo"))
    first = marked.where("rn = 1").select("gram", "ctx", F.col("lo").alias("flo"))
    # An occurrence lies in each equal context at the same distance.
    listed = (groups.join(first, ["gram", "ctx"]).join(places, ["gram", "ctx"])
              .select(F.col("cell").alias("group_1"), F.col("repeat").alias("group_2"),
                      F.col("pkey").alias("key"), F.col("pth").alias("th"),
                      (F.col("lo") - F.col("flo") + F.col("plo")).alias("lo"),
                      (F.col("hi") - F.col("flo") + F.col("plo")).alias("hi")))
    twins = marked.where("n > 1").select(F.col("gram").alias("group_1"), F.col("ctx").alias("group_2"),
                                         "key", "th", "lo", "hi")
    listed = listed.unionByName(twins)
    return listed.withColumnRenamed("key", key)


def _removed_batches(names):
    """Per text the merged ranges and the bytes that are left."""
    def run(batches):
        for b in parts(batches, 0):
            texts = b.column(0).to_pylist()
            spans = b.column(1).to_pylist()
            size, removed, runs, digest, merged_out = [], [], [], [], []
            for t, sp in zip(texts, spans):
                merged = []
                for s in sorted((x["lo"], x["hi"]) for x in sp or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                h, at = hashlib.sha256(), 0
                for lo, hi in merged:
                    h.update(t[at:lo])
                    at = hi
                h.update(t[at:])
                size.append(len(t))
                removed.append(sum(hi - lo for lo, hi in merged))
                runs.append(len(merged))
                digest.append(h.hexdigest())
                merged_out.append([{"lo": lo, "hi": hi} for lo, hi in merged])
            span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(merged_out, span)]
                + [b.column(i) for i in range(2, b.num_columns)],
                names=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *names])
    return run


def repeated_spans(docs: DataFrame, min_len: int = MIN_LEN, text: str = "text",
                   key: str = "doc_id", hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """Per row of ``docs``: key, n_bytes, n_removed, n_spans, kept_sha256
    and spans (lo, hi), the maximal byte ranges covered by ``min_len``-byte
    strings that also start elsewhere, in this text or another.

    Texts are UTF-8 bytes, null is empty; matches never cross texts and
    are judged on the input.  Equal rows are copies of each other.  Texts
    under ``min_len`` bytes have no spans; an empty table gives none.  Long
    texts are read whole, a chunk at a time.  Other columns of ``docs`` are
    not used, whatever their names.
    """
    covered = covered_ranges(docs, min_len, text, key, hot_contexts)
    by_doc = covered.groupBy(F.col("key").alias("ckey"), F.col("th").alias("cth")).agg(
        F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    kind = docs.schema[key].dataType.simpleString()
    rows = _keyed(docs, text, key).join(by_doc, _same("", "c"), "left")
    return rows.select("bytes", "ranges", F.col("key").alias(key)).mapInArrow(
        _removed_batches([key]),
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        f"spans array<struct<lo:long,hi:long>>, `{key}` {kind}").select(
        key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
