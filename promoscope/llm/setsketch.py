"""Near-duplicate groups by SetSketch registers (operator 6).

A register holds the floor of a logarithm (base ``BASE``) of the least of
exponentially distributed values that a set's elements draw for it.
Registers of a union are the maxima of the registers, and equal registers
grow with the Jaccard similarity, so bands of them find candidates; the
counts of larger, smaller and equal registers give the likelihood of a
pair's similarity, which sifts the candidates before the full shingle
sets confirm them.

Texts of equal sets are one node.  In a bucket (texts that agree in a
band) every node is compared with the bucket's center first.  Nodes that
end up in another component than it are compared with that component's
nodes, and then with each other, inside tasks and in blocks of bounded
size; then with those nodes alone that have joined that component since,
until no more join.  So every pair of a bucket is in one component or
compared, and a group of near copies does not make all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoscope.llm._bytes import PART, U, binary, mix, parts, word_hashes
from promoscope.llm._common import materialize, scratch_dir
from promoscope.llm._graph import components

BASE = 1.001
SCALE = 20.0
TOP = 65535
BANDS = 32
ROWS = 5
REGISTERS = BANDS * ROWS
#: Standard errors of the estimate that a candidate may fall short by.
SLACK = 4.0
#: Queries per block and members per chunk of a cell.
BLOCK = 64
CELL = 1024


def shingle_sets(offsets, data, size):
    """(text number, hash), sorted: the distinct shingles of each text.

    Texts with fewer words than a shingle have their whole word sequence
    as one; texts without words have none.
    """
    text, word = word_hashes(offsets, data)
    if not len(text):
        return text, word
    n = len(text)
    acc = word.copy()
    complete = np.ones(n, dtype=bool)
    first = np.ones(n, dtype=bool)
    first[1:] = text[1:] != text[:-1]
    with np.errstate(over="ignore"):
        for k in range(1, size):
            if k >= n:
                complete[:] = False
                break
            inside = np.zeros(n, dtype=bool)
            inside[:n - k] = text[k:] == text[:n - k]
            nxt = np.zeros(n, dtype=U)
            nxt[:n - k] = word[k:]
            acc = np.where(inside, mix(acc * U(0x9E3779B97F4A7C15) + nxt), acc)
            complete &= inside
    short = first & ~complete
    keep = complete | short
    text, acc = text[keep], acc[keep]
    o = np.lexsort((acc, text))
    text, acc = text[o], acc[o]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (acc[1:] != acc[:-1])
    return text[new], acc[new]


def sketch(text, element, n, m=REGISTERS):
    """n x m uint16 registers of the sets given as (set number, element).

    Every element draws the points of a Poisson process of rate m in
    rising order, each for a random register; a set is done with an
    element once its point exceeds all of the set's registers.
    """
    least = np.full(n * m, np.inf)
    x = np.zeros(len(element))
    t, h = text, element
    step = 0
    while len(t):
        step += 1
        with np.errstate(over="ignore"):
            v = mix(h + U((step * 0xD1342543DE82EF95) & (2**64 - 1)))
        x = x - np.log(((v >> U(32)).astype(np.float64) + 0.5) / 2.0**32) / m
        place = t * m + (((v & U(0xFFFFFFFF)) * U(m)) >> U(32)).astype(np.int64)
        np.minimum.at(least, place, x)
        if step < 4 or step % 8 == 0:
            sets, back = np.unique(t, return_inverse=True)
            limit = least.reshape(n, m)[sets].max(axis=1)
            on = x <= limit[back]
            t, h, x = t[on], h[on], x[on]
    with np.errstate(divide="ignore"):
        value = np.floor(1.0 - np.log(least / SCALE) / np.log(BASE))
    return np.clip(value, 0, TOP).astype(np.uint16).reshape(n, m)


def merge(a, b):
    """Registers of the union."""
    return np.maximum(a, b)


def _chance(x):
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def estimate(more, less, equal, na, nb):
    """Jaccard similarity of greatest likelihood, from the numbers of
    registers that are larger, smaller and equal and both set sizes."""
    more, less, equal, na, nb = (np.asarray(v, dtype=np.float64) for v in (more, less, equal, na, nb))
    u, v = na / (na + nb), nb / (na + nb)
    lo = np.zeros_like(u)
    hi = np.minimum(u / v, v / u)

    def slope(j):  # derivative of the log-likelihood
        p, q = _chance(u - v * j), _chance(v - u * j)
        dp = -v / (1 - (u - v * j) * (BASE - 1) / BASE) / BASE * (BASE - 1) / np.log(BASE)
        dq = -u / (1 - (v - u * j) * (BASE - 1) / BASE) / BASE * (BASE - 1) / np.log(BASE)
        with np.errstate(divide="ignore", invalid="ignore"):
            s = (np.where(more > 0, more * dp / p, 0) + np.where(less > 0, less * dq / q, 0)
                 - np.where(equal > 0, equal * (dp + dq) / (1 - p - q), 0))
        return np.nan_to_num(s, nan=0.0, posinf=np.inf, neginf=-np.inf)

    for _ in range(20):
        mid = (lo + hi) / 2
        up = slope(mid) > 0
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
    return (lo + hi) / 2


def least_estimate(threshold, m=REGISTERS):
    return threshold - SLACK * np.sqrt(threshold * (1 - threshold) / m)


def _likely(ra, rb, na, nb, pct):
    """Estimates, and which pairs may reach the threshold."""
    j = estimate((ra > rb).sum(1), (ra < rb).sum(1), (ra == rb).sum(1), na, nb)
    fits = 100 * np.minimum(na, nb) >= pct * np.maximum(na, nb)
    return j, fits & (j >= least_estimate(pct / 100))


def _matrix(column):
    offsets, data = binary(column)
    return data[offsets[0]:offsets[-1]].view(np.uint16).reshape(-1, REGISTERS)


def _sketch_batches(size):
    def run(batches):
        for b in parts(batches, 2):
            offsets, data = binary(b.column(2))
            n = b.num_rows
            text, element = shingle_sets(offsets, data, size)
            with np.errstate(over="ignore"):  # digests that ignore order
                sums = np.zeros((n, 2), dtype=U)
                np.add.at(sums[:, 0], text, mix(element + U(1)))
                np.add.at(sums[:, 1], text, mix(element ^ U(0xA5A5A5A5A5A5A5A5)))
            regs = sketch(text, element, n)
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1),
                pa.array(np.bincount(text, minlength=n).astype(np.int64)),
                pa.array([r.tobytes() for r in sums], pa.binary()),
                pa.array([r.tobytes() for r in regs], pa.binary()),
            ], names=["key", "th", "n", "node", "regs"])
    return run


def _band_batches(batches):
    for b in batches:
        regs = _matrix(b.column(1)).astype(U)
        keys = np.zeros((len(regs), BANDS), dtype=U)
        with np.errstate(over="ignore"):
            keys += mix(np.arange(1, BANDS + 1).astype(U))
            for k in range(ROWS):
                keys = mix(keys * U(0x9E3779B97F4A7C15) + regs[:, k::ROWS])
        yield pa.RecordBatch.from_arrays([
            pa.array(keys.ravel().view(np.int64)),
            b.column(0).take(pa.array(np.repeat(np.arange(len(regs)), BANDS)))],
            names=["band", "node"])


def _sift_batches(pct):
    """Keeps (a, b) whose registers make the threshold likely."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            j, ok = _likely(_matrix(b.column(2)), _matrix(b.column(4)), b.column(3).to_numpy(),
                            b.column(5).to_numpy(), pct)
            t = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(j)],
                                           names=["a", "b", "j"])
            yield t.filter(pa.array(ok))
    return run


def _set_batches(size):
    def run(batches):
        for b in parts(batches, 1):
            offsets, data = binary(b.column(1))
            text, element = shingle_sets(offsets, data, size)
            cut = np.searchsorted(text, np.arange(b.num_rows + 1))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([element[i:j].tobytes() for i, j in zip(cut, cut[1:])],
                                      pa.binary())], names=["node", "elements"])
    return run


def _confirm_batches(pct):
    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=U) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * shared >= pct * (len(x) + len(y) - shared))
            t = pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"])
            yield t.filter(pa.array(ok, pa.bool_()))
    return run


def _by_cell(solve):
    """Feeds ``solve`` runs of whole cells; rows come sorted by cell."""
    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.nbytes
            if size < PART:
                continue
            t = pa.Table.from_batches(held)
            cell = t.column(0).to_numpy()
            cut = int(np.searchsorted(cell, cell[-1]))
            if cut:
                if (out := solve(t.slice(0, cut))) is not None:
                    yield out
                t = t.slice(cut)
            held, size = t.to_batches(), t.nbytes
        if held and (out := solve(pa.Table.from_batches(held))) is not None:
            yield out
    return run


def _cells(t):
    """(queries, members) row numbers of each cell of a table."""
    cell, role = t.column(0).to_numpy(), t.column(1).to_numpy()
    cut = np.concatenate(([0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]))
    for i, j in zip(cut, cut[1:]):
        yield np.flatnonzero(role[i:j] == 0) + i, np.flatnonzero(role[i:j] == 1) + i


def _meet(t, pct):
    """(query, members likely to be linked to it) of each cell."""
    comp = t.column(3).combine_chunks().dictionary_encode().indices.to_numpy()
    n, regs = t.column(4).to_numpy(), _matrix(t.column(5))
    for queries, members in _cells(t):
        for q in queries:
            others = members[comp[members] != comp[q]]
            if len(others):
                _, ok = _likely(np.broadcast_to(regs[q], (len(others), REGISTERS)), regs[others],
                                np.full(len(others), n[q]), n[others], pct)
                if ok.any():
                    yield q, others[ok]


def _pair_batches(pct):
    """(a, b): every likely pair of a query and a member."""
    def solve(t):
        found = list(_meet(t, pct))
        if not found:
            return None
        node = t.column(2).combine_chunks()
        a = np.repeat([q for q, _ in found], [len(m) for _, m in found])
        return pa.RecordBatch.from_arrays(
            [node.take(pa.array(x)) for x in (a, np.concatenate([m for _, m in found]))], names=["a", "b"])
    return _by_cell(solve)


def _hopeful_batches(pct):
    """(node, comp, goal): the queries with a likely member."""
    def solve(t):
        found = pa.array([q for q, _ in _meet(t, pct)], pa.int64())
        return pa.RecordBatch.from_arrays([t.column(i).combine_chunks().take(found) for i in (2, 3, 6)],
                                          names=["node", "comp", "goal"])
    return _by_cell(solve)


def _link_batches(pct):
    """(a, b): one member per query that its full set confirms."""
    def solve(t):
        node = t.column(2).combine_chunks()
        offsets, data = binary(t.column(7))
        element = data[offsets[0]:offsets[-1]].view(U)
        at = (offsets - offsets[0]) // 8
        pairs = []
        for q, members in _meet(t, pct):
            mine = element[at[q]:at[q + 1]]
            for i in range(0, len(members), 256):
                some = members[i:i + 256]
                sizes = at[some + 1] - at[some]
                theirs = np.concatenate([element[at[m]:at[m + 1]] for m in some])
                place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                shared = np.add.reduceat((mine[place] == theirs).astype(np.int64),
                                         np.concatenate(([0], np.cumsum(sizes)[:-1])))
                hit = np.flatnonzero(100 * shared >= pct * (len(mine) + sizes - shared))
                if len(hit):
                    pairs.append((q, some[hit[0]]))
                    break
        if not pairs:
            return None
        return pa.RecordBatch.from_arrays([node.take(pa.array([p[k] for p in pairs])) for k in (0, 1)],
                                          names=["a", "b"])
    return _by_cell(solve)


def _deal(queries: DataFrame, members: DataFrame, group: str, folder: str, name: str) -> DataFrame:
    """Queries and members of each group in cells of bounded size.

    Both have ``group`` and equal further columns.  Every query of a
    group is in one cell with each of its members: queries in blocks,
    members in chunks, one cell per block and chunk.
    """
    counts = queries.select(group, F.lit(1).alias("q"), F.lit(0).alias("m")).unionByName(
        members.select(group, F.lit(0).alias("q"), F.lit(1).alias("m")))
    size = counts.groupBy(group).agg(
        F.ceil(F.sum("q") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.sum("m") / CELL).cast("int").alias("chunks")).where("blocks > 0 AND chunks > 0")
    size = materialize(size, folder, f"cells-{name}")

    def spread(df, role, mine, other):
        i = F.pmod(F.xxhash64("node"), F.col(mine)).cast("int")
        dealt = df.join(size, group).withColumn("i", i).withColumn(
            "j", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        ends = ("i", "j") if role == 0 else ("j", "i")
        return dealt.select(F.xxhash64(group, *ends).alias("cell"), F.lit(role).alias("role"),
                            *df.columns)

    return spread(queries, 0, "blocks", "chunks").unionByName(spread(members, 1, "chunks", "blocks"))


def _groups(docs: DataFrame, shingle: int, threshold_pct: int, text: str, key: str) -> DataFrame:
    """(key, th, n, component_id, stays) per row; see near_duplicates.

    ``th`` is xxhash64 of the text; ``stays`` marks the rows equal in key
    and text to the component's least row (null keys last).
    """
    folder = scratch_dir(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))
    sketches = materialize(rows.mapInArrow(
        _sketch_batches(shingle), f"key {kind}, th long, n long, node binary, regs binary"),
        folder, "sketches")
    nodes = materialize(sketches.where("n > 0").groupBy("node").agg(
        F.min("key").alias("rep"),
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "th")).alias("row"),
        F.first("n").alias("n"), F.first("regs").alias("regs")), folder, "nodes")

    bands = nodes.select("node", "regs").mapInArrow(_band_batches, "band long, node binary")
    buckets = bands.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(bands.join(buckets, "band"), folder, "buckets")
    # The center of a bucket is the node that meets most others in its
    # buckets: the least edited of a group of near copies.
    met = shared.groupBy("node").agg(F.sum("size").alias("met"))
    centers = shared.join(met, "node").groupBy("band").agg(
        F.max(F.struct("met", "node"))["node"].alias("center"))
    shared = materialize(shared.join(centers, "band"), folder, "shared")

    def with_sketches(pairs):
        a = nodes.select(F.col("node").alias("a"), F.col("regs").alias("ra"), F.col("n").alias("na"))
        b = nodes.select(F.col("node").alias("b"), F.col("regs").alias("rb"), F.col("n").alias("nb"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "ra", "na", "rb", "nb")

    star = shared.where("node != center").select(F.col("center").alias("a"), F.col("node").alias("b"))
    star = materialize(with_sketches(star.distinct()).mapInArrow(
        _sift_batches(threshold_pct), "a binary, b binary, j double"), folder, "star")

    # Full sets of the nodes that may have to be compared.
    wanted = (star.select(F.col("a").alias("node")).unionByName(star.select(F.col("b").alias("node")))
              .unionByName(shared.where("size > 2").select("node"))).distinct()
    wanted = nodes.select("node", F.col("row.key").alias("wkey"), F.col("row.th").alias("wth")).join(
        wanted, "node")
    sets = materialize(rows.join(wanted, F.col("key").eqNullSafe(F.col("wkey"))
                                 & (F.col("th") == F.col("wth"))).select("node", "bytes")
                       .mapInArrow(_set_batches(shingle), "node binary, elements binary"),
                       folder, "sets")

    def confirmed(pairs, name):
        a = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
        b = sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
        return materialize(pairs.select("a", "b").join(a, "a").join(b, "b").select(
            "a", "b", "ea", "eb").mapInArrow(
            _confirm_batches(threshold_pct), "a binary, b binary"), folder, name)

    links = confirmed(star, "links1")
    # (node, comp) of the nodes that are not the least of their component.
    comps = components(links, f"{folder}/c1")

    def joined(new, name):
        """Components after some more links; None if there are none."""
        if new.isEmpty():
            return None
        old = comps.select(F.col("node").alias("a"), F.col("comp").alias("b"))
        return components(old.unionByName(new), f"{folder}/{name}")

    def still_outside(rows):
        """Rows (band, node, goal) whose node is not in the component that
        ``goal`` belongs to by now; adds both components, comp and now."""
        own = comps.select("node", "comp")
        its = comps.select(F.col("node").alias("goal"), F.col("comp").alias("now"))
        return (rows.join(own, "node", "left").join(its, "goal", "left")
                .select("band", "node", "goal", F.coalesce("comp", "node").alias("comp"),
                        F.coalesce("now", "goal").alias("now"))
                .where(F.col("comp") != F.col("now")))

    # Bucket members in another component than their center's.
    outside = still_outside(shared.where("size > 2").select(
        "band", "node", F.col("center").alias("goal")))
    outside = materialize(outside.select("band", "node", "comp", F.col("now").alias("goal")),
                          folder, "outside")

    pct = threshold_pct
    sketch_of = nodes.select("node", "n", "regs")

    def in_cells(queries, members, group, solve, schema, name):
        """``solve`` on the cells of queries and members, sets included
        where it confirms links."""
        more = ["elements"] if solve is _link_batches else []

        cells = _deal(queries.select("node", "comp", group), members.select("node", "comp", group),
                      group, folder, name).join(sketch_of, "node")
        cells = cells.join(sets, "node") if more else cells
        cells = cells.select("cell", "role", "node", "comp", "n", "regs", group, *more)
        return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(solve(pct), schema)

    def ask(asked, member, name):
        """One link to a member of its goal for each asking node that has
        any: sifted by registers, then confirmed on full sets."""
        hopeful = in_cells(asked, member, "goal", _hopeful_batches,
                           "node binary, comp binary, goal binary", f"asked{name}").distinct()
        hopeful = materialize(hopeful, folder, f"hopeful{name}")
        goals = member.join(hopeful.select("goal").distinct(), "goal", "left_semi")
        return materialize(in_cells(hopeful, goals, "goal", _link_batches, "a binary, b binary",
                                    f"hopes{name}"), folder, f"links2-{name}")

    if not outside.isEmpty():
        # They meet all of that component: first by registers, then those that
        # may be linked by full sets.  One link is enough to join it.
        asked = outside.select("node", "comp", "goal").distinct()
        member = comps.select("node", "comp", F.col("comp").alias("goal"))
        roots = asked.select("goal").distinct().select(
            F.col("goal").alias("node"), F.col("goal").alias("comp"), "goal")
        member = member.unionByName(roots)
        found = ask(asked, member, "0")
        met = comps  # the components as the nodes outside have met them
        if (now := joined(found, "c2")) is not None:
            comps = now
        asked_of = outside.select("band", "node", "goal")
        # What is still outside meets its like in the bucket.
        rest = still_outside(asked_of).select("band", "node", "comp")
        rest = in_cells(rest, rest, "band", _pair_batches, "a binary, b binary", "rest")
        rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        rest = materialize(rest, folder, "rest")
        if not rest.isEmpty() and (now := joined(confirmed(rest, "links3"), "c3")) is not None:
            comps = now
        # And those that have joined its goal since it asked, until none has.
        turn = 0
        while comps is not met:
            turn += 1
            late = materialize(still_outside(asked_of), folder, f"late{turn}")
            if late.isEmpty():
                break
            goals = late.select(F.col("now").alias("comp"), "goal").distinct()
            tops = goals.select(F.col("comp").alias("node"), "comp").distinct()
            old = met.select("node", F.col("comp").alias("old"))
            newcomers = (comps.select("node", "comp").unionByName(tops).join(goals, "comp")
                         .join(old, "node", "left").where(F.coalesce("old", "node") != F.col("goal"))
                         .select("node", "comp", "goal"))
            newcomers = materialize(newcomers, folder, f"newcomers{turn}")
            if newcomers.isEmpty():
                break
            found = ask(late.select("node", "comp", "goal").distinct(), newcomers, str(turn))
            met, asked_of = comps, late.select("band", "node", F.col("now").alias("goal"))
            if (now := joined(found, f"c4-{turn}")) is None:
                break
            comps = now

    member = nodes.select("node", "rep", "row").join(comps, "node", "left").select(
        "node", "rep", "row", F.coalesce("comp", "node").alias("comp"))
    least = member.groupBy("comp").agg(F.min("rep").alias("component_id"),
                                       F.min("row").alias("first"))
    named = member.join(least, "comp").select(F.col("node").alias("cnode"), "component_id", "first")
    out = sketches.select("key", "th", "n", "node").join(
        named, (F.col("node") == F.col("cnode")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    first = F.col("key").eqNullSafe(F.col("first.key")) & (F.col("th") == F.col("first.th"))
    return out.select("key", "th", "n", component.alias("component_id"),
                      ((F.col("n") == 0) | first).alias("stays"))


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold_pct: int = 80,
                    text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, n_shingles, component_id and kept.

    Rows are linked if their sets of distinct ``shingle``-word shingles
    have at least ``threshold_pct`` percent Jaccard similarity.
    component_id is the least key reachable over links (nulls aside), the
    row's own included; kept tells whether the row's key is that.  Rows
    without words (null, empty and blank texts) have no shingles and no
    links.  Equal rows are linked, and all are kept if one is; an empty
    table gives an empty table.
    """
    found = _groups(docs, shingle, threshold_pct, text, key)
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id",
                        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, threshold_pct: int = 80,
                         text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component, with the columns of ``docs``.

    That is the row of the least key (null keys last).  Rows without
    words all stay.
    """
    folder = scratch_dir(docs.sparkSession)
    found = materialize(_groups(docs, shingle, threshold_pct, text, key), folder, "groups")
    gone = materialize(found.where(~F.col("stays")).select(
        F.col("key").alias("__key"), F.col("th").alias("__th")).distinct(), folder, "gone")
    same_text = F.col("__th") == F.xxhash64(text)
    # The list grows with the documents: one plan for every size.
    out = docs.join(gone.hint("merge"), F.col(key).eqNullSafe(F.col("__key")) & same_text, "left_anti")
    # Rows equal in key and text are one document, kept once.
    again = materialize(found.where("stays AND n > 0").groupBy("key", "th").agg(
        F.count(F.lit(1)).alias("rows")).where("rows > 1").select(
        F.col("key").alias("__key"), F.col("th").alias("__th")), folder, "again")
    if again.isEmpty():
        return out
    twice = F.col(key).eqNullSafe(F.col("__key")) & same_text
    packed = out.select(F.struct("*").alias("__row"), F.col(key).alias("__k"),
                        F.xxhash64(text).alias("__t"))
    once = packed.join(again, F.col("__k").eqNullSafe(F.col("__key"))
                       & (F.col("__t") == F.col("__th")), "left_semi").groupBy("__k", "__t").agg(
        F.first("__row").alias("__row")).select("__row.*")
    return out.join(again, twice, "left_anti").unionByName(once)
