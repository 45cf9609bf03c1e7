"""N-gram Jaccard join by a token-group matrix (operator 11).

Documents with equal shingle sets are one node.  Similar nodes (those
that an equal least hash leads to the same, most connected node) are
packed into groups of bounded size, and every group has the union of its
members' tokens: its row of the matrix.  A
query shares at most as many tokens with a member as with that union; so
a group is opened, and its members compared with the query, only where
the union holds ``threshold_pct`` percent of the query's tokens.

Which sets look at the matrix at all is told by signatures: a set's
tokens are dealt by hash into more parts than two sets that reach the
threshold can differ in tokens, so such sets agree in whole parts.  Only
sets that agree in a part with another go on; no pair is lost.

Groups of near copies do not make all pairs.  Leaders are compared with
the nodes they lead and every group opens for its own members first; what
is linked so is one component.  Only nodes whose part is also found in
another component go on.  Their tokens are put in order, those of one
component first and then the rare ones: linked sets share one of their
first tokens, and how far back it comes bounds the sizes of a partner.
Rows of the matrix are kept for such tokens and sizes.  Near copies that
each have tokens of their own have none; the groups of the others meet
two by two, unless both are of one and the same component.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoscope.llm._bytes import U, binary, mix, parts
from promoscope.llm._common import materialize, scratch_dir
from promoscope.llm._graph import components
from promoscope.llm.setsketch import shingle_sets

#: Least hashes by which similar nodes are found for the first links.
CLUSTERINGS = 3
#: Members and tokens of a group, about.
GROUP = 256
GROUP_TOKENS = 1 << 18
#: Nodes from which on a component has groups of its own.
OWN_GROUPS = 64
#: Classes of sizes from a set to its largest possible partner.
SIZE_CLASSES = 8


def ladder(top: int = 1 << 40) -> list[int]:
    """Rising numbers of differing tokens + 1 that the parts allow for."""
    out, x = [], 2.0
    while x < top:
        if not out or int(x) > out[-1]:
            out.append(int(x))
        x *= 2 ** 0.5
    return out


_LADDER = np.array(ladder(), dtype=np.int64)


def steps(n, pct: int):
    """(first, last) index into the ladder that a set of n tokens signs.

    Two sets of n <= m tokens that reach the threshold differ in at most
    (n + m) (100 - pct) / (100 + pct) tokens.  The smaller one signs the
    step that allows for its largest partner, every set signs the steps
    of all partners it may be the larger of.
    """
    def step(k):  # first step that allows for the partners of k tokens
        most = (k + 100 * k // pct) * (100 - pct) // (100 + pct)
        return np.searchsorted(_LADDER, most + 1)

    n = np.asarray(n, dtype=np.int64)
    return step(-(-pct * n // 100)), step(n)


def _spare(d):
    """Parts beyond the differences: so many may be empty in a set."""
    return 2 + d // 64


def signatures(text, element, n, pct):
    """(set number, signature) of the sets given as (set number, element).

    Of d + spare parts at least spare + 1 agree in two sets that differ
    in less than d tokens; so they agree in one that is not empty, or
    both have more than spare empty parts and sign the empty ones too.
    """
    sizes = np.bincount(text, minlength=n)
    first, last = steps(sizes, pct)
    # Sets that reach the threshold only with their equals sign nothing.
    alone = (sizes + 100 * sizes // pct) * (100 - pct) // (100 + pct) < 1
    sets, sigs = [], []
    with np.errstate(over="ignore"):
        value = mix(element + U(0x632BE59BD9B4E019))
        for k in range(int((last - first).max(initial=0)) + 1):
            here = (first + k <= last) & ~alone
            if not here.any():
                continue
            d = _LADDER[np.minimum(first + k, len(_LADDER) - 1)]
            count = np.where(here, d + _spare(d), 0)
            base = np.concatenate(([0], np.cumsum(count)))
            on = here[text]
            place = base[text[on]] + (mix(element[on]) % count[text[on]].astype(U)).astype(np.int64)
            sums = np.zeros(base[-1], dtype=U)
            np.add.at(sums, place, value[on])
            filled = np.bincount(place, minlength=base[-1]) > 0
            owner = np.repeat(np.arange(n), count)
            part = np.arange(base[-1]) - base[owner]
            empty = np.bincount(owner[~filled], minlength=n)
            keep = filled | (empty > _spare(d))[owner]
            sig = mix(sums ^ mix(part.astype(U) * U(0x9E3779B97F4A7C15) + d[owner].astype(U)))
            sets.append(owner[keep])
            sigs.append(sig[keep])
    if not sets:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
    return np.concatenate(sets), np.concatenate(sigs)


def _digests(text, element, n):
    """Two sums per set that ignore the order of its elements."""
    sums = np.zeros((n, 2), dtype=U)
    with np.errstate(over="ignore"):
        np.add.at(sums[:, 0], text, mix(element + U(1)))
        np.add.at(sums[:, 1], text, mix(element ^ U(0xA5A5A5A5A5A5A5A5)))
    return sums


def _sketch_batches(size):
    def run(batches):
        for b in parts(batches, 2):
            offsets, data = binary(b.column(2))
            n = b.num_rows
            text, element = shingle_sets(offsets, data, size)
            least = np.full((CLUSTERINGS, n), 2**64 - 1, dtype=U)
            with np.errstate(over="ignore"):
                for k in range(CLUSTERINGS):
                    np.minimum.at(least[k], text, mix(element * U(2 * k + 3) + U(k)))
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1),
                pa.array(np.bincount(text, minlength=n).astype(np.int64)),
                pa.array([r.tobytes() for r in _digests(text, element, n)], pa.binary()),
                pa.array(list(least.view(np.int64).T), pa.list_(pa.int64())),
            ], names=["key", "th", "n", "node", "least"])
    return run


def _signature_batches(size, pct, whole):
    """(sig, node) of every text, or with ``whole`` False (sig, first half)."""
    def run(batches):
        for b in parts(batches, 0):
            offsets, data = binary(b.column(0))
            n = b.num_rows
            text, element = shingle_sets(offsets, data, size)
            sums = _digests(text, element, n)
            sets, sigs = signatures(text, element, n, pct)
            if whole:
                node = pa.array([r.tobytes() for r in sums], pa.binary()).take(pa.array(sets))
            else:
                node = pa.array(sums[sets, 0].view(np.int64))
            for i in range(0, len(sets), 1 << 16):
                yield pa.RecordBatch.from_arrays([
                    pa.array(sigs[i:i + (1 << 16)].view(np.int64)), node.slice(i, 1 << 16)],
                    names=["sig", "node"])
    return run


def _token_batches(size):
    """(id, n, own, token): the tokens of every text, with its columns."""
    def run(batches):
        for b in parts(batches, 3):
            offsets, data = binary(b.column(3))
            text, element = shingle_sets(offsets, data, size)
            for i in range(0, len(text), 1 << 16):
                of = pa.array(text[i:i + (1 << 16)])
                yield pa.RecordBatch.from_arrays([
                    *(b.column(c).take(of) for c in range(3)),
                    pa.array(element[i:i + (1 << 16)].view(np.int64))], names=["id", "n", "own", "token"])
    return run


def overlap(a, b):
    """Number of tokens in both of two sorted sets."""
    if not len(b):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _reaches(a, b, pct):
    if 100 * min(len(a), len(b)) < pct * max(len(a), len(b)):
        return False
    shared = overlap(a, b)
    return 100 * shared >= pct * (len(a) + len(b) - shared)


def _sets_of(column, size):
    offsets, data = binary(column)
    text, element = shingle_sets(offsets, data, size)
    cut = np.searchsorted(text, np.arange(len(column) + 1))
    return [element[i:j] for i, j in zip(cut, cut[1:])]


def _confirm_batches(size, pct):
    """Keeps (a, b) of pairs of texts whose full sets reach the threshold."""
    def run(batches):
        for b in parts(parts(batches, 2), 3):
            ok = [_reaches(x, y, pct) for x, y in
                  zip(_sets_of(b.column(2), size), _sets_of(b.column(3), size))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(
                pa.array(ok, pa.bool_()))
    return run


class Group:
    """A group of sets: the union of its members' tokens, and where in it
    the tokens of each member are."""

    def __init__(self, members):
        """``members``: (node, component, elements) each, none empty."""
        self.nodes = [m[0] for m in members]
        self.comps = [m[1] for m in members]
        self.sizes = np.array([len(m[2]) for m in members], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.union, self.place = np.unique(np.concatenate([m[2] for m in members]), return_inverse=True)
        self.joined = {}

    def component(self, comp):
        """What ``comp`` is part of by the links found here."""
        while comp in self.joined:
            comp = self.joined[comp]
        return comp

    def links(self, comp, query, pct):
        """One member per component other than ``comp``'s that the query is
        linked to; None if the bound keeps the group shut."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        at = at[self.union[at] == query]
        if 100 * len(at) < pct * len(query):
            return None
        held = np.zeros(len(self.union), dtype=np.int32)
        held[at] = 1
        shared = np.add.reduceat(held[self.place], self.starts)
        out = []
        for i in np.flatnonzero(100 * shared >= pct * (len(query) + self.sizes - shared)):
            mine, theirs = self.component(comp), self.component(self.comps[i])
            if mine != theirs:
                self.joined[theirs] = mine
                out.append(self.nodes[i])
        return out


def _open_batches(size, pct):
    """(a, b): links of queries to the members of their group.

    Rows come sorted by cell, a cell's members (role 0) before its queries
    (role 1); rows of role 2 are members first and then queries.  A cell's
    members are held, its queries stream by."""
    def run(batches):
        cell, members, group, own = None, [], None, []
        left, right = [], []

        def ask(node, comp, elements):
            found = group.links(comp, elements, pct) or []
            left.extend([node] * len(found))
            right.extend(found)

        def close():
            nonlocal group
            if own:
                group = Group(members)
                for row in own:
                    ask(*row)

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])
            left.clear()
            right.clear()
            return out

        for b in parts(batches, 4):
            cells, roles, nodes, comps = (b.column(i).to_pylist() for i in range(4))
            for i, elements in enumerate(_sets_of(b.column(4), size)):
                if cells[i] != cell:
                    close()
                    cell, members, group, own = cells[i], [], None, []
                row = (nodes[i], comps[i], elements)
                if roles[i] != 1:
                    members.append(row)
                    if roles[i] == 2:
                        own.append(row)
                elif members:
                    group = group or Group(members)
                    ask(*row)
            if left:
                yield flush()
        close()
        if left:
            yield flush()
    return run


def _led(nodes: DataFrame, folder: str) -> DataFrame:
    """(a, na, met, node, n): the nodes of each cluster of an equal least
    hash, with its center ``a``, the node that meets most others."""
    members = nodes.select("node", "n", F.posexplode("least").alias("k", "value")).select(
        "node", "n", F.xxhash64("k", "value").alias("cluster"))
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(members.join(sizes, "cluster"), folder, "clusters")
    met = shared.groupBy("node").agg(F.sum("size").alias("met"))
    centers = shared.join(met, "node").groupBy("cluster").agg(
        F.max(F.struct("met", "node", "n")).alias("c")).select(
        "cluster", F.col("c.node").alias("a"), F.col("c.n").alias("na"), F.col("c.met").alias("met"))
    return materialize(shared.join(centers, "cluster").select("a", "na", "met", "node", "n"), folder, "led")


def _first_pairs(led: DataFrame, pct: int) -> DataFrame:
    """(a, b): leaders and the nodes of a fitting size that they lead."""
    fits = 100 * F.least("n", "na") >= pct * F.greatest("n", "na")
    return led.where((F.col("node") != F.col("a")) & fits).select("a", F.col("node").alias("b")).distinct()


def _rarest(tokens: DataFrame, pct: int) -> DataFrame:
    """(id, n, own, token, room) of the rarest tokens of each set.

    ``tokens`` has (id, n, own, token): a set, its size and its component.
    Tokens of one component come first, the others from rare to frequent.
    Two linked sets share at least pct percent of either's tokens, so the
    first token that sets of two components share has in both that
    ``room``: that many tokens from it on, itself included.
    """
    found = tokens.groupBy("token").agg(
        F.count(F.lit(1)).alias("sets"), F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo < hi")
    back = Window.partitionBy("id").orderBy(F.desc("sets"), F.desc("token"))
    return tokens.join(found.select("token", "sets"), "token").withColumn(
        "room", F.row_number().over(back).cast("long")).where(
        100 * F.col("room") >= pct * F.col("n")).select("id", "n", "own", "token", "room")


def _shared_keys(rare: DataFrame, pct: int) -> DataFrame:
    """(key, side, id): what two sets that may be linked share.

    A key is a token and two classes of sizes, the lesser's sets on side 0
    and the other's on side 1.  A set has the keys of the sizes that a
    partner may have whose first shared token this is: they share at most
    ``room`` tokens.  Kept are those that another component has on the
    other side.
    """
    width = -math.log(pct / 100) / SIZE_CLASSES

    def size_class(n):
        return F.floor(F.log(n) / width)

    least = F.ceil(F.lit(pct) * F.col("n") / 100)
    most = F.least(F.floor(100 * F.col("n") / pct), F.floor((100 + pct) * F.col("room") / pct) - F.col("n"))
    keys = rare.withColumn("mine", size_class(F.col("n"))).withColumn(
        "other", F.explode(F.sequence(size_class(least), size_class(most))))
    first, last = F.when(F.expr("other < mine"), 1).otherwise(0), F.when(F.expr("other > mine"), 0).otherwise(1)
    keys = keys.select(
        F.xxhash64("token", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"),
        F.explode(F.sequence(first, last)).alias("side"), "id", "own")
    ends = [f(F.when(F.col("side") == side, F.col("own"))).alias(f"{name}{side}")
            for side in (0, 1) for name, f in (("lo", F.min), ("hi", F.max))]
    met = keys.groupBy("key").agg(*ends).where("lo0 < hi1 OR lo1 < hi0")
    there = F.when(F.col("side") == 0, F.expr("lo1 <> own OR hi1 <> own")).otherwise(
        F.expr("lo0 <> own OR hi0 <> own"))
    return keys.join(met, "key").where(there).select("key", "side", "id")


def _classes(docs: DataFrame, shingle: int, pct: int, text: str, key: str) -> DataFrame:
    """(key, n, component_id) per row; see jaccard_join."""
    folder = scratch_dir(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))
    sketches = materialize(rows.mapInArrow(
        _sketch_batches(shingle), f"key {kind}, th long, n long, node binary, least array<long>"),
        folder, "sketches")
    nodes = materialize(sketches.where("n > 0").groupBy("node").agg(
        F.min("key").alias("rep"), F.min(F.struct("th", F.col("key").isNull().alias("none"), "key")).alias("row"),
        F.first("n").alias("n"), F.first("least").alias("least")), folder, "nodes")

    # Signatures that two different sets share, and who signs them.
    texts = rows.select("bytes")
    live = texts.mapInArrow(_signature_batches(shingle, pct, False), "sig long, node long").groupBy(
        "sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi").select("sig")
    live = materialize(live, folder, "live")
    signed = materialize(texts.mapInArrow(
        _signature_batches(shingle, pct, True), "sig long, node binary").join(live, "sig").distinct(),
        folder, "signed")

    led = _led(nodes, folder)
    first = materialize(_first_pairs(led, pct), folder, "first")
    wanted = first.select(F.col("a").alias("node")).unionByName(
        first.select(F.col("b").alias("node"))).unionByName(signed.select("node")).distinct()
    wanted = nodes.select("node", F.col("row.key").alias("wkey"), F.col("row.th").alias("wth")).join(wanted, "node")
    bodies = rows.join(wanted, F.col("key").eqNullSafe(F.col("wkey")) & (F.col("th") == F.col("wth")))
    bodies = materialize(bodies.groupBy("node").agg(F.first("bytes").alias("bytes")), folder, "texts")

    pairs = first.join(bodies.select(F.col("node").alias("a"), F.col("bytes").alias("ta")), "a").join(
        bodies.select(F.col("node").alias("b"), F.col("bytes").alias("tb")), "b").select("a", "b", "ta", "tb")
    links = materialize(pairs.mapInArrow(_confirm_batches(shingle, pct), "a binary, b binary"), folder, "links1")

    def opened_by(cells, name):
        """Links that ``cells`` (cell, role, node, comp) find."""
        cells = cells.join(bodies, "node").select("cell", "role", "node", "comp", "bytes")
        return materialize(cells.repartition("cell").sortWithinPartitions("cell", "role").mapInArrow(
            _open_batches(shingle, pct), "a binary, b binary"), folder, name)

    # The matrix: groups of similar nodes that share a signature with others.
    leader = led.groupBy("node").agg(F.max(F.struct("met", "a"))["a"].alias("leader"))
    packs = signed.select("node").distinct().join(nodes.select("node", "n"), "node").join(
        leader, "node", "left").select("node", "n", F.xxhash64(F.coalesce("leader", "node")).alias("pack"))
    packs = materialize(packs, folder, "packs")

    def grouped(packed):
        """``packed`` with its pack cut into groups of bounded size."""
        sizes = packed.groupBy("pack").agg(F.greatest(
            F.ceil(F.count(F.lit(1)) / GROUP), F.ceil(F.sum("n") / GROUP_TOKENS)).alias("chunks"),
            F.count(F.lit(1)).alias("size"))
        return packed.join(sizes, "pack").withColumn(
            "group", F.xxhash64("pack", F.pmod(F.xxhash64("node"), F.col("chunks"))))

    own = grouped(packs).where("size > 1").select(
        F.col("group").alias("cell"), F.lit(2).alias("role"), "node", F.col("node").alias("comp"))
    comps = components(links.unionByName(opened_by(own, "own")), f"{folder}/c1")

    # Nodes that agree in a part with one of another component, and what of
    # their rarest tokens and sizes they share with such a node.
    member = packs.join(comps, "node", "left").select(
        "node", "n", "pack", F.coalesce("comp", "node").alias("comp"))
    member = materialize(member.withColumn("id", F.xxhash64("node")).withColumn(
        "own", F.xxhash64("comp")), folder, "member")
    mixed = signed.join(member.select("node", "own"), "node").groupBy("sig").agg(
        F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo < hi").select("sig")
    going = signed.join(materialize(mixed, folder, "mixed"), "sig", "left_semi").select("node").distinct()
    tokens = member.join(going, "node").join(bodies, "node").select("id", "n", "own", "bytes").mapInArrow(
        _token_batches(shingle), "id long, n long, own long, token long")
    rare = materialize(_rarest(materialize(tokens, folder, "tokens"), pct), folder, "rare")
    keyed = materialize(_shared_keys(rare, pct), folder, "keyed")

    # A large component has groups of its own: they need no others of it.
    member = member.join(keyed.select("id").distinct(), "id")
    large = member.groupBy("comp").agg(F.count(F.lit(1)).alias("times")).where(
        F.col("times") >= OWN_GROUPS).select("comp", F.lit(True).alias("large"))
    member = member.join(large, "comp", "left").withColumn(
        "pack", F.when(F.col("large"), F.col("own")).otherwise(F.col("pack")))
    active = materialize(grouped(member).select("id", "node", "n", "comp", "group"), folder, "active")
    entries = materialize(keyed.join(active, "id").groupBy("key", "side", "group").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("short"), F.max("n").alias("long")),
        folder, "entries")
    one, two = (entries.where(F.col("side") == side).select(
        "key", *[F.col(c).alias(f"{c}{side + 1}") for c in ("group", "lo", "hi", "short", "long")]) for side in (0, 1))
    apart = (F.col("lo1") != F.col("hi1")) | (F.col("lo2") != F.col("hi2")) | (F.col("lo1") != F.col("lo2"))
    fits = ((100 * F.col("long1") >= pct * F.col("short2")) & (100 * F.col("long2") >= pct * F.col("short1")))
    meet = materialize(one.join(two, "key").where(apart & fits).select(
        F.least("group1", "group2").alias("group1"), F.greatest("group1", "group2").alias("group2")).distinct(),
        folder, "meet")

    # One cell per pair of groups, of the nodes that share a key.
    active = active.select("group", "node", "comp")
    meet = meet.withColumn("cell", F.xxhash64("group1", "group2"))
    members = meet.where("group1 < group2").join(active, F.col("group2") == F.col("group")).select(
        "cell", F.lit(0).alias("role"), "node", "comp")
    queries = meet.join(active, F.col("group1") == F.col("group")).select(
        "cell", F.when(F.col("group1") == F.col("group2"), 2).otherwise(1).alias("role"), "node", "comp")
    more = opened_by(members.unionByName(queries), "links2")
    if not more.isEmpty():
        old = comps.select(F.col("node").alias("a"), F.col("comp").alias("b"))
        comps = components(old.unionByName(more), f"{folder}/c2")

    named = nodes.select("node", "rep").join(comps, "node", "left").select(
        "node", "rep", F.coalesce("comp", "node").alias("comp"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "comp").select(F.col("node").alias("cnode"), "component_id")
    out = sketches.select("key", "n", "node").join(
        named, (F.col("node") == F.col("cnode")) & (F.col("n") > 0), "left")
    return out.select("key", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(
        F.col("key")).alias("component_id"))


def jaccard_join(docs: DataFrame, shingle: int = 5, threshold_pct: int = 80,
                 text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, n_shingles and component_id.

    Rows are linked if their sets of distinct ``shingle``-word shingles
    (A-Z lower-cased; of fewer words the whole sequence) have at least
    ``threshold_pct`` percent (1 to 99) Jaccard similarity; component_id
    is the least key reachable over links, nulls aside.  Exact but for
    collisions of 64-bit hashes.  Rows without words (null, empty and
    blank texts) have no shingles and no links; equal rows are linked;
    very long texts are worked on whole, a few MiB of them at once; other
    columns are ignored; an empty table gives an empty table.
    """
    found = _classes(docs, shingle, threshold_pct, text, key)
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")
