"""Repair of conversation structure by iterative-deepening A* (operator 13).

A conversation is well formed if its role initials read ``(s?(ua)+)?``.
Its rows are edited in order: K keeps a row, R gives it the role the
pattern asks for (user or assistant), D deletes it, I inserts an empty
row of that role.  The cheapest edits are found by a depth-first search
in the ASCII order of the edits under a rising cost bound; a table of
failed states holds what each is known to cost at least, which prunes
and sets the next bound.  So the first path that is accepted is the
cheapest, and of several the least in ASCII order.

The search sees one character per row (role initial and fault).  These
marks are cut into blocks of bounded length that are searched apart, for
every state a block may be entered and left in; the blocks of a long
conversation are then joined two by two.  Texts do not take part; they
meet the edits at the end, in one streaming pass over sorted rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoscope.llm._bytes import parts
from promoscope.llm._common import BLANKS, materialize, scratch_dir

#: Rows of a conversation that are searched at once.
BLOCK = 256

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States of the pattern by the initial read last.
START, SYSTEM, USER, ASSISTANT = range(4)
# Initial a state asks for; "s" may also open a conversation.
_NEXT = (USER, USER, ASSISTANT, USER)
_LEAVES = {START: (START, SYSTEM, USER, ASSISTANT), SYSTEM: (SYSTEM, USER, ASSISTANT),
           USER: (USER, ASSISTANT), ASSISTANT: (USER, ASSISTANT)}
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _mark(initial: Column, fault: Column) -> Column:
    """One letter: 4 * (s, u, a, other) + (none, blank, duplicate, truncated)."""
    who = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.char(F.lit(65) + 4 * who + fault)


def _steps(mark: int, state: int):
    """(edit, cost, rows read, next state), edits in ASCII order."""
    who, fault = divmod(mark - 65, 4)
    must_go = fault in (1, 2)
    more = TRUNCATED if fault == 3 else 0
    goal = _NEXT[state]
    steps = [("D", DELETE, 1, state), ("I", INSERT, 0, goal)]
    if not must_go:
        if who + 1 == goal or (state == START and who == 0):
            steps.append(("K", more, 1, who + 1))
        steps.append(("R", REROLE + more, 1, goal))
    return tuple(steps)


_STEPS = {(m, q): _steps(m, q) for m in range(65, 81) for q in range(4)}
_SYSTEM_ROWS = (65, 68)
_NEVER = 1 << 40
_END = {q: (("I", INSERT, 0, _NEXT[q]),) for q in range(4)}
_LEAST = {m: min(c for q in range(4) for e, c, r, _ in _STEPS[m, q] if r) for m in range(65, 81)}


@lru_cache(maxsize=1 << 16)
def search(marks: str, enter: int = START,
           leave: tuple = (START, ASSISTANT)) -> tuple[int, str] | None:
    """(cost, edits) from state ``enter`` over all marks to a state of
    ``leave``: the cheapest, and of those the least in ASCII order; None
    if there are no such edits (a system row cannot be made)."""
    n = len(marks)
    rows = marks.encode("ascii")
    # At least this is left to pay: what any edit of the rows ahead costs.
    known = [0] * (4 * n + 4)
    rest = 0
    for i in range(n - 1, -1, -1):
        rest += _LEAST[rows[i]]
        known[4 * i:4 * i + 4] = [rest] * 4
    for q in range(4):
        if not set(_LEAVES[q]) & set(leave):
            known[q::4] = [_NEVER] * (n + 1)
        elif q not in leave:
            known[4 * n + q] = INSERT
    if leave == (SYSTEM,):  # only a row that is kept leads there
        last = max((i for i, m in enumerate(rows) if m in _SYSTEM_ROWS), default=-1)
        known[4 * (last + 1)::4] = [_NEVER] * (n - last)
    bound = known[enter]
    while bound < _NEVER:
        # Frames: state, budget, its steps, the next one, least bound seen.
        path: list[str] = []
        frames = [[enter, bound, _STEPS[rows[0], enter] if n else _END[enter], 0, 1 << 60]]
        if n == 0 and enter in leave:
            return 0, ""
        while frames:
            frame = frames[-1]
            at, budget, steps, k, least = frame
            if k == len(steps):
                known[at] = least  # failed: it costs at least this
                frames.pop()
                if frames:
                    path.pop()
                    up = frames[-1]
                    up[4] = min(up[4], least + up[2][up[3] - 1][1])
                continue
            edit, cost, read, state = steps[k]
            frame[3] = k + 1
            i = (at >> 2) + read
            to = 4 * i + state
            if cost + known[to] > budget:
                frame[4] = min(least, cost + known[to])
                continue
            path.append(edit)
            if i == n and state in leave:
                return bound - budget + cost, "".join(path)
            frames.append([to, budget - cost,
                           _STEPS[rows[i], state] if i < n else _END[state], 0, 1 << 60])
        bound = known[enter]
    return None


def counts(marks: str, before: str = "") -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and adjacent initials that
    are none of su, ua, au; ``before`` is the mark in front."""
    blank = duplicate = truncated = illegal = 0
    last = before
    for m in marks:
        fault = (ord(m) - 65) % 4
        blank += fault == 1
        duplicate += fault == 2
        truncated += fault == 3
        if last:
            pair = ((ord(last) - 65) // 4, (ord(m) - 65) // 4)
            illegal += pair not in ((0, 1), (1, 2), (2, 1))
        last = m
    return blank, duplicate, truncated, illegal


def _solve_batches(batches):
    """One row per block and pair of states it may be entered and left in."""
    for b in batches:
        take, rows = [], []
        for i, (k, n, marks, before) in enumerate(zip(*(b.column(c).to_pylist() for c in range(1, 5)))):
            tally = counts(marks, before)
            last = k == n - 1
            for enter in ((START,) if k == 0 else (START, SYSTEM, USER, ASSISTANT)):
                ends = [(START, ASSISTANT)] if last else [(q,) for q in _LEAVES[enter]]
                for leave in ends:
                    if last and enter in (SYSTEM, USER, ASSISTANT):
                        leave = (ASSISTANT,)
                    if (found := search(marks, enter, leave)) is not None:
                        take.append(i)
                        rows.append((*tally, enter, leave[-1], *found))
        cols = list(zip(*rows)) or [()] * 8
        yield pa.RecordBatch.from_arrays(
            [b.column(c).take(pa.array(take, pa.int64())) for c in (0, 1, 2, 5)]
            + [pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.string())],
            names=["conv", "k", "n_blocks", "gaps", *_COUNTS, "enter", "leave", "cost", "audit"])


def join_blocks(a: dict, b: dict) -> dict:
    """{(enter, leave): (cost, edits)} of two adjacent runs of blocks.

    Edits of equal cost over the same rows never begin one another, so
    the least of two begins the least whole."""
    out: dict = {}
    for (enter, mid), (cost, audit) in a.items():
        for (start, leave), (more, rest) in b.items():
            if start == mid:
                found = (cost + more, audit + rest)
                out[enter, leave] = min(found, out.get((enter, leave), found))
    return out


def _join_conversation(key, table):
    """Blocks of one conversation, joined two by two."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in
                        ("k", "enter", "leave", "cost", "audit"))))
    blocks: dict[int, dict] = {}
    tally: dict[int, tuple] = {}
    for k, enter, leave, cost, audit in rows:
        blocks.setdefault(k, {})[enter, leave] = (cost, audit)
    for k, *some in zip(*(table.column(c).to_pylist() for c in ("k", *_COUNTS))):
        tally[k] = tuple(some)
    stack: list[tuple[int, dict]] = []
    for k in sorted(blocks):
        level, now = 0, blocks[k]
        while stack and stack[-1][0] == level:
            now = join_blocks(stack.pop()[1], now)
            level += 1
        stack.append((level, now))
    whole = stack.pop()[1]
    while stack:
        whole = join_blocks(stack.pop()[1], whole)
    cost, audit = min(whole.values())
    sums = [sum(t[i] for t in tally.values()) for i in range(4)]
    return pa.table(
        [table.column("conv").slice(0, 1), table.column("gaps").slice(0, 1)]
        + [pa.array([v], pa.int64()) for v in (*sums, cost)] + [pa.array([audit], pa.string())],
        names=["conv", "gaps", *_COUNTS, "cost", "audit"])


def _ordered(turns: DataFrame, conv: str, turn: str, role: str, text: str, folder: str) -> DataFrame:
    """conv, turn, role, text and pos, which grows along every conversation.

    Rows are dealt by ranges of their whole order, so a conversation of
    any length, and equal rows in any number, spread over partitions.
    """
    clean = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                         F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                         F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    clean = clean.withColumns({"head": F.substring("text", 1, 64), "digest": F.md5(F.col("text").cast("binary")),
                               "tie": F.monotonically_increasing_id()})
    order = ("conv", "turn", "role", "head", "digest")
    rows = clean.repartitionByRange(*order, "tie").sortWithinPartitions(*order)
    return materialize(rows.select("conv", "turn", "role", "text", "digest",
                                   F.monotonically_increasing_id().alias("pos")), folder, "ordered")


def _marked(ordered: DataFrame) -> DataFrame:
    """conv, gaps and marks (one character per row) of each conversation."""
    body = F.btrim(F.col("text"), F.lit(BLANKS))
    rows = ordered.select("conv", "turn", "role", "digest", "pos", (body == "").alias("blank"),
                          F.substring(body, -1, 1).isin(".", "!", "?").alias("ends"))
    seen = rows.where(~F.col("blank")).groupBy("conv", "role", "digest").agg(
        F.min("pos").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").select(
        F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    rows = rows.join(seen, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                     & (F.col("digest") == F.col("d")), "left")
    fault = (F.when(F.col("blank"), 1).when(F.col("pos") > F.col("first"), 2)
             .when(~F.col("ends"), 3).otherwise(0))
    rows = rows.select("conv", "turn", "pos", F.shiftright("pos", 8).alias("run"),
                       _mark(F.substring("role", 1, 1), fault).alias("mark"))
    runs = rows.groupBy("conv", "run").agg(  # at most 256 rows each
        F.array_sort(F.collect_list(F.struct("pos", "mark"))).alias("marks"),
        F.min("turn").alias("lo"), F.max("turn").alias("hi"),
        F.size(F.collect_set("turn")).alias("turns"))
    runs = runs.select("conv", F.struct(
        "run", F.array_join(F.col("marks.mark"), "").alias("marks"), "lo", "hi", "turns").alias("run"))
    whole = runs.groupBy("conv").agg(F.array_sort(F.collect_list("run")).alias("runs"))
    # A turn that goes on in the next run is counted in both.
    again = F.transform(F.col("runs"), lambda x, i: F.when(
        (i > 0) & (x["lo"] == F.get(F.col("runs"), i - 1)["hi"]), x["turns"] - 1).otherwise(x["turns"]))
    distinct = F.aggregate(again, F.lit(0).cast("long"), lambda a, x: a + x)
    span = F.array_max(F.col("runs.hi")) - F.array_min(F.col("runs.lo")) + 1
    return whole.select("conv", F.coalesce(span - distinct, F.lit(0)).cast("long").alias("gaps"),
                        F.array_join(F.col("runs.marks"), "").alias("marks"))


def _reports(ordered: DataFrame, folder: str) -> DataFrame:
    kind = ordered.schema["conv"].dataType.simpleString()
    marked = _marked(ordered).withColumn("n_blocks", F.ceil(F.length("marks") / BLOCK).cast("long"))
    blocks = marked.select(
        "conv", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("k"), "n_blocks", "marks", "gaps")
    start = (F.col("k") * BLOCK).cast("int")
    blocks = blocks.select(
        "conv", "k", "n_blocks", F.substring("marks", start + 1, F.lit(BLOCK)).alias("marks"),
        F.when(F.col("k") > 0, F.substring("marks", start, F.lit(1))).otherwise("").alias("before"), "gaps")
    numbers = ", ".join(f"{c} long" for c in (*_COUNTS, "enter", "leave", "cost"))
    solved = materialize(blocks.repartition("conv", "k").mapInArrow(
        _solve_batches, f"conv {kind}, k long, n_blocks long, gaps long, {numbers}, audit string"),
        folder, "solved")
    columns = ("conv", "gaps", *_COUNTS, "cost", "audit")
    numbers = ", ".join(f"{c} long" for c in ("gaps", *_COUNTS, "cost"))
    one = solved.where("n_blocks = 1").select(*columns)
    more = solved.where("n_blocks > 1").groupBy("conv").applyInArrow(
        _join_conversation, f"conv {kind}, {numbers}, audit string")
    return materialize(one.unionByName(more), folder, "reports")


def _replay(batches):
    """(conv, new conversation, edit, role, text) of the repaired rows.

    Rows come sorted by conversation and position, each conversation led
    by a row that holds its edits."""
    audit, at, state = "", 0, START

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at += 1
            state = _NEXT[state]
            yield "I", "user" if state == USER else "assistant", b""

    here = None
    for b in parts(batches, 3):
        convs = b.column(0)
        edits = b.column(4).to_pylist()
        roles = b.column(2).to_pylist()
        texts = b.column(3).to_pylist()
        for i in range(b.num_rows):
            if edits[i] is not None:
                for row in inserted():
                    yield here, False, *row
                audit, at, state, here = edits[i], 0, START, convs[i]
                yield here, True, "", "", b""
                continue
            for row in inserted():
                yield here, False, *row
            edit, role = audit[at], roles[i]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                state = _NEXT[state]
                role = "user" if state == USER else "assistant"
            else:
                state = "sua".index(role[0]) + 1
            yield here, False, edit, role, texts[i]
    for row in inserted():
        yield here, False, *row


def _row_batches(kind):
    def run(batches):
        held, size, place = [], 0, 0
        for conv, new, edit, role, text in _replay(batches):
            if new:
                place = 0
                continue
            held.append((conv.as_py(), place, edit, role, text.decode("utf-8", "replace")))
            place += 1
            size += len(text) + 64
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kind)],
                                                 names=["conv", "place", "edit", "role", "text"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kind)],
                                             names=["conv", "place", "edit", "role", "text"])
    return run


def _digest_batches(kind):
    def run(batches):
        convs, digests = [], []
        state = None
        for conv, new, _, role, text in _replay(batches):
            if new:
                if state is not None:
                    digests.append(state.hexdigest())
                convs.append(conv.as_py())
                state, first = hashlib.sha256(), True
                continue
            state.update(b"" if first else b"\n")
            state.update(role.encode() + b":")
            state.update(text)
            first = False
        if state is not None:
            digests.append(state.hexdigest())
        for i in range(0, len(convs), 10_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(convs[i:i + 10_000], kind[0]), pa.array(digests[i:i + 10_000], pa.string())],
                names=["conv", "repaired_sha256"])
    return run


def _led(ordered: DataFrame, reports: DataFrame) -> DataFrame:
    rows = ordered.select("conv", "pos", "role", F.col("text").cast("binary").alias("text"),
                          F.lit(None).cast("string").alias("audit"))
    heads = reports.select("conv", F.lit(-1).cast("long").alias("pos"), F.lit("").alias("role"),
                           F.lit("").cast("binary").alias("text"), "audit")
    return rows.unionByName(heads).repartition("conv").sortWithinPartitions("conv", "pos")


def _arrow_type(df: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema["conv"].dataType)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit.

    A conversation's rows are taken by turn, nulls first; rows of one
    turn by role, then by text (its first 64 code points, then its MD5).
    Null roles and texts count as one space, a null conversation is one
    of its own.  Of a row's faults the first counts: blank (no character
    but ASCII white space), duplicate (its role and text came earlier) or
    truncated (its last such character is none of ``.!?``).  ``gaps`` are
    the turns missing between the least and the greatest (0 if all are
    null), ``illegal`` the adjacent rows whose role initials are none of
    su, ua, au; ``audit`` holds the edits' initials in order.  Very long
    texts never enter the search; an empty table gives an empty table,
    other columns are ignored.
    """
    folder = scratch_dir(turns.sparkSession)
    reports = _reports(_ordered(turns, conv, turn, role, text, folder), folder)
    return reports.withColumnRenamed("conv", conv)


def repaired_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """The rows after the edits: conversation, place (from 0), edit (K, R
    or I), role and text.  Conversations of which nothing is left have none."""
    folder = scratch_dir(turns.sparkSession)
    ordered = _ordered(turns, conv, turn, role, text, folder)
    kind = ordered.schema["conv"].dataType.simpleString()
    types = (_arrow_type(ordered), pa.int64(), pa.string(), pa.string(), pa.string())
    return _led(ordered, _reports(ordered, folder)).mapInArrow(
        _row_batches(types), f"conv {kind}, place long, edit string, role string, text string"
    ).withColumnRenamed("conv", conv)


def repair_digests(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """``repair`` with repaired_sha256: of the repaired rows' ``role:text``,
    joined by newlines, hashed row by row as they stream by."""
    folder = scratch_dir(turns.sparkSession)
    ordered = _ordered(turns, conv, turn, role, text, folder)
    reports = _reports(ordered, folder)
    kind = ordered.schema["conv"].dataType.simpleString()
    digests = _led(ordered, reports).mapInArrow(
        _digest_batches((_arrow_type(ordered),)), f"conv {kind}, repaired_sha256 string")
    digests = digests.withColumnRenamed("conv", "__conv")
    return reports.join(digests, F.col("conv").eqNullSafe(F.col("__conv"))).drop(
        "__conv").withColumnRenamed("conv", conv)
