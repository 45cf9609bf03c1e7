"""Reply trees to chat conversations (operator 1).

Messages point to the message they answer.  Iterative self-joins double
the distance a message sees: after k rounds each one knows its ancestor
2**k steps up and the score of the messages between, so paths of any
length take a logarithmic number of joins.  Root-to-leaf paths are ranked
by score, and each chosen path is formatted as one conversation.

Template: ``<|role|>`` newline text ``</turn>`` newline per message.  In
roles and texts ``&`` and ``<`` (in roles ``|`` too) are written as
entities, so no text can hold a control string, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promoscope.llm._common import let, long_sum, materialize, scratch_dir

END = "</turn>\n"
HEAD_END = "|>\n"
MAX_ROUNDS = 40


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("&vert;"), F.lit("|")), F.lit("&lt;"), F.lit("<"))
    return F.replace(plain, F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("|"), F.lit("&vert;"))


def _up(left: str, right: str):
    return (F.col(f"{left}.tree").eqNullSafe(F.col(f"{right}.tree"))
            & (F.col(f"{left}.anc") == F.col(f"{right}.node")))


def branches(messages: DataFrame, folder: str, k: int = 1) -> DataFrame:
    """(tree, leaf, rank, score, node, pos) of the chosen paths.

    ``messages``: (tree, node, parent, score), one row per (tree, node).
    A path's score is the mean of its messages'; ties go to the lesser
    leaf.  A parent that is not there makes its message a root; messages
    on a circle of replies have no root and no path.
    """
    known = messages.select("tree", F.col("node").alias("anc"))
    step = (messages.alias("m").withColumn("anc", F.col("parent"))
            .join(known.withColumn("there", F.lit(True)).alias("p"),
                  F.col("m.tree").eqNullSafe(F.col("p.tree")) & (F.col("m.parent") == F.col("p.anc")),
                  "left")
            .select("m.tree", "m.node", F.when(F.col("there"), F.col("m.parent")).alias("anc"),
                    F.coalesce("m.score", F.lit(0.0)).cast("double").alias("total"),
                    F.lit(1).cast("long").alias("depth")))
    first = materialize(step, folder, "up0")
    is_open = F.col("anc").isNotNull()
    steps, done = [first.where(is_open)], first.where(~is_open)
    open_rows = steps[0].count()
    while open_rows and len(steps) < MAX_ROUNDS:
        # Only messages that have not seen their root go on.
        now = steps[-1]
        step = now.alias("a").join(now.unionByName(done).alias("b"), _up("a", "b")).select(
            "a.tree", "a.node", F.col("b.anc").alias("anc"),
            (F.col("a.total") + F.col("b.total")).alias("total"),
            (F.col("a.depth") + F.col("b.depth")).alias("depth"))
        step = materialize(step, folder, f"up{len(steps)}")
        done = done.unionByName(step.where(~is_open))
        was, open_rows = open_rows, step.where(is_open).count()
        if open_rows == was:  # only circles keep their number
            break
        steps.append(step.where(is_open))
    parents = steps[0].select("tree", F.col("anc").alias("node")).distinct()
    leaves = done.alias("d").join(parents.alias("p"), F.col("d.tree").eqNullSafe(F.col("p.tree"))
                                  & (F.col("d.node") == F.col("p.node")), "left_anti")
    best = Window.partitionBy("tree").orderBy(F.col("score").desc(), "node")
    chosen = (leaves.withColumn("score", F.col("total") / F.col("depth"))
              .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
              .select("tree", F.col("node").alias("leaf"), "rank", "score", "depth", "node",
                      F.lit(0).cast("long").alias("dist")))
    path = materialize(chosen, folder, "path")
    for i, up in enumerate(steps):
        above = path.alias("a").join(up.alias("b"), F.col("a.tree").eqNullSafe(F.col("b.tree"))
                                     & (F.col("a.node") == F.col("b.node")))
        above = above.select("a.tree", "leaf", "rank", "score", "a.depth", F.col("anc").alias("node"),
                             (F.col("dist") + F.lit(1 << i)).alias("dist"))
        path = materialize(path.unionByName(above), folder, f"path{i}")
    return path.select("tree", "leaf", "rank", "score", "node",
                       (F.col("depth") - F.col("dist") - 1).alias("pos"))


def format_trees(messages: DataFrame, k: int = 1, trained_role: str = "assistant") -> DataFrame:
    """(tree, leaf, rank, score, n_turns, formatted, loss_spans).

    ``messages``: (tree, node, parent, role, text, score); of rows equal
    in tree and node the least counts, null roles and texts are empty, a
    null tree is a tree of its own and null nodes are ignored.  The spans
    (turn, start, length, offset) are the texts of ``trained_role`` in
    code points of ``formatted``; offset is counted from the turn's begin.
    A conversation is one row, so one path must fit in a task.  An empty
    table gives an empty table.
    """
    folder = scratch_dir(messages.sparkSession)
    one = (messages.where("node IS NOT NULL").groupBy("tree", "node")
           .agg(F.min(F.struct("parent", "score", "role", "text")).alias("m"))
           .select("tree", "node", "m.*"))
    one = materialize(one, folder, "messages")
    path = branches(one.select("tree", "node", "parent", "score"), folder, k)
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit("<|"), _escape_role(role), F.lit(HEAD_END))
    turns = (path.alias("p").join(one.alias("o"), F.col("p.tree").eqNullSafe(F.col("o.tree"))
                                  & (F.col("p.node") == F.col("o.node")))
             .select("p.tree", "leaf", "rank", "p.score", "pos", role.alias("role"),
                     head.alias("head"), escape(F.coalesce("text", F.lit(""))).alias("body"))
             .withColumn("piece", F.concat("head", "body", F.lit(END))))
    upto = (Window.partitionBy("tree", "leaf").orderBy("pos")
            .rowsBetween(Window.unboundedPreceding, -1))
    turns = turns.withColumn("before", F.coalesce(
        F.sum(F.length("piece")).over(upto), F.lit(0)).cast("long"))
    span = F.struct(F.col("pos").alias("turn"),
                    (F.col("before") + F.length("head")).alias("start"),
                    F.length("body").cast("long").alias("length"),
                    F.length("head").cast("long").alias("offset"))
    grouped = turns.groupBy("tree", "leaf").agg(
        F.first("rank").alias("rank"), F.first("score").alias("score"),
        F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("pos", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("role") == trained_role, span))).alias("loss_spans"))
    return grouped.select("tree", "leaf", "rank", "score", "n_turns",
                          F.array_join("pieces.piece", "").alias("formatted"), "loss_spans")


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation, unescaped."""
    pieces = F.split(formatted, END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(p):
        cut = F.instr(p, HEAD_END)
        return F.struct(unescape(F.substr(p, F.lit(3), cut - 3)).alias("role"),
                        unescape(F.substr(p, cut + len(HEAD_END))).alias("text"))

    return F.transform(pieces, turn)


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return let(F.split(formatted, END), lambda pieces: F.transform(
        spans, lambda s: unescape(F.substr(F.get(pieces, s["turn"].cast("int")),
                                           s["offset"] + 1, s["length"]))))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what is read back from the formatted output."""
    with_parts = formatted.withColumn("turns", read_turns(F.col("formatted"))).withColumn(
        "masked", masked_texts(F.col("formatted"), F.col("loss_spans")))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return with_parts.select(
        "tree", "leaf", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        long_sum(F.transform("masked", lambda x: F.length(x).cast("long"))).alias("loss_chars"),
        F.sha2(F.array_join("masked", ""), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def as_trees(turns: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) as trees without forks:
    each row answers the one before it in its conversation.  Ties in turn
    go by role and text; equal rows stay separate messages."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.withColumn("node", F.row_number().over(order).cast("long")).select(
        F.col("conv_id").alias("tree"), "node", (F.col("node") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"))
