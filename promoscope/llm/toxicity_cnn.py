"""Toxicity by a convolutional text classifier in numpy (operator 4).

Words, and their first letters for the sake of endings, are hashed to
buckets; each bucket has an embedding and a word is the sum of its own.
Filters of several widths slide over the embeddings, every filter keeps its greatest
response in the text (max pooling), and a logistic layer turns those into
a score.  Training starts on the driver with a bounded number of labelled
texts.  Where there are more, every one of them is then counted and learnt
from in Spark tasks: in each round every block of texts goes on from the
same model, and the changes are averaged.  Scoring runs on all texts in
tasks with the trained model as a constant of fixed size.  Scores are
calibrated on labelled texts kept out of training, and so is one decision
threshold per language.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promoscope.llm._bytes import U, binary, parts, word_hashes
from promoscope.llm._common import materialize, scratch_dir
from promoscope.operators.fill import RANGE, tag_ranges

BUCKETS = 1 << 16
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Labelled texts and bytes of text that the driver's first fit reads at most
#: (of least hash); a table beyond goes on in rounds over blocks of about that.
MAX_TEXTS = 8_000
MAX_BYTES = 32 << 20
#: A text of the first fit has at most this part of the bytes.
TEXT_PART = 16
#: Rounds over all labelled texts beyond those bounds.
ROUNDS = 3
#: Words of the texts of one step in a round, about, at most.
STEP_WORDS = 1 << 16
#: Changes are summed as whole numbers of this part, so that order does not matter.
UNIT = 2.0 ** 32
EPOCHS = 6
BATCH = 32
#: First bytes of a word that have buckets of their own.
PREFIXES = (4, 5)
IDS = 1 + len(PREFIXES)
#: Share of the sample kept out of training, for the calibration.
CALIBRATION = 0.25
DECISION = 0.3


def tokens(offsets, data):
    """(text number, buckets) of the words of each text; 0 is padding."""
    text, h = word_hashes(offsets, data, letters=True, prefixes=PREFIXES)
    return text, (h % U(BUCKETS - 1)).astype(np.int32) + 1


@dataclass
class Model:
    embed: np.ndarray  # BUCKETS x DIM
    filters: list  # per width: width x DIM x FILTERS
    bias: np.ndarray  # per pooled feature
    out: np.ndarray
    shift: float
    scale: tuple = (1.0, 0.0)  # calibration of the logit

    def pooled(self, text, ids, n, embed=None):
        """n x features: greatest response of each filter in each text,
        the place where it was reached, and the ids by place.

        Texts are padded with bucket 0, whose embedding is zero, so a text
        shorter than a filter, even an empty one, has a response.
        """
        embed = self.embed if embed is None else embed
        count = np.bincount(text, minlength=n)
        pad = max(WIDTHS)  # zeros behind each text
        start = np.concatenate(([0], np.cumsum(count + pad)))
        line = np.zeros((start[-1] + pad, IDS), dtype=np.int32)
        line[np.arange(len(text)) + text * pad] = ids
        e = embed[line[:, 0]]
        for k in range(1, IDS):
            e += embed[line[:, k]]
        features = np.empty((n, len(WIDTHS) * FILTERS), dtype=np.float32)
        where = np.empty(features.shape, dtype=np.int64)
        for w, (width, f) in enumerate(zip(WIDTHS, self.filters)):
            z = e[:start[-1]] @ f[0]
            for k in range(1, width):
                z += e[k:start[-1] + k] @ f[k]
                z[start[1:] - k] = -np.inf  # would reach into the next text
            best = np.maximum.reduceat(z, start[:-1], axis=0)
            features[:, w * FILTERS:(w + 1) * FILTERS] = best
            if self._track:
                owner = np.repeat(np.arange(n), count + pad)
                hit = z == best[owner]
                for f_no in range(FILTERS):  # first place of each maximum
                    rows = np.flatnonzero(hit[:, f_no])
                    first = np.searchsorted(owner[rows], np.arange(n))
                    where[:, w * FILTERS + f_no] = rows[first]
        return features, where, line

    _track = False

    def logits(self, text, ids, n):
        features, _, _ = self.pooled(text, ids, n)
        return np.maximum(features + self.bias, 0) @ self.out + self.shift

    def scores(self, text, ids, n):
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.logits(text, ids, n) + b, -30, 30)))


def _concat(docs):
    """(text number, ids) of a list of token arrays."""
    return (np.repeat(np.arange(len(docs)), [len(d) for d in docs]),
            np.concatenate(docs) if docs else np.zeros((0, IDS), np.int32))


def gradients(m: Model, table, text, ids, labels):
    """(loss, those of filters, bias and output, of the embeddings, of the shift).

    The mean logistic loss of the texts; ``ids`` are rows of ``table``,
    the embeddings in use.  Only the place of a filter's greatest response
    has a gradient.
    """
    labels = np.asarray(labels, dtype=np.float32)
    features, where, line = m.pooled(text, ids, len(labels), table)
    hidden = np.maximum(features + m.bias, 0)
    z = np.clip(hidden @ m.out + m.shift, -30, 30)
    d = ((1 / (1 + np.exp(-z)) - labels) / len(labels)).astype(np.float32)
    of_filters = [np.zeros_like(f) for f in m.filters]
    d_hidden = d[:, None] * m.out * (features + m.bias > 0)
    of_table = np.zeros(table.shape, dtype=np.float32)
    for w, f in enumerate(m.filters):
        part = slice(w * FILTERS, (w + 1) * FILTERS)
        dh = d_hidden[:, part]
        for k in range(len(f)):
            at_ids = line[where[:, part] + k]  # texts x filters x IDS
            of_filters[w][k] = np.einsum("tf,tfd->df", dh, table[at_ids].sum(2))
            for i in range(IDS):
                np.add.at(of_table, at_ids[:, :, i], dh[:, :, None] * f[k].T[None])
    loss = float(np.mean(np.logaddexp(0, z) - labels * z))
    return loss, [*of_filters, d_hidden.sum(0), hidden.T @ d], of_table, float(d.sum())


def strength(pos, neg, n1, n0):
    """(start of the first dimension, whether it is used) of each bucket,
    found in ``pos`` of ``n1`` toxic and ``neg`` of ``n0`` other texts: the
    signed root of the likelihood-ratio statistic of word against class."""
    n = n0 + n1
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(pos + neg > 0, (pos + neg), 1) / n
        g = (np.where(pos > 0, pos * np.log(pos / (share * n1)), 0)
             + np.where(neg > 0, neg * np.log(neg / (share * n0)), 0)
             + np.where(n1 > pos, (n1 - pos) * np.log((1 - pos / n1) / (1 - share)), 0)
             + np.where(n0 > neg, (n0 - neg) * np.log((1 - neg / n0) / (1 - share)), 0))
    g = np.nan_to_num(g, nan=0.0, posinf=0.0, neginf=0.0)
    seen = pos + neg > 1
    root = np.sign(pos * n0 - neg * n1) * np.sqrt(2 * np.maximum(g, 0))
    return np.where(seen, np.clip(root / 4, -1, 3), 0), seen


class Steps:
    """Adagrad steps on a model, with their accumulators."""

    def __init__(self, m: Model):
        self.m, self.rate = m, 0.05
        self.embed = np.full((BUCKETS, 1), 1e-2, dtype=np.float32)
        self.rest = [np.full(x.shape, 1e-2, dtype=np.float32) for x in self.layers()]
        self.shift = 1e-2

    def layers(self):
        return (*self.m.filters, self.m.bias, self.m.out)

    def step(self, docs: list, labels):
        m = self.m
        text, ids = _concat(docs)
        # Only this batch's buckets: a small table.
        used, local = np.unique(np.concatenate(([0], ids.ravel())), return_inverse=True)
        small = m.embed[used]
        _, grads, d_embed, d_shift = gradients(
            m, small, text, local[1:].reshape(-1, IDS).astype(np.int32), labels)
        grads[-1] = grads[-1] + 1e-4 * m.out
        for x, g, a in zip(self.layers(), grads, self.rest):
            a += g * g
            x -= self.rate * g / np.sqrt(a)
        d_embed[used == 0] = 0  # padding stays zero
        self.embed[used] += (d_embed ** 2).mean(1, keepdims=True)
        m.embed[used] -= self.rate * 0.3 * d_embed / np.sqrt(self.embed[used])
        self.shift += d_shift ** 2
        m.shift -= self.rate * d_shift / np.sqrt(self.shift)

    def flat(self):
        """Rows of numbers: of each bucket, then of all else; the last
        column has the accumulators."""
        rest = np.concatenate([np.ravel(x) for x in (*self.layers(), self.m.shift)])
        sums = np.concatenate([np.ravel(x) for x in (*self.rest, self.shift)])
        out = np.zeros((BUCKETS + len(rest), DIM + 1))
        out[:BUCKETS, :DIM], out[:BUCKETS, DIM:] = self.m.embed, self.embed
        out[BUCKETS:, 0], out[BUCKETS:, DIM] = rest, sums
        return out

    def set(self, flat):
        self.m.embed = flat[:BUCKETS, :DIM].astype(np.float32)
        self.embed = flat[:BUCKETS, DIM:].astype(np.float32)
        at = BUCKETS
        for x, a in zip(self.layers(), self.rest):
            x[...] = flat[at:at + x.size, 0].reshape(x.shape)
            a[...] = flat[at:at + x.size, DIM].reshape(x.shape)
            at += x.size
        self.m.shift, self.shift = float(flat[at, 0]), float(flat[at, DIM])


def fit(docs: list, labels, seed: int = 11, epochs: int = EPOCHS) -> Model:
    """Trains on token arrays and their 0/1 labels with Adagrad steps.

    The first embedding dimension starts at how strongly the word is tied
    to one class (likelihood ratio), so that few texts suffice.
    """
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, dtype=np.float32)
    embed = np.zeros((BUCKETS, DIM), dtype=np.float32)
    pos, neg = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for d, y in zip(docs, labels):
        (pos if y else neg)[np.unique(d)] += 1
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    embed[:, 0], seen = strength(pos, neg, n1, n0)
    embed[:, 1:] = np.where(seen[:, None], rng.normal(0, 0.02, (BUCKETS, DIM - 1)), 0)
    embed[0] = 0
    filters = []
    for width in WIDTHS:
        f = rng.normal(0, 0.1, (width, DIM, FILTERS)).astype(np.float32)
        f[:, 0, :] = (rng.random((width, FILTERS)) * 0.5 + 0.5) / width
        filters.append(f)
    m = Model(embed, filters, np.full(len(WIDTHS) * FILTERS, -0.5, dtype=np.float32),
              np.full(len(WIDTHS) * FILTERS, 0.1, dtype=np.float32),
              float(np.log((n1 + 1) / (n0 + 1))))
    m._track = True
    steps = Steps(m)
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            steps.step([docs[i] for i in pick], labels[pick])
        steps.rate *= 0.85
    m._track = False
    return m


def _code_batches(batches):
    """Texts with the SHA-256 of their tokens and whether that keeps them
    out of training."""
    for b in parts(batches, 4):
        offsets, data = binary(b.column(4))
        t, ids = tokens(offsets, data)
        cut = np.searchsorted(t, np.arange(b.num_rows + 1))
        code = [hashlib.sha256(ids[i:j].tobytes()).digest() for i, j in zip(cut, cut[1:])]
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(code, pa.binary()), pa.array([kept_out(c) for c in code], pa.bool_())],
            names=["k", "h", "y", "l", "t", "code", "own"])


def kept_out(code: bytes) -> bool:
    """Texts of these token digests calibrate instead of training."""
    return int.from_bytes(code[:4], "big") % 1000 < CALIBRATION * 1000


def _count_batches(batches):
    """(bucket, toxic, other): the texts of a task that each bucket is found in."""
    counts = np.zeros((2, BUCKETS), dtype=np.int64)
    for b in parts(batches, 1):
        t, ids = tokens(*binary(b.column(1)))
        y = np.asarray(b.column(0).to_pylist(), dtype=bool)
        pair = np.unique(np.repeat(t, IDS) * BUCKETS + ids.ravel())
        where = y[pair // BUCKETS]
        counts[0] += np.bincount(pair[where] % BUCKETS, minlength=BUCKETS)
        counts[1] += np.bincount(pair[~where] % BUCKETS, minlength=BUCKETS)
    found = np.flatnonzero(counts.sum(0))
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[0, found]), pa.array(counts[1, found])],
                                     names=["bucket", "toxic", "other"])


def _round_batches(steps: Steps):
    """(place, blocks, change...): what each block changes in the model,
    as whole numbers of 1 / UNIT.  Rows (block, y, t) come sorted by block;
    each block starts with ``steps`` and goes through its texts once."""
    names = ["place", "blocks", *[f"d{i}" for i in range(DIM + 1)]]

    def run(batches):
        before = steps.flat()
        block, docs, labels, words = None, [], [], 0

        def learn():
            nonlocal words
            steps.step(docs, np.array(labels, dtype=np.float32))
            docs.clear()
            labels.clear()
            words = 0

        def change():
            if docs:
                learn()
            d = np.rint((steps.flat() - before) * UNIT).astype(np.int64)
            at = np.flatnonzero(d.any(1))
            steps.set(before)
            return pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(np.ones(len(at), np.int64)),
                 *[pa.array(np.ascontiguousarray(d[at, i])) for i in range(DIM + 1)]], names=names)

        for b in parts(batches, 2):
            t, ids = tokens(*binary(b.column(2)))
            cut = np.searchsorted(t, np.arange(b.num_rows + 1))
            for own, y, i, j in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), cut, cut[1:]):
                if own != block:
                    if block is not None:
                        yield change()
                    block = own
                docs.append(ids[i:j].copy())
                labels.append(y)
                words += j - i
                if len(docs) == BATCH or words >= STEP_WORDS:
                    learn()
        if block is not None:
            yield change()
    return run


def _in_rounds(m: Model, rows: DataFrame) -> None:
    """Trains ``m`` on all ``rows`` (block, y, t), sorted by block, in tasks."""
    found = rows.select("y", "t").mapInArrow(
        _count_batches, "bucket long, toxic long, other long").groupBy("bucket").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toArrow()  # a row per bucket
    pos, neg = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = found.column("bucket").to_numpy()
    pos[at], neg[at] = found.column("toxic").to_numpy(), found.column("other").to_numpy()
    n, n1 = rows.agg(F.count(F.lit(1)), F.sum(F.col("y").cast("long"))).first()
    m.embed[:, 0], seen = strength(pos, neg, float(n1 or 0), float(n - (n1 or 0)))
    m.embed[~seen] = 0
    m.embed[0] = 0
    m._track = True
    steps = Steps(m)
    fields = [f"d{i}" for i in range(DIM + 1)]
    schema = ", ".join(f"{c} long" for c in ("place", "blocks", *fields))
    for _ in range(ROUNDS):
        # At most a row per bucket and one per other number of the model.
        got = rows.mapInArrow(_round_batches(steps), schema).groupBy("place").agg(
            *[F.sum(c).alias(c) for c in ("blocks", *fields)]).toArrow()
        flat = steps.flat()
        mean = np.stack([got.column(c).to_numpy() for c in fields], axis=1) / UNIT
        flat[got.column("place").to_numpy()] += mean / got.column("blocks").to_numpy()[:, None]
        steps.set(flat)
        steps.rate *= 0.85
    m._track = False


def _logit_batches(model):
    def run(batches):
        for b in parts(batches, 2):
            t, ids = tokens(*binary(b.column(2)))
            z = model.logits(t, ids, b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(z.astype(np.float64))], names=["l", "y", "z"])
    return run


def _calibrate_rows(logits: DataFrame, steps: int = 50):
    """``calibrate`` of a table (y, z): its sums are exact, so they do not
    depend on the order of rows."""
    w, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + F.exp(-F.greatest(F.least(F.col("z") * float(w[0]) + float(w[1]), F.lit(30.0)), F.lit(-30.0))))
        one = logits.select("z", (p - F.col("y")).alias("e"), (p * (1 - p)).alias("v")).agg(*[
            F.sum(x.cast("decimal(28,14)")).alias(c) for c, x in (
                ("ez", F.col("e") * F.col("z")), ("e", F.col("e")), ("vzz", F.col("v") * F.col("z") * F.col("z")),
                ("vz", F.col("v") * F.col("z")), ("v", F.col("v")))]).first()
        if one["e"] is None:
            return 1.0, 0.0
        ez, e, vzz, vz, v = (float(x) for x in one)
        grad = np.array([ez, e]) + 0.5 * (w - start)
        move = np.clip(np.linalg.solve(np.array([[vzz, vz], [vz, v]]) + 0.5 * np.eye(2), grad), -2, 2)
        w = w - move
        if np.abs(move).max() < 1e-10:
            break
    return float(max(w[0], 0.05)), float(w[1])


def _best_thresholds(scored: DataFrame) -> dict:
    """``best_threshold`` of each language of a table (l, s, y), of any size.

    Scores are numbered in order over ranges; running counts are taken in
    each range and start with those of the ranges before.
    """
    each = scored.groupBy("l", "s").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"))
    tagged = tag_ranges(each.withColumn("o", -F.col("s")), ("l", "o"))
    kept = F.sum("n").alias("n0"), F.sum("hits").alias("hits0")
    ahead = Window.partitionBy("l").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    # A row per range and language: few.
    starts = tagged.groupBy("l", RANGE).agg(*kept).select(
        F.col("l").alias("l1"), F.col(RANGE).alias("range1"),
        *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(c) for c in ("n0", "hits0")],
        F.sum("hits0").over(Window.partitionBy("l")).alias("all"))
    upto = Window.partitionBy("l", RANGE).orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    rows = tagged.join(F.broadcast(starts), (F.col("l") == F.col("l1")) & (F.col(RANGE) == F.col("range1")))
    f1 = 2 * (F.col("hits0") + F.sum("hits").over(upto)) / (F.col("n0") + F.sum("n").over(upto) + F.col("all"))
    rows = rows.select("l", "s", "all", f1.alias("f1"))
    best = rows.groupBy("l").agg(F.max(F.struct("f1", "s"))["s"].alias("cut"), F.max("all").alias("all"))
    best = best.select(F.col("l").alias("l2"), "cut", "all")
    below = F.coalesce(F.max(F.when(F.col("s") < F.col("cut"), F.col("s"))), F.lit(0.0))
    cuts = each.join(F.broadcast(best), F.col("l") == F.col("l2")).groupBy("l", "cut", "all").agg(below.alias("below"))
    return {r["l"]: (r["cut"] + r["below"]) / 2 if r["all"] else DECISION for r in cuts.collect()}


def calibrate(logit, labels, steps: int = 50):
    """(a, b) of the logistic curve a * logit + b that fits the labels
    best, with a pull towards the identity that counts as a few texts."""
    y = np.asarray(labels, dtype=np.float64)
    x = np.asarray(logit, dtype=np.float64)
    w, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    if not len(x):
        return 1.0, 0.0
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + 0.5 * (w - start)
        hess = (design * (p * (1 - p))[:, None]).T @ design + 0.5 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(max(w[0], 0.05)), float(w[1])


def best_threshold(score, labels, default: float = DECISION) -> float:
    """The score cut of greatest F1, ties to the middle of the gap."""
    score, y = np.asarray(score), np.asarray(labels)
    if not y.any():
        return default
    o = np.argsort(-score, kind="stable")
    s, hits = score[o], np.cumsum(y[o])
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # a cut cannot split equal scores
    i = int(np.argmax(f1))
    below = s[i + 1] if i + 1 < len(s) else 0.0
    return float((s[i] + below) / 2)


def held_out(key: str = "doc_id"):
    """Rows never trained on: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2,
                      F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text",
          key: str = "doc_id", lang: str = "lang", max_texts: int = MAX_TEXTS,
          max_bytes: int = MAX_BYTES, seed: int = 11) -> tuple[Model, dict]:
    """A calibrated model and the threshold of each language.

    Learns from all rows with a label (0 or 1) that are not held out.  The
    driver fits the ones of least hash, at most ``max_texts`` texts or
    ``max_bytes`` bytes and none over a sixteenth of these, and receives
    no more than that.  If there are others, that model is only the start:
    word counts, rounds of training, calibration and thresholds then take
    in every row, in tasks.  Rows equal in key and text come once.
    Null and empty texts are texts without words; of several labels of a
    key the greatest counts; null labels and null keys are left out.  A
    table without labelled rows gives a model that scores all texts alike,
    under ``DECISION``.  Languages serve the thresholds only, never the
    score.
    """
    folder = scratch_dir(docs.sparkSession)
    y = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
         .groupBy(F.col(key).alias("__k")).agg(F.max(F.col(label)).alias("__y")))
    kind = (F.col(lang) if lang in docs.columns else F.lit(None)).cast("string")
    mine = docs.where(~held_out(key)).select(
        F.col(key).alias("__key"), F.xxhash64(text).alias("__th"), kind.alias("__l"),
        F.coalesce(text, F.lit("")).cast("binary").alias("__t"))
    # Neither table is known to be small: the join is left to Spark's size check.
    known = materialize(
        mine.select("__key", "__th", F.octet_length("__t").cast("long").alias("__b"))
        .join(y, F.col("__key") == F.col("__k"))
        .groupBy("__key", "__th").agg(F.max("__b").alias("__b"), F.max("__y").alias("__y")), folder, "known")
    # Each task offers its max_texts least; the running sum is over those that win.
    order = F.xxhash64(F.col("__key").cast("string"), "__th", F.lit(seed))
    few = known.where(F.col("__b") <= max_bytes // TEXT_PART).withColumn("__o", order).orderBy(
        "__o", "__key", "__th").limit(max_texts)
    few = few.withColumn("__sum", F.sum("__b").over(
        Window.orderBy("__o", "__key", "__th").rowsBetween(Window.unboundedPreceding, 0)))
    few = materialize(few.where(F.col("__sum") <= max_bytes).select(
        F.col("__key").alias("__k"), F.col("__th").alias("__h"), "__y"), folder, "first")
    # At most max_texts rows of three numbers: safe to broadcast.
    rows = (mine.join(F.broadcast(few), (F.col("__key") == F.col("__k")) & (F.col("__th") == F.col("__h")))
            .groupBy("__key", "__th").agg(F.max("__y").alias("__y"), F.min("__l").alias("l"),
                                          F.min("__t").alias("t"))
            .select(F.col("__key").cast("string").alias("k"), F.col("__th").alias("h"), "__y", "t", "l"))
    n, size = known.agg(F.count(F.lit(1)), F.sum("__b")).first()
    got = rows.toArrow().combine_chunks()
    if not n:
        empty = Model(np.zeros((BUCKETS, DIM), np.float32),
                      [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS],
                      np.zeros(len(WIDTHS) * FILTERS, np.float32),
                      np.zeros(len(WIDTHS) * FILTERS, np.float32), -2.0)
        return empty, {}
    whole = got.num_rows == n
    got = got.sort_by([("k", "ascending"), ("h", "ascending")])
    offsets, data = binary(got.column("t"))
    t, ids = tokens(offsets, data)
    cut = np.searchsorted(t, np.arange(got.num_rows + 1))
    texts = [ids[i:j] for i, j in zip(cut, cut[1:])]
    first_y = np.array(got.column("__y").to_pylist(), dtype=np.int64)
    langs = np.array([x or "" for x in got.column("l").to_pylist()])
    del got, data, t, ids
    # One of each group of equal texts; copies would count as evidence.
    code = [hashlib.sha256(d.tobytes()).digest() for d in texts]
    seen = {}
    for i, c in enumerate(code):
        seen.setdefault((c, int(first_y[i])), i)
    one = [seen[c] for c in sorted(seen)]
    texts, first_y, langs = [texts[i] for i in one], first_y[one], langs[one]
    own = np.array([kept_out(code[i]) for i in one], dtype=bool)
    m = fit([d for d, c in zip(texts, own) if not c], first_y[~own], seed)
    if whole:
        kept = [d for d, c in zip(texts, own) if c]
        m.scale = calibrate(m.logits(*_concat(kept), len(kept)) if kept else [], first_y[own])
        s = m.scores(*_concat(kept), len(kept)) if kept else np.zeros(0)
        return m, {str(x): best_threshold(s[langs[own] == x], first_y[own][langs[own] == x])
                   for x in np.unique(langs[own])}
    del texts
    every = mine.join(y, F.col("__key") == F.col("__k")).groupBy("__key", "__th").agg(
        F.max("__y").alias("y"), F.min("__l").alias("l"), F.min("__t").alias("t")).select(
        F.col("__key").cast("string").alias("k"), F.col("__th").alias("h"), F.col("y").cast("int").alias("y"),
        F.coalesce("l", F.lit("")).alias("l"), "t")
    blocks = -(-n // max_texts) + size // max_bytes
    every = every.mapInArrow(
        _code_batches, "k string, h long, y int, l string, t binary, code binary, own boolean").withColumn(
        "block", F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int"))
    # One shuffle both finds equal texts and deals the blocks; every pass reads its result.
    every = every.repartition(blocks, "block").groupBy("block", "code", "y").agg(
        F.min(F.struct("k", "h", "l", "t")).alias("r"), F.first("own").alias("own"))
    every = every.select("block", "code", "y", "own", F.col("r.l").alias("l"), F.col("r.t").alias("t"))
    every = every.sortWithinPartitions("block", "code", "y").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _in_rounds(m, every.where("NOT own").select("block", "y", "t"))
        logits = materialize(every.where("own").select("l", "y", "t").mapInArrow(
            _logit_batches(m), "l string, y int, z double"), folder, "logits")
    finally:
        every.unpersist()
    m.scale = _calibrate_rows(logits)
    a, b = m.scale
    s = 1 / (1 + F.exp(-F.greatest(F.least(F.col("z") * a + b, F.lit(30.0)), F.lit(-30.0))))
    return m, _best_thresholds(logits.select("l", "y", s.alias("s")))


def _score_batches(model, names):
    def run(batches):
        for b in parts(batches, 0):
            offsets, data = binary(b.column(0))
            text, ids = tokens(offsets, data)
            score = model.scores(text, ids, b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(score.astype(np.float64))] + [b.column(i) for i in range(1, b.num_columns)],
                names=["score", *names])
    return run


def score(docs: DataFrame, model: Model, thresholds: dict, text: str = "text",
          lang: str = "lang") -> DataFrame:
    """``docs`` without the text, with score, predicted and toxic.

    ``predicted`` cuts at ``DECISION``, ``toxic`` at the language's
    threshold (``DECISION`` where it has none, as for a null language).
    Null and empty texts get the score of a text without words.  Columns
    of the added names are replaced.
    """
    added = ("score", "predicted", "toxic")
    keep = [c for c in docs.columns if c != text and c not in added]
    schema = ", ".join(["score double"] + [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep])
    out = docs.select(F.coalesce(text, F.lit("")).cast("binary").alias("__t"), *keep).mapInArrow(
        _score_batches(model, keep), schema)
    cut = F.lit(DECISION)
    if lang in keep and thresholds:
        for x, v in sorted(thresholds.items()):
            cut = F.when(F.col(lang) == x, F.lit(v)).otherwise(cut)
    return out.withColumn("predicted", (F.col("score") >= DECISION).cast("int")).withColumn(
        "toxic", (F.col("score") >= cut).cast("int"))
