"""Reversible line dedup (operator 5).

State, per shard of the line-key space, in a folder of versions:

* ``postings``: (shard, k1, k2, doc, n), which documents hold a line key,
* ``refs``: (shard, k1, k2, refs, owner, n), the exact reference counts,
* ``filters``: (shard, blob), a cuckoo filter of the shard's keys that at
  least two documents hold.

Inserting adds postings and recounts the keys they touch; deleting
documents removes theirs, and lines dropped in favour of a deleted
document come back.  A filter answers "not a repeated line" for most
lines without a look at the counts; what it lets through is confirmed on
the exact table.  Fingerprints of keys that stop or start being repeated
are deleted from and inserted into the stored filters.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoscope.llm._bytes import parts
from promoscope.llm._common import materialize, scratch_dir

MIN_CHARS = 10
#: Keys per shard that a store aims at; with over twice as many on
#: average, its shards are halved.
SHARD_KEYS = 50_000
#: Lines a task sifts at once; shards with more are dealt to several.
PART_LINES = 100_000
SLOTS = 4
MAX_KICKS = 500


class CuckooFilter:
    """Cuckoo filter of 64-bit keys: 16-bit fingerprints, four a bucket."""

    def __init__(self, table: np.ndarray):
        self.table = table  # buckets x SLOTS, 0 is free

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8)))))
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def from_bytes(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, dtype=np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys):
        k = np.asarray(keys).astype(np.int64).view(np.uint64)
        print_ = ((k >> np.uint64(40)) % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
        first = (k & np.uint64(len(self.table) - 1)).astype(np.int64)
        return print_, first, self._other(first, print_)

    def _other(self, bucket, print_):
        spread = (np.asarray(print_).astype(np.int64) * 0x5BD1E995) >> 3
        return bucket ^ (spread & (len(self.table) - 1))

    def contains(self, keys) -> np.ndarray:
        p, a, b = self._places(keys)
        return ((self.table[a] == p[:, None]) | (self.table[b] == p[:, None])).any(axis=1)

    def insert(self, keys) -> None:
        """Each key once; the table grows when it is full."""
        for p, a, b in zip(*(x.tolist() for x in self._places(keys))):
            if not self._place(p, a) and not self._place(p, b) and not self._kick(p, b):
                raise OverflowError("cuckoo filter is full")

    def _place(self, p, bucket) -> bool:
        row = self.table[bucket]
        for s in range(SLOTS):
            if row[s] == 0:
                row[s] = p
                return True
        return False

    def _kick(self, p, bucket) -> bool:
        undo = []
        for i in range(MAX_KICKS):
            s = (p + i) % SLOTS
            undo.append((bucket, s, int(self.table[bucket, s])))
            p, self.table[bucket, s] = int(self.table[bucket, s]), p
            bucket = int(self._other(bucket, p))
            if self._place(p, bucket):
                return True
        for bucket, s, old in reversed(undo):
            self.table[bucket, s] = old
        return False

    def delete(self, keys) -> None:
        """Each key must have been inserted."""
        for p, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (a, b):
                hit = np.flatnonzero(self.table[bucket] == p)
                if len(hit):
                    self.table[bucket, hit[0]] = 0
                    break


def build_filter(keys, least: int = 0) -> CuckooFilter:
    """A filter of the keys, larger if they do not fit at first."""
    size = max(len(keys), least)
    while True:
        f = CuckooFilter.sized(size)
        try:
            f.insert(keys)
            return f
        except OverflowError:
            size = 2 * max(size, f.table.size // 2)


def _lines(text: bytes):
    return text.split(b"\n")


def _key(line: bytes, min_chars: int):
    """(k1, k2) of a line, None if its key is too short."""
    k = line.strip(b" \t\n\x0b\x0c\r").lower()  # bytes: ASCII only
    if len(k) < min_chars or (len(k) < 4 * min_chars and len(k.decode("utf-8", "replace")) < min_chars):
        return None
    d = hashlib.blake2b(k, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _line_batches(min_chars):
    """(doc, k1, k2, n): the keys of each text with their line counts."""
    def run(batches):
        for b in parts(batches, 1):
            rows, k1, k2, n = [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                count = {}
                for line in _lines(t):
                    k = _key(line, min_chars)
                    if k:
                        count[k] = count.get(k, 0) + 1
                rows += [i] * len(count)
                k1 += [k[0] for k in count]
                k2 += [k[1] for k in count]
                n += count.values()
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(k1, pa.int64()),
                 pa.array(k2, pa.int64()), pa.array(n, pa.int64())], names=["doc", "k1", "k2", "n"])
    return run


def _drop_batches(min_chars, names):
    """Rebuilds each text without the lines whose key is listed."""
    def run(batches):
        for b in parts(batches, 0):
            out = {"n_lines": [], "n_dropped": [], "kept": []}
            for t, drops in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                gone = {(d["k1"], d["k2"]) for d in drops or ()}
                lines = _lines(t)
                kept = [x for x in lines if _key(x, min_chars) not in gone] if gone else lines
                out["n_lines"].append(len(lines))
                out["n_dropped"].append(len(lines) - len(kept))
                out["kept"].append(b"\n".join(kept).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["n_lines"], pa.int64()), pa.array(out["n_dropped"], pa.int64()),
                 pa.array(out["kept"], pa.string())] + [b.column(i) for i in range(2, b.num_columns)],
                names=["n_lines", "n_dropped", "kept", *names])
    return run


class LineStore:
    """Line keys of the documents inserted so far, by shard.

    Documents are told apart by their key column; rows of one key are one
    document, and a null key is a document that sorts last.  Inserting a
    document again adds its lines to it.  Texts of any length are split
    whole, a few megabytes of documents at a time.  The number of shards
    doubles as the store grows; ``shards`` is the one it starts with.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, key: str = "doc_id",
                 text: str = "text", min_chars: int = MIN_CHARS, shards: int | None = None):
        self.spark, self.folder = spark, folder or scratch_dir(spark)
        self.key, self.text, self.min_chars, self.shards = key, text, min_chars, shards
        self.version = 0
        self.postings = self.refs = self.filters = None

    def _postings(self, docs: DataFrame) -> DataFrame:
        kind = docs.schema[self.key].dataType.simpleString()
        return docs.select(F.col(self.key).alias("doc"),
                           F.coalesce(F.col(self.text), F.lit("")).cast("binary").alias("t")).mapInArrow(
            _line_batches(self.min_chars), f"doc {kind}, k1 long, k2 long, n long")

    def _shard(self):
        return F.pmod(F.col("k2"), F.lit(self.shards)).cast("int").alias("shard")

    def _counted(self, postings: DataFrame) -> DataFrame:
        """Exact counts: documents per key, its owner (the least), lines."""
        return postings.groupBy("k1", "k2").agg(
            F.count(F.lit(1)).alias("refs"),
            F.min(F.struct(F.col("doc").isNull().alias("last"), "doc"))["doc"].alias("owner"),
            F.sum("n").alias("n"))

    def _save(self, postings: DataFrame) -> None:
        """Next version of the state from the postings of (doc, k1, k2)."""
        self.version += 1
        at = f"{self.folder}/v{self.version}"
        old_refs, old_filters = self.refs, self.filters
        self.postings = materialize(postings.select("doc", "k1", "k2", "n"), at, "postings")
        self.refs = materialize(self._counted(self.postings), at, "refs")
        keys = self.refs.count()
        if self.shards is None:
            self.shards = max(1, -(-keys // SHARD_KEYS))
        elif keys > 2 * SHARD_KEYS * self.shards:
            while keys > SHARD_KEYS * self.shards:
                self.shards *= 2
            old_filters = None  # fingerprints cannot be dealt anew, keys can
        self.filters = materialize(self._filters(old_refs, old_filters), at, "filters")

    def _filters(self, old_refs, old_filters) -> DataFrame:
        """Filters of the repeated keys, one row per shard.

        Without a previous version they are built; otherwise the stored
        ones take in the keys that became repeated and give up those that
        no longer are.
        """
        now = self.refs.where("refs > 1").select("k1", "k2")
        if old_filters is None:
            def build(pdf: pd.DataFrame) -> pd.DataFrame:
                f = build_filter(pdf["k1"].to_numpy())
                return pd.DataFrame({"shard": [pdf["shard"].iat[0]], "blob": [f.to_bytes()],
                                     "keys": [len(pdf)]})

            return now.select(self._shard(), "k1").groupBy("shard").applyInPandas(
                build, "shard int, blob binary, keys long")
        before = old_refs.where("refs > 1").select("k1", "k2")
        change = (now.join(before, ["k1", "k2"], "left_anti").withColumn("add", F.lit(True))
                  .unionByName(before.join(now, ["k1", "k2"], "left_anti")
                               .withColumn("add", F.lit(False)))
                  .select(self._shard(), "k1", "k2", "add"))

        def update(key, old: pd.DataFrame, delta: pd.DataFrame) -> pd.DataFrame:
            add = delta.loc[delta["add"], "k1"].to_numpy()
            cut = delta.loc[~delta["add"], "k1"].to_numpy()
            if not len(old):
                f, n = build_filter(add), len(add)
            else:
                f = CuckooFilter.from_bytes(old["blob"].iat[0])
                f.delete(cut)
                n = int(old["keys"].iat[0]) + len(add) - len(cut)
                try:
                    f.insert(add)
                except OverflowError:
                    return pd.DataFrame({"shard": [key[0]], "blob": [None], "keys": [n]})
            return pd.DataFrame({"shard": [key[0]], "blob": [f.to_bytes()], "keys": [n]})

        updated = old_filters.groupBy("shard").cogroup(change.groupBy("shard")).applyInPandas(
            update, "shard int, blob binary, keys long")
        updated = materialize(updated, f"{self.folder}/v{self.version}", "updated")
        full = updated.where("blob IS NULL").select("shard")
        if full.isEmpty():
            return updated

        def rebuild(pdf: pd.DataFrame) -> pd.DataFrame:
            f = build_filter(pdf["k1"].to_numpy(), 2 * len(pdf))
            return pd.DataFrame({"shard": [pdf["shard"].iat[0]], "blob": [f.to_bytes()],
                                 "keys": [len(pdf)]})

        again = now.select(self._shard(), "k1").join(full, "shard").groupBy("shard").applyInPandas(
            rebuild, "shard int, blob binary, keys long")
        return updated.where("blob IS NOT NULL").unionByName(again)

    def insert(self, docs: DataFrame) -> LineStore:
        """Adds the documents' lines."""
        new = self._postings(docs)
        if self.postings is not None:
            new = self.postings.unionByName(new)
        self._save(new.groupBy("doc", "k1", "k2").agg(F.sum("n").alias("n")))
        return self

    def delete(self, keys: DataFrame) -> LineStore:
        """Forgets the documents whose key is in ``keys`` (one column)."""
        gone = keys.select(F.col(keys.columns[0]).alias("gone")).distinct()
        self._save(self.postings.join(gone, F.col("doc").eqNullSafe(F.col("gone")), "left_anti"))
        return self

    def drops(self, docs: DataFrame | None = None) -> DataFrame:
        """(doc, k1, k2) of lines to drop: keys that two or more documents
        hold, in every document but the least that holds it.

        The filters sift the postings first, shard by shard in salted
        parts; hits are then joined to the exact counts.
        """
        lines = (self.postings if docs is None else self._postings(docs)).select("doc", "k1", "k2")
        kind = lines.schema["doc"].dataType.simpleString()

        def sift(key, some: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            if not len(filters):
                return some.iloc[:0][["doc", "k1", "k2"]]
            f = CuckooFilter.from_bytes(filters["blob"].iat[0])
            return some.loc[f.contains(some["k1"].to_numpy()), ["doc", "k1", "k2"]]

        lines = lines.withColumn("shard", self._shard())
        # A line that a third of all documents hold makes one large shard.
        sizes = lines.groupBy("shard").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(PART_LINES)).cast("int").alias("parts"))
        sizes = materialize(sizes, scratch_dir(self.spark), "parts")
        salted = lines.join(sizes, "shard").select("doc", "k1", "k2", "shard", F.pmod(
            F.xxhash64("doc", "k1"), F.col("parts")).cast("int").alias("salt"))
        copies = self.filters.join(sizes, "shard").select("shard", "blob", F.explode(
            F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
        hits = salted.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInPandas(
            sift, f"doc {kind}, k1 long, k2 long")
        exact = self.refs.where("refs > 1").select("k1", "k2", "owner")
        return hits.join(exact, ["k1", "k2"]).where(~F.col("doc").eqNullSafe(F.col("owner"))).select(
            "doc", "k1", "k2")

    def dedup(self, docs: DataFrame) -> DataFrame:
        """The inserted ``docs`` with n_lines, n_dropped and kept (the text
        without dropped lines); columns of those names are replaced.

        Null and empty texts are one empty line.  Keys of fewer than
        ``min_chars`` code points are never dropped.
        """
        added = ("n_lines", "n_dropped", "kept")
        rest = [c for c in docs.columns if c not in added]
        by_doc = self.drops().groupBy(F.col("doc").alias("__doc")).agg(
            F.collect_list(F.struct("k1", "k2")).alias("__drops"))
        rows = docs.select(*rest).withColumn(
            "__t", F.coalesce(F.col(self.text), F.lit("")).cast("binary"))
        joined = rows.join(by_doc, F.col(self.key).eqNullSafe(F.col("__doc")), "left")
        keep = [c for c in rest if c != self.text]
        schema = ", ".join(["n_lines long", "n_dropped long", "kept string"] + [
            f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep])
        return joined.select("__t", "__drops", *keep).mapInArrow(
            _drop_batches(self.min_chars, keep), schema)


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id",
                min_chars: int = MIN_CHARS) -> DataFrame:
    """Inserts all documents into a new store and drops repeated lines."""
    return LineStore(docs.sparkSession, key=key, text=text, min_chars=min_chars).insert(
        docs).dedup(docs)
