"""Line dedup against a plain version, and its undoing by deletion."""

import random

import numpy as np

from promoscope.llm import cuckoo_lines as cl


def plain(rows, least=cl.MIN_CHARS):
    """Brute force: (doc, n_lines, n_dropped, kept) per row, None key last."""
    def key(line):
        k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
        return k if len(k) >= least else None

    def order(d):
        return (d is None, d or 0)
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if key(line):
                holders.setdefault(key(line), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or len(holders[key(x)]) < 2
                or d == min(holders[key(x)], key=order)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def corpus(seed, n=80):
    rng = random.Random(seed)
    pool = ["  Common Line Number %d é\t" % i for i in range(15)] + ["short", "", "ABCDEFGHIJ", "éééééééééé"]
    rows = []
    for i in range(n):
        lines = [rng.choice(pool) if rng.random() < .6 else "own line %d of %d" % (rng.randint(0, 9), i)
                 for _ in range(rng.randint(1, 12))]
        if rng.random() < .3:
            lines = [x.upper() if x.isascii() else x for x in lines]
        rows.append((i, "\n".join(lines)))
    return rows + [(500, None), (501, ""), (None, pool[0] + "\nno number at all"), (7, pool[1])]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def got(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect()), key=str)


def test_dedup_matches_plain_version(spark, monkeypatch):
    monkeypatch.setattr(cl, "SHARD_KEYS", 20)
    monkeypatch.setattr(cl, "PART_LINES", 30)
    rows = corpus(1)
    assert got(cl.dedup_lines(frame(spark, rows))) == plain(rows)
    assert any(r[2] for r in plain(rows))


def test_increments_and_deletions(spark, monkeypatch):
    monkeypatch.setattr(cl, "SHARD_KEYS", 20)
    rows = corpus(2)
    first, second = rows[:30], rows[30:]
    store = cl.LineStore(spark)
    store.insert(frame(spark, first))
    before = got(store.dedup(frame(spark, first)))
    assert before == plain(first)
    store.insert(frame(spark, second))
    assert got(store.dedup(frame(spark, rows))) == plain(rows)
    gone = {r[0] for r in second}
    store.delete(spark.createDataFrame([(k,) for k in gone], "doc_id long"))
    kept = [r for r in first if r[0] not in gone]
    assert got(store.dedup(frame(spark, kept))) == plain(kept)
    # The stored filters hold what a fresh store's would let through.
    keys = np.array([r["k1"] for r in store.refs.where("refs > 1").collect()])
    blobs = {r["shard"]: r for r in store.filters.collect()}
    for k, k2 in [(r["k1"], r["k2"]) for r in store.refs.where("refs > 1").collect()]:
        f = cl.CuckooFilter.from_bytes(blobs[k2 % store.shards]["blob"])
        assert f.contains(np.array([k]))[0]
    assert sum(r["keys"] for r in blobs.values()) == len(keys)


def test_filter_deletes_and_refuses_when_full():
    rng = np.random.default_rng(3)
    keys = rng.integers(-2**63, 2**63 - 1, 5000)
    f = cl.build_filter(keys)
    assert f.contains(keys).all()
    assert f.contains(rng.integers(-2**63, 2**63 - 1, 20000)).mean() < 0.01
    f.delete(keys[:2500])
    assert f.contains(keys[2500:]).all() and f.contains(keys[:2500]).mean() < 0.01
    again = cl.CuckooFilter.from_bytes(f.to_bytes())
    assert (again.table == f.table).all()
    tight = cl.CuckooFilter(np.zeros((4, cl.SLOTS), np.uint16))
    try:
        tight.insert(keys[:100])
    except OverflowError:
        pass
    else:
        raise AssertionError("should be full")


def test_empty_table_and_extra_columns(spark):
    assert got(cl.dedup_lines(frame(spark, []))) == []
    rows = [(1, "one shared line\nx", 5, "a"), (2, "One Shared Line", None, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, lang string")
    out = cl.dedup_lines(df)
    assert sorted(out.columns) == ["doc_id", "kept", "lang", "n_dropped", "n_lines"]
    assert got(out) == [(1, 2, 0, "one shared line\nx"), (2, 1, 1, "")]


def test_shards_grow_with_the_store(spark, monkeypatch):
    monkeypatch.setattr(cl, "SHARD_KEYS", 20)
    rows = corpus(4)
    store = cl.LineStore(spark).insert(frame(spark, rows[:1]))
    assert store.shards == 1
    store.insert(frame(spark, rows[1:]))
    keys = store.refs.count()
    assert 20 * store.shards >= keys > 10 * store.shards
    assert {r["shard"] for r in store.filters.collect()} <= set(range(store.shards))
    assert got(store.dedup(frame(spark, rows))) == plain(rows)
    store.delete(spark.createDataFrame([(r[0],) for r in rows[40:]], "doc_id long"))
    left = [r for r in rows[:40] if r[0] != 7]
    assert got(store.dedup(frame(spark, left))) == plain(left)


def test_very_long_text(spark):
    long = "\n".join("line number %d of a long text" % i for i in range(200_000))
    rows = [(1, "Line number 77 of a long text"), (2, long), (3, "x" * 3_000_000), (4, "X" * 3_000_000)]
    assert got(cl.dedup_lines(frame(spark, rows))) == plain(rows)
