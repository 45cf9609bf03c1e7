"""Near-duplicate components against brute force, and the sketch itself."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from promoscope.llm import setsketch as ss

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(rows, k, pct=80):
    sets = [shingles(t, k) for _, t in rows]
    par = list(range(len(rows)))

    def root(x):
        while par[x] != x:
            x = par[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= pct * len(sets[i] | sets[j]):
                par[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i)) if s else d, d == (least.get(root(i)) if s else d))
                   for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n=120):
    """Groups of copies with 0 to 12 edits each: links, chains, outsiders."""
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(300)] + ["É", "ça"]
    rows = []
    bases = [[rng.choice(vocab) for _ in range(size)] for size in (1, 2, 4, 60, 100, 160)]
    for i in range(n):
        if rng.random() < .7:
            w = list(rng.choice(bases[3:] if rng.random() < .8 else bases))
            for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 8, 12])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
        else:
            w = [rng.choice(vocab) for _ in range(rng.randint(1, 50))]
        if rng.random() < .2:
            w = [x.upper() if x.isascii() else x for x in w]
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(w)))
    return rows + [(800, None), (801, ""), (802, " \n"), (3, rows[3][1]), (None, rows[5][1]),
                   (None, "quite alone here")]


def run(spark, rows, k):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in ss.near_duplicates(df, k).collect()), key=str)


@pytest.mark.parametrize("k", [2, 5])
def test_components_match_brute_force(spark, k, monkeypatch):
    monkeypatch.setattr(ss, "BLOCK", 4)
    monkeypatch.setattr(ss, "CELL", 16)
    rows = corpus(k)
    want = brute(rows, k)
    assert run(spark, rows, k) == want
    assert len({r[2] for r in want}) < len(want) - 15


@pytest.mark.parametrize("seed", [11, 12])
def test_one_bucket_of_all_nodes_loses_no_link(spark, monkeypatch, seed):
    """No other band helps: each pair is linked inside this bucket or never."""
    def one_band(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(b.num_rows, np.int64)), b.column(0)], names=["band", "node"])
    monkeypatch.setattr(ss, "_band_batches", one_band)
    rng = random.Random(seed)
    rows, w = [], ["w%d" % rng.randrange(10**6) for _ in range(60)]
    for i in range(40):  # a chain: each text is like its neighbours only
        at = (i * 7) % 60
        w[at:at + 2] = ["w%d" % rng.randrange(10**6) for _ in w[at:at + 2]]
        rows.append((i, " ".join(w)))
    rng.shuffle(rows)
    rows += [(i + 1000, t) for i, t in corpus(seed, 40) if i is not None]
    want = brute(rows, 2)
    assert run(spark, rows, 2) == want
    assert len({r[2] for r in want if r[0] < 40}) < 20


def test_empty_table(spark):
    assert run(spark, [], 5) == []


def test_estimates_are_near_the_similarity():
    rng = np.random.default_rng(4)
    for j in (0.3, 0.6, 0.8, 0.95):
        both = rng.integers(0, 2**63, 1000).astype(np.uint64)
        own = int(1000 * (1 - j) / j / 2)
        a = np.concatenate((both, rng.integers(0, 2**63, own).astype(np.uint64)))
        b = np.concatenate((both, rng.integers(0, 2**63, own).astype(np.uint64)))
        ra, rb = (ss.sketch(np.zeros(len(x), np.int64), x, 1) for x in (a, b))
        got = ss.estimate((ra > rb).sum(1), (ra < rb).sum(1), (ra == rb).sum(1), [len(a)], [len(b)])
        assert abs(got[0] - j) < 4 * np.sqrt(j * (1 - j) / ss.REGISTERS)
        union = ss.sketch(np.zeros(len(a) + len(b), np.int64), np.concatenate((a, b)), 1)
        assert (ss.merge(ra, rb) == union).all()


def test_short_texts_next_to_each_other():
    texts = [b"one", b"one two", b"a b c d e f", b"", b"x"]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    t, _ = ss.shingle_sets(offsets, np.frombuffer(b"".join(texts), np.uint8), 5)
    assert np.bincount(t, minlength=5).tolist() == [1, 1, 2, 0, 1]
