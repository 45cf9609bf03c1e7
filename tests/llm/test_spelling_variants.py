"""Spelling variants against brute force, and the reduced neighbourhoods."""

import random
from collections import Counter

import numpy as np

from promoscope.llm import spelling_variants as sv


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(words):
    n = {w: k for w, k in Counter(w for w in words if w is not None and len(w) >= 5).items() if k >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v.encode()), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    letters = "abciqryzéÉÿ"
    words = []
    for _ in range(60):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(4, 9)))
        times = 400
        while times >= 2 and len(w) >= 4:
            words += [w] * times
            times = rng.randint(times // 4, times // 2)
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:],
                            w[:i] + rng.choice(letters) + w[i + 1:], w[:i] + w[i:i + 1] + w[i:]])
    long = "ab" * 3_000
    return words + [None] * 5 + ["", "abc"] * 9 + [long] * 3 + [long + "a"] * 6 + [long[1:]] * 4


def test_matches_brute_force(spark):
    words = corpus(11)
    random.Random(0).shuffle(words)
    df = spark.createDataFrame([(w, "x") for w in words], "word string, id string").repartition(7)
    got = sorted(tuple(r) for r in sv.variants(df).select(
        "word", "n", "n_near", "form", "form_n", "root").collect())
    want = brute(words)
    assert got == want
    assert any(r[5] != r[3] and r[3] for r in want) and max(r[2] for r in want) > 1


def test_neighbours_are_generated_once_from_one_side():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abqré") for _ in range(rng.randint(0, 5))) for _ in range(300)})
    raw = [w.encode() for w in words]
    offsets = np.cumsum([0] + [len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    keys = sv.reduced_keys(offsets, data, len(words)).tolist()
    found = [[] for _ in words]
    for word, hashed in sv.neighbour_keys(offsets, data, len(words)):
        for w, h in zip(word.tolist(), hashed.tolist()):
            found[w].append(h)
    reduced = ["".join(str(ord(c) % sv.SYMBOLS) for c in w) for w in words]
    for i, r in enumerate(reduced):
        assert len(set(found[i])) == len(found[i])
        for j, q in enumerate(reduced):
            there, back = keys[j] in found[i], keys[i] in found[j]
            assert there + back == (1 if one_edit(r, q) else 0), (words[i], words[j])
            assert (keys[i] == keys[j]) == (r == q)


def test_empty_table(spark):
    assert sv.variants(spark.createDataFrame([], "word string")).collect() == []


def test_runs_keep_other_capitals(spark):
    df = spark.createDataFrame([("Été ÉTÉ straße-WEG Ābc",), (None,)], "t string")
    got = [r[0] for r in df.select(sv.runs(df.t)).collect()]
    assert [w for w in got[0] if w] == ["Été".replace("É", "É"), "ÉtÉ", "straße", "weg", "bc"] and got[1] is None
