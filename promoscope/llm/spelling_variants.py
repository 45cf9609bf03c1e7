"""Spelling variants by reduced-alphabet generation (operator 12).

Two words are near if one inserted, deleted or replaced code point turns
one into the other.  Their letters are mapped to a few symbols; words
that are near have reduced words that are equal or one edit apart.  So
the one-edit neighbourhood of every word's reduced form is generated and
joined with the reduced vocabulary, and the pairs found are verified on
the words themselves.  Being neighbours is mutual: every deletion and
every replacement by a lesser symbol is written out, insertions and the
other replacements are the same pairs seen from the other word.  The neighbourhood grows with the few symbols, not
with the letters of the script.

Reduced words travel as 64-bit hashes and words as row ids of the
written vocabulary, so long words do not multiply; words meet only where
a pair is verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoscope.llm._bytes import U, binary, mix, parts
from promoscope.llm._common import materialize, scratch_dir

#: Symbols of the reduced alphabet.
SYMBOLS = 8
MIN_CHARS = 5
MIN_COUNT = 3
#: A form must be this many times as frequent as the word.
FORM_RATIO = 2
#: Letters worked on at once.
CHUNK = 1 << 18

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_LETTERS = "[^A-Za-z\\u00C0-\\u00FF]+"
_B = 0x9E3779B97F4A7C15


def runs(text: Column) -> Column:
    """Maximal runs of letters (A-Z lower-cased), with empty strings at
    the ends; none for null."""
    lower = F.translate(text, _UPPER, _UPPER.lower())
    return F.split(lower, NOT_LETTERS, -1)


def vocabulary(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of a column ``word`` that are long and
    frequent enough; counted in part before the shuffle."""
    return words.where(F.char_length("word") >= min_chars).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _symbols(offsets, data, n):
    """(word number, symbol + 1 as uint64) of every code point."""
    buf = data[offsets[0]:offsets[-1]]
    starts = (buf & 0xC0) != 0x80
    # The code point's low bits tell letters apart: the last byte holds them.
    ends = np.flatnonzero(np.append(starts[1:], True)) if len(buf) else np.zeros(0, np.int64)
    at = np.flatnonzero(starts)
    word = np.searchsorted(offsets - offsets[0], at, side="right") - 1
    return word, (buf[ends] % SYMBOLS).astype(U) + U(1)


def reduced_keys(offsets, data, n):
    """(word, hash) of the reduced words, one for each of ``n`` words."""
    word, s = _symbols(offsets, data, n)
    key = np.zeros(n, dtype=U)
    with np.errstate(over="ignore"):
        for w, i, p in _pieces(word, s):
            np.add.at(key, w, s[i] * _power(p))
        return mix(key)


def _power(p):
    with np.errstate(over="ignore"):
        out = np.ones(len(p), dtype=U)
        base, e = U(_B), p.astype(np.int64)
        top = int(e.max()).bit_length() if len(e) else 0
        for bit in range(top):
            out = np.where((e >> bit) & 1 == 1, out * base, out)
            base = U((int(base) * int(base)) & (2**64 - 1))
        return out


def _pieces(word, s):
    """(word, index, position in the word) in slices of bounded length."""
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(word) else []
    lengths = np.diff(np.append(first, len(word))) if len(word) else []
    position = np.arange(len(word)) - np.repeat(first, lengths) if len(word) else np.zeros(0, np.int64)
    for i in range(0, len(word), CHUNK):
        j = np.arange(i, min(i + CHUNK, len(word)))
        yield word[j], j, position[j]


def neighbour_keys(offsets, data, n):
    """Yields (word, hash): the one-edit neighbourhood of each reduced
    word, each member once, in slices of bounded length.

    A reduced word is in the neighbourhood of each of its neighbours, so
    of two neighbours only one yields the other: the longer one, or the
    one with the greater symbol where they differ.
    """
    word, s = _symbols(offsets, data, n)
    with np.errstate(over="ignore"):
        lengths = np.bincount(word, minlength=n)
        start = np.concatenate(([0], np.cumsum(lengths)))
        position = np.arange(len(word)) - start[word]
        power = _power(position)
        # before: hash of what stands before a symbol; after: of what
        # follows, which a deletion moves one place to the left.
        term = s * power
        total = np.zeros(n, dtype=U)
        np.add.at(total, word, term)
        run = np.cumsum(term)
        base = np.concatenate((np.zeros(1, dtype=U), run))[start[word]]
        upto = run - base                       # through this symbol
        before = upto - term
        after = total[word] - upto
        left = U(pow(_B, -1, 2**64))
        # Of equal symbols in a row, deleting the last is enough.
        last = np.append((word[1:] != word[:-1]) | (s[1:] != s[:-1]), True) if len(word) else s == s
        for i in range(0, len(word), CHUNK):
            j = slice(i, i + CHUNK)
            w, b, a, p = word[j], before[j], after[j], power[j]
            yield w[last[j]], mix(b + a * left)[last[j]]
            for symbol in range(1, SYMBOLS):
                less = s[j] > U(symbol)
                yield w[less], mix(b + U(symbol) * p + a)[less]


def _reduced_batches(batches):
    for b in parts(batches, 1):
        offsets, data = binary(b.column(1))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(reduced_keys(offsets, data, b.num_rows).view(np.int64))],
            names=["near_id", "b", "key"])


def _neighbour_batches(batches):
    for b in parts(batches, 1):
        offsets, data = binary(b.column(1))
        for word, key in neighbour_keys(offsets, data, b.num_rows):
            if len(word):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(word)), pa.array(key.view(np.int64))], names=["id", "key"])


def near_words(vocab: DataFrame) -> DataFrame:
    """(id, near_id): the ordered pairs of near words of ``vocab``
    (id, word), both directions."""
    bytes_ = vocab.select("id", F.col("word").cast("binary").alias("bytes"))
    reduced = bytes_.mapInArrow(_reduced_batches, "near_id long, b binary, key long").select(
        "near_id", F.decode("b", "UTF-8").alias("b"), "key")
    around = bytes_.mapInArrow(_neighbour_batches, "id long, key long")
    same = reduced.select(F.col("near_id").alias("id"), "key").join(reduced, "key").where("id < near_id")
    pairs = around.join(reduced, "key").unionByName(same).select("id", "near_id", "b")
    a = vocab.select("id", F.col("word").alias("a"))
    near = F.levenshtein("a", "b", 1) == 1
    found = pairs.join(a, "id").where(near).select(F.array(
        F.struct("id", "near_id"), F.struct(F.col("near_id").alias("id"), F.col("id").alias("near_id"))).alias("two"))
    return found.select(F.inline("two"))


def follow(links: DataFrame, folder: str) -> DataFrame:
    """(id, root) of chains ``links`` (id, root): every step looks twice
    as far, until no chain goes on.  Chains must not close."""
    step = 0
    while True:
        onward = links.select(F.col("id").alias("root"), F.col("root").alias("next"))
        longer = materialize(links.join(onward, "root", "left").select(
            "id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            folder, f"roots{step}")
        links = longer.select("id", "root")
        if longer.where("moved").isEmpty():
            return links
        step += 1


def variants(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n, n_near, form, form_n and root of the words of ``words``.

    ``words`` has one row per occurrence in a column ``word``; null and
    short words do not count, other columns are ignored, an empty table
    gives an empty table.  n_near counts a word's near words; its form is
    the most frequent of them (ties: the least in code-point order) if
    that is at least ``FORM_RATIO`` times as frequent, else null; root is
    where the forms lead, the word itself without one.  Forms grow in
    frequency, so they never lead in circles.  Long words cost in
    proportion to their length.
    """
    folder = scratch_dir(words.sparkSession)
    vocab = materialize(vocabulary(words, min_chars, min_count), folder, "words")
    # Ids are numbered over a written table and written with it: stable.
    vocab = materialize(vocab.withColumn("id", F.monotonically_increasing_id()), folder, "vocab")
    pairs = materialize(near_words(vocab), folder, "pairs")
    target = vocab.select(F.col("id").alias("near_id"), F.struct(
        (-F.col("n")).alias("less"), "word", "id").alias("near"))
    best = pairs.join(target, "near_id").groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.min("near").alias("best"))
    found = vocab.join(best, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= FORM_RATIO * F.col("n"), F.col("best")).alias("best"))
    found = materialize(found.select(
        "id", "word", "n", "n_near", F.col("best.word").alias("form"), (-F.col("best.less")).alias("form_n"),
        F.col("best.id").alias("form_id")), folder, "forms")
    roots = follow(found.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("root")), folder)
    named = vocab.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    roots = roots.join(named, "root").select("id", "root_word")
    return found.join(roots, "id", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root_word", "word").alias("root"))
