"""Vectorised hashing of byte ranges and words, for use inside tasks."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes hashed at once; longer texts are cut with overlap.
CHUNK = 1 << 20
#: Bytes of one column that a task works on at once.
PART = 4 << 20

_R = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _tables():
    n = CHUNK + (1 << 16)  # and the overlap of a piece
    byte = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
    with np.errstate(over="ignore"):
        power = np.full(n, _R, dtype=np.uint64)
        power[0] = 1
        inverse = np.full(n, pow(_R, -1, 2**64), dtype=np.uint64)
        inverse[0] = 1
        return byte, np.cumprod(power), np.cumprod(inverse)


def mix(x):
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


class Rolling:
    """Hashes of byte ranges of one buffer of at most CHUNK (and overlap)."""

    def __init__(self, buf):
        byte, power, self.inverse = _tables()
        self.sums = np.zeros(len(buf) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(byte[buf] * power[:len(buf)], out=self.sums[1:])

    def of(self, lo, hi):
        with np.errstate(over="ignore"):
            return (self.sums[hi] - self.sums[lo]) * self.inverse[lo]


def binary(column):
    """Offsets and bytes of an Arrow binary column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)


def parts(batches, column):
    """The batches cut into parts of about PART bytes in one column."""
    for b in batches:
        offsets, _ = binary(b.column(column))
        at = 0
        while at < b.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + PART, side="right")) - 1
            end = min(max(end, at + 1), b.num_rows)
            yield b.slice(at, end - at)
            at = end


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _long_word(data, at, bound, inside_table, prefixes):
    """(end, hashes) of the word that starts at ``at``, read piece by piece
    up to its end or ``bound``, where its text ends."""
    start, total = at, 0
    while at < bound:
        buf = _LOWER[data[at:min(at + CHUNK, bound)]]
        breaks = np.flatnonzero(~inside_table[buf])
        buf = buf[:int(breaks[0])] if len(breaks) else buf
        roll = Rolling(buf)
        if at == start:
            heads = [roll.of(0, min(len(buf), k)) for k in prefixes]
        total = (total + int(roll.of(0, len(buf))) * pow(_R, at - start, 2**64)) % 2**64
        at += len(buf)
        if len(breaks):
            break
    h = np.array([total, *heads], dtype=U)
    with np.errstate(over="ignore"):
        return at, mix(h + np.array([at - start, *[1000 + k for k in prefixes]], dtype=U))


def word_hashes(offsets, data, letters=False, prefixes=()):
    """(text number, hash) of every word of the texts, in order.

    With ``prefixes`` the hashes are a matrix: of the word, then of its
    first bytes of each of these numbers (of all where it is shorter).

    ASCII letters are lower-cased.  Words are runs without ASCII white
    space or, with ``letters``, runs of ASCII letters, digits and bytes
    of other characters.
    """
    inside_table = _LETTER if letters else ~_BLANK
    base, end = int(offsets[0]), int(offsets[-1])
    texts, hashes = [], []
    at = base
    while at < end:
        stop = min(at + CHUNK, end)
        buf = _LOWER[data[at:stop]]
        inside = inside_table[buf]
        if stop < end and inside[-1] and inside_table[_LOWER[data[stop]]]:
            # Do not cut a word: stop behind the last break, if there is one.
            breaks = np.flatnonzero(~inside)
            bounds = offsets[(offsets > at) & (offsets < stop)] - at
            last = max([int(breaks[-1]) + 1] if len(breaks) else [0])
            last = max(last, int(bounds[-1]) if len(bounds) else 0)
            if not last:  # one word fills the whole piece
                bound = int(offsets[np.searchsorted(offsets, at, side="right")])
                stop, h = _long_word(data, at, bound, inside_table, prefixes)
                texts.append(np.searchsorted(offsets, [at], side="right") - 1)
                hashes.append(h[None, :] if prefixes else h)
                at = stop
                continue
            stop = at + last
            buf, inside = buf[:last], inside[:last]
        first = np.zeros(len(buf) + 1, dtype=bool)
        cuts = offsets[(offsets >= at) & (offsets <= stop)] - at
        first[cuts] = True
        shifted = np.empty_like(inside)
        shifted[0], shifted[1:] = False, inside[:-1]
        lo = np.flatnonzero(inside & (~shifted | first[:-1]))
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        hi = np.flatnonzero(inside & (~after | first[1:])) + 1
        roll = Rolling(buf)
        with np.errstate(over="ignore"):
            h = [mix(roll.of(lo, hi) + (hi - lo).astype(U))]
            h += [mix(roll.of(lo, np.minimum(hi, lo + k)) + U(1000 + k)) for k in prefixes]
        hashes.append(np.stack(h, axis=1) if prefixes else h[0])
        texts.append(np.searchsorted(offsets, lo + at, side="right") - 1)
        at = stop
    if not hashes:
        none = np.zeros((0, 1 + len(prefixes)) if prefixes else 0, dtype=U)
        return np.zeros(0, dtype=np.int64), none
    return np.concatenate(texts), np.concatenate(hashes)
