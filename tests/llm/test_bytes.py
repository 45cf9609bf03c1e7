"""Word hashes over texts and words longer than a piece."""

import re

import numpy as np
import pytest

from promoscope.llm import _bytes


@pytest.mark.parametrize("chunk", [7, 16, 64])
def test_pieces_never_cut_words(monkeypatch, chunk):
    texts = [b"a bb " + b"x" * 100 + b" ccc", b"", b"y" * 63, b"y" * 64, b" " * 40 + b"z" * 30 + b"\n", b"Q" * 200,
             b"q" * 200, b"a bb"]
    offsets = np.cumsum([3] + [len(t) for t in texts])
    data = np.frombuffer(b"###" + b"".join(texts) + b"tail", np.uint8)
    whole = _bytes.word_hashes(offsets, data, prefixes=(4, 5))
    plain = _bytes.word_hashes(offsets, data)
    monkeypatch.setattr(_bytes, "CHUNK", chunk)
    for got, want in zip(_bytes.word_hashes(offsets, data, prefixes=(4, 5)), whole):
        assert (got == want).all()
    text, h = _bytes.word_hashes(offsets, data)
    assert (text == plain[0]).all() and (h == plain[1]).all() and (h == whole[1][:, 0]).all()
    words = [(i, w.lower()) for i, t in enumerate(texts) for w in re.findall(rb"[^\x20\x09-\x0D]+", t)]
    assert text.tolist() == [i for i, _ in words]
    assert len(set(h.tolist())) == len({w for _, w in words})
