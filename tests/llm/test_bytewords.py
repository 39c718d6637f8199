from __future__ import annotations

import numpy as np
import pyarrow as pa

from clickledger.llm import bytewords


def test_words_that_share_a_hash_stay_apart(monkeypatch):
    """The first hash is cut to a few values, so that different words meet in it."""
    whole = bytewords.hashed

    def cut(data, starts, ends):
        one, two = whole(data, starts, ends)
        return one % np.uint64(3), two

    texts = pa.array([" ".join(f"w{i * i % 50}" for i in range(400)), "w1 w4 other", None, ""])
    expected = bytewords.byte_words(texts)
    monkeypatch.setattr(bytewords, "hashed", cut)
    got = bytewords.byte_words(texts)
    assert got.codes.tolist() == expected.codes.tolist()
    assert got.first.tolist() == expected.first.tolist()
    assert got.distinct() == expected.distinct() and len(got.hashes) == len(expected.hashes)
