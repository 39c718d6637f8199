from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickledger.llm import packing
from clickledger.llm.packing import pack
from clickledger.llm.queries import op2_best_fit_packing
from clickledger.llm.words_bpe import WordEncoder
from small import SMALL, make_docs  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(pieces, expected, capacity):
    """Every id in exactly one piece, sequences gapless and within capacity; returns their lengths."""
    docs, sequences = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        docs.setdefault(p.doc_id, []).append((p.start, ids, p.doc_tokens))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for doc_id, ids in expected.items():
        joined = []
        for start, part, total in sorted(docs.pop(doc_id)):
            assert start == len(joined) and total == len(ids)
            joined += part
        assert joined == ids
    assert not docs
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return [sum(n for _, n in parts) for parts in sequences.values()]


def test_smallest_documents_are_packed_whole(spark, whole):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(40)
    expected = {r.doc_id: whole(r.text) for r in docs.collect()}
    lengths = check(pack(docs, PATH, 2, 512).collect(), expected, 512)
    assert sum(512 - n for n in lengths) < 0.01 * sum(lengths) + 512
    query = op2_best_fit_packing(spark, SMALL).collect()
    assert {r.doc_id for r in query} == set(expected)
    for r in query:
        part = np.array(expected[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(expected[r.doc_id])


def test_edge_cases(make_docs, whole, spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    texts = {1: None, 2: "", 3: "word " * 5000, 4: "x" * 3000, 5: " \n", 6: "same", 7: "same"}
    docs = make_docs(texts.items()).selectExpr("*", "'a' AS ids", "1 AS offset").repartition(5)
    lengths = check(pack(docs, PATH, 2, 64).collect(), {k: whole(t) for k, t in texts.items()}, 64)
    assert sum(64 - n for n in lengths) < 64 + 0.05 * sum(lengths)
    assert pack(make_docs([]), PATH, 2).collect() == []
    twice = make_docs([(None, "a b"), (None, "a b"), (1, "c"), (1, "c")])
    assert sorted(r.doc_id or 0 for r in pack(twice, PATH, 2).collect()) == [0, 0, 1, 1]


def test_encoder_equals_the_tokenizer(whole):
    rnd = random.Random(5)
    odd = "aAzZ09 \n\t.,!'éÉßẞİıΣσ½ⅷ \u0085́日本🙂<|>#×÷»Ǆ"
    texts = ["".join(rnd.choice(odd) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    texts += ["<|endoftext|> it's IT'S we'll..., don't! x%. a». é× ×. ...", "a" * 2000, None]
    got = WordEncoder(PATH, 2).encode(pa.array(texts))
    for text, ids in zip(texts, got):
        assert ids.tolist() == whole(text), text


def test_words_are_remembered_for_two_generations(whole, monkeypatch):
    monkeypatch.setattr("clickledger.llm.words_bpe.CACHE", 20)
    small = WordEncoder(PATH, 2)
    learned = []
    learn = small._learn
    monkeypatch.setattr(small, "_learn", lambda chunks: (learned.extend(chunks), learn(chunks)))
    texts = [f"often again word{i} other{i} " + " ".join(f"w{i}x{k}" for k in range(4)) for i in range(30)]
    for text in texts:
        assert small.encode(pa.array([text, None, "often"]))[0].tolist() == whole(text)
        assert len(small.known) + len(small.older) <= 20 + 8
    assert learned.count(b"often") == 1 and learned.count(b"again") == 1
