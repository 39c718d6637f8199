from __future__ import annotations

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clickledger.llm import alignment
from clickledger.llm.alignment import align, common_ends, gallop, grouped, linked_pairs, Tokens
from small import SMALL, make_docs  # noqa: F401

PATH_A, PATH_B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def byte_alphabet():
    """The public table of byte-level vocabularies, spelled by its own rule."""
    plain = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    out, extra = {}, 0
    for b in range(256):
        if b in plain:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


def brute(docs):
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    names = {i: t for t, i in json.load(open(PATH_A, encoding="utf-8"))["model"]["vocab"].items()}
    alphabet = byte_alphabet()

    def bytes_b(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    aligned = []
    for _, text in docs:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        parts_a = [bytes(alphabet[c] for c in names[i]) for i in ids_a]
        parts_b = [bytes_b(i) for i in ids_b]
        if not text or b"".join(parts_a) != (" " + text).encode() or b"".join(parts_b) != (" " + text).encode():
            aligned.append(([], [], []))
            continue
        cuts_a = dict(zip(np.cumsum([len(p) for p in parts_a]).tolist(), range(1, len(ids_a) + 1)))
        cuts_b = dict(zip(np.cumsum([len(p) for p in parts_b]).tolist(), range(1, len(ids_b) + 1)))
        groups, at = [], (0, 0)
        for end in sorted(set(cuts_a) & set(cuts_b)):
            groups.append((ids_a[at[0] : cuts_a[end]], ids_b[at[1] : cuts_b[end]]))
            at = cuts_a[end], cuts_b[end]
        aligned.append((ids_a, ids_b, groups))
    links = [Counter((x, y) for one, two in groups for x in one for y in two) for *_, groups in aligned]
    held = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    rows = []
    for (i, _), (ids_a, ids_b, groups), c in zip(docs, aligned, links):
        line = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, two)) for one, two in groups)
        rows.append(
            (
                i, len(ids_a), len(ids_b), len(groups), sum(c.values()), sum(n for p, n in c.items() if held[p] == best[p[0]]),
                sum(n * held[p] for p, n in c.items()), hashlib.sha256(line.encode()).hexdigest() if ids_a else "",
            )
        )
    return sorted(rows, key=repr)


DOCS = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "Hello world, hello <|endoftext|> and </s> <s> <unk>."), (6, "  two  spaces\n\n\ttabs \r\n"),
    (7, "naïve Ünïcode — “quotes” … ½ ²"), (8, "漢字かな交じり文 текст اردو"), (9, "under▁score piece mark"), (10, " nbsp\u0085next line﻿"),
    (11, "é combining \U0001f600\U0001f468‍\U0001f469 emoji"), (12, "\x00\x01\x1c\x1f control"), (13, "-" * 3000), (14, "x" * 4000 + " y"),
    (15, "same"), (15, "same"), (None, "no id here"), (16, "don't we'll I'M 12345 6.7%"), (17, "<0x41> bytes <0x0A>"), (18, "\n" * 500 + "é" * 500),
    (19, "ſſ ﬁne Ⅷ ①"), (20, "à́" * 300),
]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_brute_force_on_the_smallest_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert got(align(docs, PATH_A, PATH_B)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_edge_cases(make_docs):
    docs = make_docs(DOCS).selectExpr("*", "'x' AS block", "1 AS part", "2 AS pair", "3 AS n_a").repartition(3)
    assert got(align(docs, PATH_A, PATH_B)) == brute(DOCS)


def test_empty_table(make_docs):
    assert align(make_docs([]), PATH_A, PATH_B).collect() == []


def test_gallop_finds_what_bisection_finds():
    rnd = np.random.default_rng(5)
    for _ in range(30):
        lists = [np.sort(rnd.integers(0, 3000, rnd.integers(1, 400))) for _ in range(5)]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        of = rnd.integers(0, 5, 300)
        wanted, low, high = rnd.integers(-5, 3100, 300), bounds[of], bounds[of + 1]
        start = rnd.integers(low - 2, high + 2)
        expect = [low[i] + np.searchsorted(lists[of[i]], wanted[i]) for i in range(300)]
        assert gallop(wanted, start, low, high, np.concatenate(lists)).tolist() == expect


@pytest.mark.parametrize("wide", [alignment.WIDE, 2])
def test_groups_of_random_cuts(wide):
    rnd = random.Random(2)
    for _ in range(50):
        lengths = [rnd.randrange(0, 60) for _ in range(6)]
        cuts = []
        for _ in range(2):
            cuts.append([sorted({n, *(rnd.randrange(1, n + 1) for _ in range(rnd.randrange(n + 1)))}) if n else [] for n in lengths])
        one, two = (
            Tokens(np.arange(sum(map(len, c))) % 7, np.cumsum([0, *map(len, c)]), np.array([e for part in c for e in part], np.int64))
            for c in cuts
        )
        at_a, at_b = common_ends(one, two)
        assert [(one.ends[i], two.ends[j]) for i, j in zip(at_a, at_b)] == [(e, e) for x, y in zip(*cuts) for e in sorted({*x} & {*y})]
        groups = grouped(one, two)
        assert (groups.a_to - groups.a_from).sum() == len(one.ids) and (groups.b_to - groups.b_from).sum() == len(two.ids)
        text, pair, links = linked_pairs(one, two, groups, 7, 7, wide)
        expect = Counter()
        for t, a0, a1, b0, b1 in zip(groups.text, groups.a_from, groups.a_to, groups.b_from, groups.b_to):
            expect.update((t, x * 7 + y) for x in one.ids[a0:a1] for y in two.ids[b0:b1])
        assert dict(zip(zip(text, pair), links)) == expect


def test_plain_texts_have_the_ids_of_the_library():
    side = alignment.sides(PATH_A, PATH_B)[0]
    texts = [" " + t for _, t in DOCS if t]
    assert side.encode(texts) == [e.ids for e in side.tokenizer.encode_batch(texts, add_special_tokens=False)]
