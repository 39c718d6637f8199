from __future__ import annotations

import re
import textwrap

import duckdb
import pandas as pd

from clickledger.llm.licence_texts import LICENCES
from clickledger.llm.licences import known_licences, known_texts, scan
from clickledger.llm.oracle import ORACLE
from clickledger.llm.queries import op5_canonical_digests
from small import SMALL, make_docs  # noqa: F401


def test_every_known_text_is_found_however_it_is_set(spark, make_docs):
    rows, want = [], {}
    for i, (name, title, body) in enumerate(LICENCES):
        forms = [
            body,
            f"{title}\n\nCopyright (c) 2020 A. Person\n(C) B, 2021\n  © C\nAll rights reserved.\n\n{body}",
            body.upper().replace("\n", "\r\n  * "),
            body.replace('"', "“").replace("license", "licence").replace("sublicense", "sub-license"),
        ]
        for k, form in enumerate(forms):
            rows.append((10 * i + k, form))
            want[10 * i + k] = name
        rows += [(10 * i + 8, body + " And more."), (10 * i + 9, body[:-20])]
        want |= {10 * i + 8: None, 10 * i + 9: None}
    assert {r.doc_id: r.license_id for r in scan(make_docs(rows), known_licences(spark)).collect()} == want


def test_edge_cases(spark, make_docs):
    mit = LICENCES[0][2]
    docs = make_docs([(1, None), (2, ""), (3, " .,\n"), (None, mit), (4, mit), (4, mit)]).selectExpr("*", "'x' AS license_id")
    known = known_licences(spark).unionAll(spark.createDataFrame([("A", mit), ("E", ""), ("N", None)], "license_id string, text string"))
    rows = [(r.doc_id, r.license_id) for r in scan(docs, known).collect()]
    assert sorted(rows, key=str) == [(1, None), (2, None), (3, None), (4, "A"), (4, "A"), (None, "A")]
    assert scan(make_docs([]), known).collect() == []
    assert {r.license_id for r in scan(docs, known.limit(0)).collect()} == {None}


def wrapped(text, width):
    """The paragraphs of ``text`` set anew in lines of ``width``."""
    parts = [" ".join(p.split()) for p in re.split(r"\n[ \t]*\n", text)]
    return "\n\n".join(textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in parts)


def test_line_breaks_make_no_difference(spark, make_docs):
    known = [(r.license_id, r.text) for r in known_licences(spark).collect()]
    forms = [(name, form) for name, text in known for w in (*range(10, 110, 3), 10**6) for form in (wrapped(text, w), " \r\n".join(textwrap.wrap(text, w, break_long_words=False, break_on_hyphens=False)))]
    found = {r.doc_id: r.license_id for r in scan(make_docs((i, f) for i, (_, f) in enumerate(forms)), known_licences(spark)).collect()}
    assert [(found[i], forms[i][1][:200]) for i, (name, _) in enumerate(forms) if found[i] != name] == []


def test_only_lines_that_name_owners_go(spark, make_docs):
    isc = next(body for name, _, body in LICENCES if name == "ISC")
    usual = isc.replace("the above copyright notice", "the above\ncopyright notice")
    owned = [
        f"ISC License\n\nCopyright 2020 A\nCopyright The Authors of B\n\n{usual}",
        f"/*\n * Copyright © 2020 A. All rights reserved.\n */\n{usual}",
        f"{usual}\n\nCopyright (c) 2020 A\n(c) 2021 B\n",
    ]
    others = [
        usual.replace("copyright notice and this permission notice appear in all copies.", ""),
        usual.replace("\ncopyright", "\ncopyright (c) 2020 A\ncopyright"),
        f"Copyright notices must be printed in red.\n{isc}",
        f"All rights reserved. You may not copy this.\n{isc}",
    ]
    found = {r.doc_id: r.license_id for r in scan(make_docs(enumerate(owned + others)), known_licences(spark)).collect()}
    assert [found[i] for i in range(7)] == ["ISC"] * 3 + [None] * 4


def test_long_runs_are_no_trouble(spark, make_docs):
    rows = [(0, "\n" * 10**6), (1, "the " * 10**6 + "end"), (2, "\n# " * 10**6), (3, "© A\n\n" * 10**5), (4, "x\n" * 10**5 + "(c) 2020\n" * 10**5 + "x")]
    assert {r.license_id for r in scan(make_docs(rows), known_licences(spark)).collect()} == {None}


def test_common_long_licences_are_known(spark, make_docs):
    texts = dict(known_texts()[::-1])
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0"} <= set(texts)
    apache = texts["Apache-2.0"].replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 A. Person")
    mit = f"The MIT License (MIT)\n\nCopyright (c) 2020 A\n\n{texts['MIT']}"
    gpl = texts["GPL-3.0"].partition("How to Apply")[0]
    docs = make_docs(enumerate([apache, mit, gpl, texts["GPL-3.0"].replace("three years", "two years")]))
    found = {r.doc_id: r.license_id for r in scan(docs, known_licences(spark)).collect()}
    assert "2020 A. Person" in apache and found == {0: "Apache-2.0", 1: "MIT", 2: "GPL-3.0", 3: None}


def test_the_query_takes_known_texts(spark):
    text = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id = 1").first().text
    known = spark.createDataFrame([("own", text)], "license_id string, text string")
    assert 1 in {r.doc_id for r in op5_canonical_digests(spark, SMALL, known).filter("license_id = 'own'").collect()}


def test_long_owners_and_comment_edges_are_no_limit(spark, make_docs):
    texts = dict(known_texts()[::-1])
    owned = texts["Apache-2.0"].replace("[yyyy]", "2020").replace("[name of copyright owner]", "A. Person and " * 40)
    docs = make_docs(enumerate([owned, f"{'#' * 300} Copyright (c) 2020 A\n{texts['MIT']}", f"{'* ' * 300}\n\n{texts['ISC']}"]))
    found = {r.doc_id: r.license_id for r in scan(docs, known_licences(spark)).collect()}
    assert "Person" in owned and found == {0: "Apache-2.0", 1: "MIT", 2: "ISC"}


def test_the_sql_states_the_operators_rule(spark, make_docs):
    texts = dict(known_texts()[::-1])
    mit, isc = texts["MIT"], texts["ISC"]
    forms = [text for _, text in known_texts()] + [wrapped(text, w) for _, text in known_texts() for w in (20, 43, 71)]
    forms += [
        isc.replace("copyright notice", "\ncopyright notice"),
        f"/*\n * Copyright © 2020 A. All rights reserved.\n */\n{isc}",
        f"{isc}\n\nCopyright (c) 2020 A\n(c) 2021 B\n",
        f"Copyright notices must be printed in red.\n{isc}",
        f"copyright and x\ncopyright or\ncopyright (c) 3\nmit\ncopyright x\n{mit}",
        f"MIT License:\n\"mit\"\nCopyright B\n{mit}",
        f"\r\nCopyright x\r\n\r\n{mit}\r\n\r\n(c) x\r\n",
        f"{'#' * 300} Copyright (c) 2020 A\n{mit}",
        texts["Apache-2.0"].replace("[name of copyright owner]", "A " * 260).replace("[yyyy]", "2020"),
        "© A\n\n" * 50, "\n" * 100, "x\n" * 10 + "(c) 2020\n" * 10 + "x", "(c) only", "copyright", None, "",
    ]
    connection = duckdb.connect()
    connection.register("documents", pd.DataFrame({"doc_id": range(len(forms)), "text": pd.array(forms, "string")}))
    want = connection.execute(f"SELECT doc_id, license_digest, license_id FROM ({ORACLE['op5_canonical_digests']})").fetchall()
    got = [tuple(r) for r in scan(make_docs(enumerate(forms)), known_licences(spark)).collect()]
    assert sorted(got) == sorted(want) and sum(r[2] is not None for r in got) > 80
