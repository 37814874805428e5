"""Declared links and licence declarations, in Spark and in the queries' SQL."""

from __future__ import annotations

import duckdb
import pytest

from forumlens.llm import licences, url_aliases
from forumlens.llm.queries import ORACLES

CANON, MOVED = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'

LINKS = [  # url of the page, its html, addresses that it names
    ("http://A.com/x/y?q#f", CANON.format("/fr/1"), ["A.com/fr/1"]),
    ("http://a.com/x/y?q", CANON.format("//B.com/de/1"), ["B.com/de/1"]),
    ("http://a.com/x/y?q", CANON.format("z?p=http://c.com/"), ["a.com/x/z?p=http://c.com/"]),
    ("http://a.com/x/y?q", CANON.format("../z/./w/.."), ["a.com/z/"]),
    ("http://a.com/x/y?q", CANON.format("../../../z"), ["a.com/z"]),
    ("http://a.com", CANON.format("z"), ["a.com/z"]),
    ("http://a.com/x/y?q", MOVED.format("?r=1"), ["a.com/x/y?r=1"]),
    ("http://a.com/x", "<LINK href='/1' rel='alternate canonical'>" + CANON.format("/2") + MOVED.format("/3"), ["a.com/1", "a.com/2", "a.com/3"]),
    ("http://a.com/x", "<link rel=canonical href=/1>\n<link\nrel='canonical'\nhref=' /2 '/>" + MOVED.format("/3") * 2, ["a.com/1", "a.com/2", "a.com/3", "a.com/3"]),
    ("http://a.com/x", CANON.format("mailto:a") + CANON.format("#f") + CANON.format("") + "<link rel=noncanonical href=/1>", []),
    ("http://a.com/x", "<link rel='canonical-not' href=/1><a rel='canonical' href=/2></a><link rel=canonical>", []),
    ("http://a.com/x", CANON.format("/1?a=1&amp;b=2"), ["a.com/1?a=1&b=2"]),
    ("no scheme", CANON.format("/1"), []), (None, CANON.format("/1"), []), ("http://a.com/", None, []), ("http://a.com/", "", []),
]


def _sql(name: str, table: str, df):
    con = duckdb.connect()
    con.register("given", df.toArrow())
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM given")
    return con.execute(ORACLES[name]).fetchall()


@pytest.mark.parametrize("case", range(len(LINKS)))
def test_resolved(spark, case):
    url, html, wanted = LINKS[case]
    df = spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")
    got = url_aliases.declared_links(df).collect()
    lower = [w.split("/")[0].lower() + w[len(w.split("/")[0]) :] for w in wanted]
    assert sorted(r["b"] for r in got) == sorted(lower)


def test_chains_and_conflicts(spark):
    rules = spark.createDataFrame(url_aliases.RULES, "host string, path string, verdict string")
    pages = [(k, url, html) for k, (url, html, _) in enumerate(LINKS)] + [
        (100, "http://p.com/one", CANON.format("/two")), (101, "http://p.com/two", MOVED.format("three")),
        (102, "http://p.com/three", CANON.format("//q.com/de/9")),  # blocked along a chain
        (103, "http://r.net/a", "<link rel='alternate canonical' href='//q.com/de/9'>" + CANON.format("//q.com/fr/1")),
        (104, "http://s.net/a", CANON.format("//q.com/de/8")), (104, "http://s.net/a", CANON.format("//q.com/de/8")),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    columns = ["page_id", "host", "path", "rule", "verdict", "alias_of"]
    got = [tuple(r[c] for c in columns) for r in url_aliases.judge(df, rules).collect()]
    assert sorted(got, key=str) == sorted(_sql("op1_url_aliases", "pages", df), key=str)
    verdicts = {r[0]: r[4] for r in got}
    assert [verdicts[k] for k in range(100, 105)] == ["allow"] * 4 + ["block"]
    without = df.filter("page_id <> 103")  # the allow went over the shared address
    verdicts = {r["page_id"]: r["verdict"] for r in url_aliases.judge(without, rules).collect()}
    assert [verdicts[k] for k in (100, 101, 102, 104)] == ["block"] * 4


LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
BSD = """Copyright (c) 2020, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""

TEXTS = [
    ("This project is licensed under the MIT License.", ["MIT"]),
    ("This project is licensed under the MIT License - see the LICENSE.md file for details.", ["MIT"]),
    ("SPDX-License-Identifier: GPL-3.0-or-later", ["GPL-3.0-or-later"]), ("# SPDX-License-Identifier: BSD-3-Clause\nx", ["BSD-3-Clause"]),
    ("/* SPDX-License-Identifier: ISC */", ["ISC"]), ("SPDX-License-Identifier: (MIT OR Apache-2.0)", ["MIT", "Apache-2.0"]),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", ["GPL-2.0-only", "Classpath-exception-2.0"]),
    ("a\n\nMIT License\n\nb", ["MIT"]), ("Licensed under the\nMozilla Public License, version 2.0", ["MPL-2.0"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If", ["MPL-2.0"]),
    ("                 Apache License\n           Version 2.0, January 2004\n  http://x", ["Apache-2.0"]),
    ("GNU LESSER GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n", ["LGPL-3.0-only"]), (LGPL, ["LGPL-2.1-or-later"]),
    ("GNU Affero General Public License v3.0 or later", ["AGPL-3.0-or-later"]), ("Licensed under GPLv3", ["GPL-3.0-only"]),
    (BSD, ["BSD-2-Clause"]), (BSD + BSD3, ["BSD-3-Clause"]), (BSD.replace("All rights reserved.", ""), ["BSD-2-Clause"]), (ISC, ["ISC"]),
    ("Released under the Unlicense.", ["Unlicense"]), ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", ["CC-BY-NC-4.0"]),
    ("SPDX-License-Identifier: CC-BY-ND-4.0", ["CC-BY-ND-4.0"]), ("License: MIT", ["MIT"]),
    ("I think the MIT License is short.", []), ("SPDX-License-Identifier: No-Such-1.0", []), ("submit or commit", []),
    ("the", []), ("MIT\n\nISC\nthe MIT", []), ("", []), (None, []), ("MIT License " * 3, []), ("x" * 200_000 + "\nMIT License", ["MIT"]),
]


def test_licence_declarations(spark):
    more = [(t.replace("\n", "\r\n") if t else t, w) for t, w in TEXTS]
    every = TEXTS + more
    df = spark.createDataFrame([(k, t, "x") for k, (t, _) in enumerate(every)], "doc_id long, text string, licences string")
    got = {r["doc_id"]: r for r in licences.recognise(df).collect()}
    for k, (text, wanted) in enumerate(every):
        assert set(got[k]["licences"]) == set(wanted), (text, got[k])
    rows = [(k, *[",".join(r[c]) for c in ("identifiers", "licences", "unknown")]) for k, r in got.items()]
    assert sorted(rows) == sorted(_sql("op6_licences", "documents", df))
