from __future__ import annotations

import re

import duckdb
from pyspark.sql import functions as F

from dumpwise.llm.licenses import ALL_TAGS, RULES, TRIGGERS, WORDS, oracle, scan_licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal.
The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING."""
DOCS = [
    (1, "Some prose.\nReleased under the MIT License."), (2, "x\nThis work is licensed under the GNU General Public License, version 3."), (3, "Licensed under CC BY-NC 4.0."),
    (4, "Y!! Z!!\nLicensed under the Apache License, Version 2.0."), (5, MIT), (6, None), (7, ""), (8, "The licence question. Nothing here."), (9, MIT + "\n\nLicensed under the Apache License, Version 2.0. And MIT"),
    (10, "You may obtain a copy of the License at"), (1, "Some prose.\nReleased under the MIT License."), (11, "w " * 40_000 + ". Released under the MIT License. " + "v " * 40_000), (12, "19.3.1.7\nReleased under the MIT License"),
]


def test_rules_use_known_sentences_and_every_sentence_triggers():
    assert {i for _, _, ids in RULES for i in ids} == {*WORDS.values(), *(f"spdx-{t}" for t in ALL_TAGS)}
    assert all(re.search("|".join(TRIGGERS), w) for w in WORDS)


def test_licenses(spark):
    got = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame([(*d, "x") for d in DOCS], "doc_id long, text string, sentences string")).collect()}
    names = {k: r["licenses"] for k, r in got.items()}
    assert names == {1: "MIT", 2: "GPL-3.0", 3: "CC-BY-NC-4.0", 4: "Apache-2.0", 5: "MIT", 6: "", 7: "", 8: "", 9: "MIT,Apache-2.0", 10: "", 11: "MIT", 12: "MIT"}
    assert got[5]["sentences"] == "<mit-grant><mit-notice><as-is>" and got[5]["n_unmatched"] == 0
    assert got[10]["n_unmatched"] == 1


def test_sql_twin_agrees_on_edge_cases(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", DOCS)
    got = sorted(map(tuple, scan_licenses(spark.createDataFrame(DOCS, "doc_id long, text string")).collect()))
    assert got == sorted(con.sql(oracle()).fetchall())


def test_empty(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


FULL_MIT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""


def scan(spark, texts):
    rows = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    return [(r["sentences"], r["licenses"], r["kinds"], r["n_unmatched"]) for r in rows]


def test_every_sentence_of_a_sentence_counts(spark):
    lines = FULL_MIT.split("\n")
    forms = [FULL_MIT, "/*\n" + "\n".join(" * " + x for x in lines) + "\n */", "\n".join("# " + x for x in lines), "\n".join("// " + x for x in lines), " ".join(lines)]
    whole = ("<mit-grant><mit-notice><as-is><no-liability>", "MIT", "permissive", 0)
    assert scan(spark, forms) == [whole] * len(forms)
    listed = ["Licensed under the MIT license and CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0, the MIT License or CC BY 4.0", "Licensed under CC BY 4.0 and released under the MIT license"]
    assert [x[1] for x in scan(spark, listed)] == ["MIT,CC-BY-NC-4.0", "MIT,Apache-2.0,CC-BY-4.0", "MIT,CC-BY-4.0"]


def test_known_words_that_overlap_are_taken_alike():
    """Where one ends with the beginning of another, the left one is the longer: from left to right and longest first agree."""
    for a in WORDS:
        for b in WORDS:
            x, y = a.split(), b.split()
            assert len(a) >= len(b) or not any(x[-k:] == y[:k] for k in range(1, min(len(x), len(y)))), (a, b)


GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {0} as published by
the Free Software Foundation, either version {1} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {0} for more details.

You should have received a copy of the GNU {0}
along with this program.  If not, see the web."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, ARE DISCLAIMED."""
THIRD = """3. Neither the name of the holder nor the names of its contributors may be used to endorse
   or promote products derived from this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO IT."""
FOUND = [  # text, licences, kinds
    (GPL.format("Affero General Public License", 3), "AGPL-3.0", "copyleft"), (GPL.format("Lesser General Public License", "2.1"), "LGPL-2.1", "copyleft"),
    (GPL.format("General Public License", 2), "GPL-2.0", "copyleft"), ("MIT License\n\nCopyright (c) 2020 A", "MIT", "permissive"), (ISC, "ISC", "permissive"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense", "permissive"), ("Creative Commons Attribution 4.0", "CC-BY-4.0", "permissive"),
    ("This work: Creative Commons Attribution-NonCommercial 4.0 International.", "CC-BY-NC-4.0", "restricted"), ("licensed under CC BY-NC-SA 3.0 by X", "CC-BY-NC-SA-3.0", "restricted"),
    ("Attribution: Creative Commons Attribution-Non Commercial-No Derivatives 4.0", "CC-BY-NC-ND-4.0", "restricted"),
    ("// SPDX-License-Identifier: GPL-2.0-only\nint main;", "GPL-2.0", "copyleft"), ("# SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause", "permissive"),
    ("/* SPDX-License-Identifier: AGPL-3.0-or-later */", "AGPL-3.0", "copyleft"), ("SPDX-License-Identifier: MIT-0", "MIT-0", "permissive"),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0+ WITH Classpath-exception-2.0 -->", "MIT,Apache-2.0,GPL-2.0", "copyleft,permissive"),
    (BSD.format(""), "BSD-2-Clause", "permissive"), (BSD.format(THIRD), "BSD-3-Clause", "permissive"), ("GPLv3 code", "GPL-3.0", "copyleft"),
    ("You can use it under the Eclipse Public License 2.0 only", "EPL-2.0", "copyleft"),
]
UNKNOWN = [  # licence-like, but nothing known: must not look clean
    ("This code is licensed under the Acme Source Agreement.", 1), ("SPDX-License-Identifier: LicenseRef-Acme OR MIT", 1), ("Attribution-NonCommercial 4.0, Creative Commons", 1),
    ("Strictly for non commercial use. Proprietary code.", 2), ("GNU General Public License applies", 1), ("The licence question. Nothing here. Copyright law and human rights.", 0),
]


def test_common_licences_and_unknown_ones(spark):
    got = scan(spark, [t for t, *_ in FOUND])
    assert [(x[1], x[2], x[3]) for x in got] == [(licences, kinds, 0) for _, licences, kinds in FOUND]
    got = scan(spark, [t for t, _ in UNKNOWN])
    assert [x[3] for x in got] == [n for _, n in UNKNOWN] and [x[1] for x in got] == ["", "MIT", "", "", "", ""]


def test_sql_twin_agrees_on_whole_licences(spark):
    lines = FULL_MIT.split("\n")
    texts = [t for t, *_ in FOUND] + [t for t, _ in UNKNOWN] + ["\n".join(f"{sign} {x}" for x in lines) for sign in ("#", "//", " *", "--", ";")]
    texts += [" ".join(t.split()) for t, *_ in FOUND] + ["Licensed under the MIT license and CC BY 4.0", "MIT License MIT License mit license", FULL_MIT + "\n\n" + ISC + "\n\n" + BSD.format(THIRD), None]
    rows = list(enumerate(texts))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = sorted(map(tuple, scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted(con.sql(oracle()).fetchall())


def test_every_kind_of_licence_line_in_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").where(F.rlike("text", F.lit("(?i)licen[sc]ed? |all rights reserved")))
    rows = scan_licenses(docs).collect()
    assert rows and {r["licenses"] for r in rows} >= {"All-Rights-Reserved"}
    assert all(r["licenses"] and not r["n_unmatched"] for r in rows)
    assert scan(spark, ["x\nAll rights reserved.", "Copyright 2020 A. All Rights Reserved"]) == [("<all-rights>", "All-Rights-Reserved", "restricted", 0)] * 2
