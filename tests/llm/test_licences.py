import hashlib
import textwrap
from pathlib import Path

from chartframes.llm import licences
from tests.llm.odd import against_duckdb


def test_query_equals_duckdb(spark):
    rows = against_duckdb(spark, "op10_license_scan", "/root/testdata/sf0.01")
    assert any(r[3] for r in rows)


def test_canonical_forms(spark):
    mit = next(t for n, t in licences.LICENCES if n == "MIT")  # without a title
    other = "MIT License\n\n" + "Copyright (c) 2020 Somebody\n(c) 2021 Else\n# All rights reserved.\n\n" + mit.upper().replace(" ", "  ").replace("\n", "\r\n").replace("SUBLICENSE", "sub-licence")
    rows = [
        (1, other, "x"), (2, mit + " more", "x"), (3, None, None), (4, "", "x"), (5, "Copyright 2020 A\n", "x"), (6, "word\nReleased under the M.I.T. Licence\n * Released under the “MIT” License —\n", "x"),
        (7, "released under the mit license", "x"), (7, "released under the mit license", "x"), (None, "Released under the MIT License.", "x"), (8, "Copyright notice here\nlicence " * 40_000, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = licences.scan(df, licences.known_licences(spark)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    found = sorted(((r.doc_id, r.license, r.notices, r.n_notices) for r in got), key=str)
    assert found == sorted([
        (1, "MIT", "", 0), (2, None, "", 0), (3, None, "", 0), (4, None, "", 0), (5, None, "", 0), (6, None, "MIT-notice", 1),
        (7, "MIT-notice", "MIT-notice", 1), (7, "MIT-notice", "MIT-notice", 1), (None, "MIT-notice", "MIT-notice", 1), (8, None, "", 0),
    ], key=str)
    assert {r.text_sha256 for r in got if r.doc_id in (3, 4, 5)} == {empty}
    none = licences.known_licences(spark).limit(0)
    assert {(r.license, r.notices) for r in licences.scan(df, none).collect()} == {(None, "")}
    twice = spark.createDataFrame([("b", "word"), ("a", "WORD!"), ("c", None), ("d", "(c) 2020"), (None, "word")], "license_id string, text string")
    assert [(r.doc_id, r.notices) for r in licences.scan(df, twice).where("n_notices > 0").collect()] == [(6, "a")]
    assert licences.scan(df.limit(0), twice).collect() == []


def scanned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.license, r.notices, r.n_notices) for r in licences.scan(df, licences.known_licences(spark)).orderBy("doc_id").collect()]


def wrapped(text, mark=""):
    return "\n".join(mark + line for part in text.split("\n") for line in (textwrap.wrap(part, 60) or [""]))


def test_titled_and_wrapped_texts(spark):
    known = {n: t for n, t in reversed(licences.LICENCES)}
    titles = {"MIT": "MIT License", "ISC": "ISC License", "Zlib": "zlib License", "BSD-3-Clause": "BSD 3-Clause License"}
    texts = [f"{title}\n\nCopyright (c) 2020 Somebody\n\n{wrapped(known[n])}\n" for n, title in titles.items()]
    assert [r[0] for r in scanned(spark, texts)] == list(titles)


def test_whole_texts_and_published_notices(spark):
    folder = Path(licences.__file__).parent / "texts"
    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"]
    assert [r[0] for r in scanned(spark, [(folder / f"{n}.txt").read_text() for n in names])] == names
    apache = """# Copyright 2020 Somebody
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
"""
    gpl = """/* This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int x;
"""
    found = scanned(spark, [apache, gpl.replace(" */\n", " */\n\n"), "// SPDX-License-Identifier: GPL-2.0-only\nint x;"])
    assert found == [(None, "Apache-2.0-notice", 1), (None, "GPL-3.0-notice", 1), (None, "GPL-2.0-notice", 1)]
