"""Licence scan against a plain version that reads lines one by one."""

import random
import re

import brute
import pytest
from tessera.llm import license_scan as ls
from tessera.llm.queries import QUERIES

MPL = """This Source Code Form is subject to the terms of the Mozilla Public License,
v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one
at https://mozilla.org/MPL/2.0/."""
ISC = """Copyright (c) 2020 Some One

Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS"."""
APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def commented(text, mark):
    if mark == "*":
        return "/*\n" + "\n".join(f" * {x}".rstrip() for x in text.split("\n")) + "\n */"
    return "\n".join(f"{mark} {x}".rstrip() for x in text.split("\n")) if mark else text


def plain(text):
    """(identifiers, licences) by going through lines and characters, without the scan's patterns."""
    lines = []
    for line in (text or "").split("\n"):
        rest = line.lstrip(" \t")
        for mark in ("<!--", "/*", "//", "--", "*", "#", ";", "%"):
            if rest.startswith(mark):
                rest = rest[len(mark):]
                while mark != "<!--" and rest[:1] == mark[-1]:
                    rest = rest[1:]
                if mark in ("*",) and rest[:1] == "/":
                    rest = rest[1:]
                line = rest.lstrip(" \t")
                break
        lines.append(line)

    def parts(joined):
        out, now = [], ""
        for i, c in enumerate(joined):
            now += c
            nxt = joined[i + 1:i + 2]
            if c in ".!?" and (nxt == "" or nxt in " \t\n\v\f\r"):
                ahead = joined[i + 1:].lstrip(" \t\n")
                if c == "." and re.search(r"[^a-z0-9]v\.$", now.lower()) and ahead[:1].isdigit():
                    now = now[:-1]
                    continue
                out.append(now)
                now = ""
        return [*out, now]

    def ids(pieces):
        said = (" ".join(re.findall("[a-z0-9]+", p.lower())) for p in pieces)
        return [ls.SENTENCES[s] for s in said if s in ls.SENTENCES]

    whole = "\n".join(lines)
    by_line = ids([p for x in re.split(r"(?<![.!?])\n|(?<=[.!?])\n", whole) for p in parts(x)]) if "v.\n" not in whole.lower() else None
    blocks, now = [], []
    for x in lines:
        if x.strip(" \t"):
            now.append(x)
        else:
            blocks.append("\n".join(now))
            now = []
    joined = ids([p for b in [*blocks, "\n".join(now)] for p in parts(b)])

    def holds(found, rule):
        rest = iter(found)
        return all(x in rest for x in rule)

    def inside(a, b):
        rest = iter(b)
        return a != b and all(x in rest for x in a)

    hits = [r for r in ls.RULES if holds(by_line or [], r[2]) or holds(joined, r[2])]
    kept = [f"{n}:{form}" for n, form, r in hits if not any(inside(r, o[2]) for o in hits)]
    best = joined if len(joined) > len(by_line or []) else by_line or []
    return ",".join(best), ",".join(kept)


@pytest.mark.parametrize("mark", ["", "#", "//", "*", ";", "--", "%"])
def test_headers_in_comments(spark, mark):
    texts = [commented(t, mark) + "\n\ncode()\n" for t in (MPL, ISC, APACHE)] + [f"{mark or '#'} SPDX-License-Identifier: MIT\nint x;"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.licences, r.sentence_ids) for r in ls.scan(df).collect()}
    assert got[0][0] == "MPL-2.0:header" and got[1][0] == "ISC:text" and got[2][0] == "Apache-2.0:header" and got[3][0] == "MIT:tag"
    assert all(ids for _, ids in got.values())


def test_plain_version_on_mixed_texts(spark, sf):
    rng = random.Random(1)
    parts = [MPL.replace("License,\nv.", "License, v."), ISC, APACHE, "Released under the MIT License.", "All rights reserved", "some words here",
             "x = 1; y!", "SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under the Mozilla Public License, version 2.0.", "v. 3 of it."]
    texts = [None, ""] + [commented(rng.choice(["\n", "\n\n"]).join(rng.choices(parts, k=rng.randint(1, 5))), rng.choice(["", "#", "//", "*"]))
                          for _ in range(300)]
    texts += [r["text"] for r in brute.rows(sf, "documents")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.sentence_ids, r.licences) for r in ls.scan(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_empty_table_and_megabytes(spark):
    df = spark.createDataFrame([(1, "word " * 400_000 + "\nReleased under the MIT License.")], "doc_id long, text string")
    assert [r.licences for r in ls.scan(df).collect()] == ["MIT:notice"] and ls.scan(df.limit(0)).count() == 0


def test_query_matches_its_sql(spark, sf):
    import duckdb

    got = sorted(tuple(r) for r in QUERIES["op8_license"](spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(con.execute(ls.sql()).fetchall())
