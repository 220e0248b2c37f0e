"""Licence scans by sentence rules, in DataFrame operations only.

A text is cut into sentences, each is normalised (lower case, runs of other
characters than a-z and 0-9 as one blank) and looked up among known licence
sentences; the identifiers found, in order, are matched against ordered rules.
A rule matches if its identifiers occur in that order; a rule whose identifiers
are part of a longer matching rule is not reported beside it.

Comment marks at line starts go first, so a blank comment line is a blank line, and
the full stop of ``v. 2`` ends no sentence.  Sentences are taken twice, with line ends
as sentence ends and as blanks (but for blank lines), so wrapped licence texts and
notices on a line of their own are both found; ``sentence_ids`` are those of the reading
that finds more (the first if they are level).

Null and empty texts hold no licence, an empty table gives no row.  Rows are
independent, so repeated rows are alike; nothing is shuffled.  A long text is cut up
as a whole; other columns are not used.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised licence sentences and their identifiers.
SENTENCES = {
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "this project is licensed under the mit license": "mit-notice",
    "this software is released under the mit license": "mit-notice",
    "distributed under the mit license": "mit-notice",
    "mit license": "mit-title",
    "the mit license": "mit-title",
    "the mit license mit": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-condition",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "licensed under the apache license version 2 0": "apache-2-notice",
    "licensed under the apache license version 2 0 the license": "apache-2-header",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2-header",
    "you may not use this file except in compliance with the license": "apache-2-compliance",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache-2-link",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-2-basis",
    "see the license for the specific language governing permissions and limitations under the license": "apache-2-see",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1": "bsd-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "this work is licensed under the gnu general public license version 3": "gpl-3-notice",
    "licensed under the gnu general public license version 3": "gpl-3-notice",
    "licensed under the gnu general public license version 2": "gpl-2-notice",
    "this work is licensed under the gnu general public license version 2": "gpl-2-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-or-later-header",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2-or-later-header",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu general public license for more details": "gpl-see",
    "you should have received a copy of the gnu general public license along with this program": "gpl-copy",
    "licensed under the gnu lesser general public license version 3": "lgpl-3-notice",
    "licensed under the gnu affero general public license version 3": "agpl-3-notice",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2-header",
    "licensed under the mozilla public license version 2 0": "mpl-2-notice",
    "licensed under cc by 4 0": "cc-by-4-notice",
    "licensed under cc by sa 4 0": "cc-by-sa-4-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4-notice",
    "licensed under cc by nd 4 0": "cc-by-nd-4-notice",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa-4-notice",
    "licensed under cc by nc nd 4 0": "cc-by-nc-nd-4-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4-notice",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4-notice",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4-notice",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-any",
    "this work is dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
    "this software is provided as is without any express or implied warranty": "zlib-warranty",
    "in no event will the authors be held liable for any damages arising from the use of this software": "zlib-liability",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl-2-header",
    "distributed under the boost software license version 1 0": "bsl-1-notice",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl-3-or-later-header",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl-21-or-later-header",
    "see the gnu lesser general public license for more details": "lgpl-see",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl-3-or-later-header",
    "see the gnu affero general public license for more details": "agpl-see",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl-2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl-2-copy",
}

# Identifiers of one-line tags, by the words after "SPDX-License-Identifier".
TAGGED = ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
          "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later",
          "MPL-2.0", "EPL-2.0", "BSL-1.0", "Zlib", "Unlicense", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0")
SENTENCES |= {"spdx license identifier " + re.sub("[^a-z0-9]+", " ", x.lower()): f"spdx-{x.lower()}" for x in TAGGED}

# Licence, form, identifiers in order.
RULES = (
    ("MIT", "text", ("mit-grant", "mit-warranty", "mit-liability")),
    ("MIT", "notice", ("mit-notice",)),
    ("MIT", "title", ("mit-title",)),
    ("Apache-2.0", "header", ("apache-2-header", "apache-2-basis", "apache-2-see")),
    ("Apache-2.0", "short header", ("apache-2-header",)),
    ("Apache-2.0", "notice", ("apache-2-notice",)),
    ("BSD-3-Clause", "text", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", "text", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", "text", ("isc-grant",)),
    ("GPL-3.0-only", "notice", ("gpl-3-notice",)),
    ("GPL-2.0-only", "notice", ("gpl-2-notice",)),
    ("GPL-3.0-or-later", "header", ("gpl-3-or-later-header", "gpl-see")),
    ("GPL-2.0-or-later", "header", ("gpl-2-or-later-header", "gpl-see")),
    ("LGPL-3.0-only", "notice", ("lgpl-3-notice",)),
    ("AGPL-3.0-only", "notice", ("agpl-3-notice",)),
    ("MPL-2.0", "header", ("mpl-2-header",)),
    ("MPL-2.0", "notice", ("mpl-2-notice",)),
    ("CC-BY-4.0", "notice", ("cc-by-4-notice",)),
    ("CC-BY-SA-4.0", "notice", ("cc-by-sa-4-notice",)),
    ("CC-BY-NC-4.0", "notice", ("cc-by-nc-4-notice",)),
    ("CC-BY-ND-4.0", "notice", ("cc-by-nd-4-notice",)),
    ("CC-BY-NC-SA-4.0", "notice", ("cc-by-nc-sa-4-notice",)),
    ("CC-BY-NC-ND-4.0", "notice", ("cc-by-nc-nd-4-notice",)),
    ("Unlicense", "text", ("unlicense-grant", "unlicense-any")),
    ("Public-Domain", "notice", ("public-domain",)),
    ("All-Rights-Reserved", "notice", ("all-rights-reserved",)),
    ("Zlib", "text", ("zlib-warranty", "zlib-liability", "zlib-grant")),
    ("EPL-2.0", "header", ("epl-2-header",)),
    ("BSL-1.0", "notice", ("bsl-1-notice",)),
    ("LGPL-3.0-or-later", "header", ("lgpl-3-or-later-header", "lgpl-see")),
    ("LGPL-2.1-or-later", "header", ("lgpl-21-or-later-header", "lgpl-see")),
    ("AGPL-3.0-or-later", "header", ("agpl-3-or-later-header", "agpl-see")),
    *((x, "tag", (f"spdx-{x.lower()}",)) for x in TAGGED),
)

#: Every known sentence has one of these, so texts without any are not cut up.
NEEDED = "(?i)licen[sc]e|liable|mozilla|permi[st]|redistribut|copyright|software|warrant|public[^a-z0-9]+domain|rights[^a-z0-9]+reserved"
ENDS = "[.!?]+(?:[\\x20\\x09-\\x0D]+|$)"
BLANK_LINE = "\\n[\\x20\\x09]*\\n+"
#: Marks before a line of a comment, and the full stop between v and a number.
COMMENT = "(?m)^[\\x20\\x09]*(?:/\\*+|\\*+/?|//+|#+|;+|--+|%+|<!--)[\\x20\\x09]*"
VERSION = "(?i)([^a-z0-9]v)\\.([\\x20\\x09\\n]*[0-9])"


def bare(text: Column) -> Column:
    """The text without comment marks, and with no full stop after the v of a version."""
    return F.regexp_replace(F.regexp_replace(text, COMMENT, ""), VERSION, "$1$2")


def sentences(text: Column, lines: bool) -> Column:
    """Normalised sentences; ``lines``: a line end also ends one."""
    parts = F.split(text, f"{ENDS}|\\n+" if lines else f"{ENDS}|{BLANK_LINE}", -1)
    return F.transform(parts, lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))


def identifiers(text: Column, lines: bool) -> Column:
    known = F.filter(sentences(text, lines), lambda s: s.isin(*SENTENCES))
    table = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    return F.transform(known, lambda s: F.element_at(table, s))


def _inside(small: tuple[str, ...], large: tuple[str, ...]) -> bool:
    rest = iter(large)
    return small != large and all(x in rest for x in small)


def like(ids: tuple[str, ...]) -> str:
    """LIKE pattern for identifiers in order in ``,a,,b,,c,``."""
    return "%" + "%".join(f",{x}," for x in ids) + "%"


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, sentence_ids (in order), licences
    (``licence:form``, rule order), n_licences (distinct licences)."""
    df = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.coalesce("text", F.lit("")).alias("t"))
    none = F.array().cast("array<string>")
    hint = F.col("t").rlike(NEEDED)
    df = df.withColumn("t", F.when(hint, bare(F.col("t"))).otherwise(""))
    for name, lines in (("a", True), ("b", False)):
        df = df.withColumn(name, F.when(F.col("t") != "", identifiers(F.col("t"), lines)).otherwise(none))
        df = df.withColumn(f"{name}_text", F.array_join(F.transform(name, lambda x: F.concat(F.lit(","), x, F.lit(","))), ""))
    df = df.withColumn("ids", F.when(F.size("b") > F.size("a"), F.col("b")).otherwise(F.col("a"))).drop("t", "a", "b")
    hits = {i: F.col("a_text").like(like(ids)) | F.col("b_text").like(like(ids)) for i, (*_, ids) in enumerate(RULES)}
    df = df.withColumn("hits", F.array(*[hits[i] for i in range(len(RULES))]))
    found = []
    for i, (licence, form, ids) in enumerate(RULES):
        over = [j for j, (*_, other) in enumerate(RULES) if _inside(ids, other)]
        test = F.get("hits", F.lit(i))
        for j in over:
            test = test & ~F.get("hits", F.lit(j))
        found.append(F.when(test, F.lit(f"{licence}:{form}")))
    df = df.withColumn("found", F.filter(F.array(*found), lambda x: x.isNotNull()))
    names = F.array_distinct(F.transform("found", lambda x: F.split(x, ":")[0]))
    return df.select(*[F.col(f"k_{c}").alias(c) for c in keep], F.array_join("ids", ",").alias("sentence_ids"),
                     F.array_join("found", ",").alias("licences"), F.size(names).cast("long").alias("n_licences"))


def sql() -> str:
    """The same scan in DuckDB's SQL, from the same fixed values."""
    table = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())

    def ids(ends: str) -> str:
        return (f"list_filter(list_transform(string_split_regex(t, '{ends}'), lambda x: known[trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))]), "
                "lambda x: x IS NOT NULL)")

    hit = [f"(a_text LIKE '{like(r[2])}' OR b_text LIKE '{like(r[2])}')" for r in RULES]
    found = []
    for i, (licence, form, own) in enumerate(RULES):
        over = [j for j, (*_, other) in enumerate(RULES) if _inside(own, other)]
        found.append(f"CASE WHEN hits[{i + 1}]" + "".join(f" AND NOT hits[{j + 1}]" for j in over) + f" THEN '{licence}:{form}' END")
    return f"""
WITH k AS (SELECT map_from_entries(list((s, i))) AS known FROM (VALUES {table}) v(s, i)),
d AS (SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '{COMMENT}', '', 'g'), '{VERSION}', '\\1\\2', 'g') AS t, known
      FROM documents, k),
a AS (SELECT doc_id, {ids(ENDS + "|" + chr(92) + "n+")} AS a, {ids(ENDS + "|" + BLANK_LINE)} AS b FROM d),
j AS (SELECT doc_id, CASE WHEN len(b) > len(a) THEN b ELSE a END AS ids, list_aggregate(list_transform(a, lambda x: ',' || x || ','), 'string_agg', '') AS a_text,
             list_aggregate(list_transform(b, lambda x: ',' || x || ','), 'string_agg', '') AS b_text FROM a),
h AS (SELECT doc_id, ids, [{', '.join(f"coalesce({x}, false)" for x in hit)}] AS hits FROM j),
f AS (SELECT doc_id, ids, list_filter([{', '.join(found)}], lambda x: x IS NOT NULL) AS found FROM h)
SELECT doc_id, coalesce(list_aggregate(ids, 'string_agg', ','), '') AS sentence_ids,
       coalesce(list_aggregate(found, 'string_agg', ','), '') AS licences,
       CAST(len(list_distinct(list_transform(found, lambda x: string_split(x, ':')[1]))) AS BIGINT) AS n_licences
FROM f
"""
