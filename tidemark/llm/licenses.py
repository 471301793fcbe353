"""Licence scans by sentence rules: known sentences get identifiers, identifier sequences are matched by ordered rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: known licence sentences by identifier
SENTENCES: dict[str, str] = {
    "mit-title": "MIT License",
    "mit-title-the": "The MIT License",
    "mit-released": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-this": "This project is licensed under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "apache2-licensed": "Licensed under the Apache License, Version 2.0",
    "apache2-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "apache2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache2-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-licensed": "Licensed under the GNU General Public License, version 3",
    "gpl2-licensed": "Licensed under the GNU General Public License, version 2",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "lgpl3-licensed": "Licensed under the GNU Lesser General Public License, version 3",
    "agpl3-licensed": "Licensed under the GNU Affero General Public License, version 3",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-nc4": "Licensed under CC BY-NC 4.0",
    "cc-by4": "Licensed under CC BY 4.0",
    "cc-by-sa4": "Licensed under CC BY-SA 4.0",
    "cc-by4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc0-waive": "To the extent possible under law, the author has waived all copyright and related rights to this work",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "lgpl2-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl3-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version",
    "agpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "boost-distributed": "Distributed under the Boost Software License, Version 1.0",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}
# fixed values: titles of whole licence texts, with the licence that each heads
TITLES: dict[str, tuple[str, str]] = {
    "agpl3-title": ("AGPL-3.0-only", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    "apache2-title": ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    "boost-title": ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    "bsd2-title": ("BSD-2-Clause", "BSD 2-Clause License"),
    "bsd3-title": ("BSD-3-Clause", "BSD 3-Clause License"),
    "cc0-title": ("CC0-1.0", "CC0 1.0 Universal"),
    "epl2-title": ("EPL-2.0", "Eclipse Public License - v 2.0"),
    "gpl2-title": ("GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    "gpl3-title": ("GPL-3.0-only", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "isc-title": ("ISC", "ISC License"),
    "lgpl21-title": ("LGPL-2.1-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    "lgpl3-title": ("LGPL-3.0-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "mpl2-title": ("MPL-2.0", "Mozilla Public License Version 2.0"),
}
SENTENCES |= {name: title for name, (_, title) in TITLES.items()}
# fixed values: sentences of whole licence texts that prove no licence alone
SENTENCES |= {
    "bsd-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "mit-liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "gpl-copies": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed",
}
# licences and common expressions that SPDX tags name
TAGGED = [
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only",
    "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
    "Apache-2.0 AND MIT", "Apache-2.0 OR BSL-1.0", "Apache-2.0 OR MIT", "Apache-2.0 WITH LLVM-exception", "BSD-3-Clause OR GPL-2.0-only", "EPL-2.0 OR Apache-2.0", "EPL-2.0 OR GPL-2.0-only WITH Classpath-exception-2.0",
    "GPL-2.0-only OR BSD-2-Clause", "GPL-2.0-only OR MIT", "GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0-only WITH Linux-syscall-note", "GPL-2.0-or-later WITH Linux-syscall-note", "MIT AND BSD-3-Clause", "MIT OR Apache-2.0",
    "MIT OR GPL-2.0-only", "MIT OR Zlib", "Unlicense OR MIT", "Zlib OR Apache-2.0 OR MIT",
]
SENTENCES |= {f"spdx-{name}": f"SPDX-License-Identifier: {name}" for name in TAGGED}
# known sentences with a blank for one to MOST_BLANK words, as holders' names or files: what stands before and after it
BLANKS: dict[str, tuple[str, str]] = {
    "bsd-endorse": ("Neither the name of", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    "bsd-endorse-one": ("The name of", "may not be used to endorse or promote products derived from this software without specific prior written permission"),
    "mit-see": ("Licensed under the MIT License see", ""),
    "apache2-see": ("Licensed under the Apache License, Version 2.0 see", ""),
}
MOST_BLANK = 10

# rules in order: the first that matches at a sentence counts; sentences of a rule stand close together
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("Apache-2.0", ("apache2-header", "apache2-copy", "apache2-as-is")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-one")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("LGPL-2.1-or-later", ("lgpl2-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("BSL-1.0", ("boost-distributed",)),
    ("Zlib", ("zlib-as-is", "zlib-liable", "zlib-grant")),
    ("MIT", ("mit-see",)),
    ("Apache-2.0", ("apache2-see",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-title-the",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-this",)),
    ("Apache-2.0", ("apache2-licensed",)),
    ("Apache-2.0", ("apache2-header",)),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("GPL-3.0-only", ("gpl3-licensed",)),
    ("GPL-2.0-only", ("gpl2-licensed",)),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("LGPL-3.0-only", ("lgpl3-licensed",)),
    ("AGPL-3.0-only", ("agpl3-licensed",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl2-subject",)),
    ("CC-BY-NC-4.0", ("cc-by-nc4",)),
    ("CC-BY-4.0", ("cc-by4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa4",)),
    ("CC-BY-4.0", ("cc-by4-work",)),
    ("CC0-1.0", ("cc0-waive",)),
    ("Unlicense", ("unlicense",)),
]
RULES += [(licence, (name,)) for name, (licence, _) in TITLES.items()]
RULES += [(name, (f"spdx-{name}",)) for name in TAGGED]
GAP = 3  # sentences from one of a rule to the next, at most, on average
SPLIT = r"[.!?][ \t\r\f]+|[.!?]?\n+"
NOISE = r"[^\p{L}\p{N}]+"
STOP = "\x01"  # stands between pieces where . ! ? ended one, as a piece of its own
STOPS = r"[.!?](?:[ \t\r\f]+|\n+)"


def normalise(sentence: str) -> str:
    """Lower case, with every run of other than letters and digits one space."""
    return re.sub(r"[\W_]+", " ", sentence.lower()).strip()


# normalised whole known sentences that SPLIT would cut (an inner "v. 2.0") are known by their last part
def _known() -> dict[str, str]:
    out = {}
    for name, sentence in SENTENCES.items():
        parts = [normalise(p) for p in re.split(SPLIT, sentence)]
        out[max(parts, key=len)] = name
    return out


KNOWN = _known()
OPEN = {name: (normalise(before), normalise(after)) for name, (before, after) in BLANKS.items()}
LINES = max(*(len(k.split()) for k in KNOWN), *(len(f"{a} {b}".split()) + MOST_BLANK for a, b in OPEN.values()))  # lines of a known sentence, at most
BEGINNINGS = sorted({" ".join(k.split()[:n]) for k in [*KNOWN, *(f"{a} x" for a, _ in OPEN.values())] for n in range(1, len(k.split()))})


def _named(text: Column, table: Column) -> Column:
    """The known sentence that a normalised text is, or null."""
    found = F.when(text.isin(list(KNOWN)), F.try_element_at(table, text))  # a set of many texts is hashed, a map is searched
    for name, (before, after) in OPEN.items():
        middle = F.regexp_count(text, F.lit(" ")) - (f"{before} {after}".strip().count(" ") + bool(after))
        fits = text.startswith(f"{before} ") & (text.endswith(f" {after}") if after else F.lit(True)) & middle.between(1, MOST_BLANK)
        found = F.coalesce(found, F.when(fits, F.lit(name)))
    return found


def _begun(text: Column) -> Column:
    """Whether more lines may make a known sentence of a normalised text."""
    out = text.isin(BEGINNINGS)
    for before, after in OPEN.values():
        out = out | (text.startswith(f"{before} ") & (F.regexp_count(text, F.lit(" ")) < f"{before} {after}".count(" ") + MOST_BLANK + 1))
    return out


def _matched(known: Column, i: Column) -> Column:
    """The licence of the first rule that matches from the i-th (from 1) known sentence, or null."""
    cases = []
    for licence, rule in RULES:
        k = len(rule)
        inner = F.aggregate(F.slice(known["lines"], i, k - 1), F.lit(0), lambda a, x: a + x - 1)  # line ends within sentences are no steps between them
        near = F.get(known["at"], i + (k - 2)) - F.get(known["at"], i - 1) - inner <= GAP * (k - 1)
        cases.append(F.when((F.slice(known["id"], i, k) == F.array(*(F.lit(x) for x in rule))) & near, F.lit(licence)))
    return F.coalesce(*cases)


def _longest(lines: Column, table: Column) -> Column:
    """(lines, id) of the longest known sentence that the first of `lines` make when joined; id is null if there is none."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"), F.lit(True).alias("open"), F.lit(0).alias("lines"), F.lit(None).cast("string").alias("id"))

    def more(a: Column, x: Column) -> Column:
        text = F.concat(a["text"], F.when(a["n"] > 0, F.lit(" ")).otherwise(F.lit("")), x["s"])
        found = _named(text, table)
        longer = F.struct(
            text.alias("text"), (a["n"] + 1).alias("n"), (~x["stops"] & _begun(text)).alias("open"), F.when(found.isNotNull(), a["n"] + 1).otherwise(a["lines"]).alias("lines"), F.coalesce(found, a["id"]).alias("id")
        )
        return F.when(a["open"], longer).otherwise(a)

    return F.aggregate(lines, start, more, lambda a: F.struct(a["lines"].alias("lines"), a["id"].alias("id")))


def scan_licences(docs: DataFrame) -> DataFrame:
    """(doc_id, n_sentences, known, matches, licences) for every row of docs.

    A text is cut into pieces at . ! ? before white space and at line ends; empty ones don't count, n_sentences are the
    others. A known sentence is a piece, or a run of pieces with only line ends and blank lines between them (a wrapped
    sentence, with or without comment signs before its lines), that equals it once normalised; blanks stand for one to
    MOST_BLANK words; one within a longer one doesn't count. known are their (at, lines, id): first piece, from 0, number of pieces, identifier; matches the (at, licence) of
    rules; licences the distinct licences, sorted. Null and empty texts have no sentences; null ids and repeated rows stay;
    an empty table gives no rows.
    """
    table = F.create_map(*(F.lit(x) for pair in KNOWN.items() for x in pair))
    text = F.translate(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), STOP, ",")
    lines = F.split(F.regexp_replace(text, STOPS, f"\n{STOP}\n"), r"\n+")
    pieces = F.transform(lines, lambda s: F.when(s == STOP, s).otherwise(F.trim(F.regexp_replace(s, NOISE, " "))))
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.filter(pieces, lambda s: s != "").alias("p"))
    stops = F.transform("p", lambda s, i: F.struct(s.alias("s"), F.coalesce(F.get("p", i + 1) == STOP, F.lit(True)).alias("stops")))
    cut = cut.select("doc_id", F.filter(stops, lambda x: x["s"] != STOP).alias("s"))

    def known_at(x: Column, i: Column) -> Column:
        alone = F.struct(F.lit(1).alias("lines"), _named(x["s"], table).alias("id"))
        found = F.when(~x["stops"] & _begun(x["s"]), _longest(F.slice("s", i + 1, LINES), table)).otherwise(alone)
        return F.struct(i.alias("at"), found.alias("of"))

    found = F.transform(F.filter(F.transform("s", known_at), lambda x: x["of"]["id"].isNotNull()), lambda x: F.struct(x["at"].alias("at"), x["of"]["lines"].alias("lines"), x["of"]["id"].alias("id")))
    cut = cut.select("doc_id", F.size("s").cast("long").alias("n_sentences"), found.alias("known"))

    def outermost(x: Column, i: Column) -> Column:
        return ~F.exists(F.slice("known", F.greatest(i - LINES, F.lit(0)) + 1, F.least(i, F.lit(LINES))), lambda y: y["at"] + y["lines"] >= x["at"] + x["lines"])

    cut = cut.withColumn("known", F.filter("known", outermost))
    known = F.col("known")
    each = F.when(F.size("known") > 0, F.transform(F.sequence(F.lit(1), F.size("known")), lambda i: F.struct(F.get(known["at"], i - 1).alias("at"), _matched(known, i).alias("licence"))))
    kept = F.filter(F.coalesce(each, F.array().cast("array<struct<at:int,licence:string>>")), lambda x: x["licence"].isNotNull())
    return cut.withColumn("matches", kept).withColumn("licences", F.sort_array(F.array_distinct(F.col("matches.licence"))))


def oracle() -> str:
    """The same digest in DuckDB SQL, built from the tables above."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in KNOWN.items())
    blanks = " UNION ALL ".join(
        f"SELECT *, {quote(name)} AS id FROM each WHERE regexp_full_match(sentence, {quote(f'{before}( [^ ]+){{1,{MOST_BLANK}}}' + (f' {after}' if after else ''))})" for name, (before, after) in OPEN.items()
    )
    cases = " ".join(
        f"WHEN list_slice(ids, i, i + {len(r) - 1}) = [{', '.join(map(quote, r))}] AND pos[i + {len(r) - 1}] - pos[i] <= {GAP * (len(r) - 1)} THEN {quote(n)}" for n, r in RULES
    )
    return rf"""
        WITH cut AS (
            SELECT row_number() OVER () AS row, doc_id,
                   list_filter(list_transform(regexp_split_to_array(lower(coalesce(text, '')), {quote(SPLIT)}),
                                              lambda s: trim(regexp_replace(s, {quote(NOISE)}, ' ', 'g'))), lambda s: s <> '') AS s
            FROM documents
        ), known(sentence, id) AS (VALUES {known}),
        each AS (SELECT row, unnest(s) AS sentence, generate_subscripts(s, 1) AS spot FROM cut),
        seen AS (SELECT row, list(id ORDER BY spot) AS ids, list(spot ORDER BY spot) AS pos FROM
                 (SELECT row, spot, first(id) AS id FROM (SELECT each.*, id FROM each JOIN known USING (sentence) UNION ALL {blanks}) GROUP BY row, spot) GROUP BY row),
        found AS (SELECT row, ids, pos, unnest(range(1, len(ids) + 1)) AS i FROM seen),
        named AS (SELECT row, CASE {cases} END AS licence FROM found),
        held AS (SELECT row, count(licence) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM named GROUP BY row)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_known,
               CAST(coalesce(n, 0) AS BIGINT) AS n_matches, coalesce(licences, '') AS licences
        FROM cut LEFT JOIN seen USING (row) LEFT JOIN held USING (row)
    """
