import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import licenses, toxicity
from tidemark.llm.neighbours import search


def vectors(seed=5, n=700, dim=24):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(rng.standard_normal((n, dim)))]
    rows[100] = (100, rows[7][1])
    for i in range(300, 360):
        rows[i] = (i, rows[200][1])
    bad = [(1000, None), (1100, [0.0] * dim), (1200, [None] + [1.0] * (dim - 1)), (1300, [float("nan")] * dim), (1400, [float("inf")] + [1.0] * (dim - 1)), (1500, [1.0]), (None, rows[1][1])]
    return rows + bad


def test_search(spark):
    rows = vectors()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, rank int, score string").repartition(3)
    got = {}
    for r in search(frame).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    ids, v = np.array([r[0] for r in rows[:700]]), np.array([r[1] for r in rows[:700]])
    hit = 0
    assert set(got) == {i for i in range(700) if i % 100 == 0}
    for q, found in got.items():
        dist = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        want = [int(i) for i in np.lexsort((ids, dist)) if i != q][:10]
        hit += len({i for i, _ in found} & set(want))
        assert [s for _, s in found] == pytest.approx([dist[i] for i, _ in found]) and [i for i, _ in found] == sorted((i for i, _ in found), key=lambda i: (dist[i], i))
    assert hit >= 0.9 * 10 * len(got)
    assert search(frame.where("false")).count() == 0
    few = search(frame.where("vec_id in (100, 7, 8)")).orderBy("rank").collect()
    assert [r.vec_id for r in few] == [7, 8] and few[0].score == 0.0


def test_grammar_meanings():
    lexicon = toxicity.Lexicon({"idiot": 3.0}, {"lowei": 2.0})
    finder = lexicon.finder()
    seen = lambda t: [k for k, x in enumerate(toxicity.features(t, lexicon, finder)) if x]
    assert seen("What an IDIOT that was.") == [toxicity.PLAIN]
    assert seen("You are an idiot") == [toxicity.AIMED] and seen("idiot, you there") == [toxicity.AIMED]
    assert seen("That was not an idiot!") == [toxicity.NEGATED]
    assert seen("The paper quoted the word idiot.") == [toxicity.REPORTED]
    assert seen("I will kill you") == [toxicity.MENACE] and seen("they kill time") == [] and seen("I will not kill you") == []
    assert seen("die loweischaft") == [toxicity.PLAIN] and seen("lowei") == [] and seen("idiots videoidiot") == []
    assert seen(None) == [] and seen("") == [] and seen("x" * 100_000) == []


def meant(symbols, weights):
    """The meanings of a clause by looking at each token's neighbours, without any transducer."""
    out = [0.0] * 5
    for i, symbol in enumerate(symbols):
        near = lambda x, reach: x in symbols[max(0, i - reach) : i]
        negated, reported = near("N", 2), near("R", 11)
        if symbol == "I":
            aimed = near("G", 3) or "G" in symbols[i + 1 : i + 4]
            out[toxicity.NEGATED if negated else toxicity.REPORTED if reported else toxicity.AIMED if aimed else toxicity.PLAIN] += weights[i]
        elif symbol == "G" and near("T", 2) and not negated:
            out[toxicity.REPORTED if reported else toxicity.MENACE] += 1.0
    return out


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from("IGTNROOO"), max_size=30))
def test_grammar_equals_brute_force(symbols):
    weights = [2.0**-i if x == "I" else 0.0 for i, x in enumerate(symbols)]
    assert toxicity.GRAMMAR.read(symbols, weights) == pytest.approx(meant(symbols, weights))


def test_long_clauses_are_whole():
    lexicon = toxicity.Lexicon({"idiot": 3.0}, {})
    finder = lexicon.finder()
    for pad in range(200, 270):
        one, gap = float(np.log1p(3.0)), f"idiot {'z' * pad} "
        assert toxicity.features(gap + "and no idiot", lexicon, finder) == [one, 0, one, 0, 0], pad
        assert toxicity.features(gap + "a paper said that it was some idiot", lexicon, finder) == [one, 0, 0, one, 0], pad
        assert toxicity.features(gap + "such an idiot in the house", lexicon, finder) == [float(np.log1p(6.0)), 0, 0, 0, 0], pad
    assert toxicity.features("idiot in the house " * 20_000, lexicon, finder) == [float(np.log1p(60_000.0)), 0, 0, 0, 0]


def labelled(spark, n=600):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        w = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(3, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(2):
                w.insert(rng.randint(0, len(w)), rng.choice(["grumbler", "oafish", "dolt" + rng.choice("abcd")]))
        docs.append((i, " ".join(w).replace("w", "word"), "x"))
        labels.append((i, 0, int(toxic)))
    docs += [(5000, None, "x"), (5001, "", "x"), (None, "hello", "x"), docs[0]]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns(spark):
    docs, labels = labelled(spark)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    out = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(out) > 80 and sum(r.predicted == truth[r.doc_id] for r in out) >= 0.95 * len(out)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0 if r.doc_id is not None else r.held_out)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    assert all(r.predicted == 0 for r in got if r.doc_id in (5000, 5001, None))
    left = toxicity.without_toxic(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(r.predicted == 0 for r in got)
    # labels that are held out are never looked at
    turned = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    assert {(r.doc_id, r.score) for r in toxicity.toxicity(docs, turned).collect()} == {(r.doc_id, r.score) for r in got}


def test_toxicity_without_rows(spark):
    docs, labels = labelled(spark, 20)
    assert toxicity.toxicity(docs.where("false"), labels).count() == 0
    assert toxicity.toxicity(docs, labels.where("false")).where("predicted = 1").count() == 0


def brute_licences(text):
    parts = [licenses.normalise(p) for p in re.split(licenses.SPLIT, (text or "").lower())]
    parts = [p for p in parts if p]
    blank = lambda p: next((n for n, (a, b) in licenses.OPEN.items() if re.fullmatch(f"{a}( [^ ]+){{1,10}}" + (f" {b}" if b else ""), p)), None)
    known = [(i, licenses.KNOWN.get(p) or blank(p)) for i, p in enumerate(parts) if p in licenses.KNOWN or blank(p)]
    found = []
    for k in range(len(known)):
        for name, rule in licenses.RULES:
            run = known[k : k + len(rule)]
            if tuple(x for _, x in run) == rule and run[-1][0] - run[0][0] <= licenses.GAP * (len(rule) - 1):
                found.append(name)
                break
    return len(parts), len(known), len(found), sorted(set(found))


def test_licences(spark, docs, rows, none):
    s = licenses.SENTENCES
    texts = [
        "Released under the MIT License.", "some words. RELEASED  under the mit license!\nmore", "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.", None, "",
        "\n".join([s["mit-title"], "Copyright X", s["mit-grant"], s["mit-notice"] + ".", s["mit-warranty"]]), "\n".join([s["bsd-grant"], s["bsd-source"] + ".", s["bsd-binary"] + "."]), s["bsd-source"],
        "\n".join([s["gpl-free"], *["filler"] * 9, s["gpl-hope"]]), s["mpl2-subject"] + ".", "\n".join([s["apache2-header"], s["apache2-copy"], s["apache2-as-is"]]), "é. É\n\n..!", "a" * 50_000,
    ]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, known string")
    got = licenses.scan_licences(frame).orderBy("doc_id").collect()
    assert [(r.n_sentences, len(r.known), len(r.matches), list(r.licences)) for r in got] == [brute_licences(t) for t in texts]
    assert got[5].licences == ["MIT"] and got[6].licences == ["BSD-2-Clause"] and got[7].licences == []
    assert licenses.scan_licences(docs).count() == len(rows) and licenses.scan_licences(none).count() == 0


WRAPPED = {
    "MIT": """MIT License

Copyright (c) 2020 Somebody

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
AUTHORS BE LIABLE FOR ANY CLAIM.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
RULE = {
    "MIT": ["mit-title", "mit-grant", "mit-notice", "mit-warranty"], "Apache-2.0": ["apache2-header", "apache2-copy", "apache2-as-is"], "BSD-3-Clause": ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"],
    "GPL-3.0-or-later": ["gpl-free", "gpl-hope"], "LGPL-2.1-or-later": ["lgpl2-free"], "Zlib": ["zlib-as-is", "zlib-liable", "zlib-grant"], "ISC": ["isc-grant"], "MPL-2.0": ["mpl2-subject"],
}


def test_wrapped_licences(spark):
    texts = []
    for name, text in WRAPPED.items():
        for sign, end in (("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", "\n")):
            texts.append((name, "import x\n" + end.join(sign + line for line in text.split("\n")) + "\ncode = 1\n"))
        texts.append((name, re.sub(r"\s+", "\n", text)))  # a word a line
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = licenses.scan_licences(frame).orderBy("doc_id").collect()
    assert [(list(r.licences), [k.id for k in r.known]) for r in got] == [([name], RULE[name]) for name, _ in texts]
    # of rules, whole sequences match, not their single sentences: the grants of BSD stand for no licence alone
    assert got[list(WRAPPED).index("BSD-3-Clause") * 5].matches[0].licence == "BSD-3-Clause"


def test_blanks_and_tags(spark):
    holder = WRAPPED["BSD-3-Clause"].replace("the copyright holder", "the Acme Tools\n   Corporation of Ohio")
    texts = [
        "// SPDX-License-Identifier: MIT\nint x;", "# SPDX-License-Identifier: GPL-2.0-or-later", "Licensed under the MIT license, see LICENSE file.", "Licensed under the MIT license, see " + "word " * 11 + ".",
        holder, "\n".join(" * " + x for x in holder.split("\n")), holder.replace("Acme", "Acme " * 11), "Neither the name of nor the names of its contributors",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [list(r.licences) for r in licenses.scan_licences(frame).orderBy("doc_id").collect()]
    assert got == [["MIT"], ["GPL-2.0-or-later"], ["MIT"], [], ["BSD-3-Clause"], ["BSD-3-Clause"], ["BSD-2-Clause"], []]


def test_wrapped_sentences_end(spark):
    texts = ["Released under. The MIT License", "Released\n. \nunder the\nMIT\nLicense", "Released\n\nunder the MIT\nLicense", "Released under\nthe MIT License or not", "MIT.\nLicense", "The\nMIT License\nMIT License"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = licenses.scan_licences(frame).orderBy("doc_id").collect()
    assert [[(k.at, k.lines, k.id) for k in r.known] for r in got] == [
        [(1, 1, "mit-title-the")], [(2, 2, "mit-title")], [(0, 3, "mit-released")], [], [], [(0, 2, "mit-title-the"), (2, 1, "mit-title")],
    ]
    assert [r.n_sentences for r in got] == [2, 4, 3, 2, 2, 3]


def test_toxicity_sample_is_bounded(spark):
    """One id with very many texts is one document of the sample."""
    texts = [(3, f"text number {i}") for i in range(3000)] + [(k, f"you are a wretched fool {k}" if k % 2 else f"a calm day {k}") for k in range(4, 300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(3, 300)], "doc_id long, toxic int")
    seen = []
    kept, toxicity.fit_weights = toxicity.fit_weights, lambda x, y: seen.append(len(x)) or kept(x, y)
    try:
        toxicity.train(docs, labels, sample=100)
    finally:
        toxicity.fit_weights = kept
    assert seen == [100]


def test_query_groups_are_released(spark, monkeypatch):
    from tidemark.llm import neighbours

    rows = [(i, [float((i * k) % 97 - 48) for k in range(1, 9)]) for i in range(1, 1200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = search(frame, every=10).collect()
    monkeypatch.setattr(neighbours, "QUERY_BYTES", 8 * 8 * 30)
    assert sorted(search(frame, every=10).collect()) == sorted(whole) and len(whole) == 1190


# heads of texts as they are distributed, with what a reader would say of each; written apart from the tables
HEADS = [
    ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS", "Apache-2.0"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n", "GPL-3.0-only"),
    ("                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n", "LGPL-2.1-only"),
    ("Eclipse Public License - v 2.0\n\n    THE ACCOMPANYING PROGRAM IS PROVIDED", "EPL-2.0"),
    ("Mozilla Public License Version 2.0\n==================================\n\n1. Definitions\n", "MPL-2.0"),
    ("BSD 3-Clause License\n\nCopyright (c) 2020, Some Body\nAll rights reserved.\n", "BSD-3-Clause"),
    ("// SPDX-License-Identifier: MIT OR Apache-2.0\nfn main() {}", "MIT OR Apache-2.0"),
    ("/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */\n#ifndef X", "GPL-2.0-only WITH Linux-syscall-note"),
    ("GNU GENERAL PUBLIC LICENSES are many.\nVersion 3, 29 June 2007 was a Friday", ""),
]


def test_heads_of_whole_licences(spark):
    frame = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(HEADS)], "doc_id long, text string")
    got = {r.doc_id: ",".join(r.licences) for r in licenses.scan_licences(frame).collect()}
    assert got == {i: want for i, (_, want) in enumerate(HEADS)}


def test_the_warranty_of_bsd_is_known(spark):
    text = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS\n\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT\nLIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR\nA PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT"
    row = licenses.scan_licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(row.known) == 1 and not row.licences
