import re

import pytest

from tidemark.llm.decontaminate import clean_documents, clean_spans, contamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "item_id long, text string"


def of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, words=10):
    windows = {}
    for i, text in items:
        w = of(text)
        n = min(words, len(w))
        for k in range(len(w) - n + 1 if n and i is not None else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for i, text, *_ in rows:
        w, hit, met = of(text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    met |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), sorted(met)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(rows):
    passage = rows[3][1].split("\n")[1].split("\t")[0].split()
    return [(7, "..." + "! ".join(passage[4:20]).title()), (10, "Two, three"), (9, passage[0] + "-" + passage[1]), (10, "nothing here " * 8), (3, None), (4, ""), (None, "one two"), (5, "É"), (6, "wholly new words of an item that nobody wrote ever before")]


@pytest.mark.parametrize("most_bytes", [1 << 20, 60])
def test_whole_table(spark, docs, rows, items, most_bytes):
    got = contamination(docs, spark.createDataFrame(items, SCHEMA), most_bytes=most_bytes).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=str) == brute(rows, items)
    assert any(r.n_hit for r in got)


def test_removal(spark, docs, rows, items):
    bench = spark.createDataFrame(items, SCHEMA)
    hits = {i: n for i, _, n, _ in brute(rows, items)}
    left = clean_documents(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r[0]) for r in rows if not hits[r[0]])
    for r in clean_spans(docs, bench).collect():
        before = next(x[1] for x in rows if x[0] == r.doc_id)
        assert len(of(r.text)) == len(of(before)) - hits[r.doc_id]


def test_spans_in_groups(spark, docs, rows, items):
    bench = spark.createDataFrame(items, SCHEMA)
    whole, parts = ([(r.doc_id, r.text) for r in clean_spans(docs, bench, most_bytes=n).collect()] for n in (1 << 20, 60))
    assert len(whole) == len(rows) and sorted(whole, key=str) == sorted(parts, key=str)
    hits = {i: n for i, _, n, _ in brute(rows, items)}
    texts = {r[0]: r[1] for r in rows}
    assert any(hits.values()) and all(len(of(t)) == len(of(texts[i])) - hits[i] and (hits[i] or t == texts[i]) for i, t in parts)


def test_empty(spark, docs, none, items):
    bench = spark.createDataFrame(items, SCHEMA)
    assert contamination(none, bench).count() == 0
    assert contamination(docs, bench.where("false")).where("n_hit > 0").count() == 0


def test_items_that_repeat(spark, monkeypatch):
    """Rows that repeat an item count once when groups are sized; a window of very many items is held once."""
    from tidemark.llm import decontaminate

    made, shared = [], "one two three four five six seven eight nine ten eleven"
    kept = decontaminate.Index.__init__
    monkeypatch.setattr(decontaminate.Index, "__init__", lambda self, *given: made.append(self) or kept(self, *given))
    items = spark.createDataFrame([(1, shared)] * 5000 + [(i, shared) for i in range(2, 400)], SCHEMA)
    docs = spark.createDataFrame([(1, "x " + shared + " y"), (2, "nothing of it here")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in contamination(docs, items).collect()}
    assert got == {1: (11, list(range(1, 400))), 2: (0, [])}
    assert len(made) == 1 and len(made[0].windows[10].hashes) == 2 and len(made[0].windows[10].item) == 2 * 399


def test_windows_whose_hashes_collide(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from tidemark.llm import decontaminate
    from tidemark.llm import textscan as ts

    monkeypatch.setattr(ts, "sequence_hash", lambda code, begin, length, family=0: np.full(len(begin), 7, np.uint64))
    texts = [" ".join(f"{x}{i}" for i in range(11)) for x in "abc"]
    index = decontaminate.Index([1, 2, 3, 4], [*texts, texts[0]], 10)
    chunk = next(ts.chunks(pa.array([texts[0], "q " + texts[1], "nothing"]), ts.ALNUM_WORDS_LOWER))
    hit, items = index.hits(chunk)
    assert {i: x.tolist() for i, x in items.items()} == {0: [1, 4], 1: [2]} and hit.tolist() == [True] * 11 + [False] + [True] * 11 + [False]
