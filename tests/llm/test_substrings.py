import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import reference_spans, substrings
from tidemark.llm.reference_spans import remove_reference_spans
from tidemark.llm.substrings import SuffixAutomaton, remove_repeated_spans

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, words=13):
    first = {}
    for i, text, *_ in rows:
        w = WORD.findall(text or "")
        for k in range(len(w) - words + 1 if i is not None else 0):
            key = tuple(w[k : k + words])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, text, *_ in rows:
        w, gone = WORD.findall(text or ""), set()
        for k in range(len(w) - words + 1 if i is not None else 0):
            if first[tuple(w[k : k + words])] < i:
                gone.update(range(k, k + words))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_whole_table(docs, rows):
    got = [tuple(r) for r in remove_repeated_spans(docs).collect()]
    assert order(got) == order(brute(rows)) and sum(r[2] for r in got) > 500


def test_other_length(docs, rows):
    got = [tuple(r) for r in remove_repeated_spans(docs, 7).collect()]
    assert order(got) == order(brute(rows, 7))


def test_empty(none):
    assert remove_repeated_spans(none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=12), max_size=4), st.lists(st.integers(0, 3), max_size=14))
def test_automaton(texts, text):
    made = SuffixAutomaton()
    for t in texts:
        made.add(t)
    held = {tuple(t[a:b]) for t in texts for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    want = [max((n for n in range(1, i + 2) if tuple(text[i + 1 - n : i + 1]) in held), default=0) for i in range(len(text))]
    assert made.matching(text) == want


@pytest.mark.parametrize("most", [8, 0])
def test_reference_spans(spark, monkeypatch, most):
    """By broadcast automata, and routed where the reference is too large for them."""
    monkeypatch.setattr(reference_spans, "MOST_SHARDS", most)
    rng = random.Random(1)
    reference = [" ".join(f"r{rng.randint(0, 50)}" for _ in range(40)) for _ in range(6)]
    part = reference[2].split()[5:25]
    rows = [(1, "a b " + " ".join(part) + " c"), (2, " ".join(part[:12])), (3, None), (4, "")]
    frame, ref = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(t,) for t in [*reference, None, ""]], "text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_reference_spans(frame, ref, 13).collect()}
    assert got == {1: (23, 20, "a b c"), 2: (12, 0, rows[1][1]), 3: (0, 0, ""), 4: (0, 0, "")}
    again = remove_reference_spans(frame.unionByName(frame), ref, 13).where("n_removed > 0").collect()
    assert [(r.doc_id, r.n_removed) for r in again] == [(1, 20)] * 2
    assert remove_reference_spans(frame, ref.where("false")).where("n_removed > 0").count() == 0


def brute_reference(rows, texts, words):
    held = {tuple(w[k : k + words]) for w in (WORD.findall(t or "") for t in texts) for k in range(len(w) - words + 1)}
    out = []
    for i, text in rows:
        w, gone = WORD.findall(text or ""), set()
        for k in range(len(w) - words + 1):
            if tuple(w[k : k + words]) in held:
                gone.update(range(k, k + words))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("words", [1, 5, 13])
def test_reference_of_several_shards(spark, docs, rows, monkeypatch, words):
    """Half the documents against the others, whose texts are cut into pieces and shards."""
    monkeypatch.setattr(reference_spans, "SHARD_BYTES", 60_000)
    monkeypatch.setattr(reference_spans, "PIECE_WORDS", 40)
    monkeypatch.setattr(reference_spans, "MOST_SHARDS", 1000)
    even = docs.where("pmod(doc_id, 2) = 0 or doc_id is null")
    removed = remove_reference_spans(even, docs.where("pmod(doc_id, 2) = 1"), words)
    want = brute_reference([r[:2] for r in rows if r[0] is None or r[0] % 2 == 0], [r[1] for r in rows if r[0] is not None and r[0] % 2], words)
    assert order(map(tuple, removed.collect())) == order(want) and sum(r[2] for r in want) > 100
    shuffles = lambda df: df._jdf.queryExecution().sparkPlan().toString().count("Repartition") + df._jdf.queryExecution().sparkPlan().toString().count("Exchange")
    assert shuffles(removed) == shuffles(even)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), max_size=4), st.lists(st.lists(st.integers(0, 3), max_size=16), max_size=4), st.integers(1, 5))
def test_lanes(reference, texts, words):
    """Windows by lanes of one word each, so that all meet at lane edges."""
    said = lambda t: [f"w{x}".encode() for x in t]
    lane, reference_spans.LANE = reference_spans.LANE, 1
    try:
        pieces = [b" ".join(said(t)) for t in reference if t]
        made = reference_spans._automaton(pa.table({"shard": pa.array([0] * len(pieces), pa.int32()), "piece": pa.array(pieces, pa.binary())})) if pieces else None
        held = reference_spans.Reference([tuple(made.select(range(1, 6)).to_pylist()[0].values())] if pieces else [])
        at = [0]
        for t in texts:
            at.append(at[-1] + len(t))
        got = held.covered([w for t in texts for w in said(t)], np.array(at), words).tolist()
    finally:
        reference_spans.LANE = lane
    want = [len(r[3]) for r in brute_reference([(i, " ".join(f"w{x}" for x in t)) for i, t in enumerate(texts)], [" ".join(f"w{x}" for x in t) for t in reference], words)]
    kept = [len(" ".join(f"w{x}" for x, g in zip(t, got[a:b]) if not g)) for t, a, b in zip(texts, at[:-1], at[1:])]
    assert kept == want


def test_words_of_equal_polynomial_hashes(spark, alike_words):
    same = " ".join(map(str, range(12)))
    rows = [(i + 1, f"{same} {w}") for i, w in enumerate(alike_words)] + [(3, f"{same} {alike_words[0]}")]
    got = [tuple(r) for r in remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert order(got) == order(brute(rows)) and [r[2] for r in order(got)] == [0, 0, 13]


@pytest.mark.parametrize("limit", ["SHARD_WORDS", "HOT", "hashes"])
def test_limits_change_nothing(docs, rows, monkeypatch, limit):
    """Small shards, anchors that all count as hot, and anchor hashes of which most collide, all give the same result."""
    if limit == "hashes":
        monkeypatch.setattr(substrings, "GRAM", 1)
    else:
        monkeypatch.setattr(substrings, limit, 1)
    got = [tuple(r) for r in remove_repeated_spans(docs).collect()]
    assert order(got) == order(brute(rows))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=14), min_size=1, max_size=5), st.integers(1, 5))
def test_owners(texts, n):
    made = SuffixAutomaton()
    for owner, t in enumerate(texts):
        made.add(t, owner)
    made.settle()
    for t in texts:
        want = [min(o for o, x in enumerate(texts) if any(x[k : k + n] == t[i : i + n] for k in range(len(x) - n + 1))) for i in range(len(t) - n + 1)]
        assert made.owners(t, n) == want
