import random
import re

import pytest

from tidemark.llm.components import components
from tidemark.llm.minhash import NearDup, near_duplicates, without_near_duplicates

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(set size, component) by id."""
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    top = {i: i for i, _ in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, x in sets:
        for b, y in sets:
            if a < b and x and 100 * len(x & y) >= 75 * len(x | y):
                p, q = root(a), root(b)
                top[max(p, q)] = min(p, q)
    return {i: (len(s), root(i)) for i, s in sets}


def test_whole_table(docs, rows):
    got, want = near_duplicates(docs).collect(), brute(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)
        else:
            assert r.component_id is None and r.kept
    assert sum(c != i for i, (_, c) in want.items()) >= 6


def test_links_that_no_pivot_sees(spark):
    """A chain: each text shares three quarters with the next only."""
    base = [f"v{i}" for i in range(400)]
    texts = [base[k * 12 : k * 12 + 120] for k in range(12)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(100 + i, " ".join(t[:60] + t[61:])) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and len({c for _, c in got.values()}) == 1


def test_empty(none):
    assert near_duplicates(none).count() == 0
    assert without_near_duplicates(none).count() == 0


def test_one_row_stays_of_each_group(docs, rows):
    want = {c for _, c in brute(rows).values()}
    left = without_near_duplicates(docs)
    assert left.columns == docs.columns
    got = [r.doc_id for r in left.collect()]
    assert sorted(i for i in got if i is not None) == sorted(want) and got.count(None) == 1


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (9, 8), (7, 7), (None, 1), (10, 9), (2, 5), (2, 5)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {2: 2, 3: 2, 4: 2, 5: 2, 7: 7, 8: 8, 9: 8, 10: 8} | {100 + i: 100 for i in range(31)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_other_limits(spark):
    rows = [(1, "a b c d"), (2, "a b c e"), (3, "x y")]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), NearDup(words=2, percent=50)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_words_of_equal_polynomial_hashes(spark, alike_words):
    rows = [(i + 1, f"p q {w}") for i, w in enumerate(alike_words)] + [(i + 3, " ".join([w, *map(str, range(40))])) for i, w in enumerate(alike_words)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and got[2] == (1, 2)


def test_repeated_ids(spark):
    """Rows of one id with different texts are documents of their own; of equal rows, one stays."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a, "x"), (1, b, "x"), (2, a + " more", "y"), (3, b, "y"), (4, "", "z"), (4, "", "z"), (5, None, "z"), (5, None, "z"), (None, a, "z"), (1, a, "w"), (6, " ".join(f"c{i}" for i in range(9)), "q")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in near_duplicates(frame).collect())
    assert got == [(0, 56, 0, True), (1, 56, 1, True), (1, 56, 1, True), (1, 56, 1, True), (2, 57, 1, False), (3, 56, 1, False), (4, 0, 4, True), (4, 0, 4, True), (5, 0, 5, True), (5, 0, 5, True), (6, 5, 6, True)]
    left = sorted(((r.doc_id or 0, r.text or "", r.source) for r in without_near_duplicates(frame).collect()))
    assert left == [(0, a, "z"), (1, a, "w"), (1, b, "x"), (4, "", "z"), (4, "", "z"), (5, "", "z"), (5, "", "z"), (6, rows[-1][1], "q")]
    assert sorted(((r.doc_id or 0, r.text or "", r.source) for r in without_near_duplicates(frame.repartition(3)).collect())) == left


def test_leftover_blocks_compare_words(spark, alike_words):
    """Families with no pivot in common, whose links only the block comparison finds."""
    base = [f"v{i}" for i in range(300)]
    rows = [(i, " ".join([*base[k * 8 : k * 8 + 100], alike_words[i % 2]])) for i, k in enumerate(range(24))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_bands_of_other_limits():
    assert (NearDup().rows, NearDup().minima // NearDup().rows, NearDup().loose) == (4, 32, 0.52)
    for percent, rows in ((50, 2), (30, 1), (90, 7), (100, 8)):
        spec = NearDup(percent=percent)
        assert spec.rows == rows and (1 - (percent / 100) ** rows) ** (spec.minima // rows) <= 1e-5 and 0 <= spec.loose <= percent / 100
    for bad in (NearDup, lambda **k: NearDup(minima=16, **k)):
        with pytest.raises(ValueError):
            bad(percent=5)


@pytest.mark.parametrize("percent", [50, 90])
def test_many_pairs_at_the_limit(spark, percent):
    """Pairs just at the limit and just below it: all of the first are linked and none of the others."""
    rng, rows, want = random.Random(percent), [], {}
    for k in range(300):
        size = rng.randint(60, 90)  # words of the common part, each a set element
        extra = 0
        while 100 * size >= percent * (size + extra + 1):
            extra += 1
        linked = k % 2 == 0
        extra += not linked
        common = [f"c{k}x{i}" for i in range(size)]
        left = rng.randint(0, extra)
        rows += [(2 * k, " ".join(common + [f"l{k}x{i}" for i in range(left)])), (2 * k + 1, " ".join(common + [f"r{k}x{i}" for i in range(extra - left)]))]
        want |= {2 * k: 2 * k, 2 * k + 1: 2 * k + (not linked)}
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), NearDup(words=1, percent=percent))
    assert {r.doc_id: r.component_id for r in found.collect()} == want
