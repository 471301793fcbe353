import hashlib
import math
import re
import zlib
from collections import Counter
from urllib.parse import urlparse

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import divergence, importance
from tidemark.llm import textscan as ts

LOWER = {c: c + 32 for c in range(65, 91)}
ALNUM, TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def features(text, longest=1):
    words = ALNUM.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute_resample(rows, target, percent=10, least=20, buckets=10_000, longest=1, seed=2024):
    crc = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(crc(f) for text in texts for f in features(text, longest)[1]) for texts in ([r[1] for r in rows], target))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
    out = []
    for doc_id, text in rows:
        words, own = features(text, longest)
        weight = sum(gain(crc(f)) for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for place, row in enumerate(fit[: len(fit) * percent // 100], 1):
        row[4] = place
    return [tuple(r[:5]) for r in out]


def same(got, want):
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZ é-1\n", max_size=90), max_size=6), st.integers(1, 3))
def test_crc_of_runs(texts, longest):
    import pyarrow as pa

    got = Counter((chunk.first + int(i), int(c)) for chunk in ts.chunks(pa.array(texts, pa.string()), ts.ALNUM_WORDS_LOWER) if len(chunk.code) for text, crc in importance._runs(chunk, longest) for i, c in zip(text, crc))
    assert got == Counter((i, zlib.crc32(f.encode())) for i, text in enumerate(texts) for f in features(text, longest)[1])


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 97, "percent": 35, "seed": 5}, {"min_words": 0, "percent": 100}, {"percent": 0}])
def test_resample_equals_brute_force(spark, docs, rows, options):
    target = [rows[3][1], None, "", "Some OTHER words w1 w2 w3, w4 " * 9]
    items = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    got = importance.resample(docs, items, **options).collect()
    want = {("min_words" if k == "least" else k): v for k, v in options.items()}
    want["least"] = want.pop("min_words", 20)
    same(got, brute_resample([(r[0], r[1]) for r in rows], target, **want))


def test_resample_of_ties_and_empty_tables(spark, docs, none):
    items = docs.select(F.col("doc_id").alias("item_id"), "text").limit(0)
    assert importance.resample(none, items).count() == 0
    text = "one two three four " * 6
    many = spark.createDataFrame([(7, text)] * 40 + [(i, text) for i in range(60)], "doc_id long, text string")
    got = importance.resample(many, items).collect()
    same(got, brute_resample([(r.doc_id, r.text) for r in many.collect()], []))
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 11))


def test_ranks_over_several_levels_of_scores(spark):
    counts = spark.range(0, 200_000, 7).select((F.col("id") - 100_000).alias("score"), (F.col("id") % 5 + 1).alias("n"))
    held = {r.score: r.before for r in importance._before(counts, "score").collect()}
    before = 0
    for score, n in sorted(((r.score, r.n) for r in counts.collect()), reverse=True):
        assert held[score] == before
        before += n


def test_csr_blocks_hold_the_counts(spark, docs, rows):
    matrix = importance.count_matrix(docs, 1000).collect()
    got = []
    for block in matrix:
        assert len(block.indptr) == len(block.doc_ids) + 1 and block.indptr[-1] == len(block.indices)
        for i, doc_id in enumerate(block.doc_ids):
            a, b = block.indptr[i : i + 2]
            assert block.indices[a:b] == sorted(set(block.indices[a:b]))
            got.append((doc_id, block.n_words[i], tuple(zip(block.indices[a:b], block.counts[a:b]))))
    want = [(r[0], len(features(r[1])[0]), tuple(sorted(Counter(zlib.crc32(f.encode()) % 1000 for f in features(r[1])[1]).items()))) for r in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_row_groups_hold_few_csr_blocks(spark, monkeypatch):
    """A reader decodes all lists of a row group at once, so its blocks must not grow with those of a task."""
    text, groups, sums = "one two three four five six seven " * 31_000, [], importance.column_sums  # over half a chunk, so a block of its own

    def spy(matrix, *rest):
        held = [pq.ParquetFile(urlparse(f).path).metadata for f in matrix.inputFiles()]
        groups.append([m.row_group(i).num_rows for m in held for i in range(m.num_row_groups)])
        return sums(matrix, *rest)

    monkeypatch.setattr(importance, "column_sums", spy)
    docs = spark.range(0, 9, 1, 1).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    items = spark.createDataFrame([(0, "two three")], "item_id long, text string")
    got = importance.resample(docs, items, percent=50).collect()
    assert sum(groups[0]) == 9 and max(groups[0]) <= 4
    same(got, brute_resample([(i, text) for i in range(9)], ["two three"], 50))


def brute_divergence(rows, least=10, top=10):
    groups, counts, docs = set(), Counter(), Counter()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        counts.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (own, t), n in docs.items() if own == lang and n >= least)
        sources = sorted(s for own, s in groups if own == lang)
        n = {s: [counts[lang, s, t] for t in kept] for s in sources}
        n[None] = [sum(n[s][i] for s in sources) for i in range(len(kept))]
        p = {s: [1 + 10**9 * (c + 2) // (sum(own) + 2 * len(kept)) for c in own] for s, own in n.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(x, sum(map(f, p[s], p[x]))) for x in sources if x != s]
            terms = [(t, f(a, b)) for t, a, b, c in zip(kept, p[s], p[None], n[s]) if c and a > b]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(found, key=lambda r: (-r[1], r[0].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ordered, 1)]
    return out


@pytest.mark.parametrize("options", [{}, {"min_docs": 3, "top": 2}, {"min_docs": 255}, {"min_docs": 1}])
def test_divergence_equals_brute_force(spark, docs, rows, options):
    held = [(r[1] if r[0] != 1001 else "rare words é ü", [r[2], "de", None][i % 3], r[3]) for i, r in enumerate(rows)] + [(None, "fr", "x"), ("9 8", "fr", "y")]
    df = spark.createDataFrame(held, "text string, lang string, source string").repartition(3).withColumns({c: F.lit(f"extra {c}") for c in ("term", "n", "p", "q", "item", "value", "rank", "doc_id")})
    want = brute_divergence(held, options.get("min_docs", 10), options.get("top", 10))
    same(divergence.source_divergence(df, **options).collect(), want)


def test_divergence_with_a_narrow_sketch(spark, rows):
    held = [(r[1], r[2], r[3]) for r in rows]
    df = spark.createDataFrame(held, "text string, lang string, source string").repartition(2)
    same(divergence.source_divergence(df, 5, width_bits=5).collect(), brute_divergence(held, 5))


def test_sketch_never_underestimates_and_leaves_rare_terms_out(spark):
    rows = [(f"often{'' if i % 3 else ' third'} only{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{'x' * (i // 26)}", "en", "s") for i in range(600)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    got = {r.term: (r.n, r.docs) for r in divergence.term_counts(df, 10).collect()}
    assert got["often"] == (600, 600) and got["third"] == (200, 200)
    assert len(got) < 30  # of 602 terms


def test_divergence_of_an_empty_table(none):
    assert divergence.source_divergence(none).count() == 0


def test_terms_that_share_a_code_are_told_apart(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ts, "_long_codes", lambda padded, start, size: np.zeros(len(start), np.uint64))
    chunk = next(ts.chunks(pa.array(["longestword anotherword longestword longestwora tiny"]), divergence.TERM_WORDS))
    which, first = divergence._distinct(chunk)
    words = chunk.words(0, 5)
    assert [words[i] for i in first[which]] == words and len(set(which.tolist())) == 4
