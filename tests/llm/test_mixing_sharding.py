import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix, sizes
from tidemark.llm.mixing import mix, mixed
from tidemark.llm.sharding import cut_edges, shard

WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes):
    """By the rounds of the contract: share by weight, stop at three times the size, reshare."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    goal, full = dict.fromkeys(names, 0.0), set()
    left = float(sum(sizes.values()))
    while left > 1e-9:
        free = [s for s in names if s not in full]
        if not free:
            break
        total = sum(weight[s] for s in free)
        for s in free:
            goal[s] += left * weight[s] / total
        over = [s for s in free if goal[s] >= 3 * sizes[s]]
        left = sum(goal[s] - 3 * sizes[s] for s in over)
        for s in over:
            goal[s] = 3.0 * sizes[s]
        full |= set(over)
    return goal


def test_mix(docs, rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want, got = targets(sizes), mix(docs).collect()
    assert len(got) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1
    again = mix(docs.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mixed_rows(docs):
    out = mixed(docs)
    assert out.columns == docs.columns
    want = Counter()
    for r in mix(docs).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in want.items() if v})


def test_shard(docs, rows):
    got = shard(docs, 7).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert set(by) <= set(range(7)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and len(by) == 7


@pytest.mark.parametrize("copies", [[40], [10, 10, 5, 3, 3], [2] * 12])
def test_copies_stay_together(spark, copies):
    texts = [f"group {g}" for g, n in enumerate(copies) for _ in range(n)] + [f"single {i}" for i in range(100 - sum(copies))]
    got = shard(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), 10).collect()
    spread = defaultdict(set)
    for r in got:
        if texts[r.doc_id].startswith("group"):
            spread[texts[r.doc_id]].add(r.shard)
    assert Counter(r.shard for r in got) == Counter({s: 10 for s in range(10)})
    assert sum(len(s) for s in spread.values()) <= sum(-(-n // 10) for n in copies) + 2


def doubled(spark, rows):
    """Rows with null ids, repeated ids and repeated rows."""
    more = [(None, f"{i} " * (i % 7 + 1), "en", "a", 0) for i in range(40)] + [(5, f"{i} x", "en", None, 0) for i in range(20)] + [(6, "same text", "en", "b", 0)] * 2500
    return spark.createDataFrame(rows + more, "doc_id long, text string, lang string, source string, n_chars long")


def test_reruns_agree(spark, rows):
    frame = doubled(spark, rows)
    for make in (mix, mixed, lambda d: shard(d, 7)):
        first, second = (Counter(map(tuple, make(d).collect())) for d in (frame, frame.repartition(5, "text").orderBy("text")))
        assert first == second
    assert sum(Counter(map(tuple, shard(frame, 7).collect())).values()) == frame.count()
    want = Counter()
    for r in mix(frame).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    got = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in mixed(frame).collect())
    assert got == Counter({k: n for k, n in want.items() if n})


def test_prefix_sums_in_levels(spark, monkeypatch):
    """With windows of four rows at most on average, over several levels of blocks."""
    monkeypatch.setattr(prefix, "BLOCK_BITS", 2)
    frame = spark.range(3000).selectExpr("id % 2 AS k", "id", "id % 5 AS v", "xxhash64(id) AS h")
    got = {r.id: r.before for r in prefix.running_sum(frame, ["k"], F.col("v"), ["h", "id"], 3000, "before").collect()}
    want, at = {}, Counter()
    for r in sorted(frame.collect(), key=lambda r: r.h):
        want[r.id] = at[r.k]
        at[r.k] += r.v
    assert got == want


def test_cut_edges(spark):
    rows = [(i, f"t{i % 3}") for i in range(30)] + [(100, None), (101, "alone")]
    made = shard(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    by = Counter((r.text_md5, r.shard) for r in made if r.text_md5)
    inside = sum(n * (n - 1) // 2 for n in by.values())
    got = cut_edges(spark.createDataFrame([(r.text_md5, r.shard) for r in made], "text_md5 string, shard int")).first()
    assert (int(got.links), int(got.cut)) == (3 * 45, 3 * 45 - inside)
    assert cut_edges(shard(spark.createDataFrame([], "doc_id long, text string"))).first().links == 0


def test_few_rows(spark, none):
    got = shard(spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "doc_id long, text string"), 40).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(0, 0), (1, 0), (2, 0)]
    assert shard(none).count() == 0 and mix(none).count() == 0 and mixed(none).count() == 0


def test_broadcasts_are_bounded(spark, monkeypatch):
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    frame = spark.createDataFrame([(1, "four"), (2, None)], "id long, text string")
    assert "hint" in plan(sizes.small(frame)).lower() and "hint" not in plan(sizes.small(frame, 1)).lower()
    monkeypatch.setattr(sizes, "BROADCAST_BYTES", 3)
    assert "hint" not in plan(sizes.small(frame)).lower()
