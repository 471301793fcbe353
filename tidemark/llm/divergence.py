"""How the vocabulary of a source differs from other sources of its language and from the language.

Terms are counted in two passes. The first keeps no terms: each task fills one count-min sketch with document frequencies
of (language, term), and the merged sketch, which never underestimates, tells which terms cannot be frequent enough. The
second pass leaves those out before anything is shuffled, and the rest are counted exactly. Divergences of pairs of sources then come from
a join of the terms that both have; terms that only one or neither has are counted, not listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textscan as ts
from tidemark.llm.scratch import arrow, scope, table
from tidemark.llm.sizes import small

DEPTH = 4
WIDTH_BITS = 20  # of the number of counters in a row of the sketch, one byte each in a task and one bit each when broadcast
BLOCK_BITS = 14  # counters of a row that travel together
MOST = 255  # where a counter stays; min_docs must not be above it
TERM_WORDS = ts.byte_table(bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)
PER_BILLION = 1_000_000_000


def _distinct(chunk: ts.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(of each word its number, of each number a word's place): words are told apart by their bytes, not by their codes alone."""
    codes, first, which = np.unique(chunk.code, return_index=True, return_inverse=True)
    size = chunk.end - chunk.start
    same = size == size[first][which]
    long = np.flatnonzero(same & (size > ts.SHORT))
    same[long] = ts.equal_words(chunk.shown, chunk.start[long], chunk.shown, chunk.start[first[which[long]]], size[long])
    odd = np.flatnonzero(~same)
    if len(odd):  # words that share a code with another
        own = ts.exact_ids([chunk.shown[a:b].tobytes() for a, b in zip(chunk.start[odd].tolist(), chunk.end[odd].tolist())], {})
        _, at = np.unique(own, return_index=True)
        which[odd] = len(codes) + own
        first = np.concatenate((first, odd[at]))
    return which, first


def _groups(*columns: pa.Array) -> tuple[np.ndarray, list[tuple]]:
    """(of each row its number, of each number the values)."""
    known: dict[tuple, int] = {}
    rows = zip(*(c.to_pylist() for c in columns))
    return np.fromiter((known.setdefault(r, len(known)) for r in rows), np.int64, len(columns[0])), list(known)


def _cells(code: np.ndarray, lang: np.ndarray, width_bits: int) -> np.ndarray:
    """Counters of (language, term), a row of the sketch in each row."""
    mixed = ts.mix(code ^ lang)
    again = ts.mix(mixed + np.uint64(0x9E3779B97F4A7C15))
    mask = np.uint64((1 << width_bits) - 1)
    half = np.uint64(32)
    return np.stack([(x & mask).astype(np.int64) for x in (mixed, mixed >> half, again, again >> half)][:DEPTH])


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs], np.uint64)


def _occurrences(chunk: ts.Chunk, lang: np.ndarray) -> tuple[np.ndarray, ...]:
    """(language, word number, documents) of each distinct pair in a chunk, and the place of each word number."""
    which, first = _distinct(chunk)
    text, n = np.repeat(np.arange(chunk.n), np.diff(chunk.at)), max(len(first), 1)
    pairs = np.unique(text * n + which)
    terms, docs = np.unique(lang[pairs // n] * n + pairs % n, return_counts=True)
    return terms // n, terms % n, docs, first


def document_frequency_sketch(docs: DataFrame, width_bits: int = WIDTH_BITS) -> DataFrame:
    """Blocks (block, cells) of the merged count-min sketch of document frequencies in docs (lang, text), counters to MOST."""
    size = 1 << min(BLOCK_BITS, width_bits)
    blocks = (DEPTH << width_bits) // size

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(DEPTH << width_bits, np.uint8)
        for batch in batches:
            lang, langs = _groups(batch.column(0))
            hashes = _lang_hashes([x[0] for x in langs])
            for chunk in ts.chunks(batch.column(1), TERM_WORDS):
                if not len(chunk.code):
                    continue
                of, word, n, first = _occurrences(chunk, lang[chunk.first : chunk.first + chunk.n])
                cells = _cells(chunk.code[first[word]], hashes[of], width_bits)
                for row in range(DEPTH):
                    at, inverse = np.unique(cells[row], return_inverse=True)
                    at += row << width_bits
                    counters[at] = np.minimum(counters[at] + np.bincount(inverse, n).astype(np.int64), MOST)
        used = np.flatnonzero(counters.reshape(blocks, size).any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([counters[b * size : (b + 1) * size].tobytes() for b in used], pa.binary())], ["block", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(cells.as_buffer(), np.uint8)
                held[block] = np.minimum(held[block].astype(np.int64) + own, MOST).astype(np.uint8) if block in held else own.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([c.tobytes() for c in held.values()], pa.binary())], ["block", "cells"])

    schema = "block int, cells binary"
    return arrow(arrow(docs.select("lang", "text"), fill, schema).repartition("block"), merge, schema)


def possible_cells(sketch: DataFrame, least: int, width_bits: int = WIDTH_BITS) -> np.ndarray:
    """One bit a counter, set where it is at least `least`: DEPTH << width_bits bits (512 KB at 20) whatever the corpus."""
    bits = np.zeros((DEPTH << width_bits) // 8, np.uint8)
    packed = F.udf(lambda cells: np.packbits(np.frombuffer(cells, np.uint8) >= least, bitorder="little").tobytes(), "binary")  # a few hundred blocks
    for row in sketch.select("block", packed("cells").alias("bits")).toLocalIterator():
        own = np.frombuffer(row.bits, np.uint8)
        bits[row.block * len(own) : (row.block + 1) * len(own)] = own
    return bits


def term_counts(docs: DataFrame, min_docs: int, width_bits: int = WIDTH_BITS) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term that can be in min_docs documents of its language,
    by source. Counts are exact; terms that the sketch of all documents rules out are left out before the shuffle."""
    bits = docs.sparkSession.sparkContext.broadcast(possible_cells(document_frequency_sketch(docs, width_bits), min_docs, width_bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bits.value
        for batch in batches:
            lang, langs = _groups(batch.column(0))
            hashes = _lang_hashes([x[0] for x in langs])
            group, groups = _groups(batch.column(0), batch.column(1))
            for chunk in ts.chunks(batch.column(2), TERM_WORDS):
                if not len(chunk.code):
                    continue
                which, first = _distinct(chunk)
                here, n = slice(chunk.first, chunk.first + chunk.n), max(len(first), 1)
                text = np.repeat(np.arange(chunk.n), np.diff(chunk.at))
                pairs, times = np.unique(text * n + which, return_counts=True)  # of a document and a term
                doc, word = pairs // n, pairs % n
                cells = _cells(chunk.code[first[word]], hashes[lang[here][doc]], width_bits) + (np.arange(DEPTH) << width_bits)[:, None]
                possible = (held[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).all(axis=0)
                doc, word, times = doc[possible], word[possible], times[possible]
                if not len(doc):
                    continue
                keys, inverse = np.unique(group[here][doc] * n + word, return_inverse=True)
                words, at = np.unique(keys % n, return_inverse=True)
                names = pa.array([chunk.shown[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(chunk.start[first[words]].tolist(), chunk.end[first[words]].tolist())], pa.string())
                of = pa.array(keys // n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in groups], pa.string()).take(of), pa.array([g[1] for g in groups], pa.string()).take(of), names.take(pa.array(at)),
                     pa.array(np.bincount(inverse, times).astype(np.int64)), pa.array(np.bincount(inverse).astype(np.int64))],
                    ["lang", "source", "term", "n", "docs"],
                )

    rows = arrow(docs.select("lang", "source", "text"), count, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(1e9 * (count + 2) / (total + 2 * kept)), in two steps of long division, so exact for counts to 9e13."""
    whole = total + 2 * kept
    a, step, rest = (count + 2) * 100_000, lambda x: F.call_function("div", x, whole), 10_000
    return 1 + step(a) * rest + step((a % whole) * rest)


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / (p + q)); the square is at most 1e18."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_divergence(docs: DataFrame, min_docs: int = 10, top: int = 10, width_bits: int = WIDTH_BITS) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs (lang, source, text), null columns read as empty.

    The kept terms of a language are those in at least min_docs of its documents (rows). Part `pair` compares a source with every
    other source of the language over all kept terms, the most divergent first; part `term` gives the `top` kept terms that
    a source has and uses more than its language does. Sources without terms are compared like others, with nothing but the smoothing; a language
    without kept terms gives pairs of value 0; an empty table gives no rows; repeated rows count as often as they stand.
    The sketch has DEPTH rows of 2 ** width_bits counters: a narrow one leaves less out and changes no result.
    """
    if not 1 <= min_docs <= MOST:
        raise ValueError(f"min_docs must be 1 to {MOST}")
    read = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    docs = docs.select(*read)
    with scope(docs.sparkSession):
        counted = table(term_counts(docs, min_docs, width_bits), "term-counts")
        found = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
        found = table(found.drop("docs"), "term-kept")
        kept = found.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
        terms = table(counted.drop("docs").join(found, ["lang", "term"]), "term-sources")
        totals = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
        groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
        zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
        groups = groups.select("lang", "source", *(zero(c) for c in ("total", "own", "kept", "lang_total")))
        groups = table(groups.withColumn("p0", F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept"))).otherwise(0)), "term-groups")
        shared = terms.join(small(groups.drop("own")), ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("kept")))
        return table(_pairs(groups, shared).unionByName(_terms(shared, top)), "divergence", outer=True)


def _pairs(groups: DataFrame, shared: DataFrame) -> DataFrame:
    """Part `pair`. Over all kept terms, f(p, q) is summed as if no term were in both sources, and set right for those that are."""
    a = groups.select("lang", "source", F.col("own").alias("own_a"), F.col("p0").alias("a0"), "kept")
    b = groups.select("lang", F.col("source").alias("item"), F.col("own").alias("own_b"), F.col("p0").alias("b0"))
    pairs = a.join(b, "lang").where(F.col("source") != F.col("item"))  # what the result lists
    # terms of one source with the same count have the same share
    levels = table(shared.groupBy("lang", "source", "p").agg(F.count("*").alias("terms")), "shares")
    alone = lambda left, right, base: (
        levels.withColumnRenamed("source", left).join(groups.select("lang", F.col("source").alias(right), F.col("p0").alias(base)), "lang").where(F.col(left) != F.col(right))
        .groupBy("lang", left, right).agg(F.sum(_apart(F.col("p"), F.col(base)) * F.col("terms")).alias("alone"))
    )
    one = alone("source", "item", "q0")
    x = shared.select("lang", "term", "source", F.col("p").alias("p"), F.col("p0").alias("pa"))
    y = shared.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("qb"))
    # f is symmetric: each pair of sources is joined once
    both = x.join(y, ["lang", "term"]).where(F.col("source") < F.col("item"))
    p, q, pa_, qb = (F.col(c) for c in ("p", "q", "pa", "qb"))
    both = table(both.groupBy("lang", "source", "item").agg(F.sum(_apart(p, q) - _apart(p, qb) - _apart(pa_, q) + _apart(pa_, qb)).alias("both")), "shared-terms")
    mirrored = both.unionByName(both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "both"))
    other = one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("alone").alias("alone_b"))
    key = ["lang", "source", "item"]
    none = F.when(F.col("kept") > 0, (F.col("kept") - F.col("own_a") - F.col("own_b")) * _apart(F.col("a0"), F.col("b0"))).otherwise(0)
    found = pairs.join(one, key, "left").join(other, key, "left").join(mirrored, key, "left")
    value = none + sum((F.coalesce(c, F.lit(0)) for c in ("alone", "alone_b", "both")), F.lit(0))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")).withColumn("rank", F.row_number().over(order))


def _terms(shared: DataFrame, top: int) -> DataFrame:
    """Part `term`."""
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    more = shared.withColumn("q", q).where(F.col("p") > F.col("q"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rows = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).cast("long").alias("value"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
