"""Near-duplicate detection: universal-hash minima, banding, verification, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textscan as ts
from tidemark.llm.components import components
from tidemark.llm.prefix import running_sum
from tidemark.llm.scratch import arrow, cut, scope, table
from tidemark.llm.sizes import small

_U = np.uint64
MISSED = 1e-5  # the greatest probability that a pair at the limit shares no band
MOST_ROWS = 8
BLOCK_SHINGLES = 60_000  # in a block of representatives; one longer text is a block of its own
WIDE_ROWS = 100_000  # rows of an id, an MD5 and two numbers in a broadcast: 20 MB at most


@dataclass(frozen=True)
class NearDup:
    """words: shingle length; a link needs 100 * |A & B| >= percent * |A | B|; minima: hash functions, in bands.

    A band has as many minima as let a pair at the limit share no band with probability MISSED at most; with 128 minima
    that is 4 in 32 bands at 75 %, 2 in 64 at 50 %, 7 in 18 at 90 %. A limit so low that bands of one cannot keep that bound is
    refused. Before sets are compared, pairs whose share of equal minima is six standard deviations below the limit are left out.
    """

    words: int = 5
    percent: int = 75
    minima: int = 128

    def __post_init__(self) -> None:
        if not 0 < self.percent <= 100 or self._missed(1) > MISSED:
            raise ValueError(f"{self.minima} minima cannot find pairs at {self.percent} %")

    def _missed(self, rows: int) -> float:
        return (1 - (self.percent / 100) ** rows) ** (self.minima // rows)

    @property
    def rows(self) -> int:
        """Minima in a band."""
        return max(r for r in range(1, self.minima + 1) if self._missed(r) <= MISSED and (r <= MOST_ROWS))

    @property
    def loose(self) -> float:
        s = self.percent / 100
        return max(0.0, math.floor(100 * (s - 6 * math.sqrt(s * (1 - s) / self.minima))) / 100)


def _distinct(chunk: ts.Chunk, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, end to end; the same shingles' second hashes; n + 1 offsets."""
    begin, text = ts.window_starts(chunk.at, words)
    hashes, seconds = (ts.sequence_hash(chunk.code, begin, words, k) for k in (0, 1))
    n = np.diff(chunk.at)
    cut_at = np.searchsorted(text, np.arange(chunk.n + 1))
    parts, sizes = [], np.zeros(chunk.n + 1, np.int64)
    for i in range(chunk.n):
        own, second = hashes[cut_at[i] : cut_at[i + 1]], seconds[cut_at[i] : cut_at[i + 1]]
        if 0 < n[i] < words:
            own, second = (ts.sequence_hash(chunk.code, chunk.at[i : i + 1], int(n[i]), k) for k in (0, 1))
        elif len(own) > 1:
            order = np.argsort(own, kind="stable")
            own, second = own[order], second[order]
            new = np.concatenate(([True], own[1:] != own[:-1]))
            own, second = own[new], second[new]
        parts.append((own, second))
        sizes[i + 1] = len(own)
    flat = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, _U)] * 2
    return flat[0], flat[1], np.cumsum(sizes)


def _signatures(values: np.ndarray, seconds: np.ndarray, offsets: np.ndarray, minima: int) -> tuple[np.ndarray, np.ndarray]:
    """For the non-empty sets: minima as uint32 (sets x minima), and two sums of unlike hashes that name the set."""
    rng = np.random.default_rng(20240229)
    a = rng.integers(1, 1 << 63, minima, dtype=np.int64).astype(_U) * _U(2) + _U(1)
    b = rng.integers(0, 1 << 63, minima, dtype=np.int64).astype(_U)
    begin = offsets[:-1][np.diff(offsets) > 0]
    out, work = np.empty((len(begin), minima), np.uint32), np.empty_like(values)
    for k in range(minima):
        np.multiply(values, a[k], out=work)
        np.add(work, b[k], out=work)
        out[:, k] = (np.minimum.reduceat(work, begin) >> _U(32)).astype(np.uint32)
    names = np.stack([np.add.reduceat(values, begin), np.add.reduceat(seconds, begin)])
    return out, names


def _fixed_binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    n, width = rows.shape[0], rows.shape[1] * rows.itemsize if rows.ndim == 2 else 0
    offsets = (np.arange(n + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def signatures(docs: DataFrame, spec: NearDup = NearDup(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, n, key_a, key_b, sig): MD5 of the text, set size, 128 bits that name the set, minima. n is 0 (the last three
    null) without words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in ts.chunks(batch.column(2), ts.SPACE_WORDS_LOWER):
                values, seconds, offsets = _distinct(chunk, spec.words)
                n = np.diff(offsets)
                sig, names = _signatures(values, seconds, offsets, spec.minima)
                row = np.cumsum(n > 0) - 1
                take = pa.array(row, mask=n == 0)
                part = batch.slice(chunk.first, chunk.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), *(pa.array(x.view(np.int64)).take(take) for x in names), _fixed_binary(sig).take(take)],
                    ["doc_id", "mark", "n", "key_a", "key_b", "sig"],
                )

    return arrow(_source(docs, id_col, text_col), scan, "doc_id long, mark string, n long, key_a long, key_b long, sig binary")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.md5(text.cast("binary")).alias("mark"), text.alias("text"))


def _alike(pairs: DataFrame, classes: DataFrame, spec: NearDup) -> DataFrame:
    """Pairs (u, v) that may pass: sizes allow it and enough minima are equal."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for k in (2, 3))
                yield batch.select([0, 1]).filter(pa.array((x == y).mean(axis=1) >= spec.loose))

    left = classes.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("sig").alias("sig_u"))
    right = classes.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("sig").alias("sig_v"))
    near = (
        pairs.join(left, "u")
        .join(right, "v")
        .where(100 * F.least("n_u", "n_v") >= spec.percent * F.greatest("n_u", "n_v"))
        .select("u", "v", "sig_u", "sig_v")
    )
    return arrow(near, scan, "u long, v long")


def _shingles(texts: list[pa.Array], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(number, text) of the distinct shingles of arrays of texts that follow each other, sorted; numbers tell sequences apart
    word by word. Texts of fewer words have none: they are linked with nothing but their own class."""
    known, ids, counts = {}, [], [np.zeros(1, np.int64)]
    for array in texts:
        for chunk in ts.chunks(array, ts.SPACE_WORDS_LOWER):
            ids.append(ts.exact_ids(chunk.words(0, len(chunk.code)), known))
            counts.append(np.diff(chunk.at))
    number, text = ts.exact_windows(np.concatenate(ids) if ids else np.empty(0, np.int64), np.cumsum(np.concatenate(counts)), words)
    order = np.lexsort((text, number))
    number, text = number[order], text[order]
    new = np.ones(len(number), bool)
    new[1:] = (number[1:] != number[:-1]) | (text[1:] != text[:-1])
    return number[new], text[new]


def _slices(batch: pa.RecordBatch, columns: list[int]) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about a chunk of text bytes."""
    total, at = np.cumsum(sum(pc.binary_length(batch.column(k)).to_numpy(zero_copy_only=False).astype(np.int64) for k in columns)), 0
    while at < batch.num_rows:
        after = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + ts.CHUNK_BYTES, "right")))
        yield batch.slice(at, after - at)
        at = after


def _links(pairs: DataFrame, texts: DataFrame, spec: NearDup) -> DataFrame:
    """Pairs (u, v) whose whole shingle sets, compared word by word, meet the similarity."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, [2, 3]) if batch.num_rows else ():
                n = part.num_rows
                number, text = _shingles([part.column(2), part.column(3)], spec.words)
                size, pair = np.bincount(text, minlength=2 * n), text % n
                order = np.lexsort((number, pair))
                twice = (number[order][1:] == number[order][:-1]) & (pair[order][1:] == pair[order][:-1])
                same = np.bincount(pair[order][1:][twice], minlength=n)
                good = (same > 0) & (100 * same >= spec.percent * (size[:n] + size[n:] - same))
                yield part.select([0, 1]).filter(pa.array(good))

    left = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    return arrow(pairs.join(left, "u").join(right, "v").select("u", "v", "text_u", "text_v"), scan, "u long, v long")


def _rest(met: DataFrame, label: DataFrame, texts: DataFrame, spec: NearDup) -> DataFrame:
    """Links (u, v) between different components that still share a band, enough of them to join what they join.

    Representatives are packed into blocks of bounded size, near ones together; blocks that meet in a band with different
    components are compared whole, exactly and in place, so that no pair is written out unless it is a link.
    """
    here = met.join(label, "node")
    live = here.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("band")
    here = cut(here.join(live, "band"))
    members = cut(here.select("node", "near", "comp").distinct().join(texts, "node"))
    sized = members.select("node", "near", "n", F.xxhash64("node").alias("h"))
    placed = running_sum(sized, ["near"], F.col("n"), "h", sized.count(), "before")
    block_of = cut(placed.select("node", F.xxhash64("near", F.floor(F.col("before") / BLOCK_SHINGLES)).alias("block")).distinct())
    blocks = table(
        members.join(block_of, "node").groupBy("block").agg(F.collect_list(F.struct("node", "comp", "text")).alias("rows")).withColumn(
            "rows", F.struct(F.col("rows.node").alias("node"), F.col("rows.comp").alias("comp"), F.col("rows.text").alias("text"))
        ),
        "blocks",
    )
    spots = cut(here.join(block_of, "node").groupBy("band", "block").agg(F.min("comp").alias("low"), F.max("comp").alias("high")))
    a, b = spots.alias("a"), spots.alias("b")
    differ = F.least("a.low", "b.low") < F.greatest("a.high", "b.high")
    meet = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.block") <= F.col("b.block")) & differ).select(F.col("a.block").alias("x"), F.col("b.block").alias("y")).distinct()
    both = meet.join(blocks.select(F.col("block").alias("x"), F.col("rows").alias("left")), "x").join(blocks.select(F.col("block").alias("y"), F.col("rows").alias("right")), "y")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1)):
                found = _between(left.as_py(), right.as_py(), spec)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["u", "v"])

    return arrow(both.select("left", "right"), scan, "u long, v long").distinct()


def _between(left: dict, right: dict, spec: NearDup) -> list[tuple[int, int]]:
    """Links that join different components of two blocks: whole sets are intersected, word by word, and a link is left out
    only if the links before it already join its ends."""
    n = len(left["text"])
    number, text = _shingles([pa.array(left["text"], pa.string()), pa.array(right["text"], pa.string())], spec.words)
    value, owner = number[text >= n], text[text >= n] - n  # sorted by number
    size = np.bincount(owner, minlength=len(right["text"]))
    order = np.argsort(text, kind="stable")
    own_at = np.searchsorted(text[order], np.arange(n + 1))
    top = {c: c for c in {*left["comp"], *right["comp"]}}

    def root(c: int) -> int:
        while top[c] != c:
            top[c] = top[top[c]]
            c = top[c]
        return c

    found = []
    for i, (node, comp) in enumerate(zip(left["node"], left["comp"])):
        own = number[order[own_at[i] : own_at[i + 1]]]
        begin, end = np.searchsorted(value, own, "left"), np.searchsorted(value, own, "right")
        count = end - begin
        at = np.repeat(begin - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum()) if len(own) else np.empty(0, np.int64)
        same = np.bincount(owner[at], minlength=len(size))
        for j in np.flatnonzero((same > 0) & (100 * same >= spec.percent * (len(own) + size - same))).tolist():
            p, q = root(comp), root(right["comp"][j])
            if p != q:
                top[p] = q
                found.append((node, right["node"][j]))
    return found


def _judged(docs: DataFrame, spec: NearDup, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, n, first) of each row: first is the least (doc_id, mark) of its component; null without an id or words."""
    with scope(docs.sparkSession):
        return table(_components_of(docs, spec, id_col, text_col), "near-duplicates", outer=True)


def _components_of(docs: DataFrame, spec: NearDup, id_col: str, text_col: str) -> DataFrame:
    signed = table(signatures(docs, spec, id_col, text_col), "signatures")
    full = signed.where("n > 0 and doc_id is not null")
    classes = full.groupBy("key_a", "key_b", "n").agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.min("sig").alias("sig"))
    classes = table(classes.withColumn("node", F.monotonically_increasing_id()), "classes")  # numbers are fixed once written
    rows = spec.rows
    band = F.posexplode(F.array(*(F.xxhash64(F.substring("sig", 4 * rows * k + 1, 4 * rows), F.lit(k)) for k in range(spec.minima // rows))))
    spread = classes.select("node", band).select(F.col("col").alias("band"), "node")
    shared = spread.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("band", "low")
    met = table(spread.join(shared, "band"), "bands")
    some = cut(met.groupBy("node").agg(F.min("low").alias("near")))
    known = classes.join(small(some.select("node")), "node", "left_semi")
    wanted = cut(known.select("node", "n", "first.doc_id", "first.mark"))
    texts = table(_source(docs, id_col, text_col).join(small(wanted, WIDE_ROWS), ["doc_id", "mark"]).select("node", "n", "text"), "near-texts")
    if texts.count() > wanted.count():  # rows that repeat id and text
        texts = table(texts.dropDuplicates(["node"]), "near-texts")
    pivots = met.where("node <> low").select(F.col("low").alias("u"), F.col("node").alias("v")).distinct()
    links = cut(_links(cut(_alike(pivots, known, spec)), texts, spec))
    comps = components(links)
    label = cut(some.join(comps, "node", "left").select("node", "near", F.coalesce("component", "node").alias("comp")))
    links = links.unionByName(cut(_rest(met.select("band", "node"), label, texts, spec)))
    label = cut(components(links).join(classes.select("node", "first"), "node"))
    least = label.groupBy("component").agg(F.min("first").alias("least"))
    label = cut(label.join(least, "component").select("node", "least"))
    named = cut(classes.select("key_a", "key_b", "n", "node", "first").join(label, "node", "left").select("key_a", "key_b", "n", F.coalesce("least", "first").alias("first")))
    placed = full.select("doc_id", "mark", "n", "key_a", "key_b").join(named, ["key_a", "key_b", "n"]).select("doc_id", "mark", "n", "first")
    return placed.unionByName(signed.where("n = 0 or doc_id is null").select("doc_id", "mark", "n", F.lit(None).cast(placed.schema["first"].dataType).alias("first")))


def near_duplicates(docs: DataFrame, spec: NearDup = NearDup(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept (is that one).

    Documents with equal shingle sets (named by 128 bits) are one class, so copies never become pairs. Class representatives
    meet in bands; in each band its smallest is compared with the rest, and where a band then still holds more than one
    component, bounded blocks of representatives are compared across components, so that no link between components
    is lost and none is expanded within a group. Every accepted link was confirmed on the words of the whole shingle sets.

    Null or empty texts have n_shingles 0 and link with nothing; null ids give one row each with null component
    and kept true; rows of one id with different texts are documents of their own under that id; repeated rows stay rows of
    one component; other columns are ignored; an empty table gives no rows.
    """
    component = F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return _judged(docs, spec, id_col, text_col).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def without_near_duplicates(docs: DataFrame, spec: NearDup = NearDup()) -> DataFrame:
    """docs with one row of each component: the one of the smallest doc_id, then of the smallest MD5 of its text; columns stay as
    they are. Rows without id or words link with nothing and all stay; of rows that repeat id and text one stays, the
    least by its other columns; an empty table gives no rows."""
    found = _judged(docs, spec).where("first is not null")
    own = F.struct("doc_id", "mark")
    gone = table(found.where(own != F.col("first")).select(F.col("doc_id").alias("_gone"), F.col("mark").alias("_mark")).distinct(), "gone")
    keyed = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_own": F.md5(F.col("text").cast("string").cast("binary"))})
    left = keyed.join(small(gone, WIDE_ROWS), (F.col("_id") == F.col("_gone")) & (F.col("_own") == F.col("_mark")), "left_anti")
    twins = table(found.where(own == F.col("first")).groupBy("doc_id", "mark").count().where("count > 1").select(F.col("doc_id").alias("_twin"), F.col("mark").alias("_of")), "twins")
    if twins.isEmpty():
        return left.select(*docs.columns)
    same = (F.col("_id") == F.col("_twin")) & (F.col("_own") == F.col("_of"))
    rest = F.to_json(F.struct(*(c for c in docs.columns if c != "text")), {"ignoreNullFields": "false"})
    order = Window.partitionBy("_id", "_own").orderBy("_row")
    many = left.join(small(twins, WIDE_ROWS), same, "left_semi").withColumn("_row", rest).withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return left.join(small(twins, WIDE_ROWS), same, "left_anti").select(*docs.columns).unionByName(many.select(*docs.columns))
