"""Token ids as Parquet list columns: dictionary-encoded ids, delta-encoded offsets, set row groups and pages.

The files hold documents in ascending order of id, so readers can take token ranges or metadata alone: row-group
statistics and page indexes on doc_id and start_in_part prune what a selective read touches.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tidemark.llm import textscan as ts
from tidemark.llm.scratch import arrow, place
from tidemark.llm.sizes import small

CACHE_WORDS = 600_000  # distinct words that a worker keeps, as numbers, 40 bytes each beside their ids; then it starts anew
CACHE_BYTES = 32 << 20  # bytes of those words
CACHE_PIECES = 60_000
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
SCHEMA = "doc_id long, part int, start_in_part long, n_tokens int, tokens array<int>"


def default_tokenizer() -> str:
    """The JSON of the public word_bpe_49k tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


# letters whose lower case and composition are their own, then punctuation but for the apostrophe, which may start a contraction
PLAIN_WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u017e]+)([!-&(-/:-@\[-`{-~]*)")
BYTE_LEVEL = ByteLevel(add_prefix_space=False, use_regex=False)
# fixed values: the steps of a tokenizer that takes runs of letters and of punctuation apart
STEPS = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _splits_letters(spec: dict) -> bool:
    """Whether words of PLAIN_WORD are encoded part by part, in lower case, by a tokenizer of this specification."""
    steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        steps == STEPS and [x["type"] for x in split] == ["Split", "ByteLevel"] and split[0]["pattern"].get("Regex") == PATTERN and split[0]["invert"]
        and not split[1]["add_prefix_space"] and not split[1]["use_regex"] and spec.get("truncation") is None
    )


#: pre-tokenizers that cut at white space and drop it
CUTTING = {"Whitespace", "WhitespaceSplit", "BertPreTokenizer"}


def words_stand_alone(spec: str) -> bool:
    """Whether the ids of a text are those of its white-space-separated words, one after the other, as far as the
    specification tells for sure; tokenizers that keep white space in their tokens are encoded text by text."""
    held = json.loads(spec)
    for token in held.get("added_tokens") or []:
        if token.get("lstrip") or token.get("rstrip") or any(c.isspace() for c in token["content"]):
            return False
    if held.get("truncation") or held.get("padding"):
        return False
    normalizer = (held.get("normalizer") or {}).get("type")
    return _splits_letters(held) or ((held.get("pre_tokenizer") or {}).get("type") in CUTTING and normalizer in (None, "Lowercase", "NFC", "NFD"))


class TextEncoder:
    """Ids of whole texts, by the tokenizer alone; called as WordEncoder is."""

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def __call__(self, texts: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        whole = [t or "" for t in texts.to_pylist()]
        size, first = np.cumsum([len(t) for t in whole]), 0
        while first < len(whole):
            last = max(first + 1, int(np.searchsorted(size, (size[first - 1] if first else 0) + ts.CHUNK_BYTES, "right")))
            found = [e.ids for e in self.tokenizer.encode_batch_fast(whole[first:last], add_special_tokens=False)]
            offsets = np.concatenate(([0], np.cumsum([len(ids) + 1 for ids in found])))
            yield first, np.fromiter((i for ids in found for i in (*ids, end_id)), np.int32, int(offsets[-1])), offsets
            first = last


class WordEncoder:
    """Ids of texts, word by word: the tokenizer drops white space (words_stand_alone), so the ids of a text are those of its
    ASCII-space-separated words one after the other, and each distinct word is encoded once. A word is looked up by its code
    and then compared byte by byte; one that shares its code with another is encoded on its own."""

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        special = sorted((k, t.content) for k, t in self.tokenizer.get_added_tokens_decoder().items() if t.special)
        self.plain = _splits_letters(json.loads(spec))
        self.mark = (special[0][1], special[0][0]) if special else None
        self._forget()

    def _forget(self) -> None:
        self.codes = np.empty(0, np.uint64)
        self.begin, self.size, self.place, self.width = (np.empty(0, np.int64) for _ in range(4))  # of the ids, and of the bytes
        self.ids, self.used = np.empty(1 << 16, np.int32), 0
        self.bytes, self.filled = np.zeros(1 << 16, np.uint8), 0
        self.pieces: dict[str, list[int]] = {}

    def _encoded(self, words: list[str]) -> list[list[int]]:
        """The ids of each word; words are joined by a special token, which keeps them apart and marks their ends."""
        if self.mark is None:
            return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        text, number = self.mark
        odd = {i for i, w in enumerate(words) if text in w}
        joined = text.join("" if i in odd else w for i, w in enumerate(words))
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32)
        cuts = np.flatnonzero(ids == number)
        out = [ids[a:b].tolist() for a, b in zip(np.concatenate(([0], cuts + 1)).tolist(), np.concatenate((cuts, [len(ids)])).tolist())]
        for i in odd:
            out[i] = self.tokenizer.encode(words[i], add_special_tokens=False).ids
        return out

    def _piece(self, piece: str) -> list[int]:
        """The ids of a lower-case run of letters, or of punctuation, which the model takes as one word."""
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) > CACHE_PIECES:
                self.pieces.clear()
            shown = piece if piece.isascii() else BYTE_LEVEL.pre_tokenize_str(piece)[0][0]
            ids = self.pieces[piece] = [t.id for t in self.tokenizer.model.tokenize(shown)]
        return ids

    def _all_ids(self, words: list[str]) -> list[list[int]]:
        """The ids of each word: from its letters and punctuation where it has no other parts, else from the whole tokenizer."""
        if not self.plain:
            return self._encoded(words)
        out, rest = [], []
        for i, word in enumerate(words):
            parts = PLAIN_WORD.fullmatch(word)
            if parts:
                core, ending = parts.groups()
                ids = self._piece(core.lower())
                out.append(ids + self._piece(ending) if ending else ids)
            else:
                out.append(None)
                rest.append(i)
        if rest:
            for i, ids in zip(rest, self._encoded([words[i] for i in rest]), strict=True):
                out[i] = ids
        return out

    def _add_ids(self, all_ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of words are kept from now on, and how many."""
        size = np.fromiter(map(len, all_ids), np.int64, len(all_ids))
        flat = np.fromiter((x for ids in all_ids for x in ids), np.int32, int(size.sum()))
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty(max(len(self.ids), len(flat)), np.int32)))
        self.ids[self.used : self.used + len(flat)] = flat
        begin = self.used + np.cumsum(size) - size
        self.used += len(flat)
        return begin, size

    def _learn(self, codes: np.ndarray, words: list[bytes]) -> None:
        begin, size = self._add_ids(self._all_ids([w.decode("utf-8", "replace") for w in words]))
        held = np.frombuffer(b"".join(words), np.uint8)
        if self.filled + len(held) + 7 > len(self.bytes):
            self.bytes = np.concatenate((self.bytes, np.zeros(max(len(self.bytes), len(held) + 7), np.uint8)))
        self.bytes[self.filled : self.filled + len(held)] = held
        width = np.fromiter(map(len, words), np.int64, len(words))
        place = self.filled + np.cumsum(width) - width
        self.filled += len(held)
        at = np.searchsorted(self.codes, codes)  # codes are sorted and new
        self.codes, self.begin, self.size, self.place, self.width = (
            np.insert(old, at, new) for old, new in ((self.codes, codes), (self.begin, begin), (self.size, size), (self.place, place), (self.width, width))
        )

    def _apart(self, chunk: ts.Chunk, at: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        """Sets begin and size where a word's bytes are not those that its code was learned with."""
        width = chunk.end - chunk.start
        same = width == self.width[at]
        long = np.flatnonzero(same & (width > ts.SHORT))  # shorter words have codes of their own
        same[long] = ts.equal_words(chunk.shown, chunk.start[long], self.bytes, self.place[at[long]], width[long])
        other = np.flatnonzero(~same)
        if len(other):
            words = [chunk.shown[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(chunk.start[other].tolist(), chunk.end[other].tolist())]
            begin[other], size[other] = self._add_ids(self._all_ids(words))

    def __call__(self, texts: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For runs of texts: the first text's place, all ids, each text's followed by end_id, and the run's n + 1 offsets."""
        for chunk in ts.chunks(texts, ts.SPACE_WORDS):
            if len(self.codes) > CACHE_WORDS or self.filled > CACHE_BYTES:
                self._forget()
            words, first, which = np.unique(chunk.code, return_index=True, return_inverse=True)
            near = np.searchsorted(self.codes, words)
            known = np.zeros(len(words), bool)
            inside = near < len(self.codes)
            known[inside] = self.codes[near[inside]] == words[inside]
            fresh = first[~known]
            if len(fresh):
                self._learn(words[~known], [chunk.data[a:b].tobytes() for a, b in zip(chunk.start[fresh].tolist(), chunk.end[fresh].tolist())])
            at = np.searchsorted(self.codes, words)[which]
            begin, size = self.begin[at], self.size[at]
            self._apart(chunk, at, begin, size)
            word_end = np.concatenate(([0], np.cumsum(size)))
            offsets = np.concatenate(([0], np.cumsum(np.diff(word_end[chunk.at]) + 1)))
            out = np.full(offsets[-1], end_id, np.int32)
            room = np.ones(len(out), bool)
            room[offsets[1:] - 1] = False
            out[room] = self.ids[np.arange(word_end[-1]) - np.repeat(word_end[:-1] - begin, size)]
            yield chunk.first, out, offsets


_ENCODERS: dict[str, WordEncoder | TextEncoder] = {}


def encoder_of(spec: str) -> WordEncoder | TextEncoder:
    """The encoder that this worker process keeps from task to task."""
    if spec not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[spec] = WordEncoder(spec) if words_stand_alone(spec) else TextEncoder(spec)
    return _ENCODERS[spec]


def encode(docs: DataFrame, spec: str, end_id: int) -> DataFrame:
    """Rows of SCHEMA in ascending doc_id order over the partitions; start_in_part counts ids within a partition."""
    held = docs.sparkSession.sparkContext.broadcast(spec)  # the tokenizer file, a few MB whatever the input

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, done = encoder_of(held.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, ids, offsets in encoder(batch.column(1), end_id):
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.array(np.full(n, part, np.int32)), pa.array(done + offsets[:-1]), pa.array(np.diff(offsets).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))],
                    ["doc_id", "part", "start_in_part", "n_tokens", "tokens"],
                )
                done += int(offsets[-1])

    text = F.col("text").cast("string")
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return arrow(ordered, scan, SCHEMA)


def write_tokens(docs: DataFrame, path: str, spec: str | None = None, end_id: int = 2) -> None:
    """Encode every whole text of docs (doc_id, text) and write token files to `path`.

    Null and empty texts get the end id alone. Null ids come first; repeated ids follow each other, ordered by text.
    An empty table writes no tokens.
    """
    rows = encode(docs, spec or default_tokenizer(), end_id)
    options = {
        "compression": "zstd", "parquet.writer.version": "v2", "parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES,
        "parquet.page.row.count.limit": 2000, "parquet.enable.dictionary": "true", "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#start_in_part": "false",
    }
    rows.write.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """SCHEMA plus start: the ids of all documents before each, over all files."""
    files = spark.read.schema(SCHEMA).parquet(path)
    ends = files.groupBy("part").agg(F.sum("n_tokens").alias("own"))  # one row a file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = ends.select("part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("shift"))
    return files.join(small(shift), "part").withColumn("start", F.col("shift") + F.col("start_in_part")).drop("shift")


def read_token_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """(start, tokens) of the documents that hold any of the ids first .. last - 1 of the whole order, cut to those: the places of
    all documents are read, then only the row groups and pages of the tokens that the range touches."""
    ends = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("own")).orderBy("part").collect()  # one row a file
    shift, wanted = 0, []
    for row in ends:
        if row.own and shift < last and shift + row.own > first:
            wanted.append((F.col("part") == row.part) & (F.col("start_in_part") < last - shift) & (F.col("start_in_part") + F.col("n_tokens") > first - shift))
            wanted[-1] = (wanted[-1], shift)
        shift += row.own or 0
    files, found = spark.read.schema(SCHEMA).parquet(path), None
    for own, before in wanted:
        start = F.col("start_in_part") + before
        low, high = F.greatest(F.lit(first) - start, F.lit(0)), F.least(F.lit(last) - start, F.col("n_tokens"))
        part = files.where(own).select((start + low).alias("start"), F.slice("tokens", (low + 1).cast("int"), (high - low).cast("int")).alias("tokens"))
        found = part if found is None else found.unionByName(part)
    return found if found is not None else files.where("false").select(F.col("start_in_part").alias("start"), "tokens")


def token_digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows from read_tokens."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            at = lists.offsets.to_numpy()
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = np.fromiter((zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:])), np.int64, len(lists))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return arrow(tokens.select("doc_id", "start", "tokens"), scan, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_round_trip(docs: DataFrame) -> DataFrame:
    """Digests read back from files written to the shared folder."""
    path = place(docs.sparkSession, "tokens")
    write_tokens(docs, path)
    return token_digests(read_tokens(docs.sparkSession, path))
