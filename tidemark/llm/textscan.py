"""Vectorised word hashing for Arrow batches of texts.

A batch's UTF-8 bytes are scanned as one numpy array: a 256-entry table tells word bytes from separators and lower-cases
A-Z where asked. A word of up to SHORT bytes is known by those bytes and their number, so no two share a code; a longer one
by a hash of its eight-byte parts. Hashes of word sequences are trees of mixed pairs, in two independent families. None is
a polynomial, and operators whose result is about words compare the words where hashes have found the place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

_U = np.uint64
SHORT = 7  # bytes that fit a code beside their number
CHUNK_BYTES = 2 << 20  # text bytes scanned at once; one longer text is a chunk of its own
LONG = 64  # bytes of a word beyond which it is digested apart from the others


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def byte_table(separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each byte, whether it belongs to a word, and the byte that stands for it."""
    inside, shown = np.ones(256, bool), np.arange(256, dtype=np.uint8)
    inside[list(separators)] = False
    if lower:
        shown[65:91] += 32
    return inside, shown


SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
SPACE_WORDS = byte_table(SPACES, lower=False)
SPACE_WORDS_LOWER = byte_table(SPACES, lower=True)
ALNUM_WORDS_LOWER = byte_table(NOT_ALNUM, lower=True)


@dataclass
class Chunk:
    """Words of texts first .. first + n - 1 of a batch."""

    first: int
    n: int
    data: np.ndarray  # the texts' bytes
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    code: np.ndarray  # of each word
    at: np.ndarray  # words of text i: at[i] .. at[i + 1]
    cut: np.ndarray  # bytes of text i: cut[i] .. cut[i + 1]
    shown: np.ndarray  # the bytes with their letters lower-cased where asked, then seven zeros

    def text_bytes(self, i: int) -> tuple[int, int]:
        return int(self.cut[i]), int(self.cut[i + 1])

    def words(self, first: int, last: int) -> list[bytes]:
        """Words first .. last - 1."""
        if first >= last:
            return []
        low = int(self.start[first])
        held = self.shown[low : self.end[last - 1]].tobytes()
        return [held[a:b] for a, b in zip((self.start[first:last] - low).tolist(), (self.end[first:last] - low).tolist())]


def _eight(padded: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, of bytes that seven zeros follow."""
    return np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))


def _low(size: np.ndarray) -> np.ndarray:
    """Masks of the first `size` bytes, seven at most."""
    return (_U(1) << (size.astype(_U) * _U(8))) - _U(1)


def _long_codes(padded: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of words of more than SHORT bytes, eight bytes after eight; of very long ones a digest."""
    eight, code = _eight(padded), mix(size.astype(_U) + _U(0x5851F42D4C957F2D))
    live, done = np.flatnonzero(size <= LONG), 0
    while len(live):
        left = size[live] - done
        part = eight[start[live] + done]
        part = np.where(left < 8, part & _low(np.minimum(left, SHORT)), part)
        code[live] = mix((code[live] ^ part) * _U(0x9FB21C651E98DF25) + _U(done))
        done += 8
        live = live[left > 8]
    for i in np.flatnonzero(size > LONG).tolist():
        code[i] = int.from_bytes(blake2b(padded[start[i] : start[i] + size[i]].tobytes(), digest_size=8).digest(), "little")
    return code


def equal_words(a: np.ndarray, start_a: np.ndarray, b: np.ndarray, start_b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether words of the same size, in bytes a and b that seven zeros follow, are equal."""
    eight_a, eight_b, out = _eight(a), _eight(b), np.ones(len(size), bool)
    live, done = np.flatnonzero(size <= LONG), 0
    while len(live):
        left = size[live] - done
        differ = eight_a[start_a[live] + done] ^ eight_b[start_b[live] + done]
        out[live] = np.where(left < 8, differ & _low(np.minimum(left, SHORT)), differ) == 0
        done += 8
        live = live[(left > 8) & out[live]]
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = np.array_equal(a[start_a[i] : start_a[i] + size[i]], b[start_b[i] : start_b[i] + size[i]])
    return out


def _bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the n + 1 offsets of a string array; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data, offsets


def chunks(texts, table: tuple[np.ndarray, np.ndarray]) -> Iterator[Chunk]:
    """Scan a string array in chunks of about CHUNK_BYTES."""
    if len(texts) == 0:
        return
    data, offsets = _bytes(texts)
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        yield _chunk(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], table)
        first = last


def _edges(data: np.ndarray, cut: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie end to end."""
    inside = inside[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = np.unique(cut[(cut > 0) & (cut < len(data))])
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _chunk(first: int, data: np.ndarray, cut: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> Chunk:
    n, none = len(cut) - 1, np.empty(0, np.int64)
    if not len(data):
        return Chunk(first, n, data, none, none, np.empty(0, _U), np.zeros(n + 1, np.int64), cut, data)
    start, end = _edges(data, cut, table[0])
    padded, size = np.zeros(len(data) + 7, np.uint8), end - start
    np.take(table[1], data, out=padded[: len(data)])
    short = np.minimum(size, SHORT)
    code = (_eight(padded)[start] & _low(short)) | (short.astype(_U) << _U(56))
    long = np.flatnonzero(size > SHORT)
    code[long] = _long_codes(padded, start[long], size[long])
    return Chunk(first, n, data, start, end, code, np.searchsorted(start, cut).astype(np.int64), cut, padded)


_FAMILIES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def sequence_hash(code: np.ndarray, begin: np.ndarray, length: int, family: int = 0) -> np.ndarray:
    """Hashes of the sequences of `length` words that begin at `begin`."""
    left, right = (_U(x) for x in _FAMILIES[family])

    def pairs(x: np.ndarray, y: np.ndarray, apart: int) -> np.ndarray:
        """Of the sequences in x followed, `apart` words on, by those in y."""
        n = max(0, min(len(x), len(y) - apart))
        return mix(x[:n] * left + y[apart : apart + n] * right + _U(apart))

    power, size, out, have = mix(code + right), 1, None, 0
    while True:
        if length & size:
            out, have = (power, size) if out is None else (pairs(out, power, have), have + size)
        if 2 * size > length:
            return out[begin] if len(begin) else np.empty(0, _U)
        power, size = pairs(power, power, size), 2 * size


def window_starts(at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of `length` words that stay inside one text, and the text of each."""
    count = np.maximum(np.diff(at) - length + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(at[:-1], count), text


def word_counts(texts, separators: bytes) -> np.ndarray:
    """Number of words of each text."""
    data, offsets = _bytes(texts)
    inside, counts, first = byte_table(separators, False)[0], np.zeros(len(offsets) - 1, np.int64), 0
    while first < len(counts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        part, at = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        if len(part):
            counts[first:last] = np.diff(np.searchsorted(_edges(part, at, inside)[0], at))
        first = last
    return counts


def exact_ids(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """A number for each word, the same for the same word, from 0 on."""
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def exact_windows(ids: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(number, text) of each window of `length` words of texts at[i] .. at[i + 1]: equal numbers for equal sequences, told
    apart word by word and not by hashes."""
    begin, text = window_starts(at, length)
    rank, have = ids, 1
    while have < length:
        step = min(have, length - have)  # windows of `have` words, `step` further on, overlap or touch
        pair = np.stack((rank[: len(rank) - step], rank[step:]), axis=1) if len(rank) > step else np.empty((0, 2), np.int64)
        top = int(rank.max()) + 1 if len(rank) else 1
        rank = np.unique(pair[:, 0] * top + pair[:, 1], return_inverse=True)[1] if len(pair) else np.empty(0, np.int64)
        have += step
    return (rank[begin] if len(begin) else np.empty(0, np.int64)), text
