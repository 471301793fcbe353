import base64
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def pairs():
    return bpe.BytePairs(bpe.read_ranks(bpe.default_ranks()), bpe.default_pattern())


@pytest.fixture(scope="module")
def theirs(pairs):
    return tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=pairs.ranks, special_tokens={})


def ids(pairs, text):
    return [i for got, _ in pairs.encode([text]) for i in got.tolist()]


TEXTS = [
    "", " ", "a", "it's we'll I'M don't", "a  b   c\n\n d \t", "x" * 3000, "ab" * 2000, "\n" * 50, "1234567890 12.5", "<|endoftext|>", "É ü ß 漢字かな 😀😀 👩‍👩‍👧", "\x1c\x1d\x85\xa0 a　b",
    "0x" + "deadbeef" * 200, " !!! ---- ''' '", "a'sb 's 'S",
]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_the_library(pairs, theirs, text):
    assert ids(pairs, text) == theirs.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="aab'st \n1.é漢", max_size=200), st.lists(st.sampled_from(["the", " of", "\n", "  ", "aaaa", "!?", "7"]), max_size=60).map("".join)))
def test_any_text_equals_the_library(pairs, theirs, text):
    got = ids(pairs, text)
    assert got == theirs.encode_ordinary(text)
    assert pairs.decode(np.array(got, np.int64)) == text.encode()


def test_every_character_is_cut_alike(pairs, theirs):
    for first in range(0, 0x110000, 0x400):
        text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}" for c in range(first, first + 0x400) if not 0xD800 <= c < 0xE000)
        assert ids(pairs, text) == theirs.encode_ordinary(text), hex(first)


def test_long_texts_are_cut_in_segments(pairs, theirs, monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice(["word", " ", "  ", "\n", "'s", "1", "!", "longer" * 9, "\n\n \t", "漢"]) for _ in range(5000))
    for size in (7, 64, 1000):
        monkeypatch.setattr(bpe, "SEGMENT", size)
        assert ids(pairs, text) == theirs.encode_ordinary(text)


def test_one_piece_of_a_million_bytes(pairs, theirs):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(300_000)) + "z" * 700_000
    got = ids(pairs, text)
    assert pairs.decode(np.array(got, np.int64)) == text.encode()
    part = text[:20_000]
    assert ids(pairs, part) == theirs.encode_ordinary(part)


def test_ranks_that_fall_while_merging():
    """A vocabulary in which a merge makes a pair of a lower rank than its own."""
    ranks = {bytes([i]): i + 10 for i in range(256)} | {b"ab": 5, b"abc": 1, b"bc": 7, b"ca": 6, b"abca": 0}
    own, ref = bpe.BytePairs(ranks, r"\S+|\s+"), tiktoken.Encoding("t", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    for _ in range(300):
        texts = ["".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 40, 90]))) for _ in range(4)]
        (got, size), want = next(own.encode(texts)), [ref.encode_ordinary(t) for t in texts]
        assert size.tolist() == list(map(len, want)) and got.tolist() == [i for w in want for i in w]
        assert [own.merge(t.encode()) for t in texts] == want
    assert not own.queue


def test_queue_gives_the_lowest_rank():
    rng, queue, held = random.Random(3), bpe.RankQueue(70_000), {}
    for _ in range(3000):
        if held and rng.random() < 0.45:
            assert queue.lowest() == min(held)
            assert queue.take(min(held)) == held.pop(min(held))
        else:
            rank, place = rng.choice([0, 63, 64, 4095, 4096, 69_999, rng.randrange(70_000)]), rng.randrange(100)
            queue.bucket(rank).append(place)
            held.setdefault(rank, []).append(place)
        assert bool(queue) == bool(held)


def test_what_is_kept_starts_anew(pairs, theirs, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 300)
    rng = random.Random(8)
    texts = ["".join(rng.choice(["wordlike", " of", " x1y2", "\n", "abra" * 30, " kadabra"]) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    got = [(ids.tolist(), size.tolist()) for ids, size in pairs.encode([*texts, None])]
    assert len(got) > 20 and [i for ids, _ in got for i in ids] == [i for t in texts for i in theirs.encode_ordinary(t)]
    assert [n for _, size in got for n in size] == [*(len(theirs.encode_ordinary(t)) for t in texts), 0]


def test_query_equals_the_library(spark, docs, rows, theirs, none):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for doc_id, text, *_ in rows:
        got = theirs.encode_ordinary(text or "")
        want.append((doc_id, len(got), sha(np.array(got, "<u4").tobytes()), sha((text or "").encode())))
    encoded = bpe.encode_texts(docs)
    assert encoded.columns == ["doc_id", "ids"]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, bpe.bpe_digests(encoded).collect()), key=key) == sorted(want, key=key)
    texts = {r.doc_id: bytes(r.text) for r in bpe.decode_ids(encoded).where("doc_id > 900").collect()}
    assert texts == {r[0]: (r[1] or "").encode() for r in rows if r[0] is not None and r[0] > 900}
    assert bpe.encode_texts(none).count() == 0 and bpe.decode_ids(bpe.encode_texts(none)).count() == 0


def test_another_vocabulary(spark):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        other = file.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, other.splitlines())}
    ref = tiktoken.Encoding("m", pat_str=bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(1, "Ein größerer Satz, одно предложение, 一句话")], "doc_id long, text string")
    assert bpe.encode_texts(df, other).first().ids == ref.encode_ordinary("Ein größerer Satz, одно предложение, 一句话")
