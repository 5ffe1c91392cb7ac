from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = byte_bpe.ranks(PATH)
REAL = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
SCHEMA = "doc_id bigint, text string, ids int, row int"


def expected(rows):
    out = []
    for i, t in rows:
        ids = REAL.encode_ordinary(t or "")
        told = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        out.append((i, len(ids), told, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [
    (1, "Hello world, it's   me!  \n\n  <|endoftext|> 12345"), (2, None), (3, ""), (4, " "), (5, "日本語 Ünïcödé \U0001f600\U0001f468‍\U0001f469"),
    (6, "a" * 5000), (7, "ab" * 3000 + " " * 500), (8, "\x00\x01 　x y\u0085z"), (1, "Hello world"), (1, "Hello world"),
    (None, "no id"), (None, "no id"), (9, "we'll they've I'm 'S"), (10, " ".join(f"w{i}" for i in range(20000))),
]


@pytest.mark.parametrize("hot, slab", [(0, 1 << 17), (0, 3), (20, 50), (byte_bpe.HOT, 1 << 17)])
def test_equals_the_library(spark, values, monkeypatch, hot, slab):
    monkeypatch.setattr(byte_bpe, "SLAB", slab)
    df = spark.createDataFrame([(*r, 1, 2) for r in ROWS], SCHEMA)
    ids = byte_bpe.encode(df, PATH, PATTERN, hot=hot)
    assert values(byte_bpe.digests(ids, PATH)) == expected(ROWS)
    back = byte_bpe.decode(ids, PATH)
    assert sorted((bytes(r.bytes) for r in back.collect())) == sorted((t or "").encode() for _, t in ROWS)


def test_hot_pieces_are_bounded_in_bytes_and_most_used(spark):
    texts = spark.createDataFrame([(f"often twice {i} once{i}",) for i in range(50)] + [("twice sum",), ("sum",)], "text string")
    all_of = dict(zip(*byte_bpe.hot_pieces(texts, PATH, PATTERN)))
    assert " twice" in all_of and "often" in all_of and " once" in all_of and " 7" not in all_of
    assert all(byte_bpe.ids_of(v, PATH).tolist() == REAL.encode_ordinary(k) for k, v in all_of.items())
    few = dict(zip(*byte_bpe.hot_pieces(texts, PATH, PATTERN, hot=20)))
    assert sum(len(k.encode()) + len(v) for k, v in few.items()) <= 20 and few.keys() < all_of.keys()
    assert byte_bpe.hot_pieces(texts, PATH, PATTERN, hot=0) == ([], []) == byte_bpe.hot_pieces(texts.limit(0), PATH, PATTERN)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_streams(numbers):
    assert byte_bpe.unpacked_stream(byte_bpe.packed_stream(np.array(numbers, np.uint32))).tolist() == numbers


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 10**6), st.binary(max_size=9), max_size=20))
def test_parts(parts):
    numbers = sorted(parts)
    assert byte_bpe.unpacked_parts(byte_bpe.packed_parts(numbers, [parts[n] for n in numbers])) == (numbers, [parts[n] for n in numbers])


def test_empty_table(spark):
    ids = byte_bpe.encode(spark.createDataFrame([], SCHEMA), PATH, PATTERN)
    assert byte_bpe.digests(ids, PATH).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60))
def test_merges_equal_the_library(piece):
    if piece:
        assert byte_bpe.merge(piece, RANKS) == REAL._encode_single_piece(piece)


def test_long_pieces_equal_the_library():
    rng = random.Random(1)
    for alphabet in (b"a", b"ab", b"the and", bytes(range(256))):
        piece = bytes(rng.choice(alphabet) for _ in range(3000))
        assert byte_bpe.merge(piece, RANKS) == REAL._encode_single_piece(piece)
