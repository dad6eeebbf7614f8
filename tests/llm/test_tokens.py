"""Byte-level BPE and token counts against the libraries and naive merging."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ingotflow.llm import byte_bpe, token_counts
from ingotflow.llm.bpe import Recent, merge

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
ODD = ["", " ", "  ", "\n", "a" * 3000, "ab" * 2000, " " * 700, "\n" * 90 + "x", "<|endoftext|>",
       "</s><s> <unk> <0x0A>", "▁ ▁▁x", "don't we'll", "漢字🎉 ﬁ\x00\x1c\x85", "Ünïcode ñandú"]


@pytest.fixture(scope="module")
def tiktoken_encode():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS),
                             special_tokens={}).encode_ordinary


@pytest.fixture(scope="module")
def piece_encode():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL).encode


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


texts = st.text(st.sampled_from("abcdehinorst  \n\té漢🎉'<|>0129▁ﬁ\x1c\x00ß") | st.characters(
    exclude_categories=["Cs"]), max_size=80)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_bpe_equals_the_library(tiktoken_encode, text):
    coder = byte_bpe.load(RANKS, PATTERN)
    packed = coder.encode(text)
    assert ids(packed) == tiktoken_encode(text)
    assert coder.decode(packed) == text.encode()


@settings(max_examples=300, deadline=None)
@given(texts)
def test_counts_equal_the_library(piece_encode, text):
    assert token_counts.load(MODEL).counts([text, None, text]).tolist() == [
        len(piece_encode(text)), 0, len(piece_encode(text))]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(tiktoken_encode, piece_encode, text):
    assert ids(byte_bpe.load(RANKS, PATTERN).encode(text)) == tiktoken_encode(text)
    assert token_counts.load(MODEL).counts([text])[0] == len(piece_encode(text))


def test_small_vocabulary_equals_naive_merging():
    letters = "abc"
    made = [*letters, "ab", "bc", "abc", "ca", "cab", "aa", "aaa", "bcab"]
    ranks = {token.encode(): i for i, token in enumerate(made)}
    coder = byte_bpe.ByteBpe(ranks, r"(?s).+")
    rnd = random.Random(3)
    for _ in range(2000):
        text = "".join(rnd.choices(letters, k=rnd.randint(1, 25)))
        naive = merge(list(text), {t: i for i, t in enumerate(made)})
        assert ids(coder.encode(text)) == [made.index(t) for t in naive]


def test_transducer_survives_a_full_state_table(monkeypatch, piece_encode):
    monkeypatch.setattr(token_counts, "STATES", 5)
    fresh = token_counts.CountingTransducer(dict(token_counts.load(MODEL).rank))
    for text in ("incomprehensibilities of antidisestablishment", "aaaaaaa " * 9):
        assert fresh.counts([text])[0] == len(piece_encode(text))
        assert len(fresh.contexts) <= 6


def test_memo_stays_bounded():
    class Double(Recent):
        def make(self, key):
            return 2 * key

    memo = Double(10)
    assert [memo[i % 37] for i in range(500)] == [2 * (i % 37) for i in range(500)]
    assert len(memo) + len(memo.older) <= 11


def test_operators_over_a_table(spark, tiktoken_encode, piece_encode):
    rows = [(i, text, "x", 7) for i, text in enumerate([*ODD, None, "Same text.", "Same text."])]
    rows += [(None, "no id", None, None), (3, "a repeated id", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    expected = sorted((i if i is not None else -1, len(tiktoken_encode(t or "")), hashlib.sha256(
        np.array(tiktoken_encode(t or ""), "<u4").tobytes()).hexdigest(),
        hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows)
    out = byte_bpe.digests(df, RANKS, PATTERN).na.fill(-1).collect()
    assert sorted(map(tuple, out)) == expected
    listed = byte_bpe.encode(df, RANKS, PATTERN).na.fill(-1).collect()
    assert sorted((r.doc_id, len(r.ids)) for r in listed) == [e[:2] for e in expected]
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in listed)
    counts = token_counts.count_tokens(df, MODEL, limit=50).na.fill(-1).collect()
    assert sorted(map(tuple, counts)) == sorted(
        (i if i is not None else -1, len((t or "").encode()), n := len(piece_encode(t or "")), n > 50)
        for i, t, *_ in rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.digests(df, RANKS, PATTERN).count() == 0
    assert byte_bpe.encode(df, RANKS, PATTERN).count() == 0
    assert token_counts.count_tokens(df, MODEL).count() == 0
