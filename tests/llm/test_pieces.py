"""Piece encoding against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ingotflow.llm import piece_bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")
HOSTILE = ["", " ", "  a  b ", "▁", "a▁▁b", "<s> <unk> <0x41> </s>", "\x00\x01", "日本語 テキスト", "é́ ü", "🎉🎉a", "　x",
           "a\n\n\tb\r\n", "ab" * 4000, "=-" * 700, " " * 900, "人" * 800, "Hello world. " * 300, "x" * 100_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(text):
    return np.frombuffer(piece_bpe.load(PATH).encode(text), "<i4").tolist()


def test_hostile_texts(library):
    for text in HOSTILE:
        ids = library.encode(text)
        assert ids_of(text) == ids and piece_bpe.load(PATH).decode(ids) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab  thein▁\n.é日🎉\x00<0xA>"), max_size=60) | st.text(max_size=30))
def test_texts_equal_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = library.encode(text)
    assert ids_of(text) == ids and piece_bpe.load(PATH).decode(ids) == library.decode(ids)


def test_any_ids_decode_like_the_library(library):
    rnd = random.Random(8)
    for _ in range(4000):
        ids = [rnd.choice([rnd.randrange(3), rnd.randrange(3, 259), rnd.randrange(32000), 259, 28705])
               for _ in range(rnd.randrange(9))]
        assert piece_bpe.load(PATH).decode(ids) == library.decode(ids)


def test_prefix_table_holds_every_prefix():
    coder, cut = piece_bpe.load(PATH), "▁unbelievable日stories"
    last = coder.last_tokens(cut)
    for end in range(1, len(cut) + 1):
        ids = np.frombuffer(coder.make(cut[:end]), "<i4").tolist()
        assert last[end] is None or coder.packed[last[end]] == ids[-1].to_bytes(4, "little")


def test_tables(spark, library):
    rows = [(i, t, 1, "c") for i, t in enumerate(HOSTILE)] + [(None, None, 2, "c"), (3, "again", 3, "c"), (3, "again", 3, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")
    encoded = piece_bpe.encode(df, PATH)
    assert sorted((str(r.doc_id), r.n_tokens, list(r.ids)) for r in encoded.collect()) == sorted(
        (str(i), len(library.encode(t or "")), library.encode(t or "")) for i, t, *_ in rows)
    decoded = piece_bpe.decode(encoded.withColumn("text", F.lit(0)), PATH)
    assert sorted((str(r.doc_id), r.text) for r in decoded.collect()) == sorted(
        (str(i), library.decode(library.encode(t or ""))) for i, t, *_ in rows)
    assert [r.text for r in piece_bpe.decode(
        spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).collect()] == [""]

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = sorted((str(i), len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
                      for i, t, *_ in rows for ids in [library.encode(t or "")])
    assert sorted((str(r[0]), *r[1:]) for r in piece_bpe.digests(df, PATH).collect()) == expected
    for function in (piece_bpe.encode, piece_bpe.digests):
        assert function(df.limit(0), PATH).collect() == []
