"""Byte-level BPE encoding and decoding.

Each match of the split pattern is encoded alone. Its UTF-8 bytes, read as Latin-1, go through an
Aho-Corasick automaton of all tokens, which gives the tokens that start at every position. From the
left the longest token is taken that may follow the one before it; where none may, the last token is
taken back and the next shorter one tried. A position that failed once is never entered again, so
the work is linear in the length. The result is what merging by rank gives, because a sequence in
which all neighbours may stand together is unique.

Edge cases: a null or empty text has no ids; its decoded bytes are empty. Texts of any length are
encoded whole. Rows are mapped one by one: repeated rows and ids, null ids and further columns
change nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingotflow.llm.bpe import Compatible, Recent
from ingotflow.llm.common import map_slices

#: Distinct pieces whose ids a worker remembers; longer ones (in characters) are encoded each time.
MEMO_PIECES, MEMO_LENGTH = 1_000_000, 48


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe(Recent):
    """Encoder and decoder; as a dictionary it remembers the ids of pieces, as packed bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__(MEMO_PIECES)
        self.find = regex.compile(pattern).findall
        latin = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.together = Compatible(latin)
        self.token = {rank: token for token, rank in ranks.items()}
        self.ids = {token: rank.to_bytes(4, "little") for token, rank in latin.items()}
        self.automaton = ahocorasick.Automaton()
        for token in latin:
            self.automaton.add_word(token, token)
        self.automaton.make_automaton()

    def tokens(self, piece: bytes) -> list[str]:
        text = piece.decode("latin-1")
        starts: list[list[str]] = [[] for _ in text]
        for end, token in self.automaton.iter(text):
            starts[end - len(token) + 1].append(token)  # shorter ones first
        together, size = self.together, len(text)
        dead = bytearray(size + 1)
        out: list[str] = []
        before, at = "", 0
        while at < size:
            here = starts[at]
            while here:  # what was tried here is gone
                token = here.pop()
                if not dead[at + len(token)] and (not before or together[before, token]):
                    out.append(token)
                    before, at = token, at + len(token)
                    break
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a byte of the text")
                dead[at] = 1
                at -= len(out.pop())
                before = out[-1] if out else ""
        return out

    def make(self, piece: str) -> bytes:
        return b"".join(map(self.ids.__getitem__, self.tokens(piece.encode())))

    def __missing__(self, piece: str) -> bytes:
        return super().__missing__(piece) if len(piece) <= MEMO_LENGTH else self.make(piece)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.find(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(read_ranks(path), pattern)


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``key, n_tokens, ids, round_trip`` of every row: the ids, and whether they decode to the text."""
    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = load(path, pattern)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        packed = [coder.encode(t) for t in texts]
        sizes = [len(p) // 4 for p in packed]
        ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes], dtype=np.int32)),
                                       pa.array(np.frombuffer(b"".join(packed), "<i4")))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), ids,
             pa.array([coder.decode(p) == t.encode() for p, t in zip(packed, texts)], pa.bool_())],
            ["key", "n_tokens", "ids", "round_trip"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return map_slices(df.select(F.col(key).alias("key"), F.col(text).alias("text")), apply, 1,
                      f"key {kind}, n_tokens long, ids array<int>, round_trip boolean"
                      ).withColumnRenamed("key", key)


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of every row: a round trip by digests.

    Ids are hashed where they are made, so no array of ids leaves the task.
    """
    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = load(path, pattern)
        packed = [coder.encode(t) if t else b"" for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([
            batch.column(0),
            pa.array([len(p) // 4 for p in packed], pa.int64()),
            pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
            pa.array([hashlib.sha256(coder.decode(p)).hexdigest() for p in packed]),
        ], ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return map_slices(df.select(F.col(key).alias("key"), F.col(text).alias("text")), apply, 1,
                      f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
                      ).withColumnRenamed("key", key)
