"""SentencePiece encoding and decoding (BPE pieces with byte fallback) by a prefix table.

A text gets a mark in front and marks for its spaces. For every prefix of it, the token that ends the
prefix's encoding is unique, so a table of one token per prefix holds all encodings. An Aho-Corasick
automaton of the pieces gives the tokens that may end at a position; the right one is the one that may
stand behind the last token of what precedes it, i.e. the merges of the two together give just these
two. The ids are then read off the table from its end to its start. A character that is no piece stands for
its UTF-8 bytes and never merges, so whatever follows it begins anew.

No piece has a mark behind another character, so the text is cut at the start of each run of marks, and the
ids of the cuts are remembered; the table is only built for cuts that are new.

Decoding joins the pieces, reads byte ids as UTF-8 (each byte that fits nowhere is U+FFFD), drops the one
mark in front and turns the others into spaces.

Edge cases: a null or empty text has no ids and decodes to an empty text; so does a null list of ids. Texts
of any length are encoded whole. Marks that a text holds itself are encoded like spaces, and decoded as
such. Rows are mapped one by one: repeated rows and ids, null ids and further columns (of any name) change
nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingotflow.llm.bpe import Compatible, Recent
from ingotflow.llm.common import map_slices

MARK = "▁"
#: What the library writes for its unknown id. Fixed value.
UNKNOWN_TEXT = " ⁇ "
#: Cuts whose ids a worker remembers; longer ones (in characters) are encoded each time.
MEMO_CUTS, MEMO_LENGTH = 1_000_000, 48

CUTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceBpe(Recent):
    """Encoder and decoder; as a dictionary it remembers the ids of cuts, as packed bytes."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor):
        super().__init__(MEMO_CUTS)
        ids = range(model.get_piece_size())
        self.byte_of = {i: int(model.id_to_piece(i)[3:-1], 16) for i in ids if model.is_byte(i)}
        self.silent = {i for i in ids if model.is_control(i)}
        self.unknown = {i for i in ids if model.is_unknown(i)}
        pieces = {model.id_to_piece(i): i for i in ids
                  if not (i in self.byte_of or i in self.silent or i in self.unknown)}
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("a piece crosses the start of a run of marks")
        if any(c not in pieces for piece in pieces for c in piece):
            raise ValueError("a piece holds a character that is no piece")
        self.together = Compatible({piece: -model.get_score(i) for piece, i in pieces.items()})
        self.packed = {piece: i.to_bytes(4, "little") for piece, i in pieces.items()}
        self.packed_byte = {b: i.to_bytes(4, "little") for i, b in self.byte_of.items()}
        self.text_of = [b"" if i in self.silent else UNKNOWN_TEXT.encode() if i in self.unknown
                        else bytes([self.byte_of[i]]) if i in self.byte_of
                        else model.id_to_piece(i).replace(MARK, " ").encode() for i in ids]
        self.name_of = list(map(str, ids))
        self.automaton = ahocorasick.Automaton()
        for piece in pieces:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()

    def last_tokens(self, cut: str) -> list[str | None]:
        """The last token of each prefix of a cut; none for one that ends in a character without a piece."""
        last: list[str | None] = [None] * (len(cut) + 1)
        done, together = 0, self.together
        for at, token in self.automaton.iter(cut):
            end = at + 1
            if end > done:
                before = last[end - len(token)]
                if before is None or together[before, token]:
                    last[end], done = token, end
        return last

    def make(self, cut: str) -> bytes:
        last, end, out = self.last_tokens(cut), len(cut), []
        while end:
            token = last[end]
            if token is None:
                out += [self.packed_byte[b] for b in reversed(cut[end - 1].encode())]
                end -= 1
            else:
                out.append(self.packed[token])
                end -= len(token)
        return b"".join(reversed(out))

    def __missing__(self, cut: str) -> bytes:
        return super().__missing__(cut) if len(cut) <= MEMO_LENGTH else self.make(cut)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if not text:
            return b""
        return b"".join(map(self.__getitem__, CUTS.findall(MARK + text.replace(" ", MARK))))

    def decode(self, ids: list[int] | None) -> str:
        if not ids:
            return ""
        first = next((i for i in ids if i not in self.silent), None)
        runs = [ids]
        if not self.silent.isdisjoint(ids):  # bytes on both sides of such an id make no character together
            cuts = [-1, *(n for n, i in enumerate(ids) if i in self.silent), len(ids)]
            runs = [ids[a + 1:b] for a, b in pairwise(cuts)]
        out = "".join(_text(b"".join(map(self.text_of.__getitem__, run))) for run in runs)
        marked = first not in self.unknown and first not in self.byte_of and out[:1] == " "
        return out[1:] if marked else out

    def names(self, ids: list[int]) -> str:
        return ",".join(map(self.name_of.__getitem__, ids))


def _text(data: bytes) -> str:
    """UTF-8 bytes as text; U+FFFD for each byte that fits nowhere."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return "".join(_characters(data))


def _characters(data: bytes) -> Iterator[str]:
    at = 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                yield data[at:at + size].decode()
                at += size
                break
            except UnicodeDecodeError:
                pass
        else:
            yield "\ufffd"
            at += 1


@lru_cache(maxsize=4)
def load(path: str) -> PieceBpe:
    """Read a ``.model`` file's pieces; encoding and decoding then do without the library."""
    return PieceBpe(sentencepiece.SentencePieceProcessor(model_file=path))


def _mapped(df: DataFrame, key: str, text: str, apply: Callable[[pa.RecordBatch], pa.RecordBatch],
            columns: str) -> DataFrame:
    kind = df.select(key).schema[0].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_slices(rows, apply, 1, f"key {kind}, {columns}").withColumnRenamed("key", key)


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids`` of every row."""
    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [load(path).encode(t) for t in batch.column(1).to_pylist()]
        sizes = [len(p) // 4 for p in packed]
        ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes], dtype=np.int32)),
                                       pa.array(np.frombuffer(b"".join(packed), "<i4")))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), ids],
                                          ["key", "n_tokens", "ids"])

    return _mapped(df, key, text, apply, "n_tokens long, ids array<int>")


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text`` of every row of ids."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [coder.decode(row) for row in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["key", "text"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return (df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
            .mapInArrow(apply, f"key {kind}, text string").withColumnRenamed("key", key))


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of every row: a round trip by digests.

    Ids are decoded and hashed where they are made, so no array of ids leaves the task.
    """
    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = load(path)
        sizes, of_ids, of_text = [], [], []
        for value in batch.column(1).to_pylist():
            ids = np.frombuffer(coder.encode(value), "<i4").tolist()
            sizes.append(len(ids))
            of_ids.append(hashlib.sha256(coder.names(ids).encode()).hexdigest())
            of_text.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()),
             pa.array(of_text, pa.string())], ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _mapped(df, key, text, apply, "n_tokens long, ids_sha256 string, decoded_sha256 string")
