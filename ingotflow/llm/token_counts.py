"""Token counts by a compiled finite-state tokenizer.

A piece vocabulary (BPE with byte fallback, spaces written as a mark) is compiled, as texts need it,
into a deterministic transducer over characters. A state holds what BPE needs of the past: the
longest suffix with which a piece may start, and for each boundary in it the token that ends there
and the count so far, relative to now. Reading a character finds the one token that may end
there, and the transition is annotated with the change of the token count.

A text is cut into chunks at the start of each run of marks. No piece has a mark behind another
character, so the transducer is in its start state there: the state map of a chunk is "any state to
start, plus n tokens". Such maps compose by addition, and a prefix sum over the chunks of all texts
of a batch, taken at the ends of the texts, gives every text's count. Chunk maps are remembered.

Edge cases: a null or empty text has no tokens. A character without a piece counts its UTF-8 bytes.
Texts of any length are counted whole; a chunk without a space, however long, is read once. Rows are
mapped one by one: repeated rows and ids, null ids and further columns change nothing. An empty
table gives an empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingotflow.llm.bpe import Compatible, Recent
from ingotflow.llm.common import map_slices

MARK = "▁"
#: Stands for the token of a boundary where no further token can begin.
GONE = ""
#: Chunks whose counts a worker remembers (longer ones, in characters, are read each time), and
#: states that it keeps compiled.
MEMO_CHUNKS, MEMO_LENGTH, STATES = 1_000_000, 48, 150_000

CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class CountingTransducer(Recent):
    """The transducer; as a dictionary it remembers the token count of chunks."""

    def __init__(self, rank: dict[str, int]):
        super().__init__(MEMO_CHUNKS)
        if any(MARK in piece.lstrip(MARK) for piece in rank):
            raise ValueError("a piece crosses the start of a run of marks")
        if any(c not in rank for piece in rank for c in piece):
            raise ValueError("a piece holds a character that is no piece")
        self.rank, self.together = rank, Compatible(rank)
        self.openings = {piece[:n] for piece in rank for n in range(len(piece))}
        self.reset()

    def reset(self) -> None:
        start = ("", (None,), (0,))
        self.contexts, self.state_of = [start], {start: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def context(self, past: str, tokens: tuple, counts: tuple, now: int) -> tuple:
        """What may still matter: boundaries behind which a longer piece may have begun."""
        alive = [past[n:] in self.openings for n in range(len(past) + 1)]
        keep = alive.index(True)
        kept = range(keep, len(past) + 1)
        return (past[keep:], tuple(tokens[n] if alive[n] else GONE for n in kept),
                tuple(counts[n] - now if alive[n] else 0 for n in kept))

    def compile(self, state: int, char: str) -> tuple[int, int]:
        """The next state and the emitted change of the count."""
        if char not in self.rank:
            return 0, len(char.encode())
        past, tokens, counts = self.contexts[state]
        past += char
        for begin, before in enumerate(tokens):
            if before is not GONE and (token := past[begin:]) in self.rank and (
                    before is None or self.together[before, token]):
                break
        else:
            raise AssertionError("a character without a token")
        change = counts[begin] + 1
        context = self.context(past, (*tokens, token), (*counts, change), change)
        if context not in self.state_of:
            self.state_of[context] = len(self.contexts)
            self.contexts.append(context)
            self.moves.append({})
        return self.state_of[context], change

    def run(self, chunk: str) -> int:
        state = count = 0
        for char in chunk:
            move = self.moves[state].get(char)
            if move is None:
                if len(self.contexts) >= STATES:
                    context = self.contexts[state]
                    self.reset()
                    if state:
                        self.contexts.append(context)
                        self.moves.append({})
                        self.state_of[context] = state = 1
                move = self.moves[state][char] = self.compile(state, char)
            state = move[0]
            count += move[1]
        return count

    make = run

    def __missing__(self, chunk: str) -> int:
        return super().__missing__(chunk) if len(chunk) <= MEMO_LENGTH else self.run(chunk)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """The token count of each text, from one prefix sum over all their chunks."""
        chunks: list[str] = []
        ends = []
        for text in texts:
            if text:
                chunks += CHUNKS.findall(MARK + text.replace(" ", MARK))
            ends.append(len(chunks))
        sums = np.zeros(len(chunks) + 1, np.int64)
        np.cumsum(np.fromiter(map(self.__getitem__, chunks), np.int64, len(chunks)), out=sums[1:])
        return np.diff(sums[ends], prepend=0)


@lru_cache(maxsize=4)
def load(path: str) -> CountingTransducer:
    """Read a ``.model`` file's pieces; the transducer then does without the library."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rank = {model.id_to_piece(i): -model.get_score(i) for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    return CountingTransducer(rank)


def count_tokens(df: DataFrame, path: str, limit: int = 4096, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row."""
    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1)
        counts = load(path).counts(texts.to_pylist())
        sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), sizes, pa.array(counts), pa.array(counts > limit)],
            ["key", "n_bytes", "n_tokens", "over_limit"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return map_slices(df.select(F.col(key).alias("key"), F.col(text).alias("text")), apply, 1,
                      f"key {kind}, n_bytes long, n_tokens long, over_limit boolean"
                      ).withColumnRenamed("key", key)
