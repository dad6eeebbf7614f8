"""Language identification by bit-sliced n-gram filters.

One Bloom filter for all languages: a cell holds a bit per language, and looking an n-gram up (the
AND of its cells) returns the set of all languages that contain it. For each text the bits are
counted by language; a count is corrected for the filter's false positives (a language whose bits
fill a share ``s`` of the cells is wrongly returned for ``s ** HASHES`` of the n-grams), and the
language with the highest corrected count wins, the more frequent one on a tie. The score is that
count over the number of n-grams.

N-grams are four bytes of the UTF-8 text, with ASCII letters lower-cased and every other ASCII byte
read as a space; each text is framed by spaces, and n-grams without a letter are left out. A language
contains an n-gram if it is not much rarer there than in the language where it is most frequent.

Learning reads a bounded sample, ``SAMPLE`` different documents of each language with the lowest hash of id
and text, and counts its n-grams on the executors. A text of a language that was not learned scores far
lower than others, so ``score_bound`` sets the score below which ``accepted`` rejects a text, from the scores
of documents that were held out.

Edge cases: a null text or one without a letter is ``und`` with score 0, and so is everything if
nothing could be learned. A text whose n-grams no language contains gets the most frequent language
and score 0. Texts are read whole. Null languages and null texts teach nothing. Rows are mapped one
by one, so repeated rows and ids and further columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingotflow.llm.common import bounded_sample, map_slices, slices

UNKNOWN = "und"
SAMPLE = 400
#: An n-gram belongs to a language if its rate there is at least this share of its highest rate.
SHARE = 0.4
#: n-grams seen less often than this in the whole sample are ignored.
LEAST = 2
CELLS, HASHES = 1 << 20, 3
#: Text bytes looked up at once; each takes some forty bytes of memory meanwhile.
LOOKUP_BYTES = 1 << 19
#: A language is taken for known from this share of the score that all but this part of known documents reach.
BOUND_SHARE, BOUND_QUANTILE = 0.65, 0.01

_WIDTH = 4
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 256)
for _upper, _lower in zip(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"):
    _FOLD[_upper] = _FOLD[_lower] = _lower
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts one after the other, and where each text's begin (one entry more)."""
    frame = b" " * (_WIDTH - 1)
    data = _FOLD[np.frombuffer(frame + frame.join(texts) + frame, np.uint8)]
    wide = data.astype(np.uint32)
    values = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24
    begins = np.cumsum([0, *(len(t) + len(frame) for t in texts)])
    letters = values != 0x20202020
    ends = np.concatenate([[0], np.cumsum(letters)])
    return values[letters], ends[np.minimum(begins, len(values))]


def cells(values: np.ndarray) -> list[np.ndarray]:
    """The cell of each n-gram under each hash."""
    shift = 32 - CELLS.bit_length() + 1
    return [(values * m ^ values >> 15) * np.uint32(0x2C1B3C6D) >> shift for m in _MULTIPLIERS]


@dataclass
class LanguageFilters:
    """``planes[cell, p]`` holds the bits of languages ``64 * p`` to ``64 * p + 63``."""

    languages: list[str]  # the most frequent first
    planes: np.ndarray
    false_rate: np.ndarray

    @staticmethod
    def build(languages: list[str], members: list[np.ndarray]) -> LanguageFilters:
        planes = np.zeros((CELLS, max(1, -(-len(languages) // 64))), np.uint64)
        rate = np.zeros(len(languages))
        for i, values in enumerate(members):
            for cell in cells(values):
                planes[cell, i // 64] |= np.uint64(1 << i % 64)
            filled = np.count_nonzero(planes[:, i // 64] & np.uint64(1 << i % 64))
            rate[i] = (filled / CELLS) ** HASHES
        if len(languages) <= 8:
            planes = planes.astype(np.uint8)
        return LanguageFilters(languages, planes, rate)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        values, begins = grams([t.encode() if t else b"" for t in texts])
        found = self.planes[(spots := cells(values))[0]]
        for spot in spots[1:]:
            found &= self.planes[spot]
        total = np.diff(begins)
        corrected = np.zeros((len(texts), len(self.languages)))
        for i, false in enumerate(self.false_rate):
            bits = found[:, i // 64] >> found.dtype.type(i % 64) & found.dtype.type(1)
            sums = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
            corrected[:, i] = (np.diff(sums[begins]) - total * false) / max(1 - false, 1e-9)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = np.maximum(corrected, 0, out=corrected).argmax(axis=1)
        score = corrected[np.arange(len(texts)), best] / np.maximum(total, 1)
        known = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)
        return ([self.languages[b] if k else UNKNOWN for b, k in zip(best, known)],
                np.where(known, np.clip(score, 0, 1), 0.0))


def sample_of(df: DataFrame, label: str, text: str, key: str, limit: int = SAMPLE) -> DataFrame:
    """``label, text`` of up to ``limit`` different rows of each label: those with the lowest hash."""
    rows = df.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).alias("label"), F.col(text).alias("text"), F.xxhash64(key, text).alias("hash"))
    return bounded_sample(rows, limit).select("label", "text")


def fit(df: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id",
        sample: int = SAMPLE) -> LanguageFilters:
    """Learn the filters from a bounded sample of labelled rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, LOOKUP_BYTES):
                values, begins = grams([t.encode() for t in part.column(1).to_pylist()])
                for i, name in enumerate(part.column(0).to_pylist()):
                    gram, n = np.unique(values[begins[i]:begins[i + 1]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(gram), pa.string()), pa.array(gram.astype(np.int64)),
                         pa.array(n.astype(np.int64))], ["label", "gram", "n"])

    counts = (sample_of(df, label, text, key, sample)
              .mapInArrow(count, "label string, gram long, n long")
              .groupBy("label", "gram").agg(F.sum("n").alias("n")).toPandas())
    totals = counts.groupby("label")["n"].sum().sort_index().sort_values(
        ascending=False, kind="stable")
    languages = [str(name) for name in totals.index]
    counts["rate"] = counts["n"] / counts["label"].map(totals)
    by_gram = counts.groupby("gram")
    keep = counts[(counts["rate"] >= SHARE * by_gram["rate"].transform("max"))
                  & (by_gram["n"].transform("sum") >= LEAST)]
    return LanguageFilters.build(languages, [
        keep.loc[keep["label"] == name, "gram"].to_numpy().astype(np.uint32) for name in languages])


def identify(df: DataFrame, model: LanguageFilters, text: str = "text", key: str = "doc_id",
             keep: tuple[Column, ...] = ()) -> DataFrame:
    """``key``, the columns of ``keep``, ``lang_pred`` and ``score`` of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = shared.value.predict(batch.column(0).to_pylist())
        return pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(names, pa.string()), pa.array(score)],
            [*batch.schema.names[1:], "lang_pred", "score"])

    rows = df.select(F.col(text).alias("_text"), F.col(key), *keep)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[1:])
    return map_slices(rows, apply, 0, f"{kept}, lang_pred string, score double", LOOKUP_BYTES)


def score_bound(df: DataFrame, model: LanguageFilters, label: str = "lang", text: str = "text", key: str = "doc_id",
                share: float = BOUND_SHARE, quantile: float = BOUND_QUANTILE) -> float:
    """The least score of a known language: ``share`` of the score that all but ``quantile`` of the documents reach
    whose label is known. ``df`` should hold documents that taught the model nothing; if none is labelled, 0."""
    scores = identify(df.where(F.col(label).isNotNull()), model, text, key).where(F.col("lang_pred") != UNKNOWN)
    reached = scores.agg(F.percentile_approx("score", quantile, 10_000)).first()[0]
    return share * (reached or 0.0)


def accepted(df: DataFrame, model: LanguageFilters, least: float, text: str = "text") -> DataFrame:
    """The rows whose language is known with a score of at least ``least``; all columns, rows unchanged."""
    shared, at = df.sparkSession.sparkContext.broadcast(model), df.columns.index(text)

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = shared.value.predict(batch.column(at).to_pylist())
        return batch.filter(pa.array((score >= least) & (np.array(names, object) != UNKNOWN), pa.bool_()))

    return map_slices(df, apply, at, df.schema, LOOKUP_BYTES)
