"""Near-duplicate documents by a signature-coordinate inverted join.

Every document's set of word shingles gets a MinHash signature of ``COORDINATES`` coordinates; the value
of one is a hash of ``MINIMA`` minima, so two sets of similarity J agree in a coordinate with probability
``J ** MINIMA``. Documents with equal sets form one class, and only classes go on.

* Post: each class under each coordinate-value pair. By the prefix filter, a pair that agrees in
  ``MATCHES`` coordinates shares one of all but the last ``MATCHES - 1``; only those are posted.
* Merge: a list of up to ``SHORT`` classes gives all its pairs. A longer one gives its members paired with
  its first and its last, the hubs. What proves linked forms components, and in each long list only pairs
  across components are still open, since a link inside one changes nothing: the members outside the
  list's largest component are compared with all the others. This is done for all lists of one such
  component together, and in blocks, so that a set is sent once per block, not per list or pair. Where they are more than ``FEW``, the list is first split by each later
  coordinate; a pair with ``MATCHES`` agreements meets again in one of these.
* Count: the coordinates in which a pair agrees; pairs with fewer than ``MATCHES`` are dropped.
* Confirm: the rest are compared on their full sets, rebuilt from the texts where these are read. A bitmap of
  fixed size leaves out most rows that are in no pair, so whole texts are never shuffled, and of the others' sets
  few. Written steps are deleted once the next one is written.

With the settings below a pair at similarity 0.8 is missed with a probability of about one in a million,
and less above. Components of the confirmed links are found by star contraction.

Edge cases: a null, empty or blank text has an empty set, and is linked with nothing. A text with fewer
words than a shingle has its whole sequence as one. Rows that repeat an id are one document: what one of
them is linked with, all are. A row with a null id has no component and is not kept; it links nothing.
Texts are read whole, and sets of any size compared whole. Further columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingotflow.llm.common import (
    discard,
    id_bitmap,
    in_id_bitmap,
    map_slices,
    slices,
    stored,
    written,
)
from ingotflow.llm.components import connected_components

COORDINATES, MINIMA, MATCHES, SHORT, FEW = 32, 4, 2, 8, 1024
#: Members of a block that meets a block of up to ``FEW`` others.
BLOCK = 512
#: Bits, as a power of two, of the filter for the rows whose sets are needed. Above some tens of millions of
#: such rows it lets most others pass too, which costs the shuffle of their sets and changes no result.
FILTER_BITS = 25
PERCENT = 80

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_random = np.random.default_rng(20)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEPS = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_FACTORS = _random.integers(1, 1 << 31, COORDINATES * MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = _random.integers(0, 1 << 32, COORDINATES * MINIMA, dtype=np.uint32)
#: Bytes hashed at once.
_PIECE = 1 << 20
_POWERS = np.cumprod(np.full(_PIECE + 1, _BASE))
_INVERSE = np.cumprod(np.full(_PIECE + 1, np.uint64(pow(int(_BASE), -1, 1 << 64))))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word; ``A-Z`` in lower case, words end at ASCII white space."""
    out = []
    start = 0
    while start < len(text):
        end = min(start + _PIECE, len(text))
        data = _LOWER[np.frombuffer(text, np.uint8, end - start, start)]
        space = _SPACE[data]
        if end < len(text) and not space[-1]:
            blank = np.flatnonzero(space)
            if not len(blank):  # a word longer than a piece: hash it alone
                return np.concatenate([*out, _long_words(text[start:])])
            end = start + int(blank[-1]) + 1
            data, space = data[:end - start], space[:end - start]
        edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        begins, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS[:len(data)], out=sums[1:])
        out.append(mix((sums[ends] - sums[begins]) * _INVERSE[begins]))
        start = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _long_words(text: bytes) -> np.ndarray:
    out = []
    for word in text.lower().split():
        total = 0
        for i in range(0, len(word), _PIECE):
            data = np.frombuffer(word, np.uint8, min(_PIECE, len(word) - i), i).astype(np.uint64)
            part = int(((data + np.uint64(1)) * _POWERS[:len(data)]).sum(dtype=np.uint64))
            total += part * pow(int(_BASE), i - 1, 1 << 64)
        out.append(total % (1 << 64))
    return mix(np.array(out, np.uint64))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = word_hashes((text or "").encode())
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, np.uint64(size))
    for i in range(size):
        total = mix(total * _STEPS[0] + words[i:len(words) - size + 1 + i])
    return np.unique(total)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The value of each coordinate; those of different coordinates differ, so a value is a posting key."""
    low = np.full(COORDINATES * MINIMA, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 2048):
        np.minimum(low, (short[i:i + 2048, None] * _FACTORS + _OFFSETS).min(axis=0), out=low)
    value = np.arange(1, COORDINATES + 1, dtype=np.uint64)
    for part in low.reshape(COORDINATES, MINIMA).T:
        value = mix(value * _STEPS[1] + part)
    return value


def _longs(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def sketches(df: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles``, two 64-bit digests of the set, and its ``signature`` (none if empty)."""
    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, size) for t in batch.column(1).to_pylist()]
        digests = np.array([[s.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(s + _BASE))] for s in sets],
                           np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
             *(pa.array(column) for column in digests.T),
             _longs([signature(s) if len(s) else s for s in sets])],
            ["doc_id", "n_shingles", "digest", "digest2", "signature"])

    return map_slices(df.select("doc_id", "text"), apply, 1, "doc_id long, n_shingles long, digest long, "
                      "digest2 long, signature array<long>")


def set_rows(df: DataFrame, size: int, ids: DataFrame) -> DataFrame:
    """``doc_id, signature, shingles`` of the rows whose id is in ``ids`` (one column, distinct).

    A filter of fixed size drops most other rows where they are read; only what passes is shuffled.
    """
    wanted = df.sparkSession.sparkContext.broadcast(id_bitmap(ids, FILTER_BITS))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.filter(pa.array(in_id_bitmap(wanted.value, batch.column(0)))), 1):
                sets = [shingle_set(t, size) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _longs([signature(s) for s in sets]), _longs(sets)],
                    ["doc_id", "signature", "shingles"])

    rows = df.where("doc_id is not null").select("doc_id", "text").mapInArrow(
        apply, "doc_id long, signature array<long>, shingles array<long>")
    return rows.join(ids.toDF("doc_id"), "doc_id", "left_semi")


def lists_of(postings: DataFrame) -> DataFrame:
    """The postings of lists with two members or more, with the list's length and hubs."""
    lists = postings.groupBy("key").agg(F.count("*").alias("length"), F.min("id").alias("first"),
                                        F.max("id").alias("last")).where("length > 1")
    return postings.join(lists, "key")


def fits() -> Column:
    """Whether the sizes of two sets allow a link."""
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT


def all_pairs(members: DataFrame) -> DataFrame:
    """All pairs of each list."""
    a, b = (members.select("key", F.col("id").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab")
    return a.join(b, "key").where((F.col("a") < F.col("b")) & fits()).select("a", "b")


def with_main(members: DataFrame) -> DataFrame:
    """The members of lists with several components, with the largest one and the number outside it."""
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("size"))
    lists = (sizes.groupBy("key").agg(F.max_by("component", F.struct("size", "component")).alias("main"),
                                      F.sum("size").alias("length"),
                                      (F.sum("size") - F.max("size")).alias("outside")).where("outside > 0"))
    return members.join(lists, "key")


def shared_counts(left: pa.ListArray, right: pa.ListArray) -> np.ndarray:
    """How many elements each set of the one side shares with each of the other."""
    rows = [np.repeat(np.arange(len(x)), np.diff(x.offsets.to_numpy())) for x in (left, right)]
    values = [x.flatten().to_numpy() for x in (left, right)]
    both = np.intersect1d(*map(np.unique, values), assume_unique=True)
    at = [np.searchsorted(both, v) for v in values]
    kept = [(a < len(both)) & (both[np.minimum(a, len(both) - 1)] == v) if len(both) else np.zeros(len(v), bool)
            for a, v in zip(at, values)]
    at, rows = ([x[k] for x, k in zip(side, kept)] for side in (at, rows))
    counts = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(both), 4096):
        dense = []
        for a, r, n in zip(at, rows, counts.shape):
            inside = (a >= start) & (a < start + 4096)
            dense.append(np.zeros((n, 4096), np.float32))
            dense[-1][r[inside], a[inside] - start] = 1
        counts += dense[0] @ dense[1].T
    return counts.astype(np.int64)


def block_links(left: pa.Table, right: pa.Table) -> pa.Table:
    """The links ``a, b`` between two blocks that lie in different components."""
    a = b = np.empty(0, np.int64)
    if left.num_rows and right.num_rows:
        left, right = left.combine_chunks(), right.combine_chunks()
        sets = [t["shingles"].combine_chunks() for t in (left, right)]
        shared = shared_counts(*sets)
        sizes = [np.diff(x.offsets.to_numpy()) for x in sets]
        together = sizes[0][:, None] + sizes[1] - shared
        other = left["component"].to_numpy()[:, None] != right["component"].to_numpy()
        i, j = np.nonzero((shared * 100 >= together * PERCENT) & other & (shared > 0))
        a, b = left["id"].to_numpy()[i], right["id"].to_numpy()[j]
    return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def by_main(lists: DataFrame) -> DataFrame:
    """The lists of ``with_main`` that share a largest component, as one list each."""
    rows = lists.select(F.col("main").alias("key"), "id", "component").distinct()
    counts = rows.groupBy("key").agg(F.count("*").alias("length"),
                                     F.count_if(F.col("component") != F.col("key")).alias("outside"))
    return rows.join(counts, "key").withColumn("main", F.col("key"))


def open_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The links of each list between its largest component's outsiders and all its other components."""
    held = (members.select("key", "id", "component", "main", "outside", "length")
            .join(sets.select(F.col("doc_id").alias("id"), "shingles"), "id"))
    n_left = F.ceil(F.col("outside") / FEW).cast("int")
    n_right = F.ceil(F.col("length") / BLOCK).cast("int")
    own = F.xxhash64("id")

    def grid(side: DataFrame, left: Column, right: Column) -> DataFrame:
        names = ["key", "id", "component", "shingles", "left", "right"]
        return side.select(*names[:4], left.alias("left"), right.alias("right")).select(
            *(F.col(n).alias(f"_{n}") for n in names)).toDF(*names)  # new columns, for the self join

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    outsiders = grid(held.where("component <> main"), F.pmod(own, n_left).cast("int"), every(n_right))
    rest = grid(held, every(n_left), F.pmod(own, n_right).cast("int"))
    block = ["key", "left", "right"]
    return (outsiders.groupBy(*block).cogroup(rest.groupBy(*block))
            .applyInArrow(block_links, "a long, b long").distinct())


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that agree in enough coordinates and whose full sets are similar enough."""
    a, b = (sets.select(F.col("doc_id").alias(x), F.col("signature").alias(f"signature_{x}"),
                        F.col("shingles").alias(f"shingles_{x}")) for x in "ab")
    matches = F.size(F.filter(F.zip_with("signature_a", "signature_b", lambda x, y: x == y), lambda x: x))
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    together = F.size("shingles_a") + F.size("shingles_b") - F.col("shared")
    return written(pairs.join(a, "a").join(b, "b").where(matches >= MATCHES).withColumn("shared", shared)
                   .where(F.col("shared") * 100 >= together * PERCENT).select("a", "b").distinct(), "links")


def find_links(df: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``a, b`` of links that join the documents of each component; ``classes``: ``id, n, signature``."""
    coordinates = F.posexplode(F.slice("signature", 1, COORDINATES - MATCHES + 1)).alias("at", "key")
    spark = df.sparkSession
    members, lists_path = stored(lists_of(classes.select("id", "n", coordinates)), "lists")
    short, long = members.where(F.col("length") <= SHORT), members.where(F.col("length") > SHORT)
    stars = [long.where(F.col("id") != F.col(hub)).select(
        F.least("id", hub).alias("a"), F.greatest("id", hub).alias("b")) for hub in ("first", "last")]
    pairs, pairs_path = stored(all_pairs(short).union(stars[0]).union(stars[1]).distinct(), "pairs")
    ids = written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "ids")
    sets, sets_path = stored(set_rows(df, size, ids), "sets")
    links = confirmed(pairs, sets)
    discard(spark, pairs_path)
    if long.isEmpty():
        discard(spark, lists_path, sets_path)
        return links
    found = connected_components(links)
    split = written(with_main(
        long.join(found, F.col("id") == F.col("node"), "left")
        .select("key", "at", "id", "n", F.coalesce("component", "id").alias("component"))), "open")
    discard(spark, lists_path)
    later = F.slice("signature", F.col("at") + 2, F.lit(COORDINATES))
    finer = (split.where(F.col("outside") > FEW).select("key", "at", "id", "component")
             .join(classes.select("id", "signature"), "id")
             .select("id", "component", "key", F.explode(later).alias("later"))
             .select("id", "component", F.xxhash64("key", "later").alias("key")))
    few = split.where(F.col("outside") <= FEW)
    found = written(open_links(by_main(few), sets).union(open_links(with_main(finer), sets)), "links")
    discard(spark, sets_path)
    return links.union(found)


def near_duplicates(df: DataFrame, size: int = 2) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    rows, path = stored(sketches(df, size), "sketches")
    sets = ["digest", "digest2", "n_shingles"]
    heads = (rows.where("doc_id is not null and n_shingles > 0").groupBy(*sets)
             .agg(F.min("doc_id").alias("id")))
    members = written(rows.join(heads, sets, "left").select(
        "doc_id", "n_shingles", F.coalesce("id", "doc_id").alias("id"),
        F.when(F.col("doc_id") == F.col("id"), F.col("signature")).alias("signature")), "members")
    discard(df.sparkSession, path)
    classes = (members.where("signature is not null").dropDuplicates(["id", "signature"])
               .select("id", F.col("n_shingles").alias("n"), "signature"))
    # an id with several texts is one document, whatever their classes
    same = (members.where("doc_id is not null").groupBy("doc_id").agg(F.min("id").alias("low"), F.max("id").alias("high"))
            .where("low < high").join(members.select("doc_id", "id").distinct(), "doc_id"))
    links = find_links(df, classes, size).union(
        same.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")))
    found = connected_components(links)
    return (members.join(found, F.col("id") == F.col("node"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def deduplicated(df: DataFrame, size: int = 5) -> DataFrame:
    """One row of each component; all columns, rows unchanged.

    Rows are told apart by a hash of all their columns, not by their ids, so rows with a null or a repeated id
    are compared by their texts like all others; of rows that are equal throughout one stays. The row of
    the smallest id stays (of a null one only if all are null), then the one of the smallest hash. Rows whose
    text is null or blank are linked with nothing.
    """
    keyed = df.withColumn("_key", F.xxhash64(*df.columns))
    classes, path = stored(near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"), size), "classes")
    ranks = keyed.select("_key", F.struct(F.col("doc_id").isNull(), "doc_id", "_key").alias("rank")).distinct()
    best = (classes.select(F.col("doc_id").alias("_key"), "component_id").distinct().join(ranks, "_key")
            .groupBy("component_id").agg(F.min_by("_key", "rank").alias("_key")).select("_key"))
    kept = written(best, "kept")
    discard(df.sparkSession, path)
    return (keyed.join(kept, "_key", "left_semi").groupBy("_key")
            .agg(F.first(F.struct(*df.columns)).alias("row")).select("row.*"))
