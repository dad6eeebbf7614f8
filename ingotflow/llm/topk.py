"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of integer weights by term (its position). Queries and candidates are dealt
into blocks by a hash, and each task takes one block of queries and one of candidates. It inverts
its candidates into postings, one list of rows and weights per term. For each query, the terms one
after the other scatter ``query weight * posting weight`` into a dense array of the block's scores;
a partition around the k-th score selects, and ties go to the smaller id. The k best of every block
are merged by a ranking window, which cuts them down before its shuffle.

Every candidate row is replicated once per query block and every query once per candidate block, so
memory is bounded by the block sizes, and no side is broadcast or sent to the driver.

Edge cases: vectors that are null or hold a null or non-finite component take no part, nor do rows
without id. Vectors of other lengths are compared over the shared positions. A query is not compared
with rows of its own id; repeated candidate rows are candidates each, repeated query rows (same id
and vector) are one query, and the same id with another vector is a query of its own, with its own
ranks. A query without candidates returns no rows; nor does an empty table. Weights beyond the range
of a long are held at its ends, and sums wrap as longs do. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block.
QUERY_ROWS, CANDIDATE_ROWS = 1024, 8192


def weights(vector: str, scale: float = 256.0) -> Column:
    """``floor(scale * x)`` of each component, as long; null where the vector takes no part."""
    bad = F.exists(vector, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def postings(vectors: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The rows and weights of each term."""
    offsets = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(vectors)), np.diff(offsets))
    term = np.arange(len(values)) - offsets[row]
    row, term, values = (x[values != 0] for x in (row, term, values))
    order = np.argsort(term, kind="stable")
    ends = np.cumsum(np.bincount(term, minlength=1))
    return [(row[part], values[part]) for part in np.split(order, ends[:-1])]


def best_of(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k highest scores but those of ``own``; ties to smaller ids."""
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def search_block(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    queries, candidates = queries.combine_chunks(), candidates.combine_chunks()
    out: list[tuple[int, int, int, int]] = []
    if queries.num_rows and candidates.num_rows:
        ids = candidates["vec_id"].to_numpy()
        terms = postings(candidates["vector"].combine_chunks())
        asked = queries["vector"].combine_chunks()
        for i, (query, copy) in enumerate(zip(queries["vec_id"].to_pylist(), queries["copy"].to_pylist())):
            scores = np.zeros(len(ids), np.int64)
            for weight, (rows, values) in zip(asked[i].values.to_numpy(), terms):
                if not weight or not len(rows):
                    continue
                if len(rows) == len(ids):
                    scores += weight * values
                else:
                    scores[rows] += weight * values
            out += [(query, copy, int(ids[p]), int(scores[p])) for p in best_of(scores, ids, query, k)]
    columns = zip(*out) if out else ([], [], [], [])
    return pa.table([pa.array(c, pa.int64()) for c in columns],
                    names=["query_id", "copy", "vec_id", "score"])


def search(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
           scale: float = 256.0, query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS
           ) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of every query row."""
    rows = (df.where(F.col(key).isNotNull() & F.col(vector).isNotNull())
            .select(F.col(key).cast("long").alias("vec_id"), weights(vector, scale).alias("vector"),
                    is_query.alias("asks")).where(F.col("vector").isNotNull()))
    sizes = rows.agg(F.count("*").alias("all"), F.count_if("asks").alias("asking")).first()
    n_candidates = -(-sizes["all"] // candidate_rows) or 1
    n_queries = -(-sizes["asking"] // query_rows) or 1

    def grid(side: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        """Each row once for every block of the other side."""
        # both numbers of a type: sides whose keys differ in it are dealt out differently
        return (side.withColumn(own, F.pmod(F.xxhash64("vec_id", "copy"), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))))

    queries = (rows.where("asks").select("vec_id", "vector", F.xxhash64("vector").alias("copy"))
               .dropDuplicates(["vec_id", "copy"]))
    # dealt by id and partition, so that repeats of one id do not all meet in one block
    candidates = rows.select("vec_id", "vector", F.spark_partition_id().alias("copy"))
    pairs = (grid(queries, "q", n_queries, "c", n_candidates).groupBy("q", "c")
             .cogroup(grid(candidates, "c", n_candidates, "q", n_queries).groupBy("q", "c"))
             .applyInArrow(lambda a, b: search_block(a, b, k),
                           "query_id long, copy long, vec_id long, score long"))
    order = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
