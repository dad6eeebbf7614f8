"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

1. ``language_id``: documents whose language cannot be told go, and those whose score says that their
   language was not learned; the bound comes from the scores of documents that are held out of learning.
2. ``near_dedup``: one document of each group of near duplicates (five-word shingles, 0.8) stays.
3. ``decontamination``: documents that hold a benchmark item go.
4. ``secret_scan``: secrets are masked in the text; no document goes.
5. ``byte_bpe``: texts become token ids; ``round_trip`` says that decoding gives the text back.

Stages 1 to 4 return the columns of ``documents``. Null texts and texts without a letter go in stage 1, so
empty tables give an empty result. Stages 2 and 3 tell rows apart by their contents, so rows with a null or a
repeated id are examined like all others.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ingotflow.llm import byte_bpe, decontaminate, language_id, near_dedup, secret_scan
from ingotflow.llm.common import remainder, table, written

SHINGLE = 5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 4) == 2
    model = language_id.fit(docs.where(~held_out))
    return language_id.accepted(docs, model, language_id.score_bound(docs.where(held_out), model))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(docs, SHINGLE)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_items),
    ("secret_scan", mask_secrets),
    ("byte_bpe", encode),
]

#: Learned languages and BPE merges are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
