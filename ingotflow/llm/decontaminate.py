"""Benchmark decontamination: test items inside documents, in DataFrame operations only.

Items are partitioned by size and searched by MinHash over the documents' windows; what collides is
verified by exact containment of five-word shingles (see ``containment``). A document is contaminated
if it holds at least 80 in 100 of an item's distinct shingles.

Edge cases: null texts, and texts or items of fewer words than a shingle, have no shingles and are never
found. Rows with a null id take no part. Rows that repeat an id are one text, of all their shingles, however
many they are. Documents are read whole. Further columns are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingotflow.llm.containment import contained

SHINGLE, PERCENT = 5, 80


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = SHINGLE, percent: int = PERCENT
                  ) -> DataFrame:
    """``doc_id, item_id, shared, n_shingles`` of each item found in a document."""
    return contained(documents, benchmark, size, percent, "doc_id", "item_id").selectExpr(
        "document AS doc_id", "short AS item_id", "shared", "size AS n_shingles")


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that hold an item; all columns, rows unchanged.

    Each row is examined by its text, whatever its id: null and repeated ids are like all others.
    """
    key = F.xxhash64("text")
    texts = documents.select(key.alias("doc_id"), "text").where("text is not null")
    found = contamination(texts, benchmark).select(F.col("doc_id").alias("_key")).distinct()
    return documents.withColumn("_key", key).join(found, "_key", "left_anti").select(*documents.columns)
