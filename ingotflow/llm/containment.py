"""Short texts inside long ones, in DataFrame operations only: MinHash over windows, exact containment.

Words are runs of letters and digits in lower case, and shingles are hashes of consecutive words. A short
text is found in a document if the document holds at least ``percent`` of its distinct shingles.

* Sizes: short texts are partitioned by their number of shingle positions, class ``p`` holding those of
  up to ``2 ** p``. A class has windows of ``2 ** (p + 1)`` positions at every ``2 ** p``, so each run of
  ``2 ** p`` positions lies inside one, and the whole document is a window too.
* Windows: only shingles of short texts can count, so a document first drops all others, by a bitmap of
  fixed size. What is left in a window, of short texts of its class, gets a MinHash signature. Other
  members of the class that share the window lower the similarity to a contained text, to ``FLOOR`` or so
  when it is crowded.
* Bands: each minimum is a band, and ``bands_for`` sets their number so that a pair at the floor collides
  in one with a probability of at least ``1 - MISSED``. Windows with equal signatures are looked up once.
* Check: pairs that collide are counted on their full shingle sets.

Rows that repeat an id are one document, of all their shingles; each row has windows of its own, told apart by
a hash of the row's shingles, and the whole document, all rows together, is a window too. A short text's
rows are one as well, its class that of its longest row.

The bitmap is the one thing that goes through the driver: ``2 ** BITMAP_BITS`` bits, whatever the input.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingotflow.llm.common import written

FLOOR, MISSED = 0.2, 1e-6
BITMAP_BITS = 20
NOT_WORD = r"[^\p{L}\p{N}]+"


def bands_for(similarity: float, missed: float) -> int:
    """How many one-minimum bands a pair of this similarity needs to collide but for ``missed``."""
    return math.ceil(math.log(missed) / math.log(1 - similarity))


def words_of(text: str) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def shingles_of(words: str, size: int) -> Column:
    """The shingles of a column of at least ``size`` hashed words."""
    at = F.sequence(F.lit(0), F.size(words) - size)
    return F.transform(at, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))))


def shingled(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``id`` and the array of ``shingles`` of each row, in the order of their positions."""
    hashed = (df.where(F.col(key).isNotNull() & F.col(text).isNotNull())
              .select(F.col(key).alias("id"), F.transform(words_of(text), lambda w: F.xxhash64(w)).alias("words")))
    return hashed.where(F.size("words") >= size).select("id", shingles_of("words", size).alias("shingles"))


def _cell(shingle: Column) -> Column:
    return F.shiftrightunsigned(shingle, 64 - BITMAP_BITS)


def bitmap_of(shingles: DataFrame) -> Column:
    """The bitmap of all shingles, as an array of longs."""
    bits = (shingles.select(_cell(F.col("shingle")).alias("cell"))
            .groupBy(F.shiftright("cell", 6).alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 AS int))")).alias("bits")).collect())
    cells = np.zeros(1 << BITMAP_BITS - 6, np.int64)
    for row in bits:
        cells[row["at"]] = row["bits"]
    return F.lit(cells)


def in_bitmap(bitmap: Column, shingle: Column) -> Column:
    cell = _cell(shingle)
    return F.getbit(F.get(bitmap, F.shiftright(cell, 6).cast("int")),
                    cell.bitwiseAND(F.lit(63)).cast("int")) == 1


def signature(bands: int) -> Column:
    return F.array(*(F.min(F.xxhash64(F.lit(i), "shingle")) for i in range(bands)))


def banded(df: DataFrame) -> DataFrame:
    return df.select("*", F.posexplode("signature").alias("band", "low")).drop("signature")


def contained(documents: DataFrame, short: DataFrame, size: int, percent: int, document_key: str,
              short_key: str, text: str = "text") -> DataFrame:
    """``document, short, shared, size, first, last`` of every containment.

    ``shared`` of the short text's ``size`` distinct shingles are in the document; ``first`` and ``last``
    are the word positions from which and up to which (exclusive) they are found.
    """
    positions = shingled(short, short_key, text, size)
    sized = positions.groupBy("id").agg(F.max(F.size("shingles")).alias("n")).select(
        F.col("id").alias("short"), F.ceil(F.log2("n")).cast("int").alias("p"))
    entries = written(positions.select(F.col("id").alias("short"), F.explode("shingles").alias("shingle"))
                      .distinct().join(sized, "short"), "short")
    bitmap = bitmap_of(entries)
    at = F.filter(F.sequence(F.lit(0), F.size("shingles") - 1),
                  lambda i: in_bitmap(bitmap, F.get("shingles", i)))
    hits = F.transform(at, lambda i: F.struct(i.alias("at"), F.get("shingles", i).alias("shingle")))
    found = written(shingled(documents, document_key, text, size)
                    .select(F.col("id").alias("document"), F.xxhash64("shingles").alias("row"), F.inline(hits)), "hits")

    bands = bands_for(FLOOR, MISSED)
    window = F.floor(F.col("at") / F.pow(F.lit(2), "p"))
    places = F.array(*(F.struct(row.alias("row"), place.alias("window")) for row, place in (
        (F.col("row"), window), (F.col("row"), window - 1), (F.lit(0).cast("bigint"), F.lit(-2).cast("bigint")))))
    windows = written(
        found.join(entries.select("shingle", "p").distinct(), "shingle")
        .select("document", "p", "shingle", F.inline(places)).groupBy("document", "row", "p", "window")
        .agg(signature(bands).alias("signature")).select("document", "p", "signature").distinct(), "windows")
    looked_up = banded(windows.select("p", "signature", F.xxhash64("signature").alias("set")).distinct())
    templates = banded(entries.groupBy("short", "p").agg(signature(bands).alias("signature")))
    matched = looked_up.join(templates, ["p", "band", "low"]).select("p", "set", "short").distinct()
    candidates = (windows.select("document", "p", F.xxhash64("signature").alias("set"))
                  .join(matched, ["p", "set"]).select("document", "short").distinct())

    counted = (found.join(entries, "shingle").join(candidates, ["document", "short"], "left_semi")
               .groupBy("document", "short", "shingle").agg(F.min("at").alias("first"), F.max("at").alias("last"))
               .groupBy("document", "short").agg(F.count("*").alias("shared"), F.min("first").alias("first"),
                                                 (F.max("last") + size).alias("last")))
    sizes = entries.groupBy("short").agg(F.count("*").alias("size"))
    return (counted.join(sizes, "short").where(F.col("shared") * 100 >= F.col("size") * percent)
            .select("document", "short", "shared", "size", "first", "last"))
