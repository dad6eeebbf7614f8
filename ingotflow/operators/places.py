"""Rows by where they lie: a choice made on few columns, carried back to whole rows without moving these.

A row's place is its file, as a hash of the path, and its position in it. Chosen places become bitmaps, one for
``CHUNK_ROWS`` rows of a file, and a scan of the whole rows tests them. The bitmaps are broadcast for at most
``CHUNKS_AT_ONCE`` chunks or one file at a time, so no task holds those of a whole table; a file counts as
``CHUNKS_A_FILE`` at least, as its name is held too.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE, ROW, BITS = "_place_file", "_place_row", "_place_bits"
CHUNK = "_place_chunk"
CHUNK_ROWS = 1024
CHUNKS_AT_ONCE = 65_536
CHUNKS_A_FILE = 32
IS_MARKED = (f"getbit(cast(conv(hex(substring({BITS}, cast({ROW} % {CHUNK_ROWS} div 8 AS int) + 1, 1)), 16, 10) "
             f"AS bigint), cast({ROW} % 8 AS int)) = 1")


def has_places(df: DataFrame) -> bool:
    """Whether ``df`` is a plain scan of files, so that its rows have places."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def with_places(df: DataFrame) -> DataFrame:
    return df.withColumns({FILE: F.xxhash64("_metadata.file_path"), ROW: F.col("_metadata.row_index")})


def files_of(df: DataFrame) -> dict[int, str] | None:
    """The scan's files by the hash that stands for them; none if two of them share one."""
    path = F.col("_metadata.file_path")
    hashed = df.select(F.xxhash64(path), path).distinct().collect()
    files = {number: name for number, name in hashed}
    return files if len(files) == len(hashed) else None


def marks(places: DataFrame, *kinds: str) -> DataFrame:
    """Bitmaps of the places for each file, chunk of it and value of ``kinds``."""
    # dealt out before they are counted: partial bitmaps would be larger than the places
    return (places.withColumn(CHUNK, F.expr(f"{ROW} div {CHUNK_ROWS}")).repartition(*kinds, FILE, CHUNK)
            .groupBy(*kinds, FILE, CHUNK)
            .agg(F.substring(F.bitmap_construct_agg(F.col(ROW) % CHUNK_ROWS), 1, CHUNK_ROWS // 8).alias(BITS)))


def taken(df: DataFrame, marked: DataFrame, chunks: Mapping[int, int], files: Mapping[int, str],
          others: bool = False) -> Iterator[DataFrame]:
    """The marked rows of a scan, or the others, as frames over some of its files each.

    ``chunks`` counts the marked chunks of each file, ``files`` names it.
    """
    for group in _groups({f: chunks.get(f, 0) for f in files} if others else chunks):
        scan = with_places(df.where(F.col("_metadata.file_path").isin([files[f] for f in group])))
        bits = F.broadcast(marked.where(F.col(FILE).isin(group)).select(FILE, CHUNK, BITS))
        joined = (scan.withColumn(CHUNK, F.expr(f"{ROW} div {CHUNK_ROWS}"))
                  .join(bits, [FILE, CHUNK], "left" if others else "inner"))
        is_marked = F.coalesce(F.expr(IS_MARKED), F.lit(False))
        yield joined.where(~is_marked if others else is_marked).select(*df.columns)


def _groups(chunks: Mapping[int, int]) -> Iterator[list[int]]:
    group, held = [], 0
    for file, count in sorted(chunks.items()):
        count = max(count, CHUNKS_A_FILE)
        if group and held + count > CHUNKS_AT_ONCE:
            yield group
            group, held = [], 0
        group.append(file)
        held += count
    if group:
        yield group
