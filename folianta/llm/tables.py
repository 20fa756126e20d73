"""Size-checked broadcasts, and row numbers that do not depend on how files are split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """``df`` with a broadcast hint if its rows, of about ``row_bytes``, fit in 32 MB.

    ``row_bytes`` may be an expression on the row. ``df`` should be a written table, as it is
    counted. Beyond the bound it has no hint, so the join that uses it stays a shuffle join.
    """
    if isinstance(row_bytes, Column):
        size = df.agg(F.sum(row_bytes.cast("bigint"))).first()[0] or 0
    else:
        size = df.count() * row_bytes
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


ROWS_OF_A_FILE = 1 << 40


def numbered(docs: DataFrame, *columns: str | Column, row: str = "_row") -> DataFrame:
    """``row``, a number, and ``columns`` of every row of ``docs``, a plain scan of Parquet files.

    The number is made of the file's place among the sorted paths and the row's place in its
    file. So all reads of the same files agree on it, whatever their splits: executors may come
    and go, and settings may change, between two of them. The paths, one short row a file, are
    listed first.
    """
    named = docs.select(
        *columns, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_index")
    )
    paths = sorted(r[0] for r in docs.select(F.col("_metadata.file_path").alias("path")).distinct().collect())
    listed = F.array(*map(F.lit, paths)).cast("array<string>")
    places = docs.sparkSession.range(1).select(F.posexplode(listed).alias("_file", "_path"))
    size = sum(len(path) + 64 for path in paths)
    places = F.broadcast(places) if size <= BROADCAST_BYTES else places
    number = (F.col("_file").cast("bigint") * ROWS_OF_A_FILE + F.col("_index")).alias(row)
    kept = [c for c in named.columns if c not in ("_path", "_index")]
    return named.join(places, "_path").select(number, *kept)
