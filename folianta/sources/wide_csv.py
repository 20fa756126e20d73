"""Wide multi-language CSV exports: one column per field and language."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from folianta import fixed_values as fixed
from folianta.functions.text import best_by_language, merge_lists, split_list
from folianta.storage import MAX_BROADCAST_ROWS, bounded_table, materialize

# quoted cells hold newlines; a doubled quote stands for a quote
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def columns_like(names: Sequence[str], patterns: Sequence[str]) -> list[str]:
    """Names that contain any pattern, in their own order."""
    return [name for name in names if any(pattern in name for pattern in patterns)]


def select_like(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{name}`") for name in columns_like(df.columns, patterns)])


def read_wide_csv(
    spark: SparkSession,
    path: str,
    patterns: Sequence[str] = (
        *fixed.TITLE_PATTERNS, *fixed.ABSTRACT_PATTERNS,
        *fixed.SUBJECT_PATTERNS, *fixed.TYPE_PATTERNS,
    ),
    missing: Sequence[str] = fixed.MISSING_CELLS,
) -> DataFrame:
    """The columns whose header matches, all strings, with missing-value tokens as null.

    Files are read under their own headers and united by column name, a column that a file
    lacks being null. A file larger than Spark's read partitions is read by many tasks
    (:func:`rows_by_blocks`), a smaller one by one.
    """
    def cell(name: str):
        value = F.col(f"`{name}`")
        return F.when(~value.isin(*missing), value).alias(name)

    tables = []
    for (header, large), files in _headers(spark, path).items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        if large:
            named = ", ".join(f"c{at} string" for at in range(len(header)))
            row = F.from_csv("text", named, {**CSV_OPTIONS, "header": "false"})
            raw = rows_by_blocks(spark, files).filter("NOT first").select(row.alias("row")).select("row.*").toDF(*header)
        else:
            raw = spark.read.options(**CSV_OPTIONS).schema(schema).csv(files)
        tables.append(raw.select(*[cell(name) for name in columns_like(header, patterns)]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def rows_by_blocks(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(text, first)``: rows of CSV files with quoted line ends, read in blocks by many tasks.

    Whether a line end is quoted depends on all quotes before it. So quotes are counted per block
    first; the sums of the blocks before tell for each block whether it begins inside a quoted
    cell. Every block is then cut into rows from its first true row end on. What stands before
    it, and after the last one, are pieces of a row that lies in several blocks, and are put
    together, a row at most per block. ``first`` marks the first row of a file; empty lines are no
    rows. A quote inside a cell must be doubled in a quoted cell, as CSV wants it.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    states = materialize(
        lines.groupBy("file", "block")
        .agg(F.sum(quotes).alias("quotes"))
        .select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside")),
        "csv-blocks",
    )
    numbered = lines.withColumn("at", F.monotonically_increasing_id())
    placed = numbered.join(bounded_table(states), ["file", "block"])
    if states.count() > MAX_BROADCAST_ROWS:  # a shuffle join loses the order of lines
        placed = placed.repartition("file", "block").sortWithinPartitions("file", "block", "at")
    kind = "file string, block bigint, part int, first boolean, text string"
    parts = materialize(
        placed.select("file", "block", "inside", "value").mapInArrow(_cut_rows, kind), "csv-rows"
    )
    in_file = Window.partitionBy("file").orderBy("block", "part")
    pieces = parts.filter("part <> 0").withColumn("row", F.sum(F.when(F.col("part") == 1, 1).otherwise(0)).over(in_file))
    ordered = F.array_sort(F.collect_list(F.struct("block", "part", "text")))
    joined = pieces.groupBy("file", "row").agg(
        F.array_join(F.transform(ordered, lambda p: p["text"]), "\n").alias("text"), F.max("first").alias("first")
    )
    rows = parts.filter("part = 0").select("text", "first").unionAll(joined.select("text", "first"))
    bare = F.regexp_replace("text", r"\r$", "")
    return rows.select(bare.alias("text"), "first").filter("text <> ''")


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the blocks that a task reads, lines coming in order.

    ``part`` is 0 for a whole row, -1 for the end of a row that began in an earlier block (or a
    piece of one that goes on) and 1 for the beginning of a row that goes on in the next.
    """
    place, held, begun, inside, first = None, [], False, False, False
    names = ["file", "block", "part", "first", "text"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        rows = []
        columns = [batch.column(name).to_pylist() for name in ("file", "block", "inside", "value")]
        for file, block, opens, value in zip(*columns):
            if (file, block) != place:
                if held:
                    rows.append((*place, 1 if begun else -1, first, "\n".join(held)))
                place, held, inside, begun, first = (file, block), [], opens, not opens, block == 0
            held.append(value)
            if value.count('"') % 2:
                inside = not inside
            if not inside:
                rows.append((*place, 0 if begun else -1, first, "\n".join(held)))
                held, begun, first = [], True, False
        yield batch_of(rows)
    if held:
        yield batch_of([(*place, 1 if begun else -1, first, "\n".join(held))])


def _headers(spark: SparkSession, path: str) -> dict[tuple[tuple[str, ...], bool], list[str]]:
    """Each header below ``path``, and whether its files are large, with the files.

    In the order of the first file.
    """
    largest = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    ))
    lines = spark.read.text(path).select(
        "value", "_metadata.file_path", "_metadata.file_size", "_metadata.file_block_start",
        F.monotonically_increasing_id().alias("at"),
    )
    first = (
        lines.filter("file_block_start = 0")
        .groupBy("file_path")
        .agg(F.min_by("value", "at").alias("line"), F.first("file_size").alias("file_size"))
    )
    found: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for row in first.orderBy("file_path").collect():  # one line a file
        header = tuple(next(csv.reader([row["line"].removeprefix("\ufeff")])))
        found.setdefault((header, row["file_size"] > largest), []).append(row["file_path"])
    return found


def write_wide_csv(df: DataFrame, path: str) -> None:
    options = {name: value for name, value in CSV_OPTIONS.items() if name != "multiLine"}
    df.write.options(**options).csv(path)


def convert_records(
    wide: DataFrame, keep: Sequence[str] = (), observation: Observation | str | None = None
) -> DataFrame:
    """``(title, abstract, type, subjects)`` of every row that has a title.

    ``observation`` counts the rows ``read`` and those ``valid``, as they pass: an Observation for a
    batch, a name for a stream (see :class:`ConversionCounters`).
    """
    names = wide.columns
    subjects = columns_like(names, fixed.SUBJECT_PATTERNS)
    lists = [split_list(F.col(f"`{name}`")) for name in subjects]
    converted = wide.select(
        *keep,
        best_by_language(columns_like(names, fixed.TITLE_PATTERNS)).alias("title"),
        best_by_language(columns_like(names, fixed.ABSTRACT_PATTERNS)).alias("abstract"),
        best_by_language(columns_like(names, fixed.TYPE_PATTERNS)).alias("type"),
        (merge_lists(*lists) if lists else F.array().cast("array<string>")).alias("subjects"),
    )
    valid = F.col("title") != ""
    if observation is not None:
        converted = converted.observe(
            observation, F.count("*").alias("read"), F.count(F.when(valid, True)).alias("valid")
        )
    return converted.filter(valid)


class ConversionCounters(StreamingQueryListener):
    """Sums the counters of observed conversions over all batches of the streams of a session.

    Add it with ``spark.streams.addListener``; ``totals`` has ``read`` and ``valid`` by the name given to
    :func:`convert_records`.
    """

    def __init__(self) -> None:
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            known = self.totals.setdefault(name, {})
            for counter, value in row.asDict().items():
                known[counter] = known.get(counter, 0) + value

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
