"""Token occurrences, neighbouring occurrences and fixed-size batches.

Order across rows is that of a range partitioning: a position is the place in the partition
plus the rows of the partitions before it, and a neighbour is the row at the next position. Keys
may be of any type and spread; a token position or class with a third of all rows is dealt out
over as many ranges as its rows fill.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folianta.functions.text import pre_tokenize, token_positions
from folianta.storage import materialize

IN_PARTITION = (1 << 33) - 1
BLOCK = 200  # rows of a group that meet as many others in one row; their pairs are in memory at once
TASK_PAIRS, MOST_TASKS = 5_000_000, 10_000


def number_rows(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Adds ``name``: the 0-based place of each row in the order of the columns ``order``.

    Nulls come last; rows that agree in ``order`` are numbered in any order. The one window
    without partitions runs over a row per partition.
    """
    sorting = [F.col(column).asc_nulls_last() for column in order]
    ranged = materialize(
        df.repartitionByRange(*sorting)
        .sortWithinPartitions(*sorting)
        .withColumn("_id", F.monotonically_increasing_id()),
        "numbered",
    )
    ranged = ranged.withColumn("_part", F.shiftright("_id", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit(IN_PARTITION))
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, place)
        .drop("_id", "_part", "_before")
    )


def token_occurrences(
    docs: DataFrame, target: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, pos)`` of every token equal to ``target``, positions from 0."""
    hits = token_positions(F.col(text), target)
    return docs.select(key, F.posexplode(hits).alias("nth", "pos")).select(key, "pos")


def neighbours_within_document(
    docs: DataFrame, target: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, pos_a, pos_b)`` of consecutive occurrences in a document, inside the row."""
    return _neighbours_in_row(docs.select(key, token_positions(F.col(text), target).alias("hits")), key)


def _neighbours_in_row(hits: DataFrame, key: str) -> DataFrame:
    pairs = F.arrays_zip(
        F.slice("hits", F.lit(1), F.greatest(F.size("hits") - 1, F.lit(0))).alias("a"),
        F.slice("hits", F.lit(2), F.greatest(F.size("hits") - 1, F.lit(0))).alias("b"),
    )
    return hits.select(key, F.explode(pairs).alias("pair")).select(
        key,
        F.col("pair.a").alias("pos_a"),
        F.col("pair.b").alias("pos_b"),
    )


def next_in_group(rows: DataFrame, group: str, order: str) -> DataFrame:
    """Adds ``next``: the following value of ``order`` within ``group``; null for the last."""
    numbered = number_rows(rows, [group, order], "_at")  # stored already
    after = numbered.select(
        (F.col("_at") - 1).alias("_at"), F.col(group).alias("_group"), F.col(order).alias("_next")
    )
    same = F.col(group).eqNullSafe(F.col("_group"))
    return (
        numbered.join(after, "_at", "left")
        .withColumn("next", F.when(same, F.col("_next")))
        .select(*rows.columns, "next")
    )


def pairs_in_group(rows: DataFrame, group: str, order: str) -> DataFrame:
    """``(group, _a, _b)``: ``order`` of any two rows of a ``group``, ``_a`` the one that comes first.

    Rows without ``order`` are in no pair. The numbered rows are cut into blocks, and two blocks
    that a group has rows in meet in a row of their own, so a hot group is dealt out like others.
    """
    numbered = number_rows(rows.filter(F.col(order).isNotNull()).select(group, order), [group, order], "_at")
    members = F.array_sort(F.collect_list(F.struct("_at", F.col(order).alias("_value"))))
    blocks = numbered.groupBy(group, F.floor(F.col("_at") / BLOCK).cast("long").alias("_block")).agg(members.alias("_rows"))
    blocks = materialize(blocks.select(group, "_block", F.col("_rows._value").alias("_left")), "blocks")
    spans = blocks.groupBy(F.col(group).alias("_group")).agg(
        F.min("_block").alias("_first"), F.max("_block").alias("_last"), F.sum(F.size("_left")).alias("_size")
    )
    spanned = blocks.join(spans, F.col(group).eqNullSafe(F.col("_group"))).filter("_first < _last")
    earlier = spanned.filter("_block < _last").select(
        group, "_left", "_block", F.explode(F.sequence(F.col("_block") + 1, "_last")).alias("_other")
    )
    later = spanned.filter("_first < _block").select(
        F.explode(F.sequence("_first", F.col("_block") - 1)).alias("_block"),
        F.col("_block").alias("_other"),
        F.col("_left").alias("_right"),
    )
    # one group at most reaches from a block into the next, so two blocks name their group
    met = earlier.join(later, ["_block", "_other"]).select(group, "_left", "_right")
    alone = blocks.select(group, "_left", F.lit(None).cast(blocks.schema["_left"].dataType).alias("_right"))
    return _each_pair(alone.unionByName(met), spans, "_size")


def _pairs_in_row(hits: DataFrame, key: str) -> DataFrame:
    """``(key, _a, _b)``: any two of the ``hits`` of a row, in their order."""
    found = hits.filter(F.size("hits") > 1)
    starts = F.sequence(F.lit(1), F.greatest(F.size("hits"), F.lit(1)), F.lit(BLOCK))
    blocks = found.select(key, F.transform(starts, lambda start: F.slice("hits", start, BLOCK)).alias("_blocks"))
    left = blocks.select(key, "_blocks", F.posexplode("_blocks").alias("_nth", "_left"))
    alone = F.array(F.lit(None).cast(hits.schema["hits"].dataType))
    met = F.concat(alone, F.slice("_blocks", F.col("_nth") + 2, F.size("_blocks")))
    return _each_pair(left.select(key, "_left", F.explode(met).alias("_right")), found.select(F.size("hits").alias("_size")), "_size")


def _each_pair(blocks: DataFrame, groups: DataFrame, size: str) -> DataFrame:
    """Pairs of a member of ``_left`` and one of ``_right``, or a later one of ``_left`` if that is null.

    Dealt out by the number of pairs that ``groups`` of a ``size`` have: blocks are few bytes for
    the pairs they make.
    """
    n_pairs = groups.agg(F.sum(F.col(size) * (F.col(size) - F.lit(1).cast("long")) / 2)).first()[0] or 0
    tasks = min(MOST_TASKS, max(blocks.sparkSession.sparkContext.defaultParallelism, math.ceil(n_pairs / TASK_PAIRS)))
    rest = [column for column in blocks.columns if column not in ("_left", "_right")]
    firsts = blocks.repartition(tasks).select(*rest, "_left", "_right", F.posexplode("_left").alias("_nth", "_a"))
    after = F.slice("_left", F.col("_nth") + 2, F.size("_left"))
    return firsts.select(*rest, "_a", F.explode(F.coalesce("_right", after)).alias("_b"))


def neighbours_across_documents(
    docs: DataFrame, target: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(pos, doc_a, doc_b)``: consecutive documents with the target at the same position."""
    # dealing out by range reads its rows twice; texts are cut into tokens once
    return _followers(materialize(token_occurrences(docs, target, key, text), "occurrences"), key)


def _followers(hits: DataFrame, key: str) -> DataFrame:
    return (
        next_in_group(hits, "pos", key)
        .filter(F.col("next").isNotNull())
        .select("pos", F.col(key).alias("doc_a"), F.col("next").alias("doc_b"))
    )


def occurrence_pairs(
    docs: DataFrame, target: str, key: str = "doc_id", text: str = "text", every: bool = False
) -> DataFrame:
    """Occurrences at one position or in one document, as ``(kind, doc_a, pos_a, doc_b, pos_b)``.

    Every occurrence is paired with its successor, or with all that follow it if ``every`` pair is
    asked for; their number grows with the square of the occurrences at a position or in a text.
    """
    found = materialize(docs.select(key, token_positions(F.col(text), target).alias("hits")), "token-positions")
    placed = found.select(key, F.explode("hits").alias("pos"))
    if every:
        across = pairs_in_group(placed, "pos", key).select("pos", F.col("_a").alias("doc_a"), F.col("_b").alias("doc_b"))
        within = _pairs_in_row(found, key).select(key, F.col("_a").alias("pos_a"), F.col("_b").alias("pos_b"))
    else:
        across, within = _followers(placed, key), _neighbours_in_row(found, key)
    across = across.select(
        F.lit("same_position").alias("kind"),
        "doc_a",
        F.col("pos").alias("pos_a"),
        "doc_b",
        F.col("pos").alias("pos_b"),
    )
    within = within.select(
        F.lit("same_document").alias("kind"),
        F.col(key).alias("doc_a"),
        "pos_a",
        F.col(key).alias("doc_b"),
        "pos_b",
    )
    return across.unionByName(within)


def assign_batches(df: DataFrame, key: str, batch_rows: int) -> DataFrame:
    """Adds ``position``, the 0-based rank of ``key``, and ``batch``, in steps of ``batch_rows``."""
    return number_rows(df, [key]).withColumn(
        "batch", F.floor(F.col("position") / batch_rows).cast("long")
    )


def token_totals(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_tokens, n_distinct)`` per document, counted inside the row."""
    return docs.select(key, pre_tokenize(F.col(text)).alias("_t")).select(
        key,
        F.size("_t").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("_t")).cast("long").alias("n_distinct"),
    )
