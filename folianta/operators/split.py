"""Exact, reproducible stratified splits without sorting any class in one task.

Rows are ordered within a class by ``md5(key:seed)`` and cut at the class's quotas. A class
of any size is cut at the right row in three steps: a histogram of hash prefixes, a running
sum over at most 65,536 prefixes to find the one that holds the cut, and a ranking of that
prefix's rows alone. The result is a threshold per class and cut, so membership is a
comparison made where the row is read and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folianta import fixed_values as fixed
from folianta.storage import bounded_table

PREFIX_DIGITS = 4


def shuffle_key(key: Column, seed: str | int) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def class_frequency(df: DataFrame, label: str = "type") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def frequent_classes(df: DataFrame, label: str, min_rows: int) -> DataFrame:
    return class_frequency(df, label).filter(F.col("n") >= min_rows)


def drop_rare_classes(
    df: DataFrame, label: str = "type", min_rows: int = fixed.MIN_CLASS_ROWS
) -> DataFrame:
    """Rows whose class has at least ``min_rows`` rows."""
    kept = bounded_table(frequent_classes(df, label, min_rows).select(label))
    return df.join(kept, label, "left_semi")


def apportion(
    counts: DataFrame, label: str, n: str, held_out_share: float, into: str
) -> DataFrame:
    """Largest-remainder quotas: adds ``into``, the rows of a class that are *not* held out.

    The held-out side gets ``ceil(share * total)`` rows. Ties between remainders go to the
    class that sorts first. A class whose ``n`` is null takes no part. ``counts`` has one
    row per class, so its single-partition windows stay small.
    """
    everything = Window.partitionBy()
    sized = counts.select(
        "*",
        F.sum(n).over(everything).alias("_total"),
        F.min(n).over(everything).alias("_smallest"),
        F.count(n).over(everything).alias("_classes"),
    )
    held = F.ceil(F.lit(held_out_share) * F.col("_total")).cast("long")
    sized = sized.withColumn("_target", F.col("_total") - held)
    sized = sized.withColumn("_exact", F.col(n).cast("double") * F.col("_target") / F.col("_total"))
    sized = sized.withColumn("_whole", F.floor("_exact").cast("long"))
    by_remainder = Window.orderBy(F.desc_nulls_last(F.col("_exact") - F.col("_whole")), label)
    missing = F.col("_target") - F.sum("_whole").over(everything)
    quota = F.col("_whole") + (F.row_number().over(by_remainder) <= missing).cast("long")

    smaller_side = F.least("_target", F.col("_total") - F.col("_target"))
    checked = (
        F.when(
            F.col("_smallest") < 2,
            F.raise_error(F.lit("a class has a single row; a stratified split needs two or more")),
        )
        .when(
            smaller_side < F.col("_classes"),
            F.raise_error(F.lit("a side of the split would have fewer rows than there are classes")),
        )
        .otherwise(quota)
    )
    return sized.select(*counts.columns, checked.cast("long").alias(into))


def class_bounds(
    rows: DataFrame, key: str, label: str, quotas: DataFrame, cuts: Sequence[str], seed: str | int
) -> DataFrame:
    """``quotas`` plus, for every cut, the last ``(hash, key)`` that is still before it.

    A cut is a column with a number of rows. ``rows`` must hold each key once. A cut at 0
    has no last row and stays null.
    """
    wanted = quotas.select(
        label,
        F.explode(
            F.array(*[F.struct(F.lit(cut).alias("cut"), F.col(cut).alias("at")) for cut in cuts])
        ).alias("c"),
    ).select(label, "c.cut", "c.at")
    hashed = rows.select(
        label,
        F.struct(shuffle_key(F.col(key), seed).alias("hash"), F.col(key).alias("key")).alias("place"),
    ).withColumn("prefix", F.substring("place.hash", 1, PREFIX_DIGITS))

    histogram = hashed.groupBy(label, "prefix").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(label).orderBy("prefix")
    holds_cut = (F.col("seen") >= F.col("at")) & (F.col("seen") - F.col("n") < F.col("at"))
    found = (
        histogram.withColumn("seen", F.sum("n").over(upto))
        .join(bounded_table(wanted), label)
        .filter(holds_cut)
        .select(label, "cut", "prefix", (F.col("at") - F.col("seen") + F.col("n")).alias("take"))
    )
    in_prefix = Window.partitionBy(label, "cut").orderBy("place")
    last = (
        hashed.join(bounded_table(found), [label, "prefix"])
        .withColumn("rank", F.row_number().over(in_prefix))
        .filter(F.col("rank") == F.col("take"))
    )
    by_cut = [F.max(F.when(F.col("cut") == cut, F.col("place"))).alias(f"_last_{cut}") for cut in cuts]
    return quotas.join(last.groupBy(label).agg(*by_cut), label, "left")


def _before(key: str, seed: str | int, cut: str) -> Column:
    place = F.struct(shuffle_key(F.col(key), seed).alias("hash"), F.col(key).alias("key"))
    return F.coalesce(place <= F.col(f"_last_{cut}"), F.lit(False))


def _class_sizes(df: DataFrame, label: str, min_rows: int) -> DataFrame:
    sizes = class_frequency(df, label)
    if not sizes.filter(F.col(label).isNull()).isEmpty():
        raise ValueError(f"{label} is null in some rows: name their class before splitting")
    return bounded_table(sizes.filter(F.col("n") >= min_rows) if min_rows > 1 else sizes)


def stratified_split(
    df: DataFrame,
    key: str,
    label: str = "type",
    held_out_share: float = fixed.HELDOUT_SHARE,
    seed: str | int = 0,
    sides: tuple[str, str] = ("train", "held_out"),
    column: str = "split",
) -> DataFrame:
    """Adds ``column``: which side a row falls on. Sizes and per-class shares are exact."""
    quotas = apportion(_class_sizes(df, label, 1), label, "n", held_out_share, "_first")
    quotas = bounded_table(quotas.select(label, "_first"))
    bounds = bounded_table(class_bounds(df, key, label, quotas, ["_first"], seed))
    side = F.when(_before(key, seed, "_first"), sides[0]).otherwise(sides[1])
    return df.join(bounds, label).withColumn(column, side).select(*df.columns, column)


def three_way_split(
    df: DataFrame,
    key: str,
    label: str = "type",
    held_out_share: float = fixed.HELDOUT_SHARE,
    test_share: float = fixed.TEST_SHARE,
    min_rows: int = 1,
    min_held_out: int = fixed.MIN_HELDOUT_ROWS,
    seed: str | int = 0,
    column: str = "split",
) -> DataFrame:
    """Adds ``column`` with ``train``, ``val`` or ``test``.

    Classes with fewer than ``min_rows`` rows are dropped. Classes with fewer than
    ``min_held_out`` held-out rows lose those rows, as a second stratified cut is not
    possible there. Both cuts are made in one shuffled order of the class: the train rows
    come first, then the validation rows.
    """
    sizes = _class_sizes(df, label, min_rows)
    quotas = apportion(sizes, label, "n", held_out_share, "_train")
    held = F.col("n") - F.col("_train")
    quotas = quotas.withColumn("_held", F.when(held >= min_held_out, held))
    quotas = apportion(quotas, label, "_held", test_share, "_val")
    quotas = bounded_table(
        quotas.select(label, "_train", (F.col("_train") + F.col("_val")).alias("_train_val"))
    )
    cuts = ["_train", "_train_val"]
    bounds = bounded_table(class_bounds(df, key, label, quotas, cuts, seed))
    part = (
        F.when(_before(key, seed, "_train"), "train")
        .when(_before(key, seed, "_train_val"), "val")
        .when(F.col("_train_val").isNotNull(), "test")
    )
    split = df.join(bounds, label).withColumn(column, part)
    return split.filter(F.col(column).isNotNull()).select(*df.columns, column)


def split_integrity(whole: DataFrame, parts: DataFrame, key: str, column: str = "split") -> DataFrame:
    """``(measure, value)``: rows per part, keys in two parts, keys lost, keys invented."""
    per_key = parts.groupBy(key).agg(F.count_distinct(column).alias("parts"))
    sizes = parts.groupBy(F.concat(F.lit("rows_"), F.col(column)).alias("measure")).agg(
        F.count("*").alias("value")
    )
    shared = per_key.filter("parts > 1").agg(F.count("*").alias("value"))
    lost = whole.select(key).join(per_key, key, "left_anti").agg(F.count("*").alias("value"))
    new = per_key.join(whole.select(key), key, "left_anti").agg(F.count("*").alias("value"))
    checks = [("in_two_parts", shared), ("lost", lost), ("invented", new)]
    for name, table in checks:
        sizes = sizes.unionByName(table.select(F.lit(name).alias("measure"), "value"))
    return sizes
