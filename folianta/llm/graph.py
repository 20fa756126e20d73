"""Connected components of a table of links, by repeated star contraction.

Every round, each node hands its larger neighbours to its smallest one (large star), then its
smaller ones too (small star), until every link points at the smallest node of its component.
The number of rounds grows with the logarithm of the longest chain. Each round is two
aggregates and joins over the links, written to the shared folder; links never reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folianta.storage import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction of ``links`` (a > b, each pair once)."""
    if large:
        sides = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        sides = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = sides.join(least, "u")
    if large:
        moved = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a > b").distinct()


def _contracted(links: DataFrame) -> bool:
    """Whether every node hangs on one other that hangs on none."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionAll(
        links.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return not nodes.agg(F.max((F.col("hangs") + F.col("holds") > 1))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node in a link of ``links`` (columns ``a, b``).

    ``root`` is the smallest node of the component. Loops and repeated links change nothing.
    """
    kept = materialize(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )

    while not _contracted(kept):
        kept = materialize(_star(_star(kept, True), False), "links")
    return kept.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        kept.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
