"""Harvests rebuilt from landed responses: which page follows which, and what was read.

A harvester asks for a first page, then for the page that the resumption token of the last one
names, until a page has no token or cannot be read. Responses land without an order; here the
order is found by pointer doubling over the tokens, so a chain of n pages takes about log2(n)
rounds of two joins, however long it is and however many harvests there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folianta.sources.record_xml import audit_responses
from folianta.storage import materialize

FIRST_PAGE = ""


def _pages(responses: DataFrame, harvest: str, asked: str, body: str) -> DataFrame:
    """One audited response per harvest and token asked for, with the token it leads to.

    Of several responses to one token the first readable one counts, by body. The harvest is
    wrapped, so that a null one is a harvest like any other.
    """
    audited = audit_responses(
        responses.select(
            F.struct(F.col(harvest).alias("of")).alias("harvest"), F.coalesce(asked, F.lit(FIRST_PAGE)).alias("page"), F.col(body).alias("body")
        )
    )
    better = F.struct(F.col("state") == "broken", "body")
    facts = F.struct("records", "error_code", "state", "token", "body")
    return (
        audited.groupBy("harvest", "page")
        .agg(F.min_by(facts, better).alias("p"))
        .select("harvest", "page", "p.*")
        .withColumn("next", F.when(F.col("state") == "more", F.col("token")))
    )


def list_ranks(links: DataFrame, heads: Column) -> DataFrame:
    """``(list, node, rank)`` of all nodes that a list's head leads to.

    ``links`` has ``list, node, next``, at most one row per list and node; a null ``next``, or
    one that is no node, ends the list. ``heads`` tells which nodes are heads. A node that is met
    more than once, as links may run in circles, has the rank at which it is met first.

    Each round joins the nodes known so far, and the jumps themselves, with jumps twice as long
    as those of the round before. Both have one row per node at most.
    """
    jumps = materialize(
        links.filter(F.col("next").isNotNull()).select("list", "node", F.col("next").alias("to")), "jumps"
    )
    known = links.filter(heads).select("list", "node", F.lit(0).cast("bigint").alias("rank"))
    nodes = links.select("list", "node")
    known, count, length = materialize(known, "ranks"), -1, 1
    while count != (count := known.count()):
        further = (
            known.join(jumps, ["list", "node"])
            .select("list", F.col("to").alias("node"), (F.col("rank") + length).alias("rank"))
            .join(nodes, ["list", "node"], "left_semi")
        )
        known = materialize(
            known.unionAll(further).groupBy("list", "node").agg(F.min("rank").alias("rank")), "ranks"
        )
        beyond = jumps.select("list", F.col("node").alias("to"), F.col("to").alias("far"))
        jumps = materialize(jumps.join(beyond, ["list", "to"]).select("list", "node", F.col("far").alias("to")), "jumps")
        length *= 2
    return known


def harvest_chains(
    responses: DataFrame, harvest: str = "harvest", asked: str = "asked", body: str = "body"
) -> DataFrame:
    """``(harvest, page, rank, records, state, kept, harvest_state, body)``, a row per page.

    ``asked`` is the token that a response answers, null for the first page. ``rank`` is the
    page's place in its harvest, null for a page that the first one does not lead to. ``kept`` marks
    pages whose records a harvester has: readable ones with a rank; a page that cannot be
    read ends its harvest, and what was read before it stays. ``harvest_state`` tells how the last
    page with a rank ended it: ``complete`` (no token), ``broken`` (unreadable or an error),
    ``lost`` (its token was never answered, or there is no first page) or ``loop`` (its token leads
    back to a page read before).
    """
    pages = materialize(_pages(responses, harvest, asked, body), "harvest-pages")
    links = pages.select(F.col("harvest").alias("list"), F.col("page").alias("node"), "next")
    ranks = materialize(
        list_ranks(links, F.col("node") == FIRST_PAGE).select(
            F.col("list").alias("harvest"), F.col("node").alias("page"), "rank"
        ),
        "page-ranks",
    )
    ranked = pages.join(ranks, ["harvest", "page"], "left")
    last = ranked.groupBy("harvest").agg(F.max_by(F.struct("state", "next"), "rank").alias("last"))
    answered = ranks.select("harvest", F.col("page").alias("_next"), F.lit(True).alias("_met"))
    ends = (
        last.withColumn("_next", F.col("last.next"))
        .join(answered, ["harvest", "_next"], "left")
        .select(
            "harvest",
            F.when(F.col("last").isNull(), "lost")
            .when(F.col("last.state") != "more", F.col("last.state"))
            .when(F.col("_met"), "loop")
            .otherwise("lost")
            .alias("harvest_state"),
        )
    )
    kept = F.col("rank").isNotNull() & (F.col("state") != "broken")
    return ranked.join(ends, "harvest").select(
        F.col("harvest.of").alias("harvest"), "page", "rank", "records", "state", kept.alias("kept"), "harvest_state", "body"
    )


def harvest_summary(chains: DataFrame) -> DataFrame:
    """``(harvest, harvest_state, pages, pages_read, records)`` per harvest."""
    read = F.col("kept").cast("int")
    return chains.groupBy("harvest", "harvest_state").agg(
        F.count("*").alias("pages"),
        F.sum(read).alias("pages_read"),
        F.sum(F.coalesce("records", F.lit(0)) * read).alias("records"),
    )


