"""Registered queries over records in time: windows, versions, search, paging, ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from folianta.operators import harvest, positions, records
from folianta.plans import derived as dv
from folianta.sources import record_xml
from folianta.storage import shared_dir
from folianta.streaming import ingest

START, END, MIDDLE = "2024-01-05", "2024-01-12", "2024-01-16"
YEAR_START, YEAR_END = "1996-01-01", "1997-12-31"
ONE_DAY = "1997-06-02"


def harvest_window(spark, sf_dir):
    return records.harvest_window(
        dv.table(spark, sf_dir, "events"), "ts", START, END, "event_type", "click"
    ).select("event_id", "user_id", "value")


def _chains(spark, sf_dir):
    return harvest.harvest_chains(dv.harvests(dv.table(spark, sf_dir, "documents")))


def harvest_chains(spark, sf_dir):
    return _chains(spark, sf_dir).drop("body")


def harvest_summary(spark, sf_dir):
    return harvest.harvest_summary(_chains(spark, sf_dir))


def latest_records(spark, sf_dir):
    events = dv.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    deleted = F.col("event_type") == "error"
    return records.latest_records(events, "user_id", "ts", deleted, "event_id").drop("ts")


def _orders(spark, sf_dir):
    return dv.table(spark, sf_dir, "orders")


def _issued():
    return F.date_format("o_orderdate", "yyyy-MM-dd").alias("issued")


def faceted_search(spark, sf_dir):
    found = records.faceted_search(
        _orders(spark, sf_dir),
        text="o_orderpriority",
        query="HIGH",
        equals={"o_orderstatus": "O"},
        date="o_orderdate",
        date_from=YEAR_START,
        date_to=YEAR_END,
    )
    facet = F.lit(records.date_range_facet(YEAR_START, YEAR_END))
    bounds = records.parse_date_facet(facet)
    return found.select("o_orderkey", _issued(), bounds["low"].alias("low"), bounds["high"].alias("high"))


def search_open_end(spark, sf_dir):
    """Only a start means that very date; only an end means any date."""
    orders = _orders(spark, sf_dir)
    start = records.faceted_search(orders, date="o_orderdate", date_from=ONE_DAY)
    end = records.faceted_search(orders, date="o_orderdate", date_to=ONE_DAY)
    columns = ["o_orderkey", _issued()]
    return start.select(F.lit("from").alias("bound"), *columns).unionByName(
        end.select(F.lit("to").alias("bound"), *columns)
    )


def paged_results(spark, sf_dir):
    ranked = records.result_page(
        dv.table(spark, sf_dir, "orders"), [F.desc("o_totalprice"), F.col("o_orderkey")], page=3
    )
    return ranked.select("o_orderkey", "o_totalprice")


def paged_results_all(spark, sf_dir):
    """Everything from the third page on, without an end."""
    order = [F.desc("o_totalprice"), F.col("o_orderkey")]
    return records.all_results(dv.table(spark, sf_dir, "orders"), order, page=3).select("o_orderkey")


def undated_versions(spark, sf_dir):
    """Newest versions where every purchase has lost its stamp."""
    events = dv.table(spark, sf_dir, "events").select(
        "user_id", F.expr("CASE WHEN event_type <> 'purchase' AND user_id % 3 > 0 THEN ts END").alias("ts"), "event_id", "event_type"
    )
    return records.latest_versions(events, "user_id", "ts", "event_id").drop("ts")


def assign_batches(spark, sf_dir):
    docs = dv.table(spark, sf_dir, "documents").select("doc_id")
    return positions.assign_batches(docs, "doc_id", 16)


def assign_batches_hashed(spark, sf_dir):
    """Batches in the order of a text key that is spread over its whole range."""
    hashed = dv.table(spark, sf_dir, "documents").select(F.md5(F.col("doc_id").cast("string")).alias("key"))
    return positions.assign_batches(hashed, "key", 16)


def incremental_ingest(spark, sf_dir):
    events = dv.table(spark, sf_dir, "events")
    landing, log, checkpoint = (
        shared_dir(spark, f"ingest-{part}") for part in ("landing", "log", "checkpoint")
    )
    early = F.col("ts") < F.lit(MIDDLE).cast("timestamp")
    for drop in (early, ~early):
        dv.land_records(dv.version_rows(events.filter(drop)), landing)
        ingest.ingest_available(spark, landing, log, checkpoint)
    return ingest.current_records(spark, log).select(
        "identifier",
        F.date_format("datestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("stamp"),
        F.col("status") == record_xml.DELETED,
    ).toDF("identifier", "stamp", "deleted")


def _landed_versions(spark, sf_dir, drops):
    """Land the versions of each drop and ingest it; yields the log after each."""
    events = dv.table(spark, sf_dir, "events")
    landing, log, checkpoint = (shared_dir(spark, f"ingest-{part}") for part in ("landing", "log", "checkpoint"))
    for drop in drops:
        dv.land_records(dv.version_rows(events.filter(drop)), landing)
        ingest.ingest_available(spark, landing, log, checkpoint)
        yield log


def folded_ingest(spark, sf_dir):
    """Newest versions held in a state: two batches are folded in, a third is still in the log."""
    state = shared_dir(spark, "ingest-state")
    early, late = (F.col("ts") < F.lit(day).cast("timestamp") for day in (END, MIDDLE))
    for at, log in enumerate(_landed_versions(spark, sf_dir, [early, ~late, ~early & late])):
        if at < 2:
            ingest.fold_log(spark, log, state)
    return ingest.current_records(spark, log, state).select(
        "identifier",
        F.date_format("datestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("stamp"),
        (F.col("status") == record_xml.DELETED).alias("deleted"),
    )


def deep_page(spark, sf_dir):
    """A page of line items from far inside, in an order that many rows share."""
    lines = dv.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    order = [F.col("l_shipdate"), F.desc("l_orderkey"), F.col("l_linenumber")]
    rest = records.split_at(lines, order, 4_000)[1]
    return records.split_at(rest, order, 500)[0].select("l_orderkey", "l_linenumber", "l_quantity")


QUERIES = {
    "folded_ingest": folded_ingest,
    "deep_page": deep_page,
    "harvest_chains": harvest_chains,
    "harvest_summary": harvest_summary,
    "harvest_window": harvest_window,
    "latest_records": latest_records,
    "faceted_search": faceted_search,
    "search_open_end": search_open_end,
    "paged_results": paged_results,
    "paged_results_all": paged_results_all,
    "undated_versions": undated_versions,
    "assign_batches": assign_batches,
    "assign_batches_hashed": assign_batches_hashed,
    "incremental_ingest": incremental_ingest,
}

_LATEST = """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
             FROM events"""
_ISSUED = "strftime(o_orderdate, '%Y-%m-%d')"

_CHAINS = """
    WITH placed AS (
        SELECT source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 3 AS p FROM documents),
    pages AS (SELECT source, p, count(*) AS n, max(p) OVER (PARTITION BY source) AS last FROM placed GROUP BY source, p),
    ends(source, broken, missing, state) AS (VALUES
        ('src1', 2, NULL, 'broken'), ('src2', 1, NULL, 'broken'), ('src3', NULL, 2, 'lost'), ('src4', NULL, NULL, 'loop'),
        ('src5', NULL, 0, 'lost')),
    chains AS (
        SELECT source AS harvest, CASE WHEN p = 0 THEN '' ELSE concat(source, '-', p) END AS page,
               CASE WHEN (missing IS NULL OR p < missing) AND (broken IS NULL OR p <= broken) THEN p::BIGINT END AS rank,
               CASE WHEN p = broken THEN CASE source WHEN 'src1' THEN 0 END ELSE n END AS records,
               CASE WHEN p = broken THEN 'broken' WHEN p < last OR e.state = 'loop' THEN 'more' ELSE 'complete' END AS state,
               coalesce(e.state, 'complete') AS harvest_state
        FROM pages LEFT JOIN ends e USING (source) WHERE p IS DISTINCT FROM missing),
    found AS (SELECT *, rank IS NOT NULL AND state <> 'broken' AS kept FROM chains)"""

ORACLES = {
    "folded_ingest": """
        SELECT user_id::VARCHAR AS identifier, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS stamp, false AS deleted
        FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND event_type <> 'error'""",
    "deep_page": """
        SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        ORDER BY l_shipdate, l_orderkey DESC, l_linenumber LIMIT 500 OFFSET 4000""",
    "harvest_chains": f"{_CHAINS} SELECT harvest, page, rank, records, state, kept, harvest_state FROM found",
    "harvest_summary": f"""{_CHAINS}
        SELECT harvest, harvest_state, count(*) AS pages, sum(kept::INT)::BIGINT AS pages_read,
               coalesce(sum(records) FILTER (kept), 0)::BIGINT AS records FROM found GROUP BY ALL""",
    "harvest_window": f"""
        SELECT event_id, user_id, value FROM events
        WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}' + INTERVAL 1 DAY AND event_type = 'click'""",
    "latest_records": f"""
        SELECT user_id, event_id, event_type FROM ({_LATEST})
        WHERE rn = 1 AND event_type <> 'error'""",
    "faceted_search": f"""
        SELECT o_orderkey, {_ISSUED} AS issued, '{YEAR_START}' AS low, '{YEAR_END}' AS high
        FROM orders WHERE contains(o_orderpriority, 'HIGH') AND o_orderstatus = 'O'
          AND {_ISSUED} BETWEEN '{YEAR_START}' AND '{YEAR_END}'""",
    "search_open_end": f"""
        SELECT 'from' AS bound, o_orderkey, {_ISSUED} AS issued FROM orders WHERE {_ISSUED} = '{ONE_DAY}'
        UNION ALL SELECT 'to', o_orderkey, {_ISSUED} FROM orders""",
    "paged_results": """
        SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 200""",
    "paged_results_all": """
        SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 200""",
    "undated_versions": """
        SELECT user_id, event_id, event_type FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE
                WHEN event_type <> 'purchase' AND user_id % 3 > 0 THEN ts END DESC NULLS LAST, event_id DESC) AS rn
            FROM events) WHERE rn = 1""",
    "assign_batches": """
        SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position,
               (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch FROM documents""",
    "assign_batches_hashed": """
        SELECT md5(doc_id::VARCHAR) AS key, row_number() OVER (ORDER BY key) - 1 AS position,
               (row_number() OVER (ORDER BY key) - 1) // 16 AS batch FROM documents""",
    "incremental_ingest": f"""
        SELECT user_id::VARCHAR AS identifier, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS stamp,
               false AS deleted
        FROM ({_LATEST}) WHERE rn = 1 AND event_type <> 'error'""",
}
