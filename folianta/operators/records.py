"""Record-level operators: windows, versions, search, paging, grouping, links."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folianta import fixed_values as fixed
from folianta.storage import materialize

NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _until(stamp: Column, end: str) -> Column:
    """``stamp`` is not after ``end``, a moment or a whole day."""
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", end):
        return stamp < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")
    return stamp <= F.lit(end).cast("timestamp")


def harvest_window(
    records: DataFrame,
    stamp: str = "datestamp",
    start: str | None = None,
    end: str | None = None,
    set_column: str | None = None,
    set_name: str | None = None,
) -> DataFrame:
    """Records stamped within ``[start, end]``; an absent bound is open.

    An ``end`` that names a day includes all of that day.
    """
    if start is not None:
        records = records.filter(F.col(stamp) >= F.lit(start).cast("timestamp"))
    if end is not None:
        records = records.filter(_until(F.col(stamp), end))
    if set_name is not None:
        records = records.filter(F.col(set_column) == set_name)
    return records


def latest_versions(
    records: DataFrame, key: str, stamp: str, tie_break: str | Sequence[str] | None = None
) -> DataFrame:
    """The newest version of every key, deleted or not; one without a stamp is the oldest.

    ``max_by`` keeps one row per key in the map-side aggregate, so a key with a third of
    all versions costs no more than any other.
    """
    ties = [tie_break] if isinstance(tie_break, str) else list(tie_break or [])
    order = F.struct(stamp, *ties)  # never null, so no version is passed over
    rest = [name for name in records.columns if name != key]
    newest = F.max_by(F.struct(*rest), order).alias("newest")
    return records.groupBy(key).agg(newest).select(key, "newest.*")


def latest_records(
    records: DataFrame,
    key: str,
    stamp: str,
    deleted: Column,
    tie_break: str | Sequence[str] | None = None,
) -> DataFrame:
    """The newest version of every key whose newest version is not a deletion."""
    return latest_versions(records, key, stamp, tie_break).filter(~deleted)


def date_range_facet(start: str | None, end: str | None) -> str | None:
    """The facet value of a date range. An end without a start selects nothing extra."""
    if start and end:
        return f"[{start} TO {end}]"
    return start or None


def parse_date_facet(facet: Column) -> Column:
    """``struct(low, high)`` of a facet value; a single date is both bounds."""
    low = F.regexp_extract(facet, r"^\[(.*) TO (.*)\]$", 1)
    high = F.regexp_extract(facet, r"^\[(.*) TO (.*)\]$", 2)
    return F.struct(
        F.coalesce(F.nullif(low, F.lit("")), facet).alias("low"),
        F.coalesce(F.nullif(high, F.lit("")), facet).alias("high"),
    )


def faceted_search(
    records: DataFrame,
    text: str | None = None,
    query: str | None = None,
    equals: dict[str, str] | None = None,
    date: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """Rows that contain ``query``, match every facet and fall in the date range.

    With only ``date_from`` the date must equal it; with only ``date_to`` dates are free.
    Bounds are days; a timestamp column is compared as it is, so that the scan can skip.
    """
    if query:
        records = records.filter(F.col(text).contains(query))
    for column, value in (equals or {}).items():
        records = records.filter(F.col(column) == value)
    if date_from:
        last = date_to or date_from
        if dict(records.dtypes)[date].startswith("timestamp"):
            found = (F.col(date) >= F.lit(date_from).cast("timestamp")) & _until(F.col(date), last)
        else:
            found = F.col(date).between(date_from, last)
        records = records.filter(found)
    return records


def _percent(value: Column) -> Column:
    """Percent-encoded with ``+`` for spaces; letters, digits and ``-._~`` stay."""
    return F.replace(F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def search_url(
    base: str,
    page: Column,
    query: Column | None = None,
    filters: Sequence[tuple[str, Column]] = (),
    per_page: int = fixed.RESULTS_PER_PAGE,
    double_encode_spaces: bool = False,
) -> Column:
    """A search address with its parameters in order, percent-encoded.

    ``double_encode_spaces`` replaces spaces of the query by ``+`` before encoding, so that
    they arrive as ``%2B``.
    """
    parts: list[Column] = [F.lit(f"rpp={per_page}"), F.concat(F.lit("page="), page.cast("string"))]
    if query is not None:
        sent = F.replace(query, F.lit(" "), F.lit("+")) if double_encode_spaces else query
        given = F.concat(F.lit("query="), _percent(sent))
        parts.append(F.when(query != "", given))
    for index, (kind, value) in enumerate(filters):
        parts.append(F.lit(f"filtertype_{index}={kind}"))
        parts.append(F.lit(f"filter_relational_operator_{index}=equals"))
        parts.append(F.concat(F.lit(f"filter_{index}="), _percent(value)))
    return F.concat(F.lit(f"{base}?"), F.concat_ws("&", *parts))


FEW_ROWS = 50_000


def split_at(records: DataFrame, order: Sequence[Column], place: int) -> tuple[DataFrame, DataFrame]:
    """``records`` before and from the 0-based ``place`` in ``order``; rows that tie fall on any side.

    Rows are dealt out by range and counted per range; only the range that holds the place is
    looked into, again by ranges, until it has few rows. Those are sorted, nothing else is. A
    value that many rows share is dealt out by the rest of the row and then by a number.
    """
    before: list[DataFrame] = []
    after: list[DataFrame] = []
    tie = F.xxhash64(*records.columns) if records.columns else F.lit(0)
    rows, skip, names = records, place, records.columns
    parts = max(4, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    while True:
        ranged = rows.repartitionByRange(parts, *order, tie).withColumn("_cut_range", F.spark_partition_id())
        ranged = materialize(ranged.withColumn("_cut_tie", F.monotonically_increasing_id()), "ranges")
        counts = sorted((r["_cut_range"], r["count"]) for r in ranged.groupBy("_cut_range").count().collect())
        held, at = 0, None
        for number, count in counts:
            if held + count > skip:
                at = number
                break
            held += count
        if at is None:
            before.append(ranged)
            break
        before.append(ranged.filter(F.col("_cut_range") < at))
        after.append(ranged.filter(F.col("_cut_range") > at))
        rows, skip = ranged.filter(F.col("_cut_range") == at), skip - held
        if count <= FEW_ROWS:
            whole = rows.orderBy(*order, "_cut_tie")
            before.append(whole.limit(skip))
            after.append(whole.offset(skip))
            break
        tie = F.col("_cut_tie")
    empty = records.limit(0)
    return tuple(
        reduce(DataFrame.unionAll, [part.select(*names) for part in parts], empty) for parts in (before, after)
    )


def result_page(
    records: DataFrame,
    order: Sequence[Column],
    page: int = 1,
    per_page: int = fixed.RESULTS_PER_PAGE,
) -> DataFrame:
    """The rows of one page."""
    return all_results(records, order, page, per_page, per_page)


def all_results(
    records: DataFrame,
    order: Sequence[Column],
    page: int = 1,
    per_page: int = fixed.RESULTS_PER_PAGE,
    max_items: int | None = None,
) -> DataFrame:
    """All rows from page ``page`` on, in order, or the first ``max_items`` of them.

    The first few rows are the best of each task's best. Beyond ``FEW_ROWS`` the beginning and
    the end are found by :func:`split_at`, so no task gets all rows and a deep page costs one
    pass to deal rows out, but no sort of them.
    """
    skipped = (page - 1) * per_page
    if max_items is not None and skipped + max_items <= FEW_ROWS:
        return records.orderBy(*order).offset(skipped).limit(max_items)
    if skipped:
        records = split_at(records, order, skipped)[1]
    if max_items is None:
        return records.orderBy(*order)
    if max_items <= FEW_ROWS:
        return records.orderBy(*order).limit(max_items)
    return split_at(records, order, max_items)[0].orderBy(*order)


HELD_ROWS = 200_000


def _first_nearby(values: DataFrame, by: Sequence[str], position: str) -> DataFrame:
    """``values`` with the smallest ``position`` of those that agree in ``by`` and that one task holds."""
    kept = values.select(*by, position)
    if any(isinstance(field.dataType, NESTED) for field in kept.schema):
        return kept  # Arrow does not group by these

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def firsts(tables: list[pa.Table]) -> pa.Table:
            table = pa.concat_tables(tables)
            found = table.group_by(list(by), use_threads=False).aggregate([(position, "min")])
            return found.select([*by, f"{position}_min"]).rename_columns([*by, position]).cast(table.schema)

        for batch in batches:
            held.append(firsts([pa.Table.from_batches([batch])]))
            if sum(table.num_rows for table in held) >= HELD_ROWS:
                held = [firsts(held)]
                if held[0].num_rows > HELD_ROWS // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from firsts(held).to_batches()

    return kept.mapInArrow(run, kept.schema)


def group_values(
    values: DataFrame, keys: Sequence[str], position: str = "pos", value: str = "value"
) -> DataFrame:
    """Distinct values of every group in first-seen order.

    Repeats are removed within a task first, so only distinct values are shuffled, once, and
    collected; ``keys`` should include the record the values belong to.
    """
    dealt = _first_nearby(values, [*keys, value], position).repartition(*keys)
    first_seen = dealt.groupBy(*keys, value).agg(F.min(position).alias("at"))
    listed = F.array_sort(F.collect_list(F.struct("at", value)))
    return first_seen.groupBy(*keys).agg(
        F.transform(listed, lambda entry: entry[value]).alias("values")
    )


def unseen(links: DataFrame, visited: DataFrame, key: str = "href") -> DataFrame:
    """Distinct links that are not among the visited ones.

    Both sides are distinct before they meet, so a link repeated on every page is one row.
    """
    return links.select(key).distinct().join(visited.select(key).distinct(), key, "left_anti")
