"""Approximate nearest neighbours with an inverted multi-index.

Vectors are scaled to length one and cut into halves, each half is quantised by its own
codebook of ``CENTROIDS`` centroids, and the pair of centroids is the vector's cell. A query
visits cells in the order of its summed distance to both centroids, taken from a heap, until
they hold ``VISITED`` of all vectors (at least ``LEAST``); what they hold is ranked by exact
cosine. The codebooks are fitted on a bounded sample of ``SAMPLE`` vectors, every vector is
indexed.

``VISITED`` decides the recall. The test vectors have no structure that halves could show
(the fifth neighbour lies hardly nearer than the hundredth), so it is large; on embeddings with
clusters a few hundredths would do.

Scale: equal vectors are one entry with the few smallest ids that a result can show, so a
vector that a third of all rows share is one row. Cells that hold more than ``BLOCK`` vectors are
split into blocks; blocks are dealt to buckets of about ``BUCKET`` vectors, queries into groups of
``QUERY_GROUP``, and a task ranks one bucket for one group of queries. What every task needs, the
codebooks and the size of each cell, has a fixed bound.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folianta.llm.words import mix
from folianta.storage import materialize

CENTROIDS = 64
SAMPLE = 20_000
ITERATIONS = 8
VISITED = 0.5
LEAST = 2_000
BLOCK = 4_096
BUCKET = 8_192
QUERY_GROUP = 4_096
NEAREST = 5
ASKED = ["query_id", "q_one", "q_two", "n", "vector"]
QUERY_EVERY = 50


def stacked(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled to their largest component first, against overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids."""
    return (rows**2).sum(1)[:, None] - 2 * rows @ centroids.T + (centroids**2).sum(1)


def codebook(rows: np.ndarray, seed: int) -> np.ndarray:
    """Centroids of ``rows`` by Lloyd's iterations from randomly chosen ones."""
    chosen = np.random.default_rng(seed).permutation(len(rows))[:CENTROIDS]
    centroids = rows[np.sort(chosen)]
    for _ in range(ITERATIONS):
        nearest = distances(rows, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        counts = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def traverse(left: np.ndarray, right: np.ndarray, counts: np.ndarray, quota: int) -> list[int]:
    """Non-empty cells in the order of ``left[i] + right[j]`` until they hold ``quota`` vectors."""
    rows, columns = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    a, b, ri, ci = left[rows].tolist(), right[columns].tolist(), rows.tolist(), columns.tolist()
    width, cells, held = len(ci), [], 0
    sizes = counts.tolist()
    heap = [(a[0] + b[0], 0, 0)]
    while heap and held < quota:
        _, i, j = heapq.heappop(heap)
        cell = ri[i] * width + ci[j]
        if sizes[cell]:
            cells.append(cell)
            held += sizes[cell]
        if j + 1 < width:
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return cells


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, vector`` of rows that can be compared.

    Left out: null ids, vectors that are null, empty, zero or hold null or non-finite components,
    and vectors of another length than the most frequent one.
    """
    named = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).where("vec_id IS NOT NULL AND size(vector) > 0")
    named = named.where(
        "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        " AND exists(vector, x -> x <> 0)"
    )
    widths = named.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").head(1)
    return named.where(F.size("vector") == (widths[0]["width"] if widths else 0))


def _assign(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = shared.value
        for batch in batches:
            cells = np.zeros(0, dtype=np.int32)
            if batch.num_rows:
                rows = unit(stacked(batch.column("vector")))
                half = rows.shape[1] // 2
                cells = distances(rows[:, :half], one).argmin(1) * len(two) + distances(rows[:, half:], two).argmin(1)
            names = ["ids", "one", "two", "vector"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(cells.astype(np.int32))], [*names, "cell"]
            )

    return run


def _bucket(cells: np.ndarray, blocks: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(cells.astype(np.uint64) * np.uint64(1 << 24) + blocks.astype(np.uint64)) % np.uint64(buckets)).astype(int)


def _probe(shared, quota: int, buckets: int):
    """Per query and bucket: the cells to rank there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, counts = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = unit(stacked(batch.column("vector")))
            half = rows.shape[1] // 2
            left, right = distances(rows[:, :half], one), distances(rows[:, half:], two)
            source, bucket, cells = [], [], []
            for i in range(len(rows)):
                seen = np.array(traverse(left[i], right[i], counts, quota), dtype=np.int64)
                blocks = -(-counts[seen] // BLOCK)
                where = np.repeat(seen, blocks)
                block = np.arange(len(where)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                target = _bucket(where, block, buckets)
                for at in np.unique(target):
                    source.append(i)
                    bucket.append(int(at))
                    cells.append(np.unique(where[target == at]).astype(np.int32))
            take = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name).take(take) for name in ASKED),
                    pa.array(bucket, pa.int32()),
                    pa.array(cells, pa.list_(pa.int32())),
                ],
                [*ASKED, "bucket", "cells"],
            )

    return run


def _rank(keep: int):
    """The best ``keep`` entries of one bucket for each query of a group, by exact cosine."""
    names = ["query_id", "q_one", "q_two", "n", "ids", "own", "score"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.float64()]

    def run(key: tuple, entries: pa.Table, queries: pa.Table) -> pa.Table:
        if not entries.num_rows or not queries.num_rows:
            return pa.table([pa.array([], kind) for kind in kinds], names)
        order = np.argsort(entries.column("cell").to_numpy(), kind="stable")
        entries = entries.take(pa.array(order))
        cells = entries.column("cell").to_numpy()
        rows, asked = unit(stacked(entries.column("vector"))), unit(stacked(queries.column("vector")))
        ids = entries.column("ids").combine_chunks()
        smallest = ids.values.to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
        visits: dict[int, list[int]] = {}
        for q, seen in enumerate(queries.column("cells").to_pylist()):
            for cell in seen:
                visits.setdefault(cell, []).append(q)
        best = np.full((len(asked), keep), -np.inf)
        which = np.full((len(asked), keep), -1)
        starts = np.flatnonzero(np.diff(cells, prepend=-1))
        for low, high in zip(starts, [*starts[1:], len(cells)]):
            at = np.array(visits.get(int(cells[low]), []), dtype=int)
            if len(at):
                scores = np.hstack([best[at], asked[at] @ rows[low:high].T])
                known = np.hstack([which[at], np.broadcast_to(np.arange(low, high), (len(at), high - low))])
                first = np.where(known >= 0, smallest[known], np.iinfo(np.int64).max)
                pick = np.lexsort((first, -scores), axis=1)[:, :keep]
                best[at] = np.take_along_axis(scores, pick, 1)
                which[at] = np.take_along_axis(known, pick, 1)
        q, n = np.nonzero(which >= 0)
        entry = which[q, n]
        scores = (asked[q] * rows[entry]).sum(axis=1)
        asked_for = [queries.column(name).take(pa.array(q)) for name in ASKED if name != "vector"]
        hashes = [(entries.column(a).to_numpy()[entry], queries.column(b).to_numpy()[q]) for a, b in (("one", "q_one"), ("two", "q_two"))]
        own = (hashes[0][0] == hashes[0][1]) & (hashes[1][0] == hashes[1][1])
        return pa.table([*asked_for, ids.take(pa.array(entry)), pa.array(own), pa.array(scores)], names)

    return run


def nearest(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    every: int = QUERY_EVERY,
    count: int = NEAREST,
    visited: float = VISITED,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``count`` nearest found of each query.

    Queries are the rows whose id is divisible by ``every``, candidates all other rows: a row that
    repeats a query's id, with the same vector or another, is one of its candidates and, being
    divisible too, a query with rows of its own. Equal scores go to the smaller id. Rows that
    :func:`usable` leaves out take no part, an empty table gives no rows, and other columns are
    ignored.
    """
    spark = vectors.sparkSession
    hashes = [F.xxhash64("vector").alias("one"), F.hash("vector").alias("two")]
    rows = materialize(usable(vectors, vec_id, vector).select("vec_id", *hashes, "vector"), "vectors")
    shown = Window.partitionBy("one", "two").orderBy("vec_id")
    entries = materialize(
        rows.withColumn("place", F.row_number().over(shown))
        .where(F.col("place") <= count + 1)
        .groupBy("one", "two")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("vector").alias("vector"))
        .select("ids", "one", "two", "vector"),
        "distinct-vectors",
    )
    total = entries.count()
    share = min(1.0, SAMPLE / max(total, 1))
    sample = entries.where(F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(1_000_003)) < share * 1_000_003)
    fitted = sample.orderBy(F.col("ids")[0]).select("vector").toArrow()
    if not fitted.num_rows:
        fitted = entries.limit(SAMPLE).select("vector").toArrow()
    if fitted.num_rows:
        known = unit(stacked(fitted.column("vector")))
        half = known.shape[1] // 2
        books = codebook(known[:, :half], 1), codebook(known[:, half:], 2)
    else:
        books = np.zeros((1, 0)), np.zeros((1, 0))
    indexed = materialize(
        entries.mapInArrow(
            _assign(spark.sparkContext.broadcast(books)), "ids array<bigint>, one bigint, two int, vector array<double>, cell int"
        ),
        "multi-index",
    )
    counts = np.zeros(len(books[0]) * len(books[1]), dtype=np.int64)
    for row in indexed.groupBy("cell").count().collect():  # one row a cell
        counts[row["cell"]] = row["count"]
    buckets = max(1, -(-total // BUCKET))
    facts = spark.sparkContext.broadcast((*books, counts))
    queries = (  # equal rows ask once and count n times
        rows.where(F.pmod("vec_id", F.lit(every)) == 0)
        .groupBy(F.col("vec_id").alias("query_id"), F.col("one").alias("q_one"), F.col("two").alias("q_two"))
        .agg(F.count("*").alias("n"), F.first("vector").alias("vector"))
    )
    groups = max(1, -(-queries.count() // QUERY_GROUP))
    group = F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("part")
    probes = (
        queries.repartition(max(1, min(spark.sparkContext.defaultParallelism, groups * 64)), "query_id")
        .mapInArrow(
            _probe(facts, max(LEAST, int(visited * total)), buckets),
            "query_id bigint, q_one bigint, q_two int, n bigint, vector array<double>, bucket int, cells array<int>",
        )
        .select(*ASKED, "cells", "bucket", group)
    )

    @F.pandas_udf("int")
    def bucket_of(cell, key):
        blocks = np.maximum(1, -(-facts.value[2][cell.to_numpy()] // BLOCK))
        block = (mix(key.to_numpy().astype(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)
        return cell.__class__(_bucket(cell.to_numpy(), block, buckets)).astype("int32")

    dealt = indexed.withColumn("bucket", bucket_of("cell", F.col("ids")[0])).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    ranked = (
        dealt.groupBy("bucket", "part")
        .cogroup(probes.groupBy("bucket", "part"))
        .applyInArrow(
            _rank(count + 1),
            "query_id bigint, q_one bigint, q_two int, n bigint, ids array<bigint>, own boolean, score double",
        )
    )
    asker = ["query_id", "q_one", "q_two"]
    # the row that asks is one of its entry's rows; if it is not among the smallest, others are
    itself = F.col("own") & (F.col("at") == F.array_position("ids", F.col("query_id")) - 1)
    order = Window.partitionBy(*asker).orderBy(F.desc("score"), "vec_id")
    return (
        ranked.select(*asker, "n", "score", "own", "ids", F.posexplode("ids").alias("at", "vec_id"))
        .where(~itself)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= count)
        .select(F.explode(F.sequence(F.lit(1).cast("bigint"), "n")), "query_id", "rank", "vec_id", "score")
        .drop("col")
    )


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector among all others."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op6_nearest_neighbours": op6_nearest_neighbours}
ORACLES: dict[str, str] = {}
