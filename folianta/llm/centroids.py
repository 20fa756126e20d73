"""Clustering around centroids with scalar lookup tables.

Components are integers (``floor(SCALE * x)``), so a vector's squared distance to a centroid is a
sum of entries of small tables: one per dimension, with a row for every integer value that occurs
there and a column per centroid. A task tabulates the values of the rows it holds, one dimension
at a time, and gathers and adds; nothing is multiplied per vector, and all sums are exact. Tables
are made per Arrow batch, so they are never larger than the batch whatever values the data hold.

Scale: vectors are rewritten as integers once and scanned once a round, without a shuffle of rows.
A task returns one row of sums per centroid; these are added by Spark and a fixed number of
centroids reaches the driver. A vector that a third of all rows share is work like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folianta.storage import materialize

WIDTH = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = 2
LARGEST = 1 << 27  # of an integer component; 64 squared differences of two such fit in a long


def quantised(vectors: DataFrame, vec_id: str, vector: str, width: int, scale: int) -> DataFrame:
    """``vec_id, v``: usable vectors with integer components."""
    named = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    whole = named.where(F.size("x") == width).where(
        f"forall(x, y -> y IS NOT NULL AND NOT isnan(y) AND abs(y) < {LARGEST / scale}D)"
    )
    return whole.select("vec_id", F.transform("x", lambda y: F.floor(y * scale).cast("int")).alias("v"))


def seed_order(seed: int) -> list[Column]:
    """Order in which vectors become first centroids; null ids last, equal ids by components."""
    name = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    return [F.sha2(name, 256).asc_nulls_last(), F.col("v").asc()]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def squared_distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every row to every centroid, from one lookup table a dimension."""
    total = np.zeros((len(rows), len(centroids)), dtype=np.int64)
    for dimension in range(rows.shape[1]):
        values, code = np.unique(rows[:, dimension], return_inverse=True)
        table = (values[:, None] - centroids[None, :, dimension]) ** 2
        total += table[code.reshape(-1)]
    return total


def _sums(shared):
    """Per task and centroid: number and componentwise sum of its vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        counts = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros(centroids.shape, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column("v"), centroids.shape[1])
            nearest = squared_distances(rows, centroids).argmin(axis=1)  # the first of equal ones
            order = np.argsort(nearest, kind="stable")
            found, first = np.unique(nearest[order], return_index=True)
            counts += np.bincount(nearest, minlength=len(centroids))
            sums[found] += np.add.reduceat(rows[order], first, axis=0)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(held.astype(np.int32)),
                pa.array(counts[held]),
                pa.array(list(sums[held]), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "s"],
        )

    return run


def _nearest(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            found = squared_distances(_matrix(batch.column("v"), centroids.shape[1]), centroids)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(found.argmin(axis=1).astype(np.int32)),
                    pa.array(found.min(axis=1)),
                ],
                ["vec_id", "cluster", "distance"],
            )

    return run


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    width: int = WIDTH,
    scale: int = SCALE,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every usable vector, and the final integer centroids.

    First centroids are the vectors whose id hashes lowest (:func:`seed_order`); fewer vectors
    than centroids give as many centroids as there are vectors. Ties go to the smaller cluster
    number, empty clusters keep their centroid. Left out are vectors that are null, of another
    length than ``width``, with null or non-finite components, or with integer components beyond
    2**27, whose distances a long could not hold. Rows with null or repeated ids are rows of
    their own; an empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = materialize(quantised(vectors, vec_id, vector, width, scale), "integer-vectors")
    first = rows.orderBy(*seed_order(seed)).limit(centroids).select("v").collect()
    kept = np.array([row["v"] for row in first], dtype=np.int64).reshape(-1, width)
    sums = [F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(width)]
    for _ in range(rounds if len(kept) else 0):
        parts = rows.select("v").mapInArrow(
            _sums(spark.sparkContext.broadcast(kept)), "cluster int, n bigint, s array<bigint>"
        )
        moved = kept.copy()
        for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():  # one a centroid
            moved[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
        kept = moved
    kind = rows.schema["vec_id"].dataType.simpleString()
    found = rows.mapInArrow(
        _nearest(spark.sparkContext.broadcast(kept)), f"vec_id {kind}, cluster int, distance bigint"
    )
    return materialize(found, "clustered"), kept


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding with the inertia of its cluster and of all."""
    found, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    sums = dict(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    everything = sum(sums.values())
    facts = spark.createDataFrame(
        [
            (i, _long(sums.get(i)), _long(everything), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for i, c in enumerate(centroids.tolist())
        ],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return found.join(F.broadcast(facts), "cluster").select(  # one row a centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _long(value) -> int | None:
    """``value`` if a long can hold it."""
    return int(value) if value is not None and value < 1 << 63 else None


def _oracle() -> str:
    steps = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE len(embedding) = {WIDTH}
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH})""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, v) - 1 AS cluster, v AS c
            FROM kept QUALIFY cluster < {CENTROIDS})""",
    ]
    for at in range(ROUNDS + 1):
        steps.append(
            f"""a{at} AS MATERIALIZED (
            SELECT r, vec_id, v, cluster, distance FROM (
                SELECT r, vec_id, v, cluster,
                       list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
                FROM kept, c{at})
            QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1)"""
        )
        if at < ROUNDS:
            steps.append(
                f"""m{at} AS (
            SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
                SELECT cluster, i, sum(v[i]) AS s, count(*) AS n
                FROM a{at}, range(1, {WIDTH + 1}) AS dims(i) GROUP BY cluster, i)
            GROUP BY cluster),
            c{at + 1} AS MATERIALIZED (
            SELECT c{at}.cluster, coalesce(m{at}.c, c{at}.c) AS c FROM c{at} LEFT JOIN m{at} USING (cluster))"""
            )
    return f"""
    WITH {', '.join(steps)}
    SELECT vec_id, cluster::INTEGER AS cluster, distance,
           try_cast(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
           try_cast(sum(distance) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{ROUNDS} JOIN c{ROUNDS} USING (cluster)"""


QUERIES = {"op13_centroid_clusters": op13_centroid_clusters}
ORACLES = {"op13_centroid_clusters": _oracle()}
