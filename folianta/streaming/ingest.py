"""Incremental ingest of landed record files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folianta.operators.records import latest_records, latest_versions
from folianta.sources.record_xml import DELETED, stream_records


def ingest_available(
    spark: SparkSession,
    landing: str,
    log: str,
    checkpoint: str,
    watermark: str | None = None,
    files_per_batch: int = 1000,
) -> int:
    """Append the records of files not seen before to ``log``; returns batches run.

    The checkpoint remembers which files were read, so a later call continues there. A batch
    is written to a folder of its own number, and a retried batch replaces that folder: no
    record is lost or doubled when an executor or the driver dies.

    With ``watermark`` repeats of (identifier, datestamp) are removed in bounded state, at
    the price that later records are dropped. Without it every record is kept and
    ``current_records`` removes repeats.
    """
    records = stream_records(spark, landing, files_per_batch)
    if watermark:
        records = records.withWatermark("datestamp", watermark).dropDuplicatesWithinWatermark(
            ["identifier", "datestamp"]
        )

    stored: set[int] = set()

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")
        stored.add(number)

    query = (
        records.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(stored)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.parquet(log)


STATE_BUCKETS = 64
TIES = ["batch", "status", "sets", "dc"]


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _manifest(spark: SparkSession, state: str) -> dict[int, int]:
    """Per bucket of the state, the batch up to which it was last folded; one number a bucket."""
    if not _exists(spark, f"{state}/manifest"):
        return {}
    rows = spark.read.schema("number int, bucket int, upto int").parquet(f"{state}/manifest")
    newest = rows.groupBy("bucket").agg(F.max_by("upto", "number").alias("upto")).collect()
    return {row["bucket"]: row["upto"] for row in newest}


def _folded(spark: SparkSession, state: str, kept: dict[int, int], schema: StructType) -> DataFrame:
    """The newest versions that the state holds in the buckets of ``kept``."""
    paths = [f"{state}/versions/upto={upto}/bucket={bucket}" for bucket, upto in sorted(kept.items()) if bucket >= 0]
    rows = spark.createDataFrame([], schema) if not paths else spark.read.schema(schema).parquet(*paths)
    return rows


def fold_log(spark: SparkSession, log: str, state: str, buckets: int = STATE_BUCKETS) -> int:
    """Fold batches that the state at ``state`` has not seen into it; returns the rows read for it.

    The state holds the newest version of every record, deletions too, in buckets by identifier.
    A fold reads new batches, and of the state only the buckets that they touch; these are
    written anew under the number of the last batch, the others stay where they are. The manifest
    is appended to last, so a fold that fails halfway is as if it had not begun, and a repeated
    one replaces what it left. ``buckets`` must not change during the life of a state.
    """
    kept = _manifest(spark, state)
    seen = max(kept.values(), default=-1)  # -1 stands for the batches themselves
    fresh = read_log(spark, log).filter(F.col("batch") > seen)
    place = F.pmod(F.xxhash64("identifier"), F.lit(buckets)).cast("int").alias("bucket")
    touched = {row["bucket"]: row["count"] for row in fresh.groupBy(place).count().collect()}
    last = fresh.agg(F.max("batch")).first()[0]
    if last is None:
        return 0
    old = _folded(spark, state, {b: upto for b, upto in kept.items() if b in touched}, fresh.schema)
    versions = latest_versions(old.unionByName(fresh), "identifier", "datestamp", TIES)
    read = sum(touched.values()) + old.count()
    written = versions.withColumn("bucket", place)
    written.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{state}/versions/upto={last}")
    rows = [(int(last), bucket, int(last)) for bucket in [*touched, -1]]
    spark.createDataFrame(rows, "number int, bucket int, upto int").coalesce(1).write.mode("append").parquet(f"{state}/manifest")
    return read


def current_records(spark: SparkSession, log: str, state: str | None = None) -> DataFrame:
    """The newest version of every record in the log, without deleted ones.

    Of versions with one stamp the one that was ingested last counts; within a batch a
    deletion does, and then the larger content, so that a rerun picks the same one.

    With ``state`` only batches that :func:`fold_log` has not seen are read from the log, and where
    there are none nothing is aggregated.
    """
    rows = read_log(spark, log)
    if state is not None:
        kept = _manifest(spark, state)
        fresh = rows.filter(F.col("batch") > max(kept.values(), default=-1))
        folded = _folded(spark, state, kept, rows.schema)
        if fresh.isEmpty():
            return folded.filter(F.col("status") != DELETED).drop("batch")
        rows = folded.unionByName(fresh)
    return latest_records(rows, "identifier", "datestamp", F.col("status") == DELETED, TIES).drop("batch")
