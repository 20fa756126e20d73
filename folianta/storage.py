"""Where intermediate tables live, and how small a table must be to be broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
MAX_BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a cluster a
    machine-local folder would be lost with its executor.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="folianta-")
        spark.conf.set(CHECKPOINT_CONF, base)
    return f"{base.rstrip('/')}/folianta/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage durably: a lost executor costs a re-read, not a replay of every
    earlier round.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_table(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A broadcast copy of ``df`` if it has at most ``max_rows`` rows, else ``df`` itself.

    At most ``max_rows + 1`` rows reach the driver. A table beyond the limit is returned
    without a hint, so the join that uses it stays a shuffle join under AQE, which splits
    skewed keys.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as the cluster has cores.

    For scans of few large row groups or small tables that feed expensive per-row work. A
    table that is split enough already is returned as it is, without a shuffle.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
