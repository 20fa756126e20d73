"""JSON lines in and out, whole or by split."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, skip_empty: bool = False) -> None:
    """Non-ASCII text is written as is. With ``skip_empty`` no rows means no files."""
    if skip_empty and df.isEmpty():
        return
    df.write.option("ignoreNullFields", "false").json(path)


def write_splits(df: DataFrame, path: str, column: str = "split") -> None:
    df.write.partitionBy(column).option("ignoreNullFields", "false").json(path)


def load_splits(
    spark: SparkSession,
    paths: Mapping[str, str],
    schema: T.StructType | str,
    column: str = "split",
) -> DataFrame:
    """The named files as one table tagged with their split."""
    parts = [
        read_jsonl(spark, path, schema).withColumn(column, F.lit(name))
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)
