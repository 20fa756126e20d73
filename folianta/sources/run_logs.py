"""Run metrics, loss histories and consolidated summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folianta import fixed_values as fixed

CONFIG_STRUCT = (
    "struct<fase string, method string, lora_r int, galore_rank int, update_proj_gap int, "
    "target_modules string, seed bigint>"
)
_INTEGER_METRICS = {"trainable_parameters", "total_parameters", "svd_call_count"}
# a final loss may be the text "N/A"
_TEXT_METRICS = {"final_train_loss", "final_eval_loss"}


def _metric_type(name: str) -> str:
    if name in _TEXT_METRICS:
        return "string"
    return "bigint" if name in _INTEGER_METRICS else "double"


_TRAIN_FIELDS = ", ".join(f"{name} {_metric_type(name)}" for name in fixed.TRAIN_METRICS)
_EVAL_FIELDS = ", ".join(f"{name} double" for name in fixed.EVAL_METRICS)
_CLASS_FIELDS = ", ".join(f"{name} double" for name in fixed.CLASS_METRICS)
TRAIN_SCHEMA = f"config {CONFIG_STRUCT}, metrics struct<{_TRAIN_FIELDS}>"
EVAL_SCHEMA = (
    f"config {CONFIG_STRUCT}, metrics struct<global struct<{_EVAL_FIELDS}>, "
    f"per_class map<string, struct<{_CLASS_FIELDS}>>>"
)
HISTORY_SCHEMA = ", ".join(
    ["epoch double", "step bigint"]
    + [f"{name} double" for name in fixed.EPOCH_METRICS]
    + [f"eval_{name} double" for name in fixed.EPOCH_METRICS]
)


def read_train_metrics(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per training run: config columns and metrics, non-numeric losses as null."""
    raw = spark.read.schema(TRAIN_SCHEMA).option("multiLine", multi_line).json(path)
    metrics = [
        F.col(f"metrics.{name}").try_cast("double").alias(name) if name in _TEXT_METRICS
        else F.col(f"metrics.{name}")
        for name in fixed.TRAIN_METRICS
    ]
    return raw.select("config.*", *metrics)


def read_eval_metrics(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per evaluated run: config, global metrics and the per-class map."""
    raw = spark.read.schema(EVAL_SCHEMA).option("multiLine", multi_line).json(path)
    return raw.select("config.*", "metrics.global.*", F.col("metrics.per_class").alias("per_class"))


def class_rows(evals: DataFrame) -> DataFrame:
    """The per-class map in long form: one row per run and class."""
    keys = [name for name in evals.columns if name != "per_class"]
    keys = [name for name in keys if name not in fixed.EVAL_METRICS]
    return evals.select(*keys, F.explode("per_class").alias("class", "scores")).select(
        *keys, "class", "scores.*"
    )


def read_loss_history(spark: SparkSession, path: str) -> DataFrame:
    """Step entries of all histories below ``path``, with the file each came from.

    A history file is one JSON array; it becomes one row per element. Partition folders
    such as ``run=...`` become columns.
    """
    entries = spark.read.schema(HISTORY_SCHEMA).option("multiLine", True).json(path)
    return entries.withColumn("run_file", F.col("_metadata.file_path"))


def summary_schema(keys: Sequence[str], metrics: Sequence[str]) -> T.StructType:
    texts = {"method", "target_modules", "class"}
    fields = [
        T.StructField(key, T.StringType() if key in texts else T.DoubleType()) for key in keys
    ]
    fields += [T.StructField(f"{name}_mean", T.DoubleType()) for name in metrics]
    fields += [T.StructField(f"{name}_std", T.DoubleType()) for name in metrics]
    return T.StructType(fields)


def write_summary_csv(summary: DataFrame, path: str) -> None:
    summary.write.option("header", True).option("emptyValue", "").csv(path)


def read_summary_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A consolidated summary; an empty cell is null."""
    schema = schema or summary_schema(fixed.CONFIG_KEYS, fixed.EVAL_METRICS)
    return spark.read.schema(schema).option("header", True).csv(path)
