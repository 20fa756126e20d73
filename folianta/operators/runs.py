"""Runs: keys, grids, joins of phases and summaries over repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folianta import fixed_values as fixed


def is_adapter(method: Column) -> Column:
    return method.isin(*fixed.ADAPTER_METHODS)


def is_projection(method: Column) -> Column:
    return method.isin(*fixed.PROJECTION_METHODS)


def null_by_method(configs: DataFrame) -> DataFrame:
    """Clears the settings that a row's method does not use."""
    method = F.col("method")
    return (
        configs.withColumn("lora_r", F.when(is_adapter(method), F.col("lora_r")))
        .withColumn("galore_rank", F.when(is_projection(method), F.col("galore_rank")))
        .withColumn("update_proj_gap", F.when(is_projection(method), F.col("update_proj_gap")))
    )


def run_key() -> Column:
    """The name of a run's files, from its configuration columns."""
    method = F.col("method")
    seed = F.concat(F.lit("s"), F.col("seed").cast("string"))
    rank = F.concat(F.lit("r"), F.col("lora_r").cast("string"))
    subspace = F.concat(F.lit("r"), F.col("galore_rank").cast("string"))
    gap = F.concat(F.lit("gap"), F.col("update_proj_gap").cast("string"))
    modules = F.col("target_modules")
    return (
        F.when(is_adapter(method), F.concat_ws("_", method, rank, modules, seed))
        .when(is_projection(method), F.concat_ws("_", method, subspace, gap, modules, seed))
        .otherwise(F.concat_ws("_", method, seed))
    )


def run_timestamp(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def match_configs(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A join on ``keys`` in which absent settings equal each other."""
    condition = None
    for key in keys:
        same = left[key].eqNullSafe(right[key])
        condition = same if condition is None else condition & same
    joined = left.join(right, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    kept = [left[name] for name in left.columns]
    return joined.select(*kept, *[right[name] for name in right.columns if name not in keys])


def expected_runs(spark: SparkSession, seeds: Sequence[int]) -> DataFrame:
    """The configurations a full study holds, times the seeds."""
    rows: list[tuple] = [("fft", None, None, None, "all")]
    for rank in fixed.GRID_RANKS:
        rows += [(method, rank, None, None, "attn") for method in ("lora", "dora")]
        rows += [(method, rank, None, None, "all") for method in fixed.ADAPTER_METHODS]
    rows += [(method, None, rank, gap, "all") for method, rank, gap in fixed.GRID_SUBSPACE]
    schema = (
        "method string, lora_r int, galore_rank int, update_proj_gap int,"
        " target_modules string, seed bigint"
    )
    return spark.createDataFrame([(*row, seed) for row in rows for seed in seeds], schema)


def missing_runs(expected: DataFrame, completed: DataFrame) -> DataFrame:
    keys = [*fixed.CONFIG_KEYS, "seed"]
    return match_configs(expected, completed.select(*keys).distinct(), keys, "left_anti")


def run_summary(runs: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of every metric per key; absent key values form a group.

    Columns are the keys, all means, then all deviations. A single run has no deviation.
    """
    means = [F.avg(name).alias(f"{name}_mean") for name in metrics]
    deviations = [F.stddev_samp(name).alias(f"{name}_std") for name in metrics]
    return runs.groupBy(*keys).agg(*means, *deviations)


def ordered_summary(runs: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return run_summary(runs, keys, metrics).orderBy(*keys)


def merge_epochs(history: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """The sparse train and evaluation entries of an epoch as one row."""
    return history.groupBy(*keys).agg(*[F.max(name).alias(name) for name in metrics])


def final_losses(
    history: DataFrame, run: str, step: str, losses: Sequence[str], absent: str = "N/A"
) -> DataFrame:
    """Per run, the last value of each loss to four decimals, or ``absent``."""
    def last(name: str) -> Column:
        latest = F.max_by(F.col(name), F.when(F.col(name).isNotNull(), F.col(step)))
        shown = F.when(latest.isNotNull(), F.format_string("%.4f", latest))
        return F.coalesce(shown, F.lit(absent)).alias(f"final_{name}")

    return history.groupBy(run).agg(*[last(name) for name in losses])


def rounded_metric(value: Column, digits: int) -> Column:
    """A metric for a report: numbers, also written ones, rounded to ``digits`` places; other
    text passes through."""
    number = value.try_cast("double")
    shown = F.round(number, digits).cast("string")
    return F.when(number.isNotNull(), shown).otherwise(value.cast("string"))


def share_percent(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, 100 * part / whole)


def milliseconds_per_call(seconds: Column, calls: Column) -> Column:
    return seconds / F.greatest(calls, F.lit(1)) * 1000
