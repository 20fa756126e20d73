"""Scores of predicted classes. One shuffle on (reference, prediction) feeds them all."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folianta import fixed_values as fixed
from folianta.functions import text as tx


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0 where ``whole`` is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def batch_predict(
    prompts: DataFrame,
    prompt: str,
    load: Callable[[], Callable[[list[str]], list[str]]],
    batch_rows: int = fixed.INFERENCE_BATCH,
    output: str = "generated_text",
) -> DataFrame:
    """Adds ``output``: what a predictor makes of each prompt, ``batch_rows`` at a time.

    ``load`` makes the predictor on the worker, once a task, so a model need not travel with
    every task. Only the prompts cross into Python; they need no order or shuffle, and batches
    are cut inside the partitions.
    """
    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for batch in batches:
            texts = batch.tolist()
            answers: list[str] = []
            for start in range(0, len(texts), batch_rows):
                answers += predict(texts[start : start + batch_rows])
            yield pd.Series(answers, dtype=object)

    return prompts.withColumn(output, answer(F.col(prompt)))


def judge(
    answers: DataFrame,
    label: str = "type",
    generated: str = "generated_text",
    classes: Sequence[str] = fixed.CLASS_DOMAIN,
    unclassified: str = fixed.UNCLASSIFIED,
) -> DataFrame:
    """Adds ``ref``, ``pred`` and ``exact``.

    ``pred`` looks for a class anywhere in the answer; ``exact`` asks whether the answer's
    first line is the reference and nothing else.
    """
    said = tx.strip_control_tokens(F.col(generated))
    return (
        answers.withColumn("ref", tx.normalize_label(F.col(label)))
        .withColumn("pred", tx.extract_category(said, classes, unclassified))
        .withColumn("exact", tx.normalize_label(tx.first_line(said)) == F.col("ref"))
    )


def align(answers: DataFrame, references: DataFrame, key: str) -> DataFrame:
    """Answers next to their references, by key."""
    return references.join(answers, key)


def confusion(judged: DataFrame) -> DataFrame:
    """``(ref, pred, n, n_exact)``; at most classes squared rows."""
    return judged.groupBy("ref", "pred").agg(
        F.count("*").alias("n"), F.sum(F.col("exact").cast("long")).alias("n_exact")
    )


def _label_sums(cells: DataFrame) -> DataFrame:
    """``(label, support, predicted, hits, exact)`` of every label on either side."""
    hit = F.when(F.col("ref") == F.col("pred"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    names = ("support", "predicted", "hits", "exact")

    def side(label: str, *values: Column) -> Column:
        named = [value.cast("long").alias(name) for name, value in zip(names, values)]
        return F.struct(F.col(label).alias("label"), *named)

    sides = F.array(
        side("ref", F.col("n"), zero, hit, F.col("n_exact")),
        side("pred", zero, F.col("n"), zero, zero),
    )
    return (
        cells.select(F.explode(sides).alias("side"))
        .groupBy("side.label")
        .agg(*[F.sum(f"side.{name}").alias(name) for name in names])
    )


def _scores() -> list[Column]:
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return [
        ratio(hits, predicted).alias("precision"),
        ratio(hits, support).alias("recall"),
        ratio(2 * hits, support + predicted).alias("f1_score"),
    ]


def class_report(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every label among references or predictions."""
    return _label_sums(cells).select("label", *_scores(), "support")


def _domain(df: DataFrame, classes: Sequence[str]) -> DataFrame:
    rows = [(index, name) for index, name in enumerate(classes)]
    return df.sparkSession.createDataFrame(rows, "class_order int, label string")


def exact_match_per_class(
    cells: DataFrame, classes: Sequence[str] = fixed.CLASS_DOMAIN
) -> DataFrame:
    """Exact-match share and support of every class of the domain, 0 without support."""
    found = cells.groupBy(F.col("ref").alias("label")).agg(
        F.sum("n").alias("support"), F.sum("n_exact").alias("n_exact")
    )
    joined = _domain(cells, classes).join(found, "label", "left")
    support = F.coalesce("support", F.lit(0).cast("long"))
    return joined.select(
        "class_order", "label",
        ratio(F.coalesce("n_exact", F.lit(0)), support).alias("exact_match"),
        support.alias("support"),
    )


def domain_report(cells: DataFrame, classes: Sequence[str] = fixed.CLASS_DOMAIN) -> DataFrame:
    """The report of the domain's classes in their order, exact match included."""
    report = class_report(cells)
    scores = ["precision", "recall", "f1_score"]
    exact = exact_match_per_class(cells, classes)
    return exact.join(report.drop("support"), "label", "left").select(
        "class_order",
        "label",
        F.initcap("label").alias("title"),
        *[F.coalesce(name, F.lit(0.0)).alias(name) for name in scores],
        "exact_match",
        "support",
    )


def global_scores(cells: DataFrame) -> DataFrame:
    """One row: ``n, accuracy, exact_match, macro_f1``; all 0 without rows."""
    sums = _label_sums(cells).select("*", *_scores())
    total = F.coalesce(F.sum("support"), F.lit(0))
    return sums.agg(
        total.alias("n"),
        ratio(F.sum("hits"), total).alias("accuracy"),
        ratio(F.sum("exact"), total).alias("exact_match"),
        F.coalesce(F.avg("f1_score"), F.lit(0.0)).alias("macro_f1"),
    )


def report_averages(cells: DataFrame) -> DataFrame:
    """The report's summary rows: accuracy, macro and support-weighted averages.

    The accuracy stands in the column of the F-scores, as reports print it.
    """
    report = class_report(cells)
    scores = ["precision", "recall", "f1_score"]
    weight = F.sum("support")
    macro = report.select(F.lit("macro avg").alias("average"), *scores, "support").groupBy(
        "average"
    ).agg(*[F.avg(name).alias(name) for name in scores], weight.alias("support"))
    weighted = report.groupBy(F.lit("weighted avg").alias("average")).agg(
        *[ratio(F.sum(F.col(name) * F.col("support")), weight).alias(name) for name in scores],
        weight.alias("support"),
    )
    total = F.coalesce(F.sum("support"), F.lit(0))
    accuracy = _label_sums(cells).agg(
        F.lit("accuracy").alias("average"),
        *[F.lit(None).cast("double").alias(name) for name in scores[:2]],
        ratio(F.sum("hits"), total).alias("f1_score"),
        total.alias("support"),
    )
    return accuracy.unionByName(macro).unionByName(weighted)


def throughput(
    samples: DataFrame, group: str, batch: str, tokens: str, seconds: str
) -> DataFrame:
    """Samples and tokens per second; a batch counts its longest row for every row."""
    batches = samples.groupBy(group, batch).agg(
        F.count("*").alias("n"),
        (F.max(tokens) * F.count("*")).alias("padded"),
        F.sum(seconds).alias("seconds"),
    )
    summed = batches.groupBy(group).agg(
        F.sum("n").alias("samples"),
        F.sum("padded").alias("tokens"),
        F.sum("seconds").alias("seconds"),
    )
    return summed.withColumn(
        "samples_per_second", ratio(F.col("samples"), F.col("seconds"))
    ).withColumn("tokens_per_second", ratio(F.col("tokens"), F.col("seconds")))
