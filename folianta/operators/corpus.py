"""From converted records to a clean, class-filtered and split corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from folianta import fixed_values as fixed
from folianta.functions import text as tx
from folianta.operators import split
from folianta.storage import materialize


def filter_by_subject(
    records: DataFrame, subjects: str = "subjects", pattern: str = fixed.SUBJECT_REGEX
) -> DataFrame:
    """Records with any subject that matches; subjects are matched as they stand."""
    return records.filter(tx.any_matches(F.col(subjects), pattern))


def corpus_records(
    records: DataFrame,
    keep: Sequence[str] = (),
    minority: Sequence[str] = fixed.MINORITY_CLASSES,
) -> DataFrame:
    """Normalized ``title, abstract, type`` with small classes collapsed and none missing."""
    label = tx.collapse_classes(tx.normalize_nfc(F.col("type")), minority, fixed.COLLAPSED_CLASS)
    return records.select(
        *keep,
        tx.normalize_nfc(F.col("title")).alias("title"),
        tx.normalize_nfc(F.col("abstract")).alias("abstract"),
        tx.default_label(label, fixed.UNKNOWN_CLASS).alias("type"),
    )


def prepare_corpus(
    records: DataFrame,
    key: str,
    pattern: str = fixed.SUBJECT_REGEX,
    min_rows: int = fixed.MIN_CLASS_ROWS,
    seed: str | int = 0,
    observation: Observation | None = None,
) -> DataFrame:
    """Filter, normalize, drop rare classes and split: ``(key, title, abstract, type, split)``.

    The normalized corpus is written once to the shared folder. The counting passes of the
    split then read only its key and class columns instead of repeating the text work.
    """
    if observation is not None:
        matched = tx.any_matches(F.col("subjects"), pattern)
        records = records.observe(
            observation,
            F.count("*").alias("evaluated"),
            F.coalesce(F.sum(matched.cast("long")), F.lit(0)).alias("selected"),
        )
    chosen = filter_by_subject(records, pattern=pattern)
    corpus = materialize(corpus_records(chosen, keep=[key]), "corpus")
    return split.three_way_split(corpus, key, min_rows=min_rows, seed=seed)
