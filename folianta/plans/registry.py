"""All registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folianta.plans import (
    corpus_queries,
    evaluation_queries,
    record_queries,
    run_queries,
    text_queries,
    vector_queries,
)

AREAS = [
    text_queries,
    corpus_queries,
    record_queries,
    evaluation_queries,
    run_queries,
    vector_queries,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for area in AREAS for name, query in area.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for area in AREAS for name, sql in area.ORACLES.items()}
