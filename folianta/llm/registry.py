"""Registered queries of the operators here and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folianta.llm import (
    centroids,
    decontaminate,
    language,
    license_scan,
    line_dedup,
    mixing,
    multi_index,
    neardup,
    prefix_trie,
    secrets,
    substring_dedup,
    token_shards,
    tool_calls,
)

AREAS = [
    language,
    decontaminate,
    license_scan,
    secrets,
    mixing,
    multi_index,
    line_dedup,
    token_shards,
    tool_calls,
    neardup,
    prefix_trie,
    substring_dedup,
    centroids,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for area in AREAS for name, query in area.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for area in AREAS for name, sql in area.ORACLES.items()}
