"""From raw documents to token shards: five stages, each written and read by the next.

Language identification, near-duplicate removal, benchmark decontamination, mixing of sources
and token output. Every stage works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folianta.llm import decontaminate, language, mixing, neardup, token_shards
from folianta.llm.tables import numbered, small
from folianta.storage import materialize


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows numbered in ``gone``, by their place in the scanned files."""
    rows = materialize(gone.select("_row"), "removed-rows")
    placed = numbered(docs, F.struct(*docs.columns).alias("_doc"))
    return placed.join(small(rows, 16), "_row", "left_anti").select("_doc.*")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "lang")]
    boxed = docs.select("doc_id", "text", "lang", F.struct(F.lit(0).alias("_"), *rest).alias("_rest"))
    found = language.identify(boxed, keep=boxed.columns).where(~language.rejected())
    return found.select(*[F.col("_rest")[c].alias(c) if c in rest else c for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each class of near duplicates."""
    return _without(docs, neardup.classes(docs).where("_row <> root"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage to speak of."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, items)
    return _without(docs, found.where(decontaminate.contaminated()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.repeat_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order."""
    return token_shards.token_shards(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

# Sampling, regression and token output are not expressible in SQL; tests compare the stages
# with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
