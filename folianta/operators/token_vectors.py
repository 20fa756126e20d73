"""From words to vectors of a learned vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folianta.functions.vectors import input_embedding
from folianta.operators.subword import UNKNOWN, SubwordModel
from folianta.storage import bounded_table, materialize

HOT_ROWS = 1_000_000
SALTS = 32
FEW_VECTORS = 4_096


def with_vectors(
    pieces: DataFrame, vectors: DataFrame, key: str = "id", hot_rows: int = HOT_ROWS, salts: int = SALTS,
    few_vectors: int = FEW_VECTORS,
) -> DataFrame:
    """``pieces`` with the columns of ``vectors``, joined on the piece id ``key``.

    Up to ``few_vectors`` vectors are sent to where the pieces are, in one pass. Else pieces are
    dealt out by id. An id with more than ``hot_rows`` pieces is dealt out ``salts``
    times finer, and its vector repeated as often; other vectors are not. Pieces without a
    vector, and those with a null id, are left out.
    """
    pieces = pieces.filter(F.col(key).isNotNull())
    few = bounded_table(vectors, few_vectors)
    if few is not vectors:
        return pieces.join(few, key)
    pieces = materialize(pieces, "pieces")
    hot = materialize(
        pieces.groupBy(key).count().filter(F.col("count") > hot_rows).select(key, F.lit(salts).alias("_salts")), "hot-pieces"
    )
    few = bounded_table(hot)
    dealt = (
        pieces.join(few, key, "left")
        .withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.coalesce("_salts", F.lit(1))).cast("int"))
        .drop("_salts")
    )
    repeated = vectors.join(few, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    return dealt.join(repeated.drop("_salts"), [key, "_salt"]).drop("_salt")


def first_pieces(spark: SparkSession, model: SubwordModel, words: DataFrame, word: str = "word") -> DataFrame:
    """``words`` with the first ``piece`` of each and its ``id``.

    A word that is cut into several pieces is known by its first one. Words without a piece, or
    whose first piece is unknown, are left out.
    """
    coded = words.select("*", model.encode(spark, F.col(word)).alias("_coded"))
    first = coded.select(
        *words.columns, F.try_element_at("_coded.tokens", F.lit(1)).alias("piece"), F.try_element_at("_coded.ids", F.lit(1)).alias("id")
    )
    return first.filter(F.col("piece") != UNKNOWN)


def first_piece_vectors(
    spark: SparkSession, model: SubwordModel, words: DataFrame, vectors: DataFrame, word: str = "word"
) -> DataFrame:
    """``words`` with ``piece``, ``id`` and the columns of ``vectors``, whose key is ``id``.

    Vectors without a piece of the vocabulary are not read further.
    """
    named = vectors.filter(F.col("id").between(0, len(model.tokens) - 1))
    return with_vectors(first_pieces(spark, model, words, word), named)


def occurrence_vectors(
    spark: SparkSession, model: SubwordModel, docs: DataFrame, words: DataFrame, vectors: DataFrame, width: int,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(key, pos, id, vector)``: input embeddings wherever the first piece of one of ``words`` occurs.

    ``vectors`` has ``id`` and ``v``; ``pos`` is the place among the pieces of the text.
    """
    wanted = bounded_table(first_pieces(spark, model, words).select("id").distinct())
    coded = docs.select(key, model.encode(spark, F.col(text)).alias("_coded"))
    placed = coded.select(key, F.posexplode("_coded.ids").alias("pos", "id")).join(wanted, "id", "left_semi")
    return with_vectors(placed, vectors).select(
        key, "pos", "id", input_embedding(F.col("v"), F.col("pos"), width).alias("vector")
    )
