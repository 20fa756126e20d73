"""Vectors of learned pieces: first pieces, unknown words, hot ids."""

from pyspark.sql import functions as F

from folianta.operators import subword, token_vectors
from folianta.plans import vector_queries

MODEL = subword.SubwordModel("wordpiece", ["[UNK]", "lu", "##na", "sol", "##a"], prefix="##", longest_word=None)


def test_first_pieces(spark):
    words = spark.createDataFrame([("luna", 1), ("sol", 2), ("xx", 3), ("", 4), (None, 5), ("lua", 6)], "word string, at int")
    found = token_vectors.first_pieces(spark, MODEL, words).collect()
    assert {(r["word"], r["piece"], r["id"]) for r in found} == {("luna", "lu", 1), ("sol", "sol", 3), ("lua", "lu", 1)}


def test_hot_pieces_are_dealt_out_and_none_is_lost(spark):
    pieces = spark.range(4_000).select(F.when(F.col("id") % 4 > 0, 1).otherwise(F.col("id") % 7).alias("id"), F.lit("same").alias("x"))
    pieces = pieces.withColumn("id", F.when(F.col("id") == 5, None).otherwise(F.col("id")))
    vectors = spark.createDataFrame([(i, [float(i)]) for i in (0, 1, 2, 9)], "id bigint, v array<double>")
    plain = pieces.join(vectors, "id").groupBy("id", "v").count().collect()
    for hot in (10, 1_000_000):
        found = token_vectors.with_vectors(pieces, vectors, hot_rows=hot)
        assert found.columns == ["id", "x", "v"]
        assert sorted(map(str, found.groupBy("id", "v").count().collect())) == sorted(map(str, plain))


def test_occurrences_of_first_pieces(spark):
    docs = spark.createDataFrame([(1, "luna sol lua"), (2, "xx"), (3, None), (4, "sola luna")], "doc_id int, text string")
    words = spark.createDataFrame([("luna",)], "word string")
    vectors = spark.createDataFrame([(1, [1.0, 0.0])], "id bigint, v array<double>")
    found = token_vectors.occurrence_vectors(spark, MODEL, docs, words, vectors, 2).collect()
    # luna: lu ##na, sol: sol, lua: lu ##a; sola: sol ##a
    assert sorted((r["doc_id"], r["pos"]) for r in found) == [(1, 0), (1, 3), (4, 2)]
    assert [round(x, 6) for x in min(found)["vector"]] == [round(2**0.5, 6), 1.0]


def test_few_vectors_go_to_the_pieces(spark, monkeypatch):
    pieces = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (7, "e")], "id int, x string")
    vectors = spark.createDataFrame([(1, [1.0]), (1, [2.0]), (7, [7.0]), (9, [9.0]), (None, [0.0])], "id bigint, v array<double>")
    dealt = token_vectors.with_vectors(pieces, vectors, few_vectors=4)
    assert dealt.columns == ["id", "x", "v"]
    expected = sorted(map(str, dealt.collect()))
    assert len(expected) == 5

    def written(*_):
        raise AssertionError("pieces need not be written")

    monkeypatch.setattr(token_vectors, "materialize", written)
    found = token_vectors.with_vectors(pieces, vectors)
    assert found.columns == ["id", "x", "v"]
    assert sorted(map(str, found.collect())) == expected


def test_words_are_counted_and_coded_once(spark, sf_dir, monkeypatch):
    counted = []
    counts = vector_queries._counts
    monkeypatch.setattr(vector_queries, "_counts", lambda *given: counted.append(1) or counts(*given))
    found = vector_queries.first_piece_vectors(spark, sf_dir)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(counted) == 1 and "regexp_extract_all" in plan
    assert plan.count("encode_words") == 1 and "format_string" not in plan
