"""The pipeline's stages on small tables: what they drop, keep and return."""

import corpus_pipeline
from folianta.llm import token_shards

from .tables import PASSAGE, TEXTS, documents, with_extras, write_all


def staged(spark, folder, stage, docs, name):
    path = f"{folder}/{name}"
    stage(spark, docs, folder).write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark, folder):
    rare = " ".join(f"word{i} más" for i in range(400))
    texts = [*TEXTS, rare, rare.replace("word7 ", "other "), f"{PASSAGE} and what follows it"]
    write_all(folder, with_extras(documents(texts)))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = staged(spark, folder, corpus_pipeline.keep_known_languages, docs, "a")
    assert known.columns == docs.columns
    lettered = {i for i, t in enumerate(texts) if any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in known.collect()} == lettered
    single = staged(spark, folder, corpus_pipeline.drop_near_duplicates, known, "b")
    assert single.columns == docs.columns
    assert lettered - {r["doc_id"] for r in single.collect()} == {5, len(TEXTS) + 1}
    clean = staged(spark, folder, corpus_pipeline.drop_contaminated, single, "c")
    gone = {r["doc_id"] for r in single.collect()} - {r["doc_id"] for r in clean.collect()}
    assert gone == {4, 6, 7, 8, 9, len(TEXTS) + 2}
    assert {tuple(r) for r in clean.collect()} <= {tuple(r) for r in docs.collect()}
    mixed = staged(spark, folder, corpus_pipeline.mix_sources, clean, "d")
    assert mixed.columns == docs.columns
    counts = [r["count"] for r in mixed.groupBy("doc_id").count().collect()]
    assert counts and max(counts) <= 3
    shards = staged(spark, folder, corpus_pipeline.write_tokens, mixed, "e")
    total = sum(r["sequences"] for r in shards.collect())
    ends = [r["tokens"] for r in token_shards.read_sequences(shards, 0, total).collect()]
    assert sum(t[-1] == token_shards.END for t in ends) == sum(counts)


def test_run_on_empty_tables(spark, folder):
    write_all(folder, documents([]), [])
    assert corpus_pipeline.run(spark, folder).collect() == []
