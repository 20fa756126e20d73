"""Row numbers that hold whatever way files are split, and the operators that rely on them."""

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from folianta.llm import line_dedup, neardup, secrets
from folianta.llm.tables import numbered
from folianta.storage import shared_dir

from .tables import PASSAGE, TEXTS, documents, with_extras, write_all

SPLITS = {
    "spark.sql.files.maxPartitionBytes": "4k",
    "spark.sql.files.minPartitionNum": "7",
    "spark.sql.files.openCostInBytes": "1",
    "spark.sql.files.maxPartitionNum": "1",
}


@pytest.fixture
def resplit(spark):
    """Gives every read other splits than the one before."""
    kept = {key: spark.conf.get(key, None) for key in SPLITS}
    keys = list(SPLITS)

    def turn(at):
        for i, key in enumerate(keys):
            if i == at % len(keys):
                spark.conf.set(key, SPLITS[key])
            elif kept[key] is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, kept[key])

    yield turn
    for key, value in kept.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def many(folder, parts=5):
    texts = [f"{t or ''} {i}" for i in range(40) for t in TEXTS[4:12]] + [PASSAGE] * 9 + TEXTS
    table = with_extras(documents(texts))
    import os

    os.makedirs(f"{folder}/documents.parquet")
    step = -(-table.num_rows // parts)
    for at in range(parts):
        pq.write_table(
            table.slice(at * step, step), f"{folder}/documents.parquet/part {at}%.parquet", row_group_size=11
        )
    return table


def test_numbers_do_not_depend_on_splits(spark, folder, resplit):
    table = many(folder)
    seen = []
    for at in range(4):
        resplit(at)
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        rows = numbered(docs, "doc_id", "_row", row="number").collect()
        seen.append((docs.rdd.getNumPartitions(), {r["number"]: r["doc_id"] for r in rows}))
    assert len({n for n, _ in seen}) > 1
    assert all(numbers == seen[0][1] for _, numbers in seen)
    assert [seen[0][1][n] for n in sorted(seen[0][1])] == table.column("doc_id").to_pylist()


@pytest.mark.parametrize("name", ["classes", "lines", "secrets", "without"])
def test_operators_read_the_same_rows_after_a_change(spark, folder, resplit, monkeypatch, name):
    many(folder)
    turns = iter(range(10_000))

    def run():
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        if name == "classes":
            return neardup.classes(docs).select("_row", "doc_id", "root", "class_id")
        if name == "lines":
            return line_dedup.op7_line_dedup(spark, folder)
        if name == "secrets":
            return secrets.scan_versions(docs, ["doc_id"], shared_dir(spark, "ledger"))
        gone = numbered(docs, "doc_id").where("doc_id % 3 = 0")
        return corpus_pipeline._without(docs, gone)

    known = sorted(map(repr, run().collect()))
    for module in {"classes": [neardup], "lines": [line_dedup], "secrets": [secrets], "without": [corpus_pipeline]}[name]:
        keep = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, title, keep=keep: (resplit(next(turns)), keep(df, title))[1])
    assert sorted(map(repr, run().collect())) == known
    assert next(turns) > 0
