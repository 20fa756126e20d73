"""Substring dedup: awkward rows, ids, crowded buckets and a full bit table, against its SQL."""

import pyarrow as pa
import pytest

from folianta.llm import substring_dedup

from .tables import PASSAGE, TEXTS, assert_same, documents, with_extras, write_all

QUERY, SQL = substring_dedup.op12_substring_dedup, substring_dedup.ORACLE
SHARED = " ".join(f"w{i}" for i in range(40))


def same(spark, folder, docs):
    write_all(folder, docs)
    return assert_same(spark, folder, QUERY, SQL)


def test_awkward_rows(spark, folder):
    extra = [PASSAGE, f"{PASSAGE}\t\n{PASSAGE}", PASSAGE.upper(), f"a {SHARED} b", f"c\x0b{SHARED}", f"é ü {SHARED}"]
    assert same(spark, folder, with_extras(documents(TEXTS + TEXTS[4:12] + extra)))


def test_empty_table(spark, folder):
    write_all(folder, documents([]))
    assert QUERY(spark, folder).collect() == []


def test_null_and_repeated_ids(spark, folder):
    texts = [SHARED, SHARED, f"x {SHARED}", f"{SHARED} y", SHARED, SHARED, None, ""]
    ids = pa.array([None, 7, 7, 3, 3, None, 1, None], pa.int64())
    docs = documents(texts)
    same(spark, folder, docs.set_column(0, "doc_id", ids))
    gone = sorted((r.doc_id or -1, r.n_removed) for r in QUERY(spark, folder).collect())
    assert gone == [(-1, 0), (-1, 0), (-1, 0), (1, 0), (3, 0), (3, 0), (7, 40), (7, 40)]


def test_windows_are_judged_on_the_input(spark, folder):
    a, b = SHARED.split(" ")[:20], SHARED.split(" ")[20:]
    same(spark, folder, documents([" ".join(a), " ".join(a + b), " ".join(b), SHARED]))
    assert [r.n_removed for r in QUERY(spark, folder).orderBy("doc_id").collect()] == [0, 20, 20, 40]


CONTEXTS = [f"left{i} of{i % 5} the {' '.join(SHARED.split()[: 13 + i % 9])} right{i}" for i in range(80)]


@pytest.mark.parametrize("bits, bucket", [(1 << 15, 4_096), (1 << 15, 3), (1 << 20, 1), (1 << 20, 40)])
def test_crowded_buckets_and_full_bit_tables_change_nothing(spark, folder, bits, bucket):
    write_all(folder, documents(CONTEXTS + TEXTS[6:17]))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = {r.doc_id: (r.n_removed, r.kept_sha256) for r in QUERY(spark, folder).collect()}
    found = substring_dedup.remove_repeated(docs, bits=bits, bucket=bucket)
    digest = found.selectExpr("row.doc_id", "n_removed", "sha2(kept, 256) AS digest").collect()
    assert known == {r.doc_id: (r.n_removed, r.digest) for r in digest}


def test_runs_of_windows_cover_all_and_share_one_minimiser():
    import numpy as np

    texts = pa.array([SHARED, "a b c", None, " ".join("xy"[i % 2] for i in range(60)), PASSAGE])
    words = substring_dedup._words(texts)
    text, first, windows, found = substring_dedup.super_kmers(words, 13, 4)
    seen = [(t, f + i) for t, f, n in zip(text, first, windows) for i in range(n)]
    sizes = np.diff(words.first)
    assert seen == [(t, words.first[t] + i) for t, n in enumerate(sizes) for i in range(n - 12)]
    hashes = substring_dedup.grams(words.hashes, 4).view(np.int64)
    for f, n, m in zip(first, windows, found):
        assert all(hashes[i : i + 10].view(np.uint64).min() == np.int64(m).view(np.uint64) for i in range(f, f + n))
