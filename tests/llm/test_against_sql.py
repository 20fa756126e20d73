"""Operators that SQL can express, over awkward rows, repeated texts and clashing columns."""

import pytest

from folianta.llm import decontaminate, license_scan, line_dedup, mixing, secrets, tool_calls

from .tables import TEXTS, assert_same, documents, with_extras, write_all

MODULES = [decontaminate, license_scan, secrets, mixing, line_dedup, tool_calls]
CASES = [(m, name) for m in MODULES for name in m.QUERIES]


@pytest.mark.parametrize("module, name", CASES, ids=[name for _, name in CASES])
def test_awkward_rows(spark, folder, module, name):
    write_all(folder, with_extras(documents(TEXTS + TEXTS[4:12])))
    assert assert_same(spark, folder, module.QUERIES[name], module.ORACLES[name])


@pytest.mark.parametrize("module, name", CASES[:-1], ids=[name for _, name in CASES[:-1]])
def test_empty_table(spark, folder, module, name):
    write_all(folder, documents([]), [])
    assert module.QUERIES[name](spark, folder).collect() == []


def test_documents_without_benchmark(spark, folder):
    write_all(folder, items=[])
    rows = decontaminate.op2_decontaminate(spark, folder).collect()
    assert len(rows) == len(TEXTS) and not any(r.contaminated or r.n_items for r in rows)


@pytest.mark.parametrize("module, name", CASES[:4], ids=[name for _, name in CASES[:4]])
def test_repeated_and_null_ids_are_rows_of_their_own(spark, folder, module, name):
    import pyarrow as pa

    docs = documents(TEXTS[4:16])
    write_all(folder, docs)
    once = [tuple(r)[1:] for r in module.QUERIES[name](spark, folder).collect()]
    ids = pa.array([None if i % 3 else 7 for i in range(len(docs))], pa.int64())
    write_all(folder, docs.set_column(0, "doc_id", ids))
    again = [tuple(r)[1:] for r in module.QUERIES[name](spark, folder).collect()]
    if module is mixing:  # which documents are taken depends on their ids
        once, again = [r[:3] for r in once], [r[:3] for r in again]
    assert sorted(map(repr, once)) == sorted(map(repr, again))
