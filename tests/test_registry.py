"""Registered queries against their checking SQL, at the smallest scale."""

import math
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    mine = sorted("|".join(normal(row[c]) for c in columns) for row in result.collect())
    cursor = duck.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    theirs = sorted("|".join(normal(row[at]) for at in order) for row in cursor.fetchall())
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_flagship_keeps_several_classes(spark, scale):
    found = QUERIES["prepare_corpus"](spark, f"/root/testdata/{scale}").collect()
    assert len({row["type"] for row in found}) > 2
    assert {row["split"] for row in found} == {"train", "val", "test"}


@pytest.mark.parametrize("gone", [["corpus_pipeline.py"], ["folianta/llm"], ["folianta/llm", "corpus_pipeline.py"]])
def test_loads_without_the_training_operators(folder, gone):
    root = Path(__file__).resolve().parents[1]
    left_out = shutil.ignore_patterns("__pycache__", *[Path(g).name for g in gone])
    for name in ("folianta", "corpus_pipeline.py", "__spark_entry__.py"):
        if name not in gone and (root / name).exists():
            copy = shutil.copytree if (root / name).is_dir() else shutil.copy
            copy(root / name, f"{folder}/{name}", **({"ignore": left_out} if (root / name).is_dir() else {}))
    code = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    count, whole = done.stdout.split()
    assert int(count) > 100 and whole == "True"
