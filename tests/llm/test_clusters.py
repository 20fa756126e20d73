"""Clusters by lookup tables: against SQL and the plain algorithm, and awkward vectors."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from folianta.llm import centroids

from .tables import assert_same, with_extras

QUERY, SQL = centroids.op13_centroid_clusters, centroids.ORACLES["op13_centroid_clusters"]
NAN, INF = float("nan"), float("inf")


def vectors(rows):
    ids, values = zip(*rows) if rows else ((), ())
    return pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(values, pa.list_(pa.float32()))})


def drawn(count, seed=1):
    pick = random.Random(seed)
    return [(i, [pick.choice([-1.5, -0.3, 0, 1 / 256, 0.7]) + pick.gauss(0, 0.1) for _ in range(64)]) for i in range(count)]


def test_matches_sql_on_awkward_rows(spark, folder):
    rows = drawn(90)
    odd = [None, [], [0.5] * 63, [0.5] * 65, [None] + [0.5] * 63, [NAN] + [0.5] * 63, [INF] + [0.5] * 63]
    rows += [(200 + i, v) for i, v in enumerate(odd)] + rows[:30] * 3 + [(300, [0.0] * 64), (None, rows[1][1])]
    pq.write_table(with_extras(vectors(rows)), f"{folder}/embeddings.parquet")
    assert assert_same(spark, folder, QUERY, SQL, ["embeddings"]) == 90 + 90 + 2


def test_few_equal_and_no_vectors(spark, folder):
    for rows in ([], [(5, [0.25] * 64)], [(5, [0.25] * 64)] * 4, drawn(3)):
        pq.write_table(vectors(rows), f"{folder}/embeddings.parquet")
        assert assert_same(spark, folder, QUERY, SQL, ["embeddings"]) == len(rows)


def test_components_too_large_for_a_long_are_left_out(spark, folder):
    pq.write_table(vectors(drawn(3) + [(9, [1e30] * 64), (10, [5e5] * 64)]), f"{folder}/embeddings.parquet")
    found = {r.vec_id: r for r in QUERY(spark, folder).collect()}
    assert set(found) == {0, 1, 2, 10}


def test_equals_the_plain_algorithm(spark, folder):
    rows = drawn(300, seed=4)
    pq.write_table(vectors(rows), f"{folder}/embeddings.parquet")
    whole = np.floor(np.array([v for _, v in rows], dtype=np.float32).astype(float) * 256).astype(int)
    order = sorted(range(300), key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())
    kept = whole[order[:40]]

    def nearest():
        return [min(range(40), key=lambda c: (int(((v - kept[c]) ** 2).sum()), c)) for v in whole]

    for _ in range(5):
        at = np.array(nearest())
        kept = np.array([
            [int(s) // int((at == c).sum()) for s in whole[at == c].sum(0)] if (at == c).any() else kept[c]
            for c in range(40)
        ])
    final = nearest()
    assert {r.vec_id: r.cluster for r in QUERY(spark, folder).collect()} == dict(enumerate(final))


def test_tables_give_squared_distances():
    rows, other = np.arange(12).reshape(3, 4) - 5, np.array([[1, -2, 3, -4], [0, 0, 0, 1 << 27]])
    expected = ((rows[:, None] - other[None]) ** 2).sum(2)
    assert (centroids.squared_distances(rows, other) == expected).all()
