import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from folianta.functions import vectors as vec
from folianta.operators import projection

RNG = np.random.default_rng(3)
ROWS = RNG.standard_normal((60, 9)) @ np.diag([9, 7, 5, 3, 1, 0.5, 0.3, 0.2, 0.1]) + 2.0


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(i, [float(x) for x in row]) for i, row in enumerate(ROWS)], "id int, v array<double>"
    ).repartition(4)


def collected(df, column):
    return np.array([r[column] for r in df.orderBy("id").collect()])


@pytest.mark.parametrize("width", [8, 7])
def test_positional_encoding(spark, width):
    got = spark.range(5).select("id", vec.positional_encoding(F.col("id"), width).alias("p"))
    expected = [
        [
            (math.sin if i % 2 == 0 else math.cos)(pos * math.exp((i - i % 2) * -math.log(1e4) / width))
            for i in range(width)
        ]
        for pos in range(5)
    ]
    assert np.allclose(collected(got, "p"), expected)


def test_elementwise(spark, table):
    out = table.select(
        "id",
        vec.layer_norm(F.col("v"), eps=1e-5).alias("n"),
        vec.sample_variance(F.col("v")).alias("s"),
        vec.mean(F.col("v")).alias("m"),
        vec.add(F.col("v"), F.col("v")).alias("a"),
        vec.cosine(F.col("v"), F.reverse("v")).alias("c"),
        vec.input_embedding(F.col("v"), F.lit(2), 9).alias("e"),
    )
    centred = ROWS - ROWS.mean(1, keepdims=True)
    assert np.allclose(collected(out, "n"), centred / np.sqrt(ROWS.var(1, keepdims=True) + 1e-5))
    assert np.allclose(collected(out, "s"), ROWS.var(1, ddof=1))
    assert np.allclose(collected(out, "a"), 2 * ROWS)
    norms = np.linalg.norm(ROWS, axis=1)
    assert np.allclose(collected(out, "c"), (ROWS * ROWS[:, ::-1]).sum(1) / norms**2)
    place = np.array(spark.range(1).select(vec.positional_encoding(F.lit(2), 9)).first()[0])
    assert np.allclose(collected(out, "e"), ROWS * 3.0 + place)


def test_zero_vectors_and_singletons(spark):
    row = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0], [3.0])], "z array<double>, v array<double>, o array<double>")
    assert row.select(vec.cosine(F.col("z"), F.col("v"))).first()[0] is None
    assert row.select(vec.sample_variance(F.col("o"))).first()[0] is None
    shown = spark.createDataFrame([([0.124, -1.3],)], "v array<double>")
    assert shown.select(vec.format_vector(F.col("v"))).first()[0] == "[0.12, -1.30]"


def numpy_components(rows, fit=None):
    fit = rows if fit is None else fit
    _, _, vt = np.linalg.svd(fit - fit.mean(0), full_matrices=False)
    axes = vt[:4]
    signs = np.sign(axes[np.arange(4), np.abs(axes).argmax(1)])
    return (rows - fit.mean(0)) @ (axes * signs[:, None]).T


def test_pca(spark, table):
    assert np.allclose(collected(projection.pca_project(table, "v"), "components"), numpy_components(ROWS))
    half = table.filter("id < 30")
    other = projection.apply_pca(projection.fit_pca(half, "v"), table, "v")
    assert np.allclose(collected(other, "components"), numpy_components(ROWS, ROWS[:30]))
    few = projection.pca_project(table.filter("id < 3"), "v")
    assert len(few.first()["components"]) == 3


@pytest.mark.parametrize("method", ["exact", "randomized"])
def test_truncated_svd(table, method):
    u, s, vt = np.linalg.svd(ROWS, full_matrices=False)
    values, left = projection.truncated_svd(table, "v", 3, method, side="left")
    assert np.allclose(values, s[:3], rtol=1e-6)
    mine = collected(left, "factors")
    assert np.allclose(np.abs(mine.T @ u[:, :3]), np.eye(3), atol=1e-4)
    _, right = projection.truncated_svd(table, "v", 3, method)
    axes = np.array([r["factors"] for r in right.orderBy("component").collect()])
    assert np.allclose(np.abs(axes @ vt[:3].T), np.eye(3), atol=1e-4)


def test_small_singular_values_keep_their_digits(spark, monkeypatch):
    monkeypatch.setattr(projection, "FOLDED", 3)
    pick = np.random.default_rng(8)
    u, v = (np.linalg.qr(pick.standard_normal(shape))[0] for shape in ((400, 6), (6, 6)))
    wanted = np.array([1.0, 1e-2, 1e-4, 1e-6, 1e-8, 1e-10])
    matrix = u * wanted @ v.T
    rows = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], "id int, v array<double>")
    for spread in (rows.coalesce(1), rows.repartition(13)):
        values, left = projection.truncated_svd(spread, "v", 6, side="left")
        assert np.allclose(values, np.linalg.svd(matrix)[1], rtol=1e-5)
        mine = collected(left, "factors")
        assert np.allclose(np.abs(mine.T @ u), np.eye(6), atol=1e-5)
    assert projection.triangle(rows.limit(2), "v").shape == (2, 6)


def test_feed_forward(table):
    w1, b1, w2, b2 = RNG.random((9, 5)), RNG.random(5), RNG.random((5, 9)), RNG.random(9)
    layers = [(w1, b1), (w2, b2)]
    plain = table.select("id", projection.feed_forward(table, F.col("v"), layers).alias("o"))
    assert np.allclose(collected(plain, "o"), (ROWS @ w1 + b1) @ w2 + b2)
    active = table.select("id", projection.feed_forward(table, F.col("v"), layers, np.tanh).alias("o"))
    assert np.allclose(collected(active, "o"), np.tanh(ROWS @ w1 + b1) @ w2 + b2)
