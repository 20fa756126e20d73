"""Linear maps of vector columns: PCA, truncated SVD and feed-forward layers.

Rows may be many; a vector's width is small, so width-sized matrices may reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, PCAModel, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folianta.functions.vectors import as_doubles
from folianta.storage import materialize

MAX_COMPONENTS = 4


def fit_pca(rows: DataFrame, vector: str, components: int = MAX_COMPONENTS) -> PipelineModel:
    """Centre and rotate onto the leading components."""
    features = rows.select(array_to_vector(as_doubles(F.col(vector))).alias("_raw"))
    scaler = StandardScaler(
        inputCol="_raw", outputCol="_centred", withMean=True, withStd=False
    ).fit(features)
    pca = PCA(k=components, inputCol="_centred", outputCol="_components")
    return PipelineModel([scaler, pca.fit(scaler.transform(features))])


def _component_signs(model: PCAModel) -> list[float]:
    # a component is defined up to its sign: make its largest loading positive
    loadings = model.pc.toArray()
    largest = np.abs(loadings).argmax(axis=0)
    return [1.0 if loadings[row, at] >= 0 else -1.0 for at, row in enumerate(largest)]


def apply_pca(
    model: PipelineModel, rows: DataFrame, vector: str, output: str = "components"
) -> DataFrame:
    """Adds ``output``, the components of each vector with a fixed sign."""
    signs = F.array(*map(F.lit, _component_signs(model.stages[-1])))
    raw = rows.withColumn("_raw", array_to_vector(as_doubles(F.col(vector))))
    turned = F.zip_with(vector_to_array("_components"), signs, lambda x, sign: x * sign)
    return (
        model.transform(raw).withColumn(output, turned).drop("_raw", "_centred", "_components")
    )


def pca_project(
    rows: DataFrame, vector: str, components: int = MAX_COMPONENTS, output: str = "components"
) -> DataFrame:
    """Fit and apply; as many components as there are rows, at most ``components``."""
    available = rows.limit(components).count()
    return apply_pca(fit_pca(rows, vector, min(components, available)), rows, vector, output)


FOLDED = 16  # triangles of one task in the tree


def _folded(triangle: np.ndarray | None, block: np.ndarray) -> np.ndarray:
    return np.linalg.qr(block if triangle is None else np.vstack([triangle, block]), mode="r")


def triangle(rows: DataFrame, vector: str, basis: np.ndarray | None = None) -> np.ndarray:
    """R of the QR decomposition of all rows (times ``basis``), which has their singular values.

    Each partition folds its rows into one triangle of at most as many rows as columns, and
    triangles are folded ``FOLDED`` at a time, level by level, until one is left. No product of
    the matrix with itself is formed, so small singular values keep their digits.
    """
    shared = rows.sparkSession.sparkContext.broadcast(basis)

    def of_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = None
        for frame in frames:
            if len(frame):
                block = np.stack(frame["v"]).astype(float)
                found = _folded(found, block if shared.value is None else block @ shared.value)
        if found is not None:
            yield pd.DataFrame({"cells": list(found)})

    def of_triangles(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": int(key[0]), "cells": list(_folded(None, np.stack(frame["cells"])))})

    numbered = rows.select(as_doubles(F.col(vector)).alias("v")).mapInPandas(of_rows, "cells array<double>")
    parts = materialize(numbered.select(F.spark_partition_id().alias("part"), "cells"), "triangles")
    while parts.agg(F.max("part")).first()[0]:
        level = F.floor(F.col("part") / FOLDED).cast("int").alias("level")
        folded = parts.groupBy(level).applyInPandas(of_triangles, "part int, cells array<double>")
        parts = materialize(folded, "triangles")
    return np.array([row["cells"] for row in parts.select("cells").collect()])  # one triangle


def exact_right_vectors(rows: DataFrame, vector: str, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right singular vectors ``(width, rank)`` by QR in a tree."""
    _, values, right = np.linalg.svd(triangle(rows, vector))
    kept = min(rank, len(values))
    return values[:kept], right[:kept].T


def _summed_product(
    rows: DataFrame, vector: str, product: Callable[[np.ndarray], np.ndarray], height: int
) -> np.ndarray:
    """Sum over all rows' blocks of a small ``height``-row matrix.

    Every partition adds its blocks up before anything is shuffled.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if len(frame):
                part = product(np.stack(frame["v"]).astype(float))
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"row": range(len(total)), "cells": list(total)})

    parts = rows.select(as_doubles(F.col(vector)).alias("v")).mapInPandas(
        run, "row int, cells array<double>"
    )
    cells = (
        parts.select("row", F.posexplode("cells").alias("col", "cell"))
        .groupBy("row", "col")
        .agg(F.sum("cell").alias("cell"))
        .toPandas()
    )
    out = np.zeros((height, int(cells["col"].max()) + 1))
    out[cells["row"], cells["col"]] = cells["cell"]
    return out


def randomized_right_vectors(
    rows: DataFrame,
    vector: str,
    rank: int,
    oversampling: int = 6,
    power_rounds: int = 2,
    seed: int = 0,
) -> tuple[np.ndarray, np.ndarray]:
    """The same by a random sketch (Halko et al., 2011): one pass per round plus two.

    A pass multiplies by the transpose times the matrix, so only sketch-sized sums leave
    the partitions and no row is shuffled.
    """
    width = rows.select(F.size(vector)).first()[0]
    sketch = min(rank + oversampling, width)
    basis = np.random.default_rng(seed).standard_normal((width, sketch))
    for _ in range(power_rounds + 1):
        basis, _ = np.linalg.qr(basis)
        basis = _summed_product(
            rows, vector, lambda block, b=basis: block.T @ (block @ b), width
        )
    basis, _ = np.linalg.qr(basis)
    _, values, turn = np.linalg.svd(triangle(rows, vector, basis))
    kept = min(rank, len(values))
    return values[:kept], basis @ turn[:kept].T


def truncated_svd(
    rows: DataFrame,
    vector: str,
    rank: int,
    method: str = "exact",
    side: str = "right",
    output: str = "factors",
    seed: int = 0,
) -> tuple[np.ndarray, DataFrame]:
    """Singular values, and the singular vectors of one side as a table.

    ``side='left'`` adds ``output``, a row's entries of the left vectors, to ``rows``;
    ``'right'`` gives ``(component, output)``. Null vectors take no part; without vectors
    there are no values and no rows.
    """
    rows = rows.filter(F.col(vector).isNotNull())
    width = rows.select(F.size(vector)).first()
    if width is None:
        values, right = np.zeros(0), np.zeros((0, 0))
    elif method == "exact":
        values, right = exact_right_vectors(rows, vector, rank)
    elif method == "randomized":
        values, right = randomized_right_vectors(rows, vector, rank, seed=seed)
    else:
        raise ValueError(f"unknown method {method!r}")
    if right.size:
        largest = np.abs(right).argmax(axis=0)
        right = right * np.where(right[largest, np.arange(right.shape[1])] < 0, -1.0, 1.0)
    if side == "right":
        table = [(at, [float(x) for x in column]) for at, column in enumerate(right.T)]
        spark = rows.sparkSession
        return values, spark.createDataFrame(table, f"component int, {output} array<double>")
    if side != "left":
        raise ValueError(f"unknown side {side!r}")
    scaled = right / np.where(values > 0, values, 1.0)
    return values, rows.withColumn(output, linear(rows, F.col(vector), scaled))


def linear(
    rows: DataFrame, vector: Column, weights: np.ndarray, bias: Sequence[float] | None = None
) -> Column:
    """``x W + b``, one matrix product per Arrow batch."""
    return feed_forward(rows, vector, [(weights, bias)])


def feed_forward(
    rows: DataFrame,
    vector: Column,
    layers: Sequence[tuple[np.ndarray, Sequence[float] | None]],
    activation: Callable[[np.ndarray], np.ndarray] | None = None,
) -> Column:
    """``vector`` through affine layers, with ``activation`` between them if given."""
    shared = rows.sparkSession.sparkContext.broadcast((list(layers), activation))

    @F.pandas_udf("array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        steps, between = shared.value
        for batch in batches:
            if not len(batch):
                yield pd.Series([], dtype=object)
                continue
            block = np.stack(batch.to_numpy()).astype(float)
            for at, (weights, bias) in enumerate(steps):
                if at and between is not None:
                    block = between(block)
                block = block @ weights + (0.0 if bias is None else np.asarray(bias))
            yield pd.Series(list(block))

    return project(as_doubles(vector))
