"""Dense vectors as ``array<double>`` columns, with higher-order functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from folianta.functions.text import bind

BASE = 10000.0


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def mean(vector: Column) -> Column:
    return total(vector) / F.size(vector)


def squared_deviation(vector: Column) -> Column:
    def around(centre: Column) -> Column:
        return F.aggregate(
            vector, F.lit(0.0), lambda acc, x: acc + (x - centre) * (x - centre)
        )

    return bind(mean(vector), around)  # inlined, the mean would be redone per element


def sample_variance(vector: Column) -> Column:
    """Variance with n - 1; null for fewer than two values."""
    n = F.size(vector)
    return F.when(n > 1, squared_deviation(vector) / (n - 1))


def layer_norm(
    vector: Column,
    gain: Sequence[float] | None = None,
    shift: Sequence[float] | None = None,
    eps: float = 1e-12,
) -> Column:
    """``(x - mean) / sqrt(population variance + eps)``, then optional gain and shift."""
    # mean and spread are bound once per row; inlined they would be redone per element
    stats = F.array(
        F.struct(
            mean(vector).alias("centre"),
            F.sqrt(squared_deviation(vector) / F.size(vector) + F.lit(eps)).alias("spread"),
        )
    )
    scaled = F.flatten(
        F.transform(
            stats,
            lambda s: F.transform(vector, lambda x: (x - s["centre"]) / s["spread"]),
        )
    )
    if gain is not None:
        scaled = F.zip_with(scaled, F.array(*map(F.lit, gain)), lambda x, g: x * g)
    if shift is not None:
        scaled = add(scaled, F.array(*map(F.lit, shift)))
    return scaled


def positional_encoding(position: Column, dimensions: int) -> Column:
    """Sine on even and cosine on odd dimensions; an odd ``dimensions`` is allowed."""
    def component(index: Column) -> Column:
        even = index - index % 2
        angle = position * F.exp(even * F.lit(-math.log(BASE)) / dimensions)
        return F.when(index % 2 == 0, F.sin(angle)).otherwise(F.cos(angle))

    return F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), component)


def input_embedding(vector: Column, position: Column, dimensions: int) -> Column:
    scale = math.sqrt(dimensions)
    return F.zip_with(
        vector, positional_encoding(position, dimensions), lambda x, p: x * scale + p
    )


def format_vector(vector: Column, digits: int = 2) -> Column:
    shown = F.transform(vector, lambda x: F.format_string(f"%.{digits}f", x))
    return F.concat(F.lit("["), F.array_join(shown, ", "), F.lit("]"))


def round_vector(vector: Column, digits: int) -> Column:
    return F.transform(vector, lambda x: F.round(x, digits))
