"""Approximate kernel features for non-linear SVM splits.

An exact kernel machine needs all pairs of rows.  Instead, rows are described
by their kernel values to a fixed set of landmark rows (Nystroem features);
a linear split of these features approximates a kernel split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from grovekit.operators.moments import collect_moments, dense, moments
from grovekit.operators.sampling import random_subset

KERNELS = ("rbf", "poly", "sigmoid")
# Degree and offset of the library kernels.
POLY_DEGREE = 3
OFFSET = 0.0


def kernel(x: np.ndarray, y: np.ndarray, name: str, gamma: float) -> np.ndarray:
    if name == "rbf":
        squared = (x**2).sum(1)[:, None] + (y**2).sum(1)[None, :] - 2 * x @ y.T
        return np.exp(-gamma * np.clip(squared, 0, None))
    if name == "poly":
        return (gamma * x @ y.T + OFFSET) ** POLY_DEGREE
    if name == "sigmoid":
        return np.tanh(gamma * x @ y.T + OFFSET)
    raise ValueError(f"unknown kernel {name!r}")


class KernelMap:
    """Standardised features to kernel features over ``landmarks``."""

    def __init__(self, name, mean, scale, landmarks, whiten, gamma):
        self.name, self.mean, self.scale = name, mean, scale
        self.landmarks, self.whiten, self.gamma = landmarks, whiten, gamma

    @property
    def width(self) -> int:
        return self.whiten.shape[1]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        scaled = (x - self.mean) / self.scale
        return kernel(scaled, self.landmarks, self.name, self.gamma) @ self.whiten


def fit_kernel_map(
    rows: DataFrame, key: str, name: str, landmarks: int = 32, features: str = "features", seed=42
) -> KernelMap:
    """Landmarks are a seeded subset of the rows.  Runs two jobs."""
    m = collect_moments(moments(rows, features=features))
    n = m[0, 0]
    mean = m[0, 1:] / n
    std = np.sqrt(np.clip(np.diag(m)[1:] / n - mean**2, 0, None))
    scale = np.where(std > 1e-12, std, 1.0)
    chosen = random_subset(rows.select(key, features), key, landmarks, seed).collect()
    points = (np.array([r[features] for r in chosen], dtype=float) - mean) / scale
    gamma = 1.0 / len(mean)  # 1 / (m * variance) of standardised features
    gram = kernel(points, points, name, gamma)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    keep = values > 1e-8 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    return KernelMap(name, mean, scale, points, whiten, gamma)


def apply_kernel_map(rows: DataFrame, mapping: KernelMap, features: str = "features") -> DataFrame:
    """Replace ``features`` by their kernel features, one Arrow batch at a time."""
    schema = T.StructType(
        [
            T.StructField(f.name, T.ArrayType(T.DoubleType())) if f.name == features else f
            for f in rows.schema
        ]
    )

    at = schema.fieldNames().index(features)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                phi = pa.array(list(mapping(dense(batch.column(features)))), pa.list_(pa.float64()))
                columns = [phi if i == at else c for i, c in enumerate(batch.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return rows.mapInArrow(convert, schema)
