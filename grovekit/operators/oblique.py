"""Directions for oblique splits, computed from small per-node matrices.

The data is only ever reduced to moments (see ``moments``); the solvers below
see one (m + 1) x (m + 1) matrix per node and return directions in the space
of the raw features, so that a node is always ``w·x <= th``.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.operators.moments import FLUSH_DOUBLES, summed, symmetric
from grovekit.operators.scan import WalkedTree, blocks, scanned

RANK_TOLERANCE = 1e-10


def bipartition_masks(k: int) -> range:
    """Bit masks over ``k`` classes, one for each split in two groups: the side without the last class."""
    return range(1, 1 << max(0, k - 1))


def bipartition_table(labels: DataFrame, label: str = "label") -> DataFrame:
    """The same splits as rows ``mask, members`` from the labels of a table.

    A bit mask over all classes but the last names the side without the last
    class, so every split appears once.  The classes of a table form one small
    row; the masks are expanded by Spark.
    """
    classes = labels.agg(F.array_sort(F.collect_set(label)).alias("classes"))
    masks = classes.filter(F.size("classes") > 1).select(
        "classes", F.expr("explode(sequence(1L, shiftleft(1L, size(classes) - 1) - 1))").alias("mask")
    )
    members = F.expr("filter(classes, (c, i) -> (mask & shiftleft(1L, i)) != 0)")
    return masks.select("mask", members.alias("members"))


def _centered(matrix: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    n = matrix[0, 0]
    mean = matrix[0, 1:] / n
    return n, mean, matrix[1:, 1:] / n - np.outer(mean, mean)


def principal_axes(cov: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors (rows), largest first, signs fixed.

    At most ``c`` of them and none beyond the numerical rank.
    """
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1]
    values, vectors = values[order], vectors[:, order].T
    keep = values > RANK_TOLERANCE * max(values[0], 1e-300)
    values, vectors = values[keep][:c], vectors[keep][:c]
    sign = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return values, vectors * sign[:, None]


class Basis:
    """A tree's working features: some raw columns, then optional linear maps."""

    def __init__(self, n_features: int, columns: list[int], maps: np.ndarray | None = None):
        self.n_features = n_features
        self.columns = list(columns)
        self.maps = maps

    def to_raw(self, w: np.ndarray) -> list[float]:
        """The raw-space vector with the same projections as ``w`` on working features."""
        if self.maps is not None:
            w = w @ self.maps
        raw = np.zeros(self.n_features)
        raw[self.columns] = w
        return raw.tolist()

    def own_axes(self) -> list[list[float]]:
        size = len(self.columns) if self.maps is None else len(self.maps)
        return [self.to_raw(row) for row in np.eye(size)]


    def work(self, x: np.ndarray) -> np.ndarray:
        """The working features of raw rows."""
        own = x[:, self.columns]
        return own if self.maps is None else own @ self.maps.T


Reduced = Callable[[int, np.ndarray, np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray]]]


def node_moments(rows: DataFrame, trees: Sequence[WalkedTree], classes: np.ndarray, views, reduced: Reduced) -> DataFrame:
    """``slot, part, i, j, s``: sums over the table of the matrices that ``reduced`` makes of a node's rows.

    ``reduced(slot, x, labels, weights)`` gives (part, symmetric matrix) pairs for some rows of the node.  Tasks add up
    their matrices; rows are neither copied nor shuffled.
    """
    shared = rows.sparkSession.sparkContext.broadcast((trees, classes, views))

    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, classes, views = shared.value
        held: dict[tuple[int, int], np.ndarray] = {}

        def emit() -> pa.RecordBatch:
            upper = [m[np.triu_indices(len(m))] for m in held.values()]
            ends = np.cumsum([0, *map(len, upper)])
            flat = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(upper)))
            keys = [pa.array([k[i] for k in held], pa.int32()) for i in range(2)]
            return pa.RecordBatch.from_arrays([*keys, flat], ["slot", "part", "partial"])

        for block in blocks(batches, classes, views):
            for tree in trees:
                for slot, x, labels, weights in block.at_nodes(tree):
                    for part, matrix in reduced(slot, x, labels, weights):
                        held[slot, part] = held.get((slot, part), 0.0) + matrix
                if sum(m.size for m in held.values()) > FLUSH_DOUBLES:
                    yield emit()
                    held.clear()
        if held:
            yield emit()

    partials = scanned(rows).mapInArrow(reduce_task, "slot int, part int, partial array<double>")
    return summed(partials, ["slot", "part"])


def weighted_products(z: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return (z * weights[:, None]).T @ z


def with_one(x: np.ndarray, *more: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), x, *more])


Vectors = dict[tuple[int, int], np.ndarray]


def pca_axes(rows: DataFrame, trees, classes, views, bases: Sequence[Basis], counts: Sequence[int]) -> Vectors:
    """Principal axes of each node by (slot, axis), ``counts`` of them at most, in working features.  Runs a job."""

    def reduced(slot, x, labels, weights):
        yield 0, weighted_products(with_one(bases[slot].work(x)), weights)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        slot = int(pdf["slot"].iloc[0])
        _, _, cov = _centered(symmetric(pdf["i"].to_numpy(), pdf["j"].to_numpy(), pdf["s"].to_numpy()))
        _, axes = principal_axes(cov, counts[slot])
        return pd.DataFrame([(slot, a, v.tolist()) for a, v in enumerate(axes)], columns=["slot", "axis", "w"])

    table = node_moments(rows, trees, classes, views, reduced)
    solved = table.groupBy("slot").applyInPandas(solve, "slot int, axis int, w array<double>")
    return {(r["slot"], r["axis"]): np.array(r["w"]) for r in solved.collect()}  # vectors of the model


def discriminants(parts: Sequence[np.ndarray], components: int) -> np.ndarray:
    """Discriminant directions from the moment matrices of the classes.

    Classes are told apart by between-class scatter in the space whitened by the pooled within-class scatter.
    """
    centered = [_centered(m) for m in parts]
    n = sum(p[0] for p in centered)
    within = sum(p[0] / n * p[2] for p in centered)
    mean = sum(p[0] / n * p[1] for p in centered)
    between = sum(p[0] / n * np.outer(p[1] - mean, p[1] - mean) for p in centered)
    values, axes = principal_axes(within, len(within))
    whiten = axes / np.sqrt(values)[:, None]
    _, inner = principal_axes(whiten @ between @ whiten.T, min(components, len(parts) - 1))
    return inner @ whiten


def class_matrices(rows: DataFrame, trees, classes, views) -> dict[int, list[np.ndarray]]:
    """Moment matrices of the raw features by slot, one for each class with rows.  Runs a job."""

    def reduced(slot, x, labels, weights):
        for c in np.unique(labels).tolist():
            at = labels == c
            yield c, weighted_products(with_one(x[at]), weights[at])

    found: dict[int, list[np.ndarray]] = {}
    table = node_moments(rows, trees, classes, views, reduced).toPandas()  # bags x classes matrices
    for (slot, _), g in table.groupby(["slot", "part"]):
        found.setdefault(slot, []).append(symmetric(g["i"].to_numpy(), g["j"].to_numpy(), g["s"].to_numpy()))
    return found


@dataclass
class Separation:
    """A squared-hinge problem on its way: accepted and tried weights (intercept first), in working features."""

    slot: int
    mask: int
    penalty: float
    tried: np.ndarray | None = None
    kept: np.ndarray | None = None
    objective: float = np.inf
    gradient: float = np.inf
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    following: np.ndarray | None = None


SOLVED = "slot int, part int, objective double, gradient double, following array<double>, mean array<double>, scale array<double>"


def separate(
    rows: DataFrame, trees, classes: np.ndarray, views, bases: Sequence[Basis], problems: Sequence[Separation],
    steps: int, tolerance: float = 1e-8,
) -> None:
    """Linear squared-hinge separations of nodes' rows by class masks, solved in place.  Runs one job for each step.

    Finite Newton steps with a line search.  The rows inside the margin at the tried weights give the objective, its
    gradient and the next Newton point from one moment matrix.  Where the objective has risen, the step is halved.  One
    pass serves every node and mask: sides come from the labels inside the task, so that no row is copied.  Features are
    standardised per node (constant ones keep scale 1), and the intercept is penalised like a weight.  Steps end when
    the gradient is ``tolerance`` of the penalty's and the loss's together.
    """
    live = list(problems)
    for _ in range(steps):
        if not live:
            return
        here: dict[int, list[Separation]] = {}
        for p in live:
            here.setdefault(p.slot, []).append(p)

        def reduced(slot, x, labels, weights):
            z = with_one(bases[slot].work(x), np.empty(len(x)))
            for p in here[slot]:
                z[:, -1] = np.where(p.mask >> np.arange(len(classes)) & 1, -1.0, 1.0)[labels]
                if p.tried is None:
                    yield p.mask, weighted_products(z, weights)
                else:
                    inside = np.flatnonzero(z[:, -1] * (z[:, :-1] @ p.tried) < 1)
                    yield p.mask, weighted_products(z.take(inside, axis=0), weights.take(inside))

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            slot, part = int(pdf["slot"].iloc[0]), int(pdf["part"].iloc[0])
            p = next(p for p in here[slot] if p.mask == part)
            m = symmetric(pdf["i"].to_numpy(), pdf["j"].to_numpy(), pdf["s"].to_numpy())
            mean, scale, u = p.mean, p.scale, np.zeros(len(m) - 1)
            if p.tried is None:  # every row is inside the margin
                _, mean, cov = _centered(m[:-1, :-1])
                std = np.sqrt(np.clip(np.diag(cov), 0, None))
                scale = np.where(std > 1e-12, std, 1.0)
            else:
                u = np.append(p.tried[0] + p.tried[1:] @ mean, p.tried[1:] * scale)
            to_scaled = np.zeros((len(u), len(u)))  # scaled (1, x) = to_scaled @ raw (1, x)
            to_scaled[0, 0] = 1.0
            to_scaled[1:, 0] = -mean / scale
            to_scaled[1:, 1:] = np.diag(1.0 / scale)
            gram, rhs = to_scaled @ m[:-1, :-1] @ to_scaled.T, to_scaled @ m[:-1, -1]
            objective = u @ u / 2 + p.penalty * (m[-1, -1] - 2 * u @ rhs + u @ gram @ u)
            slope = 2 * p.penalty * (gram @ u - rhs)
            gradient = np.abs(u + slope).max() / max(np.abs(u).max(), np.abs(slope).max(), 1e-300)
            following = np.linalg.solve(np.eye(len(u)) + 2 * p.penalty * gram, 2 * p.penalty * rhs) @ to_scaled
            row = (slot, part, objective, gradient, following.tolist(), mean.tolist(), scale.tolist())
            return pd.DataFrame([row], columns=["slot", "part", "objective", "gradient", "following", "mean", "scale"])

        table = node_moments(rows, [t for t in (t.only(here) for t in trees) if t], classes, views, reduced)
        found = {(r["slot"], r["part"]): r for r in table.groupBy("slot", "part").applyInPandas(solve, SOLVED).collect()}
        waiting = []
        for p in live:
            r = found.get((p.slot, p.mask))
            if r is None and p.tried is None:
                continue  # a node without rows
            if r is None:  # no row inside the margin: only the penalty is left
                u = np.append(p.tried[0] + p.tried[1:] @ p.mean, p.tried[1:] * p.scale)
                objective, gradient, following = float(u @ u / 2), 1.0, np.zeros(len(u))
            else:
                objective, gradient, following = r["objective"], r["gradient"], np.array(r["following"])
                p.mean, p.scale = np.array(r["mean"]), np.array(r["scale"])
            tried = np.zeros(len(following)) if p.tried is None else p.tried
            if objective <= p.objective * (1 + 1e-12):
                p.kept, p.objective, p.gradient, p.following = tried, objective, gradient, following
                if gradient <= tolerance:
                    continue
                p.tried = following
            else:
                p.tried = (p.kept + tried) / 2
            moved = np.abs(p.tried - p.kept).max() / max(np.abs(p.kept).max(), np.abs(p.tried).max(), 1e-300)
            if moved > 1e-12:
                waiting.append(p)
        live = waiting
    if live:
        warnings.warn(f"{len(live)} of {len(problems)} separations still moved after {steps} steps", stacklevel=2)
