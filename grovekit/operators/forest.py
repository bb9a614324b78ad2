"""Decision trees and oblique forests: parameters, fits and predictions.

All nodes of a depth, in all trees, are split together (``growth``).  Rows are
stored once with the list of bags that drew them; a row's node is not stored
but found again inside the task by walking the levels above, so there is no
state to lose and no row is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovekit.functions.impurity import GAIN_METHODS
from grovekit.functions.vectors import dot
from grovekit.operators.growth import grow
from grovekit.operators.kernels import KernelMap, apply_kernel_map, fit_kernel_map
from grovekit.operators.metrics import class_counts
from grovekit.operators.moments import complete, dense
from grovekit.operators.sampling import bags, subspace_lists
from grovekit.operators.scan import SPLIT_TYPES, TreePlan, packed, packing, scanned
from grovekit.session import BROADCAST_LIMIT_BYTES, discard, local_table

NODE_SCHEMA = (
    "tree_id int, node_id bigint, kind string, feature int, w array<double>, th double, "
    "gain double, label int, class_counts array<bigint>"
)


@dataclass(frozen=True)
class ForestParams:
    """``split``: orthogonal, PCA (``c`` components) or SVM (``penalty``, ``kernel``)."""

    trees: int = 1
    max_depth: int = 4
    split: str = "orthogonal"
    c: int = 5
    penalty: float = 1.0
    svm_steps: int = 100
    kernel: str = "linear"
    gain: str = "gini"
    lda: int | None = None
    features_per_tree: int | None = None
    samples_per_tree: int | None = None
    replace: bool = True
    bagging: bool = True
    candidates: str = "midpoint"
    seed: int = 42
    landmarks: int = 32

    def __post_init__(self):
        if self.split not in SPLIT_TYPES:
            raise ValueError(f"unknown split {self.split!r}")
        if self.gain not in GAIN_METHODS:
            raise ValueError(f"unknown gain method {self.gain!r}")
        if self.split == "PCA" and self.c <= 0:
            raise ValueError("c must be positive")


@dataclass
class Forest:
    """Fitted node rows; ``nodes`` is the model as a table."""

    spark: SparkSession
    rows: list[tuple]
    classes: list[int]
    depth: int
    kernel_map: KernelMap | None = None

    def nodes(self) -> DataFrame:
        return local_table(self.spark, self.rows, NODE_SCHEMA)


def _small(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """Broadcast a model table of known size, or leave the join to the planner."""
    return F.broadcast(df) if rows * bytes_per_row <= BROADCAST_LIMIT_BYTES else df


def _projection(oblique_nodes: bool, prefix: str = "") -> Column:
    axis = F.get(F.col("features"), F.col(f"{prefix}feature"))
    if not oblique_nodes:
        return axis
    return F.when(F.col(f"{prefix}kind") == "axis", axis).otherwise(
        dot(F.col("features"), F.col(f"{prefix}w"))
    )


def _level_table(spark: SparkSession, nodes: Sequence[tuple], depth: int) -> tuple[DataFrame, bool, int, int]:
    """Inner nodes of one depth as ``tree_id, node_id, _kind, _feature, _w, _th``."""
    inner = [n for n in nodes if n[2] != "leaf" and n[1].bit_length() - 1 == depth]
    table = local_table(
        spark,
        [n[:6] for n in inner],
        "tree_id int, node_id bigint, _kind string, _feature int, _w array<double>, _th double",
    )
    width = max((len(n[4]) for n in inner if n[4]), default=0)
    return table, any(n[2] == "oblique" for n in inner), len(inner), 64 + 8 * width


def _descend(df: DataFrame, nodes: Sequence[tuple], depth: int, keep_leaves: bool) -> DataFrame:
    """Move rows (features, tree_id, node_id) one level down."""
    table, has_oblique, count, width = _level_table(df.sparkSession, nodes, depth)
    if count == 0:
        return df if keep_leaves else df.limit(0)
    joined = df.join(
        _small(table, count, width), ["tree_id", "node_id"], "left" if keep_leaves else "inner"
    )
    child = F.col("node_id") * 2 + F.when(
        _projection(has_oblique, "_") <= F.col("_th"), F.lit(0)
    ).otherwise(F.lit(1))
    moved = F.when(F.col("_th").isNull(), F.col("node_id")).otherwise(child)
    return joined.withColumn("node_id", moved.cast("bigint")).drop("_kind", "_feature", "_w", "_th")


def fit_forest(
    rows: DataFrame,
    key: str,
    n_features: int,
    params: ForestParams,
    classes: Sequence[int] | None = None,
    n_rows: int | None = None,
) -> Forest:
    """Fit on ``key, features, label``.  Runs jobs; see ``grow``.

    Rows without a complete vector are left out; ``n_rows`` counts the others.
    """
    spark = rows.sparkSession
    rows = rows.filter(complete())
    counts = None
    if classes is None or n_rows is None:
        counted = {r["label"]: r["n"] for r in class_counts(rows).collect()}  # one row per class
        classes = sorted(counted)
        n_rows = sum(counted.values())
        if not params.bagging:
            counts = {0: np.array([counted[c] for c in classes], dtype=np.int64)}
    rows = rows.select(key, "features", "label")
    views = []
    if params.split == "SVM" and params.kernel != "linear":
        views = [fit_kernel_map(rows, key, params.kernel, params.landmarks, seed=params.seed)]
    several = params.max_depth > 1 or params.split == "SVM"  # passes: only what they read is kept for them
    if params.bagging:
        samples = n_rows if params.samples_per_tree is None else params.samples_per_tree
        bagged = bags(rows, key, params.trees, samples, n_rows, params.replace, f"{params.seed}|bag", kept=["features", "label"],
            finish=packing(classes) if several else None)
    else:
        bagged = rows.select("features", "label")  # one bag has every row once
    if several:
        bagged = packed(bagged, classes)
    plans = tree_plans(params, n_features, views[0] if views else None)
    grown = grow(bagged, plans, classes, views, counts)
    return Forest(spark, [n for nodes in grown for n in nodes], sorted(classes), params.max_depth, *views)


def tree_plans(
    params: ForestParams, n_features: int, mapping: KernelMap | None = None, view: int = 0, first_bag: int = 0
) -> list[TreePlan]:
    """The plans of a forest's trees; their bags are numbered from ``first_bag`` on."""
    per_tree = n_features if params.features_per_tree is None else params.features_per_tree
    if mapping is not None:
        # A subspace of kernel features plays the part of a subspace of features.
        per_tree = max(1, round(per_tree / n_features * mapping.width))
        n_features = mapping.width
    spaces = subspace_lists(params.trees, n_features, per_tree, f"{params.seed}|space")
    return [
        TreePlan(
            first_bag + (t if params.bagging else 0), tuple(spaces[t]), n_features, params.max_depth, params.split, params.gain,
            params.candidates, params.c, params.penalty, params.svm_steps, params.lda, view if mapping is not None else None,
        )
        for t in range(params.trees)
    ]


@dataclass(frozen=True)
class Fit:
    """One model to fit: its parameters and the part of the rows that it must not see (None: it sees all)."""

    params: ForestParams
    without: int | None = None


def shared_bags(
    rows: DataFrame, key: str, fits: Sequence[Fit], sizes: dict[int | None, int], classes: Sequence[int] | None = None
) -> tuple[DataFrame, list[int]]:
    """``features, label, bag`` with the bags of all fits, and the first bag of each fit; perhaps packed for ``classes``.

    Fits that draw alike from the same rows share their bags.  Bags of several draws are put together by key, and rows
    join them once; those of one draw come with their rows.
    """
    wanted: dict[tuple, int] = {}
    for f in fits:
        draw = _draw(f, sizes)
        wanted[draw] = max(wanted.get(draw, 0), f.params.trees if f.params.bagging else 1)
    first, parts, done = {}, [], 0
    kept = ["features", "label"] if len(wanted) == 1 else [key]
    for draw, trees in wanted.items():
        without, samples, replace, seed = draw
        part = (rows if without is None else rows.filter(F.col("fold") != without)).select(key, *[c for c in kept if c != key])
        if samples is None:
            bagged = part.withColumn("bag", F.array(F.struct(F.lit(0).alias("tree_id"), F.lit(1).cast("bigint").alias("weight"))))
        else:
            bagged = bags(part, key, trees, samples, sizes[without], replace, f"{seed}|bag", kept=kept,
                finish=packing(classes) if classes and len(wanted) == 1 else None)
        parts.append(bagged.select(*kept, _renumbered(done).alias("bag")) if done else bagged)
        first[draw], done = done, done + trees
    starts = [first[_draw(f, sizes)] for f in fits]
    if len(parts) == 1:
        return scanned(parts[0]), starts
    union = reduce(DataFrame.union, parts).groupBy(key).agg(F.flatten(F.collect_list("bag")).alias("bag"))
    return rows.select(key, "features", "label").join(union, key).select("features", "label", "bag"), starts


def _renumbered(by: int) -> Column:
    return F.transform("bag", lambda b: F.struct((b["tree_id"] + by).alias("tree_id"), b["weight"].alias("weight")))


def _draw(fit: Fit, sizes: dict[int | None, int]) -> tuple:
    p = fit.params
    samples = None if not p.bagging else p.samples_per_tree or sizes[fit.without]
    return fit.without, samples, p.replace, p.seed


def fit_forests(rows: DataFrame, key: str, n_features: int, fits: Sequence[Fit]) -> list[Forest]:
    """Many models in shared jobs, on ``key, features, label`` (and ``fold``, where fits leave one out).

    Trees of all models grow together, so that the number of jobs follows the deepest tree and not the models.  Each
    model is the one that ``fit_forest`` fits on its rows alone.
    """
    spark, rows = rows.sparkSession, rows.filter(complete())
    by = ["fold"] if "fold" in rows.columns else []
    counted = class_counts(rows, by=by).collect()  # folds x classes numbers
    outs = {f.without for f in fits}
    inside = {o: [r for r in counted if o is None or r["fold"] != o] for o in outs}
    sizes = {o: sum(r["n"] for r in c) for o, c in inside.items()}
    classes = sorted({r["label"] for r in counted})
    views: list[KernelMap] = []
    numbers: dict[tuple, int] = {}
    for f in fits:
        p, kernel = f.params, (f.without, f.params.kernel, f.params.landmarks, f.params.seed)
        if p.split == "SVM" and p.kernel != "linear" and kernel not in numbers:
            part = rows if f.without is None else rows.filter(F.col("fold") != f.without)
            numbers[kernel] = len(views)
            views.append(fit_kernel_map(part.select(key, "features"), key, p.kernel, p.landmarks, seed=p.seed))
    table, first = shared_bags(rows, key, fits, sizes, classes)
    table, plans, owner = packed(table, classes), [], []
    for i, (f, bag) in enumerate(zip(fits, first)):
        view = numbers.get((f.without, f.params.kernel, f.params.landmarks, f.params.seed), -1) if f.params.split == "SVM" else -1
        own = tree_plans(f.params, n_features, views[view] if view >= 0 else None, max(view, 0), bag)
        plans += own
        owner += [i] * len(own)
    grown: list[list] = [[] for _ in fits]
    start = [owner.index(i) for i in range(len(fits))]
    for t, nodes in enumerate(grow(table, plans, classes, views)):
        grown[owner[t]] += [(n[0] - start[owner[t]], *n[1:]) for n in nodes]
    discard(table)
    models = []
    for f, nodes in zip(fits, grown):
        view = numbers.get((f.without, f.params.kernel, f.params.landmarks, f.params.seed)) if f.params.split == "SVM" else None
        seen = sorted({r["label"] for r in inside[f.without]})
        models.append(Forest(spark, _only(nodes, classes, seen), seen, f.params.max_depth, None if view is None else views[view]))
    return models


def _only(nodes: list[tuple], classes: list[int], seen: list[int]) -> list[tuple]:
    """Node rows with the counts of the ``seen`` classes alone."""
    at = [classes.index(c) for c in seen]
    return nodes if len(at) == len(classes) else [(*n[:8], [n[8][i] for i in at]) for n in nodes]


def right_answers(models: Sequence[Forest], parts: Sequence[int | None], rows: DataFrame) -> list[tuple[int, int]]:
    """(right, all) votes of each model on its part of ``rows`` (features, label, fold), in one job.

    Rows without a complete vector get no answer and count as wrong.  ``parts`` are the folds; None takes all rows.
    """
    spark = rows.sparkSession
    packed = [(_model_arrays(m), np.array(m.classes), m.depth, m.kernel_map, part) for m, part in zip(models, parts)]
    shared = spark.sparkContext.broadcast(packed)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        right, asked = np.zeros(len(models), np.int64), np.zeros(len(models), np.int64)
        for batch in batches:
            known = batch.column("usable").to_numpy(zero_copy_only=False).astype(bool)
            x = dense(batch.column("features").filter(pa.array(known))) if known.any() else None
            labels, folds = batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            mapped: dict[int, np.ndarray] = {}
            for i, (trees, classes, depth, mapping, part) in enumerate(models):
                mine = np.ones(len(labels), bool) if part is None else folds == part
                asked[i] += mine.sum()
                own = mine[known]
                if x is None or not own.any():
                    continue
                if mapping is not None and id(mapping) not in mapped:
                    mapped[id(mapping)] = mapping(x)
                xs = (x if mapping is None else mapped[id(mapping)])[own]
                votes, at = np.zeros((len(xs), len(classes)), np.int32), np.arange(len(xs))
                for tree in trees:
                    votes[at, _tree_votes(tree, xs, depth)] += 1
                right[i] += (classes[votes.argmax(axis=1)] == labels[known][own]).sum()
        numbers = pa.array(np.arange(len(right)), pa.int32())
        yield pa.RecordBatch.from_arrays([numbers, pa.array(right), pa.array(asked)], ["model", "right", "asked"])

    fold = F.col("fold").cast("int") if "fold" in rows.columns else F.lit(-1)
    source = rows.select("features", "label", fold.alias("fold"), F.coalesce(complete(), F.lit(False)).alias("usable"))
    counts = source.mapInArrow(task, "model int, right long, asked long").groupBy("model").agg(F.sum("right"), F.sum("asked"))
    found = {r[0]: (r[1], r[2]) for r in counts.collect()}  # one row per model
    return [found.get(i, (0, 0)) for i in range(len(models))]


def tree_predictions(forest: Forest, rows: DataFrame, key: str) -> DataFrame:
    """``key, tree_id, predicted, class_counts``: every tree's leaf for every row.

    A row without a complete vector has no leaf: ``predicted`` and the counts are NULL.
    """
    rows = rows.withColumn("features", F.when(complete(), F.col("features")))
    if forest.kernel_map is not None:
        rows = apply_kernel_map(rows.select(key, "features"), forest.kernel_map)
    trees = sorted({n[0] for n in forest.rows})
    at = rows.select(
        key,
        "features",
        F.explode(F.array(*[F.lit(t) for t in trees])).alias("tree_id"),
    ).withColumn("node_id", F.lit(1).cast("bigint"))
    for depth in range(forest.depth):
        at = _descend(at, forest.rows, depth, keep_leaves=True)
    leaves = [(n[0], n[1], n[7], n[8]) for n in forest.rows if n[2] == "leaf"]
    table = local_table(
        forest.spark, leaves, "tree_id int, node_id bigint, predicted int, class_counts array<bigint>"
    )
    joined = at.join(_small(table, len(leaves), 32 + 8 * len(forest.classes)), ["tree_id", "node_id"])
    known = F.col("features").isNotNull()
    answer = [F.when(known, F.col(c)).alias(c) for c in ("predicted", "class_counts")]
    return joined.select(key, "tree_id", "node_id", *answer)


def vote(predictions: DataFrame, key: str, classes: Sequence[int], out: str = "predicted") -> DataFrame:
    """Most frequent prediction per row; ties go to the smallest label.

    Votes are plain counters per class, summed map-side.
    """
    classes = sorted(classes)
    counts = predictions.groupBy(key).agg(
        *[F.sum((F.col("predicted") == c).cast("int")).alias(f"_v{i}") for i, c in enumerate(classes)]
    )
    top = F.greatest(*[F.col(f"_v{i}") for i in range(len(classes))]) if len(classes) > 1 else F.col("_v0")
    label = F.lit(None).cast("int")
    for i in reversed(range(len(classes))):
        label = F.when(F.col(f"_v{i}") == top, F.lit(classes[i])).otherwise(label)
    return counts.select(key, label.alias(out))


def _model_arrays(forest: Forest) -> list[dict[str, np.ndarray]]:
    """Each tree's nodes as arrays; a leaf points to itself."""
    trees = []
    for tree in sorted({n[0] for n in forest.rows}):
        nodes = [n for n in forest.rows if n[0] == tree]
        at = {n[1]: i for i, n in enumerate(nodes)}
        leaf = [n[2] == "leaf" for n in nodes]
        width = max((len(n[4]) for n in nodes if n[4]), default=0)
        trees.append(
            {
                "root": at[1],
                "feature": np.array([n[3] if n[2] == "axis" else -1 for n in nodes]),
                "w": np.array([n[4] or [0.0] * width for n in nodes]),
                "th": np.array([np.inf if is_leaf else n[5] for n, is_leaf in zip(nodes, leaf)]),
                "left": np.array([i if leaf[i] else at[2 * n[1]] for i, n in enumerate(nodes)]),
                "right": np.array([i if leaf[i] else at[2 * n[1] + 1] for i, n in enumerate(nodes)]),
                "shares": np.array([np.array(n[8], float) / max(1, sum(n[8])) for n in nodes]),
                "vote": np.array(
                    [forest.classes.index(n[7]) if is_leaf else 0 for n, is_leaf in zip(nodes, leaf)]
                ),
            }
        )
    return trees


def _model_bytes(forest: Forest) -> int:
    return sum(48 + 8 * len(n[4] or ()) + 8 * len(forest.classes) for n in forest.rows)


def _tree_votes(tree: dict[str, np.ndarray], x: np.ndarray, depth: int) -> np.ndarray:
    """Class position each row of ``x`` is given by one tree."""
    return tree["vote"][_tree_leaves(tree, x, depth)]


def _tree_leaves(tree: dict[str, np.ndarray], x: np.ndarray, depth: int) -> np.ndarray:
    """Place of the leaf of each row of ``x`` among a tree's nodes."""
    at = np.full(len(x), tree["root"])
    rows = np.arange(len(x))
    for _ in range(depth):
        feature = tree["feature"][at]
        z = x[rows, np.maximum(feature, 0)]
        skew = feature < 0
        if tree["w"].shape[1] and skew.any():
            # Summed in feature order, as the expression used in training does.
            w, xs, dot_z = tree["w"][at[skew]], x[skew], np.zeros(int(skew.sum()))
            for i in range(w.shape[1]):
                dot_z = dot_z + xs[:, i] * w[:, i]
            z[skew] = dot_z
        at = np.where(z <= tree["th"][at], tree["left"][at], tree["right"][at])
    return at


def predict_forest(forest: Forest, rows: DataFrame, key: str, out: str = "predicted") -> DataFrame:
    """Voted prediction per row; ties go to the smallest label, and a row without a complete vector gets NULL.

    All trees of a row are walked and counted where the row is, so nothing is
    shuffled.  A model too large to send to every task takes the join path.
    """
    if _model_bytes(forest) > BROADCAST_LIMIT_BYTES:
        return vote(tree_predictions(forest, rows, key), key, forest.classes, out)
    if forest.kernel_map is not None:
        rows = apply_kernel_map(rows.select(key, "features"), forest.kernel_map)
    shared = forest.spark.sparkContext.broadcast(_model_arrays(forest))
    classes = np.array(forest.classes, dtype=np.int32)
    depth = forest.depth

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            known = batch.column("features").is_valid()
            x = dense(batch.column("features").filter(known))
            votes = np.zeros((len(x), len(classes)), dtype=np.int32)
            rows_at = np.arange(len(x))
            for tree in shared.value:
                votes[rows_at, _tree_votes(tree, x, depth)] += 1
            at = np.cumsum(known.to_numpy(zero_copy_only=False)) - 1
            label = pa.array(classes[votes.argmax(axis=1)]).take(pa.array(at, mask=~known.to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([batch.column(key), label], names=[key, out])

    schema = T.StructType([rows.schema[key], T.StructField(out, T.IntegerType())])
    usable = F.when(complete(), F.col("features")).alias("features")
    return rows.select(key, usable).mapInArrow(task, schema)


def predict_tree(forest: Forest, rows: DataFrame, key: str, out: str = "predicted") -> DataFrame:
    """Prediction of a single tree: no vote, no shuffle."""
    return tree_predictions(forest, rows, key).select(key, F.col("predicted").alias(out))


def class_probabilities(forest: Forest, rows: DataFrame, key: str) -> DataFrame:
    """``key, label, probability``: class shares of the leaves, averaged over trees; none for rows without a complete vector.

    All trees of a row are walked where the row is, so nothing is shuffled.  A model too large to send to every task
    takes the join path.
    """
    if _model_bytes(forest) > BROADCAST_LIMIT_BYTES:
        return _joined_probabilities(forest, rows, key)
    rows = rows.filter(complete()).select(key, "features")
    if forest.kernel_map is not None:
        rows = apply_kernel_map(rows, forest.kernel_map)
    shared = forest.spark.sparkContext.broadcast(_model_arrays(forest))
    labels, depth = forest.classes, forest.depth

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, k = dense(batch.column("features")), len(labels)
            shares = sum(tree["shares"][_tree_leaves(tree, x, depth)] for tree in shared.value) / len(shared.value)
            keys = batch.column(key).take(pa.array(np.repeat(np.arange(len(x)), k)))
            arrays = [keys, pa.array(np.tile(np.array(labels, np.int32), len(x))), pa.array(shares.ravel())]
            yield pa.RecordBatch.from_arrays(arrays, [key, "label", "probability"])

    schema = T.StructType(
        [rows.schema[key], T.StructField("label", T.IntegerType()), T.StructField("probability", T.DoubleType())]
    )
    return rows.mapInArrow(task, schema)


def _joined_probabilities(forest: Forest, rows: DataFrame, key: str) -> DataFrame:
    at = tree_predictions(forest, rows, key)
    total = F.aggregate("class_counts", F.lit(0).cast("bigint"), lambda s, v: s + v)
    labels = F.array(*[F.lit(c) for c in forest.classes])
    return (
        at.select(key, total.alias("_t"), F.posexplode("class_counts").alias("_i", "_c"))
        .groupBy(key, F.get(labels, F.col("_i")).alias("label"))
        .agg(F.avg(F.col("_c") / F.col("_t")).alias("probability"))
    )


def decision_grid(bounds: DataFrame, step: float, margin: float = 1.0) -> DataFrame:
    """``row_key, features``: points ``step`` apart over two features' ranges.

    ``bounds`` has one row ``x_min, x_max, y_min, y_max``.  The grid's first
    side is spread over tasks before the second is expanded.
    """
    def steps(low: Column, high: Column) -> Column:
        return F.sequence(F.lit(0), F.floor((high - low) / F.lit(step)).cast("int"))

    box = bounds.select(
        *[(F.col(f"{a}_min") - margin).alias(f"{a}0") for a in "xy"],
        *[(F.col(f"{a}_max") + margin).alias(f"{a}1") for a in "xy"],
    )
    across = box.withColumn("i", F.explode(steps(F.col("x0"), F.col("x1")))).repartition("i")
    cells = across.withColumn("j", F.explode(steps(F.col("y0"), F.col("y1"))))
    return cells.select(
        F.concat_ws(":", "i", "j").alias("row_key"),
        F.array(
            F.col("x0") + F.col("i") * F.lit(step), F.col("y0") + F.col("j") * F.lit(step)
        ).alias("features"),
    )
