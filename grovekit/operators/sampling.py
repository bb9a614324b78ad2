"""Seeded holdouts, folds, samples, bags and feature subspaces.

Every choice is an order of md5 digests over (seed, key), so it repeats on any
cluster and survives the loss of an executor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from grovekit.functions.hashing import HEX_DIGITS, digest_of, digest, draw, md5_heads
from grovekit.operators.ranking import hash_cuts, hash_rank, with_cuts

#: Rows and draws that are brought together at once, and draws that are sorted and packed, and hashed, at once.
GROUP_ROWS, PACKED_DRAWS, HASHED_DRAWS = 250_000, 2_000_000, 8192


def shuffle_rank(df: DataFrame, key: str, seed, groups: Sequence[str] = (), prefix: int = 4) -> DataFrame:
    """Adds ``rank``: the 1-based place of a row in a seeded shuffle (per group)."""
    keyed = df.withColumn("_order", digest(seed, F.col(key)))
    return hash_rank(keyed, "_order", groups, "rank", tie=[key], prefix=prefix).drop("_order")


def _cut(df: DataFrame, key: str, seed, groups: Sequence[str], quotas, prefix: int) -> DataFrame:
    """Adds ``_order`` and ``_cuts``, the digests where the shuffle reaches each quota.

    Rows are then assigned by comparing digests, without a shuffle.  ``key``
    must be unique.
    """
    keyed = df.withColumn("_order", digest(seed, F.col(key)))
    return with_cuts(keyed, groups, hash_cuts(keyed, "_order", groups, quotas, prefix))


def _before(cut: int) -> Column:
    """True for rows inside the first quota; a quota of zero has none."""
    return F.coalesce(F.col("_order") <= F.get("_cuts", F.lit(cut)), F.lit(False))


def _named(df: DataFrame, first: str, rest: str) -> DataFrame:
    split = F.when(_before(0), F.lit(first)).otherwise(F.lit(rest))
    return df.withColumn("split", split).drop("_order", "_cuts")


def holdout(df: DataFrame, key: str, fraction: float, seed=42, prefix: int = 4) -> DataFrame:
    """Adds ``split``: the first int(n * fraction) rows of a shuffle are ``val``."""
    quota = lambda n, _: [F.floor(n * F.lit(float(fraction)))]
    return _named(_cut(df, key, seed, [], quota, prefix), "val", "train")


def stratified_holdout(
    df: DataFrame, key: str, fraction: float = 0.25, label: str = "label", seed=42, prefix: int = 4
) -> DataFrame:
    """Adds ``split``: round(n_label * fraction) shuffled rows per label are ``test``."""
    quota = lambda n, _: [F.bround(n * F.lit(float(fraction)))]
    return _named(_cut(df, key, seed, [label], quota, prefix), "test", "train")


def tail_holdout(df: DataFrame, position: str, fraction: float = 0.25) -> DataFrame:
    """Unshuffled holdout: the last ceil(n * fraction) rows by 1-based ``position``."""
    n = F.count(F.lit(1))
    cut = df.agg((n - F.ceil(n * F.lit(float(fraction)))).alias("cut")).scalar()
    split = F.when(F.col(position) > cut, F.lit("test")).otherwise(F.lit("train"))
    return df.withColumn("split", split)


def stratified_folds(
    df: DataFrame, key: str, k: int = 3, label: str = "label", seed=42, prefix: int = 4
) -> DataFrame:
    """Adds ``fold`` in 0..k-1, dealt out per label in shuffled order."""
    ranked = shuffle_rank(df, key, seed, [label], prefix)
    return ranked.withColumn("fold", ((F.col("rank") - 1) % k).cast("int")).drop("rank")


def plain_folds(df: DataFrame, key: str, k: int = 5, seed=42, prefix: int = 4) -> DataFrame:
    """Adds ``fold`` in 0..k-1: k even runs of a shuffle, the first ones one longer."""

    def quotas(n: Column, _: Column) -> list[Column]:
        return [F.floor(n / k) * i + F.least(F.lit(i), n % k) for i in range(1, k)]

    cut = _cut(df, key, seed, [], quotas, prefix)
    fold = sum(((~_before(i)).cast("int") for i in range(k - 1)), F.lit(0))
    return cut.withColumn("fold", fold).drop("_order", "_cuts")


def stratified_sample(
    df: DataFrame, key: str, n: int, label: str, seed=42, prefix: int = 4
) -> DataFrame:
    """About n rows with every label's share kept: min(round(n * n_l / N), n_l) each."""
    quota = lambda n_l, total: [F.least(F.bround(F.lit(float(n)) * n_l / total), n_l)]
    return _cut(df, key, seed, [label], quota, prefix).filter(_before(0)).drop("_order", "_cuts")


def random_subset(df: DataFrame, key: str, n: int, seed=42) -> DataFrame:
    """The first n rows of a seeded shuffle."""
    return df.withColumn("_order", digest(seed, F.col(key))).orderBy("_order", key).limit(n).drop("_order")


def dense_rows(df: DataFrame, key: str, seed, prefix: int = 4) -> DataFrame:
    """Adds ``position`` 1..n in a seeded shuffle: the address space of draws."""
    return shuffle_rank(df, key, seed, prefix=prefix).withColumnRenamed("rank", "position")


def drawn(ids: np.ndarray, samples: int, n: int, seed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tree, draw and position of the draws of these numbers; the position is ``hashing.draw`` of tree and draw."""
    tree, nth = np.divmod(ids, samples)
    first = np.empty(len(ids), np.uint64)
    for t in np.unique(tree).tolist():  # numbers ascend
        at = slice(*np.searchsorted(tree, (t, t + 1)))
        first[at] = md5_heads(f"{seed}|{t}|".encode(), nth[at])
    return tree, nth, (first >> np.uint64(64 - 4 * HEX_DIGITS)).astype(np.int64) % n + 1


def bag_draws(spark, trees: int, samples: int, n: int, seed) -> DataFrame:
    """Draws with replacement: ``tree_id, draw, position``, exactly ``samples`` per tree."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, nth, position = drawn(batch.column("id").to_numpy(), samples, n, seed)
            arrays = [pa.array(tree.astype(np.int32)), pa.array(nth), pa.array(position)]
            yield pa.RecordBatch.from_arrays(arrays, ["tree_id", "draw", "position"])

    return spark.range(trees * samples).mapInArrow(task, "tree_id int, draw bigint, position bigint")


def _drawn_bags(rows: DataFrame, key: str, trees: int, samples: int, n: int, seed, prefix: int, kept: Sequence[str], finish) -> DataFrame:
    """Bags with replacement: rows and draws meet in groups of consecutive positions.

    A group holds about ``GROUP_ROWS`` rows and draws together.  Draws travel as arrays, a few bytes each, and are counted
    where the group's rows are put in order, so that rows move once, with their digests in bytes and the ``kept`` columns
    alone; rows of one digest have one key.  Runs a job for the sizes of the groups.
    """
    slices = 16**prefix
    groups = min(slices, -(-(n + trees * samples) // GROUP_ROWS))
    keyed = rows.withColumn("_order", digest(seed, F.col(key)))
    slice_ = F.conv(F.substring("_order", 1, prefix), 16, 10).cast("bigint")
    keyed = keyed.withColumn("_group", F.floor(slice_ * groups / slices).cast("int"))
    sizes = np.zeros(groups, np.int64)
    for r in keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per group
        sizes[r["_group"]] = r["n"]
    bounds = np.concatenate(([0], np.cumsum(sizes))) * trees
    code = np.uint32 if sizes.max(initial=0) * trees < 2**32 else np.uint64

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Draws of each group as numbers position * trees + tree inside the group."""

        def emit(held: list[np.ndarray]) -> pa.RecordBatch:
            codes = np.sort(np.concatenate(held))
            cuts = np.searchsorted(codes, bounds)
            full = np.flatnonzero(np.diff(cuts))
            parts = [(codes[cuts[g] : cuts[g + 1]] - bounds[g]).astype(code).tobytes() for g in full]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(parts, pa.binary())], ["_group", "draws"])

        for batch in batches:
            for start in batch.column("id").to_numpy().tolist():
                held = []
                for first in range(start, min(start + at_once, trees * samples), HASHED_DRAWS):
                    ids = np.arange(first, min(first + HASHED_DRAWS, start + at_once, trees * samples))
                    tree, _, position = drawn(ids, samples, n, seed)
                    held.append((position - 1) * trees + tree)
                yield emit(held)

    rows_schema = rows.select(*kept).schema
    schema = T.StructType([*rows_schema, *T.StructType.fromDDL("bag array<struct<tree_id: int, weight: bigint>>")])
    arrow_schema = to_arrow_schema(schema)

    finished, out_schema = finish or (lambda table: table, schema)

    def meet(members: pa.Table, packed: pa.Table) -> pa.Table:
        if not members.num_rows or not packed.num_rows:
            return finished(arrow_schema.empty_table())
        codes = np.concatenate([np.frombuffer(b.as_buffer(), code) for b in packed.column("draws")])
        codes, weight = np.unique(codes, return_counts=True)
        place, tree = np.divmod(codes, code(trees))
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        order = pc.sort_indices(members.column("_order"))
        taken = members.take(order.take(pa.array(place[first].astype(np.int64))))
        pairs = [pa.array(tree.astype(np.int32)), pa.array(weight.astype(np.int64))]
        bag = pa.ListArray.from_arrays(
            pa.array(np.append(first, len(place)).astype(np.int32)), pa.StructArray.from_arrays(pairs, ["tree_id", "weight"])
        )
        return finished(pa.table([*[taken.column(f.name) for f in rows_schema], bag], names=arrow_schema.names))

    keyed = keyed.select(*kept, F.unhex("_order").alias("_order"), "_group")
    # Only the first number of some draws is a row.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    at_once = max(1, min(PACKED_DRAWS, -(-trees * samples // (4 * cores))))
    starts = rows.sparkSession.range(0, trees * samples, at_once, max(1, min(4 * cores, -(-trees * samples // at_once))))
    draws = starts.mapInArrow(pack, "_group int, draws binary")
    return keyed.groupBy("_group").cogroup(draws.groupBy("_group")).applyInArrow(meet, out_schema)


def bags(
    rows: DataFrame, key: str, trees: int, samples: int, n: int, replace: bool, seed, prefix: int = 4,
    kept: Sequence[str] | None = None, finish: tuple[Callable[[pa.Table], pa.Table], str] | None = None,
) -> DataFrame:
    """Adds ``bag ARRAY<STRUCT<tree_id, weight>>``: how often each tree drew the row.

    A row is stored once, however many trees draw it.  Rows that no tree drew
    drop out.  ``n`` is the number of rows; of the columns only the ``kept``
    ones come out, or all.  Draws with replacement go through ``finish``, a
    function of a group's table and the schema it gives, where they are made.
    """
    kept = list(rows.columns if kept is None else kept)
    if samples > n:
        raise ValueError("samples per tree exceed the number of rows")
    if replace:
        return _drawn_bags(rows, key, trees, samples, n, seed, prefix, kept, finish)
    if samples == n:  # every tree has every row
        whole = [F.struct(F.lit(t).alias("tree_id"), F.lit(1).cast("bigint").alias("weight")) for t in range(trees)]
        return rows.select(*kept, F.array(*whole).alias("bag"))
    # Each tree's digest of rank ``samples`` is found; a row then knows its trees.
    orders = [(t, digest(f"{seed}|{t}", F.col(key))) for t in range(trees)]
    member = F.array(*[F.struct(F.lit(t).alias("tree_id"), o.alias("order")) for t, o in orders])
    keyed = rows.select(F.explode(member).alias("_m")).select("_m.tree_id", "_m.order")
    cuts = {t: d[0] for t, d in hash_cuts(keyed, "order", ["tree_id"], lambda *_: [F.lit(samples)], prefix)}
    one = F.lit(1).cast("bigint")
    drawn = F.array(
        *[
            F.when(o <= F.lit(cuts[t]), F.struct(F.lit(t).alias("tree_id"), one.alias("weight")))
            for t, o in orders
            if cuts.get(t) is not None
        ]
    )
    bagged = rows.withColumn("bag", F.filter(drawn, lambda b: b.isNotNull()))
    return bagged.filter(F.size("bag") > 0).select(*kept, "bag")


def subspaces(spark, trees: int, n_features: int, per_tree: int, seed) -> DataFrame:
    """``tree_id, pos, feature``: per_tree distinct features per tree, seeded."""
    if not 0 < per_tree <= n_features:
        raise ValueError("features per tree must be in 1..n_features")
    cells = spark.range(trees * n_features).select(
        F.floor(F.col("id") / n_features).cast("int").alias("tree_id"),
        (F.col("id") % n_features).cast("int").alias("feature"),
    )
    order = F.array_sort(
        F.collect_list(F.struct(digest(seed, F.col("tree_id"), F.col("feature")).alias("o"), "feature"))
    )
    return (
        cells.groupBy("tree_id")
        .agg(F.slice(order, 1, per_tree).getField("feature").alias("f"))
        .select("tree_id", F.posexplode(F.array_sort("f")).alias("pos", "feature"))
    )


def subspace_lists(trees: int, n_features: int, per_tree: int, seed) -> list[list[int]]:
    """The rows of ``subspaces`` as lists, one per tree: parameters of a model, drawn without a job."""
    if not 0 < per_tree <= n_features:
        raise ValueError("features per tree must be in 1..n_features")
    order = lambda t: sorted(range(n_features), key=lambda f: (digest_of(seed, t, f), f))
    return [sorted(order(t)[:per_tree]) for t in range(trees)]


def sample_params(trials: DataFrame, number: str, n_features: int, seed=42) -> DataFrame:
    """Search parameters drawn per trial; conditional ones are NULL where unused."""

    def u(axis: str) -> Column:
        return draw(f"{seed}|{axis}", F.col(number)) / F.lit(float(16**12))

    def whole(axis: str, low: int, high: int) -> Column:
        return (F.lit(low) + F.floor(u(axis) * (high - low + 1))).cast("int")

    def choice(axis: str, options: Sequence) -> Column:
        return F.get(F.array(*[F.lit(o) for o in options]), F.floor(u(axis) * len(options)).cast("int"))

    split = choice("splitType", SPLIT_TYPES)
    low, high = SVM_C_RANGE
    log_uniform = F.lit(float(low)) * F.pow(F.lit(high / low), u("svm_C"))
    return trials.withColumns(
        {
            "maxDepth": whole("maxDepth", *DEPTH_RANGE),
            "gainMethod": choice("gainMethod", GAIN_CHOICES),
            "splitType": split,
            "lda_components": choice("lda_components", LDA_CHOICES),
            "featuresPerTree": whole("featuresPerTree", 1, n_features),
            "samplesFraction": FRACTION_RANGE[0]
            + u("samplesFraction") * (FRACTION_RANGE[1] - FRACTION_RANGE[0]),
            "treeCount": whole("treeCount", *TREES_RANGE),
            "pca_c": F.when(split == "PCA", choice("pca_c", PCA_C_CHOICES)),
            "svm_C": F.when(split.startswith("SVM-"), log_uniform),
        }
    )


# Ranges and choices of the sampled parameters.
DEPTH_RANGE = (2, 10)
TREES_RANGE = (10, 200)
FRACTION_RANGE = (0.3, 1.0)
SPLIT_TYPES = ("orthogonal", "PCA", "SVM-linear", "SVM-rbf", "SVM-poly", "SVM-sigmoid")
GAIN_CHOICES = ("gini", "entropy")
LDA_CHOICES = (None, 1, 2)
PCA_C_CHOICES = (5, 10, 15, 20)
SVM_C_RANGE = (0.01, 100.0)
