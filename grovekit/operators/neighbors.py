"""Exact nearest neighbours and the classifier built on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grovekit.functions.hashing import draw
from grovekit.operators.stats import feature_stats, zscore
from grovekit.session import BROADCAST_LIMIT_BYTES

# Rows of one block of the block-wise join.
BLOCK_BYTES = 32 * 1024 * 1024
SLACK = 1e-9

OUT = "_q string, _t string, distance double"


def _candidates(q: np.ndarray, x: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query, row numbers and exact distances that contain its k nearest.

    A matrix product screens the block; its rounding error is bounded by the
    slack, and what passes is measured exactly.
    """
    qq, xx = (q**2).sum(1), (x**2).sum(1)
    rough = qq[:, None] + xx[None, :] - 2 * q @ x.T
    kth = np.partition(rough, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
    limit = kth + SLACK * (qq + xx.max() + 1)
    found = []
    for i in range(len(q)):
        near = np.nonzero(rough[i] <= limit[i])[0]
        found.append((near, np.sqrt(((x[near] - q[i]) ** 2).sum(1))))
    return found


def _nearest_in_block(qkeys, q, tkeys, x, k: int) -> pd.DataFrame:
    rows = []
    for i, (near, d) in enumerate(_candidates(q, x, k)):
        order = np.lexsort((tkeys[near], d))[:k]
        rows += [(qkeys[i], tkeys[near[j]], d[j]) for j in order]
    return pd.DataFrame(rows, columns=["_q", "_t", "distance"])


def _stack(pdf: pd.DataFrame, prefix: str) -> tuple[np.ndarray, np.ndarray]:
    return pdf[f"_{prefix}"].to_numpy(), np.stack(pdf[f"_{prefix}x"].to_numpy()).astype(float)


def nearest(
    train: DataFrame,
    queries: DataFrame,
    k: int,
    key: str,
    features: str = "features",
    broadcast_bytes: int = BROADCAST_LIMIT_BYTES // 2,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``query, neighbor, distance, rank``: the k nearest training rows per query.

    Ties go to the smaller key (as text).  Queries that fit ``broadcast_bytes``
    are sent to the training rows; otherwise both sides are cut in hashed
    blocks and every pair of blocks is one group.  Either way a task emits at
    most k rows per query and the final ranking sees only those.  Runs one job
    to size the queries.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.col(key).cast("string").alias(f"_{name}"),
            F.transform(features, lambda v: v.cast("double")).alias(f"_{name}x"),
        )

    t, q = side(train, "t"), side(queries, "q")
    shape = q.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_qx")).alias("m")).first()
    if not shape["n"]:
        partial = t.select(F.col("_t").alias("_q"), "_t", F.lit(0.0).alias("distance")).limit(0)
    elif shape["n"] * (8 * shape["m"] + 48) <= broadcast_bytes:
        partial = _by_broadcast(t, q, k)
    else:
        partial = _by_blocks(t, q, k, 8 * shape["m"] + 48, block_bytes)
    w = Window.partitionBy("_q").orderBy("distance", "_t")
    return (
        partial.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(F.col("_q").alias("query"), F.col("_t").alias("neighbor"), "distance", "rank")
    )


def _by_broadcast(t: DataFrame, q: DataFrame, k: int) -> DataFrame:
    spark = t.sparkSession
    shared = spark.sparkContext.broadcast(_stack(q.toPandas(), "q"))  # size checked by the caller

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qkeys, qx = shared.value
        held = None
        for batch in batches:
            if batch.empty:
                continue
            tkeys, x = _stack(batch, "t")
            for start in range(0, len(qkeys), 1024):
                cut = slice(start, start + 1024)
                new = _nearest_in_block(qkeys[cut], qx[cut], tkeys, x, k)
                held = new if held is None else pd.concat([held, new])
            if len(held) > 4 * k * len(qkeys):
                held = _prune(held, k)
        if held is not None:
            yield _prune(held, k)

    return t.mapInPandas(task, OUT)


def _prune(held: pd.DataFrame, k: int) -> pd.DataFrame:
    return held.sort_values(["_q", "distance", "_t"]).groupby("_q", sort=False).head(k)


def _by_blocks(t: DataFrame, q: DataFrame, k: int, row_bytes: int, block_bytes: int) -> DataFrame:
    per_block = max(1, block_bytes // row_bytes)
    n_q, n_t = (max(1, -(-side.count() // per_block)) for side in (q, t))

    def blocked(side: DataFrame, name: str, own: str, n_own: int, other: str, n_other: int):
        return side.withColumn(own, (draw("block", F.col(f"_{name}")) % n_own).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    left = blocked(q, "q", "_qb", n_q, "_tb", n_t).groupBy("_qb", "_tb")
    right = blocked(t, "t", "_tb", n_t, "_qb", n_q).groupBy("_qb", "_tb")

    def pair(qs: pd.DataFrame, ts: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or ts.empty:
            return pd.DataFrame(columns=["_q", "_t", "distance"])
        return _nearest_in_block(*_stack(qs, "q"), *_stack(ts, "t"), k)

    return left.cogroup(right).applyInPandas(pair, OUT)


def knn_classify(
    train: DataFrame, queries: DataFrame, k: int, key: str, label: str = "label", scale: bool = True, **sizes
) -> DataFrame:
    """``query, predicted``: most frequent label of the k nearest, ties to the smallest."""
    if scale:
        stats = feature_stats(train)
        # A constant feature scales to NULL; it cannot tell rows apart, so it counts as 0.
        fill = lambda df: df.withColumn(
            "features", F.transform("features", lambda v: F.coalesce(v, F.lit(0.0)))
        )
        train, queries = fill(zscore(train, stats)), fill(zscore(queries, stats))
    near = nearest(train, queries, k, key, **sizes)
    labels = train.select(F.col(key).cast("string").alias("neighbor"), F.col(label).alias("_label"))
    votes = near.join(labels, "neighbor").groupBy("query", "_label").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("query").agg(
        F.min_by("_label", F.struct(-F.col("n"), F.col("_label"))).alias("predicted")
    )
