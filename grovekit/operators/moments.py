"""Counts, sums and cross products of feature vectors, per key.

The cross products of wide vectors are matrix products, so each task reduces
its rows with numpy, holding one small matrix per key, and Spark adds up what
the tasks emit.  The data itself is never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Partial sums a task may hold before it emits them and starts anew.
FLUSH_DOUBLES = 4_000_000


def complete(features: str = "features") -> Column:
    """Whether a vector can be computed with: it is there, and so are all its elements.

    The one rule for all models: rows without a complete vector are left out of fits, and get NULL where a row needs
    an answer.
    """
    return F.col(features).isNotNull() & ~F.exists(features, lambda v: v.isNull())


def dense(column: pa.ListArray) -> np.ndarray:
    """The rows of an array column of complete vectors of one length as one matrix."""
    if column.null_count:
        raise ValueError(f"{column.null_count} of {len(column)} vectors are NULL")
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError(f"vectors of {lengths.min()} to {lengths.max()} elements in one column")
    flat = column.flatten()
    if flat.null_count:
        raise ValueError(f"{flat.null_count} elements of vectors are NULL")
    return flat.to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(column), -1)


def _groups(batch: pa.RecordBatch, keys: Sequence[str]) -> list[tuple[tuple, object]]:
    """Keys that occur in a batch with the rows of each."""
    if not keys:
        return [((), slice(None))]
    table = pd.DataFrame({k: batch.column(k).to_pandas() for k in keys})
    found = table.groupby(list(keys), sort=False).indices
    return [(k if isinstance(k, tuple) else (k,), at) for k, at in found.items()]


def moments(
    df: DataFrame, keys: Sequence[str] = (), features: str = "features", weight: str | None = None
) -> DataFrame:
    """``keys…, i, j, s`` with the sums of w·z_i·z_j for i <= j, z = (1, x).

    (0, 0) is the (weighted) row count and (0, j) the sum of feature j - 1.
    Rows without a complete vector are left out; vectors of two lengths fail.
    """
    kept = [*keys, features] + ([weight] if weight else [])
    source = df.filter(complete(features)).select(*kept)
    key_fields = [source.schema[k] for k in keys]
    schema = T.StructType(
        [*key_fields, T.StructField("partial", T.ArrayType(T.DoubleType()))]
    )

    arrow_schema = to_arrow_schema(schema)

    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def emit() -> pa.RecordBatch:
            upper = [m[np.triu_indices(len(m))] for m in held.values()]
            columns = [[k[i] for k in held] for i in range(len(keys))] + [upper]
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow_schema)]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            x = dense(batch.column(features))
            z = np.column_stack([np.ones(len(x)), x])
            zw = z * batch.column(weight).to_numpy()[:, None] if weight else z
            for key, at in _groups(batch, keys):
                held[key] = held.get(key, 0.0) + zw[at].T @ z[at]
            if sum(m.size for m in held.values()) > FLUSH_DOUBLES:
                yield emit()
                held.clear()
        if held:
            yield emit()

    return summed(source.mapInArrow(reduce_task, schema), keys)


def summed(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys…, i, j, s``: sums of the flattened upper triangles ``partial`` of the tasks."""
    # Position p of the flattened upper triangle back to (i, j): rows have
    # size, size - 1, … entries, so i counts the row starts that p has passed.
    size = ((F.sqrt(8.0 * F.size("partial") + 1) - 1) / 2).cast("int")
    return (
        partials.select(*keys, size.alias("_m"), F.posexplode("partial").alias("_p", "_v"))
        .groupBy(*keys, "_m", "_p")
        .agg(F.sum("_v").alias("s"))
        .withColumn(
            "i",
            F.floor(
                (2 * F.col("_m") + 1 - F.sqrt((2.0 * F.col("_m") + 1) ** 2 - 8.0 * F.col("_p"))) / 2
            ).cast("int"),
        )
        .withColumn(
            "j",
            (F.col("_p") - F.col("i") * F.col("_m") + F.col("i") * (F.col("i") + 1) / 2).cast("int"),
        )
        .select(*keys, "i", "j", "s")
    )


def symmetric(i: np.ndarray, j: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Full symmetric matrix from its upper triangle."""
    size = int(max(j)) + 1
    out = np.zeros((size, size))
    out[i, j] = s
    out[j, i] = s
    return out


def collect_moments(table: DataFrame) -> np.ndarray:
    """The matrix of an unkeyed moment table: (m + 1)² numbers, independent of n."""
    pdf = table.toPandas()
    return symmetric(pdf["i"].to_numpy(), pdf["j"].to_numpy(), pdf["s"].to_numpy())


def covariance(df: DataFrame, features: str = "features") -> DataFrame:
    """``i, j, gram, cov``: centered X'X and population covariance, i <= j."""
    m = moments(df, features=features)
    n = m.filter("i = 0 AND j = 0").select("s").scalar()
    first = m.filter("i = 0 AND j > 0")
    left = first.select(F.col("j").alias("i"), F.col("s").alias("_si"))
    right = first.select("j", F.col("s").alias("_sj"))
    gram = F.col("s") - F.col("_si") * F.col("_sj") / F.col("_n")
    return (
        m.filter("i > 0")
        .join(left, "i")
        .join(right, "j")
        .withColumn("_n", n)
        .select(
            (F.col("i") - 1).alias("i"),
            (F.col("j") - 1).alias("j"),
            gram.alias("gram"),
            (gram / F.col("_n")).alias("cov"),
        )
    )
