"""Per-feature statistics and the scalings built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Features up to which a scaling is written out term by term.
UNROLLED = 128


def to_long(df: DataFrame, *keep: str, features: str = "features") -> DataFrame:
    """One row per (row, feature): ``keep…, feature INT, value DOUBLE``."""
    return df.select(*keep, F.posexplode(features).alias("feature", "value"))


def feature_stats(df: DataFrame, features: str = "features") -> DataFrame:
    """``feature, n, mean, std, min, max``; std is the population deviation.

    Map-side aggregation leaves one row per feature and task to shuffle.
    """
    return (
        to_long(df, features=features)
        .groupBy("feature")
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )


def _scaled(df: DataFrame, stats: DataFrame, names: tuple[str, str], make, features: str) -> DataFrame:
    """Map every feature with two of its statistics.

    Runs a job that returns one row per feature.  Vectors of usual width are
    written out term by term, which keeps them in compiled code.
    """
    known = sorted((r["feature"], r[names[0]], r[names[1]]) for r in stats.collect())
    x = F.col(features)
    if len(known) <= UNROLLED:
        out = F.array(*[make(F.get(x, F.lit(i)), F.lit(a), F.lit(b)) for i, a, b in known])
    else:
        first, second = (F.lit([k[p] for k in known]) for p in (1, 2))
        out = F.transform(x, lambda v, i: make(v, F.get(first, i), F.get(second, i)))
    return df.withColumn(features, out)


def zscore(df: DataFrame, stats: DataFrame, features: str = "features") -> DataFrame:
    """(x - mean) / std with the given statistics; a constant feature gives NULL."""
    return _scaled(
        df, stats, ("mean", "std"), lambda v, mean, std: F.try_divide(v - mean, std), features
    )


def minmax(df: DataFrame, stats: DataFrame, features: str = "features") -> DataFrame:
    """(x - min) / (max - min); unseen rows may leave [0, 1]."""
    return _scaled(
        df, stats, ("min", "max"), lambda v, low, high: F.try_divide(v - low, high - low), features
    )


def center(df: DataFrame, stats: DataFrame, features: str = "features") -> DataFrame:
    """x - mean."""
    return _scaled(df, stats, ("mean", "std"), lambda v, mean, _: v - mean, features)
