"""Gains of all thresholds as a table, and the best threshold of every feature.

The table is scored from class counts per distinct value: counts are combined
map-side, then summed along the sorted values.  Where only the best threshold
is asked for, ``histograms`` finds it without sorting all values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.functions.impurity import gain as gain_of
from grovekit.functions.impurity import total
from grovekit.operators.histograms import root_splits
from grovekit.operators.ranking import running_totals
from grovekit.session import local_table

CANDIDATES = ("midpoint", "value")


def class_table(
    projected: DataFrame, keys: Sequence[str], classes: Sequence[int], weight: str | None = None
) -> DataFrame:
    """``keys…, value, c0, c1, …``: weighted class counts per distinct value."""
    w = F.col(weight) if weight else F.lit(1)
    counts = [
        F.sum(F.when(F.col("label") == c, w).otherwise(0)).cast("bigint").alias(f"c{i}")
        for i, c in enumerate(classes)
    ]
    return projected.groupBy(*keys, "value").agg(*counts)


def threshold_gains(
    table: DataFrame,
    keys: Sequence[str],
    n_classes: int,
    gain: str = "entropy",
    candidates: str = "midpoint",
    spread: bool = False,
) -> DataFrame:
    """``keys…, value, th, gain, l0…, n0…`` for every valid candidate threshold.

    l* are the class counts at or below the threshold, n* those of the whole
    group.  The largest value is no candidate, since nothing lies above it.
    ``spread`` sorts groups of any size across tasks.
    """
    if candidates not in CANDIDATES:
        raise ValueError(f"unknown candidates {candidates!r}")
    ids = range(n_classes)
    summed = running_totals(
        table,
        keys,
        "value",
        {f"l{i}": F.col(f"c{i}") for i in ids},
        following="_next",
        grand="n_",
        spread=spread,
    ).filter(F.col("_next").isNotNull())
    summed = summed.withColumnsRenamed({f"n_l{i}": f"n{i}" for i in ids})
    left, right, whole = ([F.col(f"{p}{i}") for i in ids] for p in ("l", "_r", "n"))
    staged = summed.withColumns(
        {f"_r{i}": F.col(f"n{i}") - F.col(f"l{i}") for i in ids}
        | {"_nl": total(left), "_n": total(whole)}
    ).withColumn("_nr", F.col("_n") - F.col("_nl"))
    measured = gain_of(left, right, whole, F.col("_nl"), F.col("_nr"), F.col("_n"), gain)
    th = F.col("value") if candidates == "value" else (F.col("value") + F.col("_next")) / 2.0
    return staged.select(
        *keys,
        "value",
        th.alias("th"),
        measured.alias("gain"),
        *[f"l{i}" for i in ids],
        *[f"n{i}" for i in ids],
    )


def root_split(
    rows: DataFrame,
    classes: Sequence[int],
    gain: str = "entropy",
    candidates: str = "midpoint",
    exact_rows: int | None = None,
) -> DataFrame:
    """Best threshold of every feature: ``feature, th, gain, n_left, n_right``.  Runs jobs.

    ``exact_rows`` are the rows of an axis that one task sorts; ranges with more are cut further.
    """
    if candidates not in CANDIDATES:
        raise ValueError(f"unknown candidates {candidates!r}")
    found, n = root_splits(rows, classes, gain, candidates, exact_rows)
    best = [(f, s.th, s.gain, sum(s.left), n - sum(s.left)) for f, s in enumerate(found) if s is not None]
    return local_table(rows.sparkSession, best, "feature int, th double, gain double, n_left long, n_right long")
