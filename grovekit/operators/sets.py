"""Differences, stacks and memberships of row sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def union_first_wins(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """All rows of ``first`` and those of ``second`` whose key is new."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"))


def stack_classes(parts: Sequence[DataFrame], label: str = "label") -> DataFrame:
    """Tables on top of each other; ``label`` tells which one a row is from."""
    out = parts[0].withColumn(label, F.lit(0))
    for i, part in enumerate(parts[1:], 1):
        out = out.unionByName(part.withColumn(label, F.lit(i)))
    return out


def distinct_in_order(df: DataFrame, value: str, position: str) -> DataFrame:
    """Distinct values with the position where each was first seen."""
    return df.groupBy(value).agg(F.min(position).alias("first"))


def with_membership(df: DataFrame, members: DataFrame, key: str, out: str = "member") -> DataFrame:
    """Adds a flag that tells whether the key is in the set."""
    known = members.select(key).distinct().withColumn(out, F.lit(True))
    return df.join(known, key, "left").withColumn(out, F.coalesce(out, F.lit(False)))
