"""Impurity of a class-count vector given as one column per class."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

GAIN_METHODS = ("entropy", "gini")


def total(counts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, counts)


def entropy(counts: Sequence[Column]) -> Column:
    """Base-2 entropy of the class shares; an empty class adds nothing."""
    n = total(counts)
    terms = []
    for c in counts:
        p = F.try_divide(c.cast("double"), n)
        terms.append(F.when(c > 0, -p * F.log2(p)).otherwise(F.lit(0.0)))
    return reduce(lambda a, b: a + b, terms)


def gini(counts: Sequence[Column]) -> Column:
    n = total(counts)
    shares = [F.try_divide(c.cast("double"), n) for c in counts]
    return F.lit(1.0) - reduce(lambda a, b: a + b, [p * p for p in shares])


def impurity(counts: Sequence[Column], method: str) -> Column:
    if method not in GAIN_METHODS:
        raise ValueError(f"unknown gain method {method!r}")
    return entropy(counts) if method == "entropy" else gini(counts)


def _scaled(counts: Sequence[Column], n: Column, method: str) -> Column:
    """Group size times impurity, from whole counts; an empty class adds nothing."""
    if method == "gini":
        return n - total([c.cast("double") * c for c in counts]) / n

    def xlogx(c: Column) -> Column:
        return F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))

    return xlogx(n) - total([xlogx(c) for c in counts])


def gain(
    left: Sequence[Column], right: Sequence[Column], parent: Sequence[Column],
    n_left: Column, n_right: Column, n: Column, method: str,
) -> Column:
    """Parent impurity minus the children's, weighted by their shares of rows.

    Takes counts and their sums as columns of their own, so that the
    expression stays small enough to be compiled.
    """
    if method not in GAIN_METHODS:
        raise ValueError(f"unknown gain method {method!r}")
    children = _scaled(left, n_left, method) + _scaled(right, n_right, method)
    return (_scaled(parent, n, method) - children) / n
