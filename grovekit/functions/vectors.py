"""Array arithmetic on ``features ARRAY<DOUBLE>``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# isclose(|z|, 1, atol=1e-3) with the default rtol of 1e-5 around 1.
MARGIN_TOLERANCE = 1e-3 + 1e-5


def dot(x: Column, w: Sequence[float] | Column) -> Column:
    """x·w.  A literal ``w`` is unrolled, so the sum stays inside codegen."""
    if isinstance(w, Column):
        return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    terms = [F.get(x, F.lit(i)) * F.lit(float(v)) for i, v in enumerate(w)]
    return reduce(lambda a, b: a + b, terms, F.lit(0.0))


def squared_distance(x: Column, y: Column) -> Column:
    return F.aggregate(
        F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v
    )


def euclidean(x: Column, y: Column) -> Column:
    return F.sqrt(squared_distance(x, y))


def squared_error(y_hat: Column, y: Column) -> Column:
    return (y_hat - y) * (y_hat - y)


def truncate_to_int(x: Column, dtype: str = "bigint") -> Column:
    """Cut toward zero, like a cast from double to an integer."""
    return x.cast(dtype)


def hyperplane_score(x: Column, w: Sequence[float] | Column, b: float | Column) -> Column:
    return dot(x, w) + (b if isinstance(b, Column) else F.lit(float(b)))


def hyperplane_class(x: Column, w, b) -> Column:
    """1 on and above the hyperplane, 0 below it."""
    return F.when(hyperplane_score(x, w, b) >= 0, F.lit(1)).otherwise(F.lit(0))


def on_margin(x: Column, w, b) -> Column:
    """True for rows whose score is -1 or +1 up to the closeness tolerance."""
    return F.abs(F.abs(hyperplane_score(x, w, b)) - 1) <= F.lit(MARGIN_TOLERANCE)


def goes_left(x: Column, w, th) -> Column:
    """Threshold partition of a projection: the boundary belongs to the left."""
    return dot(x, w) <= (th if isinstance(th, Column) else F.lit(float(th)))


def in_group(label: Column, group: Sequence[int]) -> Column:
    """Binary relabelling of a class partition: 0 inside ``group``, 1 outside."""
    return F.when(label.isin(*group), F.lit(0)).otherwise(F.lit(1))
