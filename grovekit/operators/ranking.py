"""Exact ranks and running totals that never put a whole group in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from grovekit.session import local_table, materialize


def hash_rank(
    df: DataFrame,
    order: str,
    groups: Sequence[str] = (),
    out: str = "rank",
    tie: Sequence[str] = (),
    prefix: int = 4,
) -> DataFrame:
    """1-based rank by a hex digest column, per group, as one global order.

    A digest is uniform, so its first ``prefix`` digits cut every group, hot or
    not, into 16**prefix even slices.  The rank is the count of rows in lower
    slices plus the position inside the slice; the slice counts are a small
    table (groups x 16**prefix rows).
    """
    sliced = df.withColumn("_slice", F.substring(F.col(order), 1, prefix))
    keys = [*groups, "_slice"]
    counts = sliced.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    below = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_slice")
    offsets = counts.select(
        *keys,
        F.coalesce(
            F.sum("_n").over(below.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_below"),
    )
    if groups:
        # Null-safe, so that a NULL group keeps its rows.
        offsets = offsets.select([F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)] + [F.col("_below")])
        on = F.lit(True)
        for i, k in enumerate(keys):
            on = on & sliced[k].eqNullSafe(offsets[f"_o{i}"])
        joined = sliced.join(offsets, on).drop(*[f"_o{i}" for i in range(len(keys))])
    else:
        joined = sliced.join(offsets, "_slice")
    within = Window.partitionBy(*keys).orderBy(order, *tie)
    return joined.withColumn(
        out, (F.row_number().over(within) + F.col("_below")).cast("bigint")
    ).drop("_slice", "_below")


def hash_cuts(
    df: DataFrame,
    order: str,
    groups: Sequence[str],
    quotas: Callable[[Column, Column], Sequence[Column]],
    prefix: int = 4,
) -> list[tuple]:
    """Digests at which a group's hash order reaches given counts.

    ``quotas(n_group, n_total)`` gives the counts; the result has one tuple
    ``(*group, [digest, …])`` per group, with None for a count of zero.  Two
    jobs: slice counts find the slice that holds each cut, then only those
    slices are ranked.  No row is shuffled but theirs, and what comes back is
    one digest per group and cut.
    """
    groups = list(groups)
    sliced = df.select(*groups, F.col(order).alias("_d"), F.substring(order, 1, prefix).alias("_slice"))
    counts = sliced.groupBy(*groups, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    per_group = Window.partitionBy(*(groups or [F.lit(0)]))
    below = per_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sized = counts.select(
        *groups,
        "_slice",
        "_n",
        F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below"),
        F.sum("_n").over(per_group).alias("_group"),
        counts.agg(F.sum("_n")).scalar().alias("_total"),  # not asked for unless a quota does
    )
    wanted = [q.cast("bigint") for q in quotas(F.col("_group"), F.col("_total"))]
    cuts = sized.select("*", F.posexplode(F.array(*wanted)).alias("_cut", "_quota"))
    held = (F.col("_quota") > F.col("_below")) & (F.col("_quota") <= F.col("_below") + F.col("_n"))
    found = cuts.filter(held | ((F.col("_quota") <= 0) & (F.col("_below") == 0)))
    spark = df.sparkSession
    rows = found.select(*groups, "_slice", "_cut", (F.col("_quota") - F.col("_below")).alias("_rank")).collect()
    fields = [df.schema[g] for g in groups]
    schema = StructType(
        [
            *fields,
            StructField("_slice", StringType()),
            StructField("_cut", IntegerType()),
            StructField("_rank", LongType()),
        ]
    )
    table = F.broadcast(local_table(spark, [tuple(r) for r in rows], schema))
    renamed = table.withColumnsRenamed({c: f"_c{i}" for i, c in enumerate([*groups, "_slice"])})
    on = F.lit(True)
    for i, c in enumerate([*groups, "_slice"]):
        on = on & sliced[c].eqNullSafe(renamed[f"_c{i}"])
    within = Window.partitionBy(*groups, "_cut").orderBy("_d")
    ranked = sliced.join(renamed, on).withColumn("_at", F.row_number().over(within))
    hits = ranked.filter(F.col("_at") == F.col("_rank")).select(*groups, "_cut", "_d").collect()
    out = {tuple(r[g] for g in groups): [None] * len(wanted) for r in rows}
    for r in hits:
        out[tuple(r[g] for g in groups)][r["_cut"]] = r["_d"]
    return [(*g, d) for g, d in out.items()]


def with_cuts(df: DataFrame, groups: Sequence[str], cuts: list[tuple], out: str = "_cuts") -> DataFrame:
    """Adds the digests of ``hash_cuts`` to the rows of each group; no shuffle."""
    fields = [StructField(f"_g{i}", df.schema[g].dataType) for i, g in enumerate(groups)]
    schema = StructType([*fields, StructField(out, ArrayType(StringType()))])
    table = F.broadcast(local_table(df.sparkSession, cuts, schema))
    on = F.lit(True)
    for i, g in enumerate(groups):
        on = on & df[g].eqNullSafe(table[f"_g{i}"])
    return df.join(table, on).drop(*[f.name for f in fields])


def positions(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """1-based position in the total order of ``order`` (a range sort).

    Runs a job: the sorted rows are written once, because the partition a row
    sorts into must not be sampled anew by the second pass.
    """
    sorted_rows = materialize(
        df.orderBy(*order).withColumn("_part", F.spark_partition_id())
    )
    counts = sorted_rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    below = Window.partitionBy(F.lit(0)).orderBy("_part")
    offsets = counts.select(
        "_part",
        F.coalesce(
            F.sum("_n").over(below.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_below"),
    )
    within = Window.partitionBy("_part").orderBy(*order)
    return (
        sorted_rows.join(offsets, "_part")
        .withColumn(out, (F.row_number().over(within) + F.col("_below")).cast("bigint"))
        .drop("_part", "_below")
    )


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: str,
    totals: dict[str, Column],
    following: str | None = None,
    grand: str | None = None,
    spread: bool = False,
    part: str | None = None,
) -> DataFrame:
    """Running sums of ``totals`` inside ``groups`` in the order of ``order``.

    ``following`` names a column for the next value of ``order``; ``grand`` is
    a prefix for columns with the group's full sums.  With ``spread`` the
    groups may be of any size: rows are range-sorted by (groups, order),
    written once, summed inside each sorted partition and shifted by the
    totals of the group's earlier partitions.  ``part`` names a column that
    already cuts each group in consecutive parts; then nothing is written.
    """
    upto = (Window.unboundedPreceding, Window.currentRow)
    if not spread and part is None:
        w = Window.partitionBy(*groups).orderBy(order)
        cols = {name: F.sum(c).over(w.rowsBetween(*upto)) for name, c in totals.items()}
        if grand:
            whole = Window.partitionBy(*groups)
            cols |= {grand + name: F.sum(c).over(whole) for name, c in totals.items()}
        if following:
            cols[following] = F.lead(order).over(w)
        return df.withColumns(cols)

    parts = df.withColumns({f"_v_{n}": c for n, c in totals.items()})
    if part is None:
        part = "_part"
        placed = parts.orderBy(*groups, order).withColumn(part, F.spark_partition_id())
        parts = materialize(placed)
    per_part = parts.groupBy(*groups, part).agg(
        F.min(order).alias("_first"),
        *[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals],
    )
    across = Window.partitionBy(*groups).orderBy(part)
    whole = Window.partitionBy(*groups)
    shifts = per_part.select(
        *groups,
        part,
        *[F.sum(f"_s_{n}").over(whole).alias(grand + n) for n in totals if grand],
        F.lead("_first").over(across).alias("_next_first"),
        *[
            F.coalesce(
                F.sum(f"_s_{n}").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias(f"_b_{n}")
            for n in totals
        ],
    )
    w = Window.partitionBy(*groups, part).orderBy(order)
    joined = parts.join(shifts, [*groups, part])
    cols = {n: F.sum(f"_v_{n}").over(w.rowsBetween(*upto)) + F.col(f"_b_{n}") for n in totals}
    if following:
        cols[following] = F.coalesce(F.lead(order).over(w), F.col("_next_first"))
    helpers = ["_part", "_next_first", *[f"_{p}_{n}" for n in totals for p in "vb"]]
    return joined.withColumns(cols).drop(*helpers)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the record of greatest ``order`` per key."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return (
        df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*").select(*df.columns)
    )
