"""Sharding (12): contiguous shards of near equal bytes, by prefix sums over the whole table.

Rows are put in order by range partitions; each partition sums its sizes once, the few sums are added up along the
partitions, and every row's first byte follows from the sum before its partition and the sum before it inside.  The
order is cut at equal targets: a row belongs to the shard in which its middle byte lies, so that every cut is the row
end nearest to its target and two shards differ by the size of one row at most, where rows are smaller than a shard.

Rows are ordered by id (null first), size, checksum and place in the input: a hot id or thousands of equal rows are
spread over partitions like any others, and rows that change places are equal in all columns given here.

Only DataFrame functions.  The sums of partitions are ordered in one task: one row for each partition, whatever the
table holds.  Defined cases: a null text is an empty one, of size 1.  Repeated rows get places of their own.  Shards
may be empty where there are fewer rows than shards.  Equal texts are not kept together by this law.  Other columns
are not looked at, but for those in ``carry``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grovekit.llm.common import written

LAW = "bytes"


def ordered(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, at, part[, row]``: rows in range partitions, ``row`` with the carried columns."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("at"),
        *([F.struct(*[docs[c] for c in carry]).alias("row")] if carry else []),
    )
    ranged = rows.repartitionByRange("doc_id", "size", "text_crc32", "at")
    return written(ranged.withColumn("part", F.spark_partition_id()))


def places(rows: DataFrame) -> DataFrame:
    """``rows`` with their place ``position`` and first byte ``begin`` in the whole order, and the ``total`` of bytes."""
    sums = rows.groupBy("part").agg(F.sum("size").alias("part_size"), F.count("*").alias("part_rows"))
    up_to = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        "part",
        F.coalesce(F.sum("part_size").over(up_to), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(up_to), F.lit(0)).alias("rows_before"),
        F.sum("part_size").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "size", "text_crc32", "at")
    numbered = rows.select(
        "*",
        F.row_number().over(inside).alias("nth"),
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
    )
    return numbered.join(F.broadcast(before), "part").select(
        *[c for c in rows.columns if c != "part"],
        (F.col("rows_before") + F.col("nth") - 1).alias("position"),
        (F.col("bytes_before") + F.col("end") - F.col("size")).alias("begin"),
        "total",
    )


def shard_rows(docs: DataFrame, shards: int = 8, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot[, row]``: the shard of every row, and its place there, gapless from 0."""
    placed = places(ordered(docs, carry))
    middle = (2 * F.col("begin") + F.col("size")) * shards
    cut = placed.withColumn("middle", middle).selectExpr(
        "*", f"cast(least(middle div (2 * total), {shards - 1}) as int) AS shard"
    )
    first = cut.groupBy("shard").agg(F.min("position").alias("first"))
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("position") - F.col("first")).alias("slot"), *(["row"] if carry else [])
    )


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """All rows and columns of ``docs`` under ``path/shard=k``, each file a stretch of the shard in order.

    A file has ``slot`` and ``row``, a struct of the columns of ``docs``, so that no name can clash.
    """
    shard_rows(docs, shards, docs.columns).select("shard", "slot", "row").write.partitionBy("shard").parquet(path)
