"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table whose rows keep every core busy.

    A table of fewer splits than cores is dealt out once; larger tables, that
    is all tables that need a cluster, are scanned as they lie.  Pruned columns
    and pushed filters still reach the scan.
    """
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() < cores:  # a bare scan: counting its splits runs nothing
        return table.repartition(cores)
    return table
