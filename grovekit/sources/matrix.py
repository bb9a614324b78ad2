"""Feature tables from whitespace-separated text and from parquet bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovekit.functions.answers import SPACE, strip


def parse_numbers(line: Column) -> Column:
    """``ARRAY<DOUBLE>`` of a line of numbers separated by white space."""
    return F.transform(F.split(strip(line), f"{SPACE}+"), lambda t: t.cast("double"))


def parse_matrix(lines: DataFrame, width: int, labelled: bool, line: str = "value") -> DataFrame:
    """``features`` and, if ``labelled``, ``label`` from the last column.

    Blank lines are no rows.  A line of any other width, or with a word that is no number, fails the job.
    """
    others = [c for c in lines.columns if c != line]
    parsed = lines.filter(strip(F.col(line)) != "").select(*others, line, parse_numbers(F.col(line)).alias("_n"))
    wrong = F.concat(F.lit(f"not {width} numbers: "), F.substring(line, 1, 80))
    right = (F.size("_n") == width) & ~F.exists("_n", lambda v: v.isNull())
    numbers = F.when(right, F.col("_n")).otherwise(F.raise_error(wrong).cast("array<double>"))
    rows = parsed.select(*others, numbers.alias("_n"))
    if not labelled:
        return rows.select(*others, F.col("_n").alias("features"))
    return rows.select(
        *others,
        F.slice("_n", 1, width - 1).alias("features"),
        F.get("_n", F.lit(width - 1)).cast("int").alias("label"),
    )


def read_matrix(
    spark: SparkSession, path: str, width: int, labelled: bool = False, header_lines: int = 0
) -> DataFrame:
    """A matrix from text files, without the first ``header_lines`` lines of each, whatever they hold."""
    lines = spark.read.text(path)
    if header_lines:
        placed = lines.select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_at"),
        )
        # Line ids rise within a file's first block, so the header is what comes first there.
        first = placed.filter("_block = 0").groupBy("_file").agg(F.min("_at").alias("_first"))
        in_header = (F.col("_block") == 0) & (F.col("_at") < F.col("_first") + header_lines)
        lines = placed.join(first, "_file", "left").filter(~F.coalesce(in_header, F.lit(False))).select("value")
    return parse_matrix(lines, width, labelled)


def write_matrix(df: DataFrame, path: str, features: str = "features", label: str | None = None) -> None:
    numbers = F.array_join(F.transform(features, lambda v: v.cast("string")), " ")
    line = F.concat_ws(" ", numbers, F.col(label).cast("string")) if label else numbers
    df.select(line.alias("value")).write.text(path)


def read_bundle(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of a table partitioned by ``split``."""
    table = spark.read.parquet(path)
    train = table.filter(F.col("split") == "train").drop("split")
    test = table.filter(F.col("split") == "test").drop("split", "label")
    return train, test


def write_bundle(df: DataFrame, path: str) -> None:
    """One folder per value of ``split``, so that each part is read on its own."""
    df.write.partitionBy("split").parquet(path)
