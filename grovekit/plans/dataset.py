"""From raw question files to train, validation and test records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovekit.operators.sampling import holdout
from grovekit.sources.records import image_listing, missing_images, read_jsonl, write_jsonl
from grovekit.sources.schemas import ITEM


def image_path(folder: str, index: Column) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/circuit_"), index.cast("string"), F.lit(".png"))


def build_records(items: DataFrame, folder: str, has_answer: bool) -> DataFrame:
    """``index, image, question[, answer]`` with the answer as text."""
    fields = ["index", image_path(folder, F.col("index")).alias("image"), "question"]
    if has_answer:
        fields.append(F.col("answer").cast("string").alias("answer"))
    return items.select(*fields)


def require_images(records: DataFrame, listing: DataFrame) -> DataFrame:
    """The records, once every picture is known to exist.  Runs a job."""
    absent = [r["image"] for r in missing_images(records, listing).select("image").limit(5).collect()]
    if absent:
        raise FileNotFoundError(f"pictures not found, for example {absent}")
    return records


def split_records(records: DataFrame, val_fraction: float = 0.1, seed=42, prefix: int = 4) -> DataFrame:
    """Adds ``split``: the first int(n * fraction) shuffled rows are ``val``."""
    return holdout(records, "index", val_fraction, seed, prefix)


def prepare(
    spark: SparkSession,
    train_file: str,
    test_file: str,
    train_images: str,
    test_images: str,
    out: str,
    val_fraction: float = 0.1,
    seed: int = 42,
) -> None:
    """Read, check and split the raw files; write ``train``, ``val`` and ``test`` JSON lines."""
    train = build_records(read_jsonl(spark, train_file, ITEM), train_images, has_answer=True)
    test = build_records(read_jsonl(spark, test_file, ITEM), test_images, has_answer=False)
    train = require_images(train, image_listing(spark, train_images))
    test = require_images(test, image_listing(spark, test_images))
    divided = split_records(train, val_fraction, seed)
    for split in ("train", "val"):
        write_jsonl(divided.filter(F.col("split") == split).drop("split"), f"{out}/{split}")
    write_jsonl(test, f"{out}/test")
