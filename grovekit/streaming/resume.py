"""The resumable run as a file stream.

New item files are worked off as they arrive.  Progress is the stream's own
checkpoint plus the run table: a replayed micro-batch finds its items done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from grovekit.functions.answers import question_kind
from grovekit.plans.experiments import run_predictions
from grovekit.sources.schemas import ITEM


def item_stream(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    lines = spark.readStream.schema(ITEM).option("maxFilesPerTrigger", max_files).json(folder)
    return lines.withColumn("kind", question_kind(lines["question"]))


def stream_predictions(
    items: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    backend: str,
) -> StreamingQuery:
    """Predict everything available, then stop."""

    def work(batch: DataFrame, _: int) -> None:
        run_predictions(batch, predict, path, backend)

    return (
        items.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
