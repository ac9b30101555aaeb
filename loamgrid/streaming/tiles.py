"""New tiles as a stream (an extension: batch work only lists folders)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tile_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    """Rows of Parquet files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def process_stream(stream: DataFrame, operator: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, keys: list[str] | None = None) -> StreamingQuery:
    """Each batch through a batch operator into a folder of its own in target, by the batch's number and the checkpoint's
    name: a batch that is repeated after a failure replaces itself, and rows of a key that arrive later are added. Only
    with `keys` is it otherwise: a key that target has from another batch is skipped, as files that exist are."""
    run = checkpoint.rstrip("/").rpartition("/")[2]

    def one(batch: DataFrame, number: int) -> None:
        made = operator(batch)
        if keys:
            try:
                made = made.join(batch.sparkSession.read.parquet(target).where((F.col("run") != run) | (F.col("batch") != number)).select(keys).distinct(), keys, "left_anti")
            except Exception as e:  # noqa: BLE001  the first batch has no target yet
                if "PATH_NOT_FOUND" not in str(e):
                    raise
        named = made.withColumns({"run": F.lit(run), "batch": F.lit(number).cast("long")})
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch").parquet(target)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def confusion_stream(stream: DataFrame, event_time: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Confusion counts of arriving pixels by window of event time; rows later than `late` are left out by the watermark."""
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, window).alias("w"), "label", "pred").agg(F.count("*").alias("n")).select("w.start", "w.end", "label", "pred", "n")
