"""The manifest as a stream: files of new rows in, the latest row of each artifact out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.operators.registry import MANIFEST


def manifest_stream(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", files_at_once).parquet(path)


def keep_latest(stream: DataFrame, state_path: str, checkpoint: str, key: tuple[str, ...] = ("stage", "artifact")):
    """A query that merges each batch's rows into state_path/<batch number>: the latest row of each key by created_at_utc so far. Start it with available-now for a backfill."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        w = Window.partitionBy(*key).orderBy(F.desc("created_at_utc"), F.desc("path"))
        rows = batch
        if number > 0:
            rows = rows.unionByName(spark.read.schema(MANIFEST).parquet(f"{state_path}/{number - 1}"))
        rows.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r").write.mode("overwrite").parquet(f"{state_path}/{number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "1 day", time: str = "ts", key: str = "event_type") -> DataFrame:
    """window_start, key, n, total: tumbling windows, rows later than `late` left out; the same plan for a stream and a table."""
    timed = events.withWatermark(time, late) if events.isStreaming else events
    out = timed.groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), key, "n", "total")
