"""Helpers that the operators share: tables, shared storage, word classes."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: A word is a run of characters outside ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or the context's checkpoint folder where that is unset. On a cluster it has to be set; a local session gets a temporary one."""
    context = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not where and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; it has to name a folder that driver and executors share")
    if not where:
        where = "file://" + tempfile.mkdtemp(prefix="orrery-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(where)
    return where


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: the lineage ends in files that survive the loss of executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """df, stored, with a column of numbers from 0 in the order given. Ranges are numbered in parallel; their sizes, a row each, are summed up in one task."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = stored(ranged.withColumn("__part", F.spark_partition_id()).withColumn("__nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    sizes = held.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    ahead = sizes.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
    return held.join(F.broadcast(ahead), "__part").withColumn(name, F.col("__ahead") + F.col("__nth")).drop("__part", "__nth", "__ahead")


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    """The Arrow type in which a column comes to Python and has to go back."""
    return to_arrow_type(df.schema[column].dataType)


def fold(column: str, folds: int):
    """The fold of a row: crc32 of the id as text, modulo folds; a null id is in the fold of the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


#: Rows and bytes of a batch between Spark and Python, at most: a worker holds one or two, and Spark as much again.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch limits to BATCH_ROWS and BATCH_BYTES, where they are higher."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
