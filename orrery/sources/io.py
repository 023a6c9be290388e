"""Reading and writing tables."""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrites path; partition_by: a folder for each value."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text: for CSV."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema])


def save_csv(df: DataFrame, path: str) -> None:
    """Values as they are: white space at their ends stays."""
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    flat(df).write.mode("overwrite").options(header=True, escape='"', **spaces).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def save_json(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """All rows; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_yaml(path: str) -> dict:
    import yaml

    with open(path) as f:
        return yaml.safe_load(f)


def taxonomy(spark: SparkSession, config: dict) -> DataFrame:
    """label, label_name from {labels: {code: {name}}}."""
    rows = [(str(k), str((v or {}).get("name", k))) for k, v in (config.get("labels") or {}).items()]
    return spark.createDataFrame(rows, "label string, label_name string")


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, size, modified of the files below path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the context's checkpoint folder where that is unset. On a cluster it has to be set; a local session gets a temporary one."""
    context = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not where and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; it has to name a folder that driver and executors share")
    if not where:
        where = "file://" + tempfile.mkdtemp(prefix="orrery-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(where)
    return where
