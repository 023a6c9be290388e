"""Artifact manifest: append-only, latest by key; fingerprints."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators.sampling import first_by_order

MANIFEST = (
    "stage string, artifact string, path string, schema_version string, created_at_utc string, inputs_json string, outputs_json string, rows long, cols long, warnings_count long, fails_count long,"
    " runtime_sec double, notes string, extra_json string"
)


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def register(spark: SparkSession, path: str, stage: str, artifact: str, where: str, table: DataFrame | None = None, **more) -> None:
    """Appends a row to the manifest at path; earlier rows are never rewritten."""
    row = {"stage": stage, "artifact": artifact, "path": where, "schema_version": "1", "created_at_utc": now(), "rows": table.count() if table is not None else None, "cols": len(table.columns) if table is not None else None}
    row |= {k: json.dumps(v, sort_keys=True) if k.endswith("_json") else v for k, v in more.items()}
    names = [f.strip().split()[0] for f in MANIFEST.split(",")]
    spark.createDataFrame([tuple(row.get(n) for n in names)], MANIFEST).write.mode("append").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The manifest with all its columns, those that older files lack as null."""
    found = spark.read.option("mergeSchema", "true").parquet(path)
    want = [f.strip().split() for f in MANIFEST.split(",")]
    return found.select(*[F.col(n).cast(t) if n in found.columns else F.lit(None).cast(t).alias(n) for n, t in want])


def latest_outputs(manifest: DataFrame, key: list[str], order: list) -> DataFrame:
    """The last row of each key by order (most recent first)."""
    return first_by_order(manifest, key, order)


def table_fingerprint(df: DataFrame, key_cols: list[str], order: list[str], n: int = 1000) -> DataFrame:
    """One row: rows, cols, sha256 of the first n rows' keys in order, one to a line, parts with | between."""
    first = df.orderBy(*order).limit(n).select(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in key_cols]).alias("k"), *order)
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "k"))), lambda x: x["k"]), "\n")
    head = first.agg(F.sha2(lines.cast("binary"), 256).alias("key_sha256"))
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns))).crossJoin(head)


def file_fingerprints(spark: SparkSession, path: str, edge: int = 65536) -> DataFrame:
    """path, size, modified, sha256 of the first and last `edge` bytes, md5 of all, for the files under path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ends = F.when(F.col("length") > edge, F.concat(F.expr(f"substring(content, 1, {edge})"), F.expr(f"substring(content, -{edge}, {edge})"))).otherwise(F.col("content"))
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2(ends, 256).alias("sha256"), F.md5("content").alias("md5"))


def sidecar(artifact: str, schema_version: str, table: DataFrame | None = None, extra: dict | None = None) -> dict:
    """What a manifest file beside an artifact says."""
    out = {"schema_version": schema_version, "artifact": artifact, "created_at_utc": now()}
    if table is not None:
        out["table"] = {"rows": table.count(), "cols": table.columns}
    return out | (extra or {})


def changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Paths whose fingerprint is new or another: what has to be built again."""
    return new.join(old.select("path", F.col("sha256").alias("was")), "path", "left").filter("was IS NULL OR was <> sha256").drop("was")


PLOTS = "plot_id string, stage string, title string, path string, created_at_utc string, tags_json string, is_core boolean, notes string"


def add_plot(spark: SparkSession, index: str, stage: str, title: str, path: str, tags: list[str] | None = None, is_core: bool = False, notes: str = "") -> str:
    """Appends a plot's row to the index at `index`; its id is the first 12 hex digits of the sha1 of stage, title and path."""
    import hashlib

    plot_id = hashlib.sha1(f"{stage}|{title}|{path}".encode()).hexdigest()[:12]
    spark.createDataFrame([(plot_id, stage, title, path, now(), json.dumps(tags or []), is_core, notes)], PLOTS).write.mode("append").parquet(index)
    return plot_id


def plots(spark: SparkSession, index: str) -> DataFrame:
    """The index with the last row of each plot."""
    return first_by_order(spark.read.schema(PLOTS).parquet(index), ["plot_id"], [F.desc("created_at_utc")])
