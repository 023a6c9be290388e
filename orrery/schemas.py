"""Canonical relations and their validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Column names and kinds of the canonical tables.
SCHEMAS: dict[str, dict[str, str]] = {
    "items": {"item_id": "string", "source": "string", "split": "string", "label": "string", "text": "string", "image_path": "string", "width": "int", "height": "int", "mpp": "float"},
    "embeddings": {"item_id": "string", "modality": "string", "model_id": "string", "dim": "int", "vector": "vector"},
    "fused": {"item_id": "string", "model_id": "string", "dim": "int", "vector": "vector"},
    "clusters": {"item_id": "string", "cluster_id": "int"},
    "map2d": {"item_id": "string", "x": "float", "y": "float"},
    "entities": {"entity_id": "string", "entity_type": "string", "name": "string", "description": "string"},
    "edges": {"edge_id": "string", "src": "string", "dst": "string", "rel": "string", "weight": "float", "provenance_id": "string"},
    "provenance": {"provenance_id": "string", "source_item_id": "string", "evidence_type": "string", "evidence": "string", "confidence": "float"},
}
KINDS = {"string": (T.StringType,), "int": (T.LongType, T.IntegerType, T.ShortType, T.ByteType), "float": (T.DoubleType, T.FloatType, T.DecimalType), "vector": (T.ArrayType,), "bool": (T.BooleanType,)}


def validate(df: DataFrame, table: str | dict[str, str], strict: bool = False) -> list[str]:
    """Problems of df's columns against a table's: missing ones, others (strict), other kinds. From the schema alone; nothing is read."""
    want = SCHEMAS[table] if isinstance(table, str) else table
    have = {f.name: f.dataType for f in df.schema}
    out = [f"missing column: {c}" for c in want if c not in have]
    if strict:
        out += [f"unexpected column: {c}" for c in have if c not in want]
    out += [f"column {c}: {have[c].simpleString()} is not {k}" for c, k in want.items() if c in have and not isinstance(have[c], KINDS[k])]
    return out


def issues(spark: SparkSession, problems: list[str]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in problems], "issue string")
