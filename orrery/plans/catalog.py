"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orrery.plans import q_cluster, q_eda, q_graph, q_model, q_tables

MODULES = (q_eda, q_cluster, q_graph, q_model, q_tables)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_graph.Q["kg_similarity_qa"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.Q.items()}


def oracle_sql() -> dict[str, str]:
    return {k: f for m in MODULES for k, f in m.SQL.items()}
