"""A catalog of datasets and a registry of their loaders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Loader = Callable[..., DataFrame]


class Registry:
    """Loaders by dataset key."""

    def __init__(self) -> None:
        self.entries: dict[str, tuple[Loader, dict[str, str]]] = {}

    def add(self, key: str, loader: Loader, provider: str, kind: str, description: str = "") -> None:
        self.entries[key] = (loader, {"provider": provider, "type": kind, "description": description})

    def load(self, spark: SparkSession, key: str, **options) -> DataFrame:
        if key not in self.entries:
            raise ValueError(f"unknown dataset {key}; known: {sorted(self.entries)}")
        return self.entries[key][0](spark, **options)

    def catalog(self, spark: SparkSession) -> DataFrame:
        """dataset_key, provider, type, description, by provider and key."""
        rows = sorted((m["provider"], k, m["type"], m["description"]) for k, (_, m) in self.entries.items())
        return spark.createDataFrame([(k, p, t, d) for p, k, t, d in rows], "dataset_key string, provider string, type string, description string")
