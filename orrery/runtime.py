"""A run's state, its log and the checks before a step, kept in a folder that outlives the driver."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators.registry import now
from orrery.operators.sampling import first_by_order

EVENTS = "run_id string, seq long, time_utc string, step string, stage string, status string, duration_s double, detail string"


class Unhealthy(RuntimeError):
    pass


class Run:
    """Steps of a run as rows of JSON lines under root/log, one file for each event; the state of a run is what its last events say, so a new driver resumes from it."""

    def __init__(self, spark: SparkSession, root: str, run_id: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.run_id = run_id or f"run_{now().replace('-', '').replace(':', '')}_{uuid.uuid4().hex[:6]}"
        self.seq = 0

    def note(self, step: str, status: str, stage: str = "", duration: float | None = None, **detail) -> None:
        """Appends an event."""
        self.seq += 1
        row = (self.run_id, time.time_ns(), now(), step, stage, status, duration, json.dumps(detail, sort_keys=True, default=str))
        self.spark.createDataFrame([row], EVENTS).coalesce(1).write.mode("append").json(f"{self.root}/log")

    def events(self) -> DataFrame:
        """All events of all runs; none where there is no log yet."""
        where = self.path("log")
        if not self.exists(where):
            return self.spark.createDataFrame([], EVENTS)
        return self.spark.read.schema(EVENTS).json(f"{self.root}/log")

    def state(self) -> DataFrame:
        """The last event of each step, of whichever run."""
        return first_by_order(self.events(), ["step"], [F.desc("seq")])

    def done(self, step: str) -> bool:
        last = self.state().filter(F.col("step") == step).first()
        return last is not None and last["status"] == "ok"

    def path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name if "/" in name else f"{self.root}/{name}")

    def exists(self, where) -> bool:
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def health_check(self, tables: dict[str, DataFrame] | None = None, need_tables: Sequence[str] = (), need_paths: Sequence[str] = (), least_free_gb: float = 1.0) -> dict:
        """Free space under the root, tables and paths that a step needs; Unhealthy with all that is wrong, else the figures."""
        root = self.path(self.root)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        free = files.getStatus(root if files.exists(root) else None).getRemaining() / 2**30
        wrong = [f"free space {free:.3f} GB < {least_free_gb:.3f} GB"] if free < least_free_gb else []
        wrong += [f"no table {t}" for t in need_tables if t not in (tables or {})]
        wrong += [f"no path {p}" for p in need_paths if not self.exists(self.path(p))]
        if wrong:
            raise Unhealthy("; ".join(wrong))
        return {"free_gb": round(free, 3), "executors": self.spark.sparkContext.defaultParallelism}

    @contextmanager
    def step(self, name: str, stage: str = "", **detail) -> Iterator[None]:
        """Notes the begin of a step, and its end with the seconds it took or the error that ended it, which goes on to the caller."""
        began = time.monotonic()
        self.note(name, "running", stage, **detail)
        try:
            yield
        except Exception as error:
            self.note(name, "error", stage, round(time.monotonic() - began, 3), error_type=type(error).__name__, error=str(error)[:2000])
            raise
        self.note(name, "ok", stage, round(time.monotonic() - began, 3), **detail)
