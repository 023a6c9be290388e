"""Stages: lazy transforms with gates before and after, skipped while their inputs are the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators.critic import Result
from orrery.operators.registry import register

Tables = dict[str, DataFrame]


class GateFailed(RuntimeError):
    pass


@dataclass
class Stage:
    name: str
    inputs: list[str]
    outputs: list[str]
    transform: Callable[[Tables], Tables]
    before: list[Callable[[Tables], Result]] = field(default_factory=list)
    after: list[Callable[[Tables], Result]] = field(default_factory=list)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def fingerprint(df: DataFrame) -> str:
    """What a table is made of: its plan and its files' paths, sizes and times; where no files are known, a digest of the rows in any order."""
    spark, parts = df.sparkSession, [df.schema.json()]
    files = df.inputFiles()
    if files:
        parts.append(df._jdf.queryExecution().analyzed().canonicalized().toString())
        conf = spark._jsc.hadoopConfiguration()
        for f in sorted(files):
            where = spark._jvm.org.apache.hadoop.fs.Path(f)
            status = where.getFileSystem(conf).getFileStatus(where)
            parts.append(f"{f} {status.getLen()} {status.getModificationTime()}")
    else:
        parts.append(str(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*df.columns)), F.sum(F.hash(*df.columns).cast("long"))).first()))
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def last_inputs(spark: SparkSession, where: str) -> dict[str, str]:
    """The fingerprints that a stage's outputs were made from."""
    return {r[0]: r[1] for r in spark.read.schema("name string, fingerprint string").json(where).collect()} if exists(spark, where) else {}


def run(spark: SparkSession, stages: list[Stage], tables: Tables, root: str, rebuild: bool = False) -> tuple[Tables, list[Result]]:
    """Runs the stages in order: each one's outputs are parquet under root/<stage>/<table> and read back, so later stages start from files.

    A stage is not run again while its outputs are there and its inputs' fingerprints are those that they were made from (root/<stage>/_inputs), unless rebuild. A gate that fails stops the run. Each output gets a row in root/manifest.
    """
    tables, results = dict(tables), []
    for stage in stages:
        where = {t: f"{root}/{stage.name}/{t}" for t in stage.outputs}
        given = {t: tables[t] for t in stage.inputs}
        now, noted = {t: fingerprint(df) for t, df in given.items()}, f"{root}/{stage.name}/_inputs"
        if rebuild or not all(exists(spark, p) for p in where.values()) or last_inputs(spark, noted) != now:
            check(stage.before, given, results)
            for name, df in stage.transform(given).items():
                df.write.mode("overwrite").parquet(where[name])
            made = {t: spark.read.parquet(p) for t, p in where.items()}
            check(stage.after, made, results)
            for t, p in where.items():
                register(spark, f"{root}/manifest", stage.name, t, p, made[t])
            spark.createDataFrame(sorted(now.items()), "name string, fingerprint string").coalesce(1).write.mode("overwrite").json(noted)
        tables |= {t: spark.read.parquet(p) for t, p in where.items()}
    return tables, results


def check(gates: list[Callable[[Tables], Result]], tables: Tables, results: list[Result]) -> None:
    for gate in gates:
        r = gate(tables)
        results.append(r)
        if not r.passed:
            raise GateFailed(f"{r.stage} {r.gate}: {r.fails}")
