"""Running sums and ranks over all rows, without a window that one task would have to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.sources.io import ensure_checkpoint_dir


def running(df: DataFrame, order: list[str], sums: dict[str, Column | str]) -> DataFrame:
    """df with inclusive running sums in the order of the columns given; equal rows in any order.

    Rows are dealt to ranges of the order and summed within each; what lies before a range comes from one sum for each range. The ranges are
    checkpointed, so that both read the same ones.
    """
    ensure_checkpoint_dir(df.sparkSession)
    held = df.withColumns({f"__{k}": F.col(v) if isinstance(v, str) else v for k, v in sums.items()}).repartitionByRange(*order).withColumn("__range", F.spark_partition_id()).checkpoint()
    totals = held.groupBy("__range").agg(*[F.sum(f"__{k}").alias(f"__all_{k}") for k in sums])
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    ahead = totals.select("__range", *[F.coalesce(F.sum(f"__all_{k}").over(before), F.lit(0)).alias(f"__ahead_{k}") for k in sums])
    own = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = held.join(F.broadcast(ahead), "__range").withColumns({k: F.sum(f"__{k}").over(own) + F.col(f"__ahead_{k}") for k in sums})
    return out.drop("__range", *[f"__{k}" for k in sums], *[f"__ahead_{k}" for k in sums])


def codes(df: DataFrame, column: str, out: str, kind: str = "long") -> DataFrame:
    """column, out: the distinct values and their places from 0 among them, nulls first."""
    return running(df.select(column).distinct(), [column], {out: F.lit(1)}).withColumn(out, (F.col(out) - 1).cast(kind))


def average_ranks(df: DataFrame, column: str) -> DataFrame:
    """column, rank: each distinct value's average rank among all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    return running(counts, [column], {"__upto": "__n"}).select(column, (F.col("__upto") - (F.col("__n") - 1) / 2).alias("rank"))
