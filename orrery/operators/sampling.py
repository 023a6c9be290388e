"""Samples that are the same in every run: rows in the order of the md5 of their id, a colon and a seed, which SQL can name too."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.lines import codes


def by_hash(id_col: str, seed: int) -> list:
    """The order of a sample."""
    return [F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary")), F.col(id_col)]


def sample(df: DataFrame, id_col: str, n: int, seed: int = 1337) -> DataFrame:
    """n rows."""
    return df.orderBy(*by_hash(id_col, seed)).limit(n)


def stratified(df: DataFrame, id_col: str, label_col: str, n: int, seed: int = 1337) -> DataFrame:
    """ceil(n / labels) rows of each label at most, n in all."""
    labels = max(1, df.select(label_col).distinct().count())
    return sample(per_group(df, id_col, label_col, -(-n // labels), seed), id_col, n, seed)


def per_group(df: DataFrame, id_col: str, group_col: str, n: int, seed: int = 1337) -> DataFrame:
    """n rows of each group at most."""
    w = Window.partitionBy(group_col).orderBy(*by_hash(id_col, seed))
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).drop("__r")


def first_by_order(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__r = 1").drop("__r")


def top_per_group(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= n)


def factorize(df: DataFrame, column: str, out: str) -> DataFrame:
    """Codes from 0 by the sorted values: ranked among the distinct values, joined back."""
    return df.join(codes(df, column, out), column)


def mode(df: DataFrame, key: str, column: str) -> DataFrame:
    """key, mode, n: the most frequent value of each key, the first in order of ties."""
    counts = df.groupBy(key, F.col(column).alias("mode")).agg(F.count(F.lit(1)).alias("n"))
    return first_by_order(counts, [key], [F.desc("n"), "mode"])
