"""Kendall's rank correlation without looking at every pair."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges that each column is cut into: a range's rows are one task's work.
RANGES = 64


def agreement(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> int:
    """Sum of sign(x_i - x_j) * sign(y_i - y_j) over all pairs of rows, from different (x, y) and how often each is there; n log n steps."""
    order = np.lexsort((y, x))
    x, n = x[order], n[order].astype(np.int64)
    rank = np.unique(y[order], return_inverse=True)[1]
    total = 0
    for bit in range(int(rank.max(initial=0)).bit_length() - 1, -1, -1):
        # pairs whose ranks differ in this bit first, in the order of x
        node = rank >> (bit + 1)
        by = np.argsort(node, kind="stable")
        one, w = (rank[by] >> bit & 1).astype(bool), n[by]
        first = np.searchsorted(node[by], node[by], side="left")
        zeros, ones = (np.concatenate([[0], np.cumsum(np.where(hit, w, 0))]) for hit in (~one, one))
        at = np.arange(len(by))
        total += int((w * np.where(one, zeros[at] - zeros[first], ones[first] - ones[at])).sum())
    # rows of the same x, which came in the order of y
    cuts = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.empty(0, np.int64)
    if len(cuts):
        s, q = np.add.reduceat(n, cuts), np.add.reduceat(n * n, cuts)
        total -= int((s * s - q).sum()) // 2
    return total


def below(column: str):
    return lambda v: v < F.col(column)


def kendall(df: DataFrame, a: str, b: str, ranges: int = RANGES) -> float | None:
    """tau-b of two columns over the rows that have both; None where one of them does not vary.

    Both columns are cut into ranges of about equal size. Pairs within a range of a are counted there, those of different ranges of a but one of b in b's, the
    others from the table of ranges (at most ranges x ranges numbers).
    """
    import pandas as pd

    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    cells = df.select(x.alias("x"), y.alias("y")).filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    shares = [i / ranges for i in range(1, ranges)]
    edges = cells.agg(F.percentile_approx("x", shares), F.percentile_approx("y", shares)).first()
    if edges[0] is None:
        return None
    for c, own in (("x", edges[0]), ("y", edges[1])):
        bounds = F.array(*[F.lit(float(v)) for v in sorted(set(own))])
        cells = cells.withColumn(f"p{c}", F.size(F.filter(bounds, below(c))))

    def within(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"s": [agreement(frame["x"].to_numpy(), frame["y"].to_numpy(), frame["n"].to_numpy())]})

    def total(parts: DataFrame, key: str) -> int:
        return int(parts.groupBy(key).applyInPandas(within, "s long").agg(F.coalesce(F.sum("s"), F.lit(0))).first()[0])

    s = total(cells, "px")
    s += total(cells.groupBy("py", F.col("px").cast("double").alias("x"), "y").agg(F.sum("n").alias("n")), "py")
    table = cells.groupBy("px", "py").agg(F.sum("n").alias("n")).toPandas()  # at most ranges x ranges rows
    s += agreement(table["px"].to_numpy(), table["py"].to_numpy(), table["n"].to_numpy())
    n = int(table["n"].sum())
    tied = [float(cells.groupBy(c).agg(F.sum("n").alias("n")).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0]) for c in ("x", "y")]
    every = n * (n - 1) / 2
    square = (every - tied[0]) * (every - tied[1])
    return s / square**0.5 if square > 0 else None
