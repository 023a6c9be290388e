"""Statistical tests and small models."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.lines import running


def ks_two_sample(a: DataFrame, b: DataFrame, column: str = "x") -> DataFrame:
    """One row: n_a, n_b, statistic (largest distance of the two distribution functions), p_value (asymptotic); nulls below 10 values on a side.

    Values are counted first, so that the running sums go over distinct values, range by range.
    """
    finite = lambda d, i: d.select(F.col(column).cast("double").alias("x"), F.lit(1 - i).alias("a"), F.lit(i).alias("b")).filter("x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')")
    x = finite(a, 0).union(finite(b, 1)).groupBy("x").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    size = x.agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b"))
    d = running(x, ["x"], {"to_a": "a", "to_b": "b"}).crossJoin(F.broadcast(size)).select(F.abs(F.col("to_a") / F.col("n_a") - F.col("to_b") / F.col("n_b")).alias("d"))
    one = size.crossJoin(d.agg(F.max("d").alias("d")))  # single rows
    n = F.sqrt(F.col("n_a") * F.col("n_b") / (F.col("n_a") + F.col("n_b")))
    t = (n + 0.12 + 0.11 / n) * F.col("d")
    tail = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda s, k: s + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * t * t))
    enough = (F.col("n_a") >= 10) & (F.col("n_b") >= 10)
    return one.select("n_a", "n_b", F.when(enough, F.col("d")).alias("statistic"), F.when(enough, F.when(t < 0.04, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * tail)))).alias("p_value"))


def chi2_contingency(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row: statistic, dof, n over the table of a and b; Yates' correction for a 2 x 2 table; null statistic for fewer than two values of either."""
    cells = rows.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("o")).filter("a IS NOT NULL AND b IS NOT NULL")
    ra = cells.groupBy("a").agg(F.sum("o").alias("ra"))
    rb = cells.groupBy("b").agg(F.sum("o").alias("rb"))
    grid = ra.crossJoin(F.broadcast(rb)).join(cells, ["a", "b"], "left").fillna(0, ["o"])  # values of a x values of b: the table itself
    size = cells.agg(F.sum("o").alias("n"), F.count_distinct("a").alias("ka"), F.count_distinct("b").alias("kb"))
    grid = grid.crossJoin(F.broadcast(size))
    e = F.col("ra") * F.col("rb") / F.col("n")
    gap = F.abs(F.col("o") - e)
    gap = F.when((F.col("ka") == 2) & (F.col("kb") == 2), gap - F.least(F.lit(0.5), gap)).otherwise(gap)
    out = grid.agg(F.sum(gap * gap / e).alias("s"), F.max("n").alias("n"), F.max("ka").alias("ka"), F.max("kb").alias("kb"))
    return out.select(F.when((F.col("ka") > 1) & (F.col("kb") > 1), F.col("s")).alias("statistic"), ((F.col("ka") - 1) * (F.col("kb") - 1)).alias("dof"), "n")


#: Strata that the rows of a permutation test are dealt to, and values that may take part (what an exact hypergeometric draw allows).
STRATA, MOST_VALUES = 256, 10**9


def permutation_test(a: DataFrame, b: DataFrame, column: str = "x", n_perm: int = 500, seed: int = 1337) -> DataFrame:
    """One row: statistic (difference of means), p_value over n_perm shufflings of the labels, each of which leaves both sides their sizes.

    A shuffling puts n_a of all values on side a, every such choice being equally likely. The values lie in strata by a hash; how many of each stratum are
    chosen is a multivariate hypergeometric draw on the driver (strata x n_perm numbers), and within a stratum its different values draw in turn
    from what is left. So nothing is copied for a permutation, and each task holds one batch. Nulls and NaN are left out; nulls for the figures
    below 10 values on a side. From 10^9 values on there is no exact draw: ValueError.
    """
    both = a.select(F.col(column).cast("double").alias("x"), F.lit(1).alias("a")).unionAll(b.select(F.col(column).cast("double"), F.lit(0))).filter("x IS NOT NULL AND NOT isnan(x)")
    counts = both.groupBy("x").agg(F.sum("a").alias("a"), F.count(F.lit(1)).alias("n")).withColumn("stratum", F.pmod(F.xxhash64("x"), F.lit(STRATA)).cast("int"))
    held = counts.groupBy("stratum").agg(F.sum("n"), F.sum("a"), F.sum(F.col("x") * F.col("a")), F.sum(F.col("x") * (F.col("n") - F.col("a")))).orderBy("stratum").collect()  # at most STRATA rows
    sizes = np.array([r[1] for r in held], np.int64)
    n, n_a = int(sizes.sum()), int(sum(r[2] for r in held))
    spark, schema = a.sparkSession, "n_a long, n_b long, statistic double, p_value double"
    if n >= MOST_VALUES:
        raise ValueError(f"{n} values, at most {MOST_VALUES - 1}")
    if n_a < 10 or n - n_a < 10:
        return spark.createDataFrame([(n_a, n - n_a, None, None)], schema)
    sum_a, sum_b = sum(r[3] for r in held), sum(r[4] for r in held)
    rng = np.random.default_rng(seed)
    rest, need, chosen = n, np.full(n_perm, n_a), {}
    for r in held:
        rest -= int(r[1])
        chosen[r[0]] = rng.hypergeometric(int(r[1]), rest, need)
        need = need - chosen[r[0]]
    rows_in = {r[0]: int(r[1]) for r in held}

    def draw(batches):
        left: dict[int, int] = dict(rows_in)
        want = {k: v.copy() for k, v in chosen.items()}
        sums = np.zeros(n_perm)
        generators = {k: np.random.default_rng([seed, k]) for k in chosen}
        for batch in batches:
            x, count, stratum = (batch.column(i).to_numpy() for i in range(3))
            for value, times, k in zip(x.tolist(), count.tolist(), stratum.tolist(), strict=True):
                # of the stratum's values that are left, `times` are this one
                left[k] -= times
                got = generators[k].hypergeometric(times, left[k], want[k])
                want[k] -= got
                sums += value * got
        yield pa.RecordBatch.from_pydict({"p": np.arange(n_perm), "s": sums})

    spread = counts.select("x", "n", "stratum").repartition("stratum").sortWithinPartitions("stratum", "x")
    per = spread.mapInArrow(draw, "p long, s double").groupBy("p").agg(F.sum("s").alias("s"))
    shuffled = F.col("s") / n_a - (F.lit(sum_a + sum_b) - F.col("s")) / (n - n_a)
    statistic = sum_a / n_a - sum_b / (n - n_a)
    # sums of floats in another order differ in the last digits
    hits = per.agg(F.sum((F.abs(shuffled) >= F.lit(abs(statistic) * (1 - 1e-12))).cast("long")).alias("h"))
    return hits.select(F.lit(n_a).cast("long").alias("n_a"), F.lit(n - n_a).cast("long").alias("n_b"), F.lit(statistic).alias("statistic"), ((F.col("h") + 1) / (n_perm + 1)).alias("p_value"))


def effective_rank(values: DataFrame, column: str = "s") -> DataFrame:
    """One row: exp of the entropy of the positive values over their sum; 0 without any."""
    x = values.select(F.col(column).cast("double").alias("s")).filter("s > 0")
    p = x.select((F.col("s") / F.sum("s").over(Window.partitionBy())).alias("p"))
    return p.agg(F.coalesce(F.exp(-F.sum(F.col("p") * F.ln(F.col("p") + 1e-12))), F.lit(0.0)).alias("effective_rank"))


def separability(rows: DataFrame, label: str, vector: str = "vector", train_share: float = 0.75, seed: int = 1337) -> DataFrame:
    """One row: accuracy of a logistic regression that tells the labels apart, on the rows outside a hash-chosen share."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.functions import array_to_vector

    x = rows.select("item_id", F.col(label).cast("string").alias("y"), array_to_vector(F.col(vector).cast("array<double>")).alias("features")).filter("y IS NOT NULL")
    x = StringIndexer(inputCol="y", outputCol="label", stringOrderType="alphabetAsc").fit(x).transform(x)
    at = F.pmod(F.xxhash64("item_id", F.lit(seed)), F.lit(10_000))
    model = LogisticRegression(maxIter=50).fit(x.filter(at < int(train_share * 10_000)))
    test = model.transform(x.filter(at >= int(train_share * 10_000)))
    return test.agg(F.count(F.lit(1)).alias("n_test"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


def cross_validated(rows: DataFrame, label: str, vector: str = "vector", folds: int = 5, seed: int = 1337) -> DataFrame:
    """fold, accuracy, macro_f1 of a logistic regression in hash-made folds."""
    from functools import reduce

    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.functions import array_to_vector

    x = rows.select("item_id", F.col(label).cast("string").alias("y"), array_to_vector(F.col(vector).cast("array<double>")).alias("features")).filter("y IS NOT NULL")
    x = StringIndexer(inputCol="y", outputCol="label", stringOrderType="alphabetAsc").fit(x).transform(x).withColumn("fold", F.pmod(F.xxhash64("item_id", F.lit(seed)), F.lit(folds)))
    parts = []
    for k in range(folds):
        model = LogisticRegression(maxIter=30).fit(x.filter(F.col("fold") != k))
        parts.append(model.transform(x.filter(F.col("fold") == k)).select("fold", F.col("label").alias("truth"), F.col("prediction").alias("guess")))
    return fold_scores(reduce(DataFrame.union, parts))


def fold_scores(guesses: DataFrame) -> DataFrame:
    """fold, accuracy, macro_f1 from fold, truth, guess."""
    cell = lambda c, t, g, h: F.struct(F.col(c).cast("double").alias("c"), F.lit(t).alias("t"), F.lit(g).alias("g"), h.cast("int").alias("h"))
    both = guesses.select("fold", F.explode(F.array(cell("truth", 1, 0, F.col("truth") == F.col("guess")), cell("guess", 0, 1, F.lit(0)))).alias("e")).select("fold", "e.*")
    per = both.groupBy("fold", "c").agg(F.sum("t").alias("t"), F.sum("g").alias("g"), F.sum("h").alias("h"))
    return per.groupBy("fold").agg((F.sum("h") / F.sum("t")).alias("accuracy"), F.avg(2 * F.col("h") / (F.col("t") + F.col("g"))).alias("macro_f1"))


def confusion(rows: DataFrame, truth: str, guess: str) -> DataFrame:
    """truth, guess, n."""
    return rows.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count(F.lit(1)).alias("n"))


def kolmogorov_tail(t: float) -> float:
    """The asymptotic p value in plain Python, for tests."""
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * t * t) for k in range(1, 101))))
