"""Embeddings: TF-IDF, scaling, fusion, PCA, alignment, similarity statistics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.vectors import cosine, doubles, norm, unit

WORD = r"\b\w\w+\b"


def joined(n: int):
    """From a place to the n words there, as one term."""
    return lambda i: F.array_join(F.slice("w", i, n), " ")


def times(w: float):
    return lambda x: x * w


def ngrams(docs: DataFrame, id_col: str, text_col: str, most: int = 2) -> DataFrame:
    """id, term: all runs of 1 to `most` words (of two characters at least, in lower case)."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text_col, F.lit(""))), F.lit(f"(?U)({WORD})"), 1)
    w = docs.select(F.col(id_col).alias("id"), words.alias("w"))
    terms = [F.col("w")]
    for n in range(2, most + 1):
        at = F.when(F.size("w") >= n, F.sequence(F.lit(1), F.size("w") - (n - 1))).otherwise(F.array().cast("array<int>"))
        terms.append(F.transform(at, joined(n)))
    return w.select("id", F.explode(F.concat(*terms)).alias("term"))


def tfidf(docs: DataFrame, id_col: str = "item_id", text_col: str = "text", max_features: int = 8192, most: int = 2) -> DataFrame:
    """id, term, tf, tfidf: smooth idf ln((1 + n) / (1 + df)) + 1, rows of length 1; the max_features most frequent terms (ties by term)."""
    counts = ngrams(docs, id_col, text_col, most).groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))
    terms = counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df")).orderBy(F.desc("total"), "term").limit(max_features)
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    idf = terms.crossJoin(F.broadcast(n)).select("term", (F.ln((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))  # max_features rows
    weighted = counts.join(F.broadcast(idf), "term").withColumn("v", F.col("tf") * F.col("idf"))
    size = F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy("id")))
    return weighted.select("id", "term", "tf", (F.col("v") / size).alias("tfidf"))


def tfidf_svd(docs: DataFrame, dims: int = 64, **options) -> DataFrame:
    """item_id, vector: rows of TF-IDF projected on its leading singular directions, of length 1. The Gram matrix of the kept terms is summed in the cluster."""
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.linalg.distributed import IndexedRow, IndexedRowMatrix

    cells = tfidf(docs, **options)
    terms = {r[0]: i for i, r in enumerate(cells.select("term").distinct().orderBy("term").collect())}
    size = len(terms)
    if size < 2:
        return docs.select(F.col(options.get("id_col", "item_id")).alias("item_id"), F.array(F.lit(0.0)).alias("vector"))
    at = cells.sparkSession.sparkContext.broadcast(terms)  # max_features entries
    rows = cells.groupBy("id").agg(F.collect_list(F.struct("term", "tfidf")).alias("x"))
    ids = rows.select("id", F.xxhash64("id").alias("k"))
    matrix = IndexedRowMatrix(rows.select(F.xxhash64("id").alias("k"), "x").rdd.map(lambda r: IndexedRow(r[0], Vectors.sparse(size, sorted((at.value[t], v) for t, v in r[1])))))
    k = min(dims, max(2, size - 1))
    svd = matrix.computeSVD(k, computeU=True)
    scale = svd.s.toArray()
    made = svd.U.rows.map(lambda r: (r.index, (r.vector.toArray() * scale).tolist())).toDF(["k", "v"])
    return ids.join(made, "k").select(F.col("id").alias("item_id"), unit("v").alias("vector"))


def standardise(rows: DataFrame, vector: str = "vector") -> DataFrame:
    """rows with vector standardised by coordinate: population deviation, unscaled where that is 0."""
    cells = rows.select(F.posexplode(doubles(vector)).alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    stats = cells.agg(F.sort_array(F.collect_list(F.struct("i", "m", "s"))).alias("st"))  # one row as wide as a vector
    scaled = F.zip_with(doubles(vector), "st", lambda x, s: (x - s["m"]) / F.when(s["s"] > 0, s["s"]).otherwise(1.0))
    return rows.crossJoin(F.broadcast(stats)).withColumn(vector, scaled).drop("st")


def numeric_vectors(rows: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """item_id, dim, vector: standardised numeric columns, nulls as 0."""
    v = F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in cols])
    return standardise(rows.select(F.col(id_col).alias("item_id"), F.lit(len(cols)).cast("long").alias("dim"), v.alias("vector")))


def align(modalities: list[DataFrame]) -> DataFrame:
    """item_id, v0, v1, ..: items that every modality (item_id, vector) has."""
    out = modalities[0].select("item_id", F.col("vector").alias("v0"))
    for i, m in enumerate(modalities[1:], 1):
        out = out.join(m.select("item_id", F.col("vector").alias(f"v{i}")), "item_id")
    return out


def fused(modalities: list[DataFrame]) -> DataFrame:
    """item_id, vector: the aligned vectors one after the other, standardised."""
    a = align(modalities)
    return standardise(a.select("item_id", F.concat(*[doubles(f"v{i}") for i in range(len(modalities))]).alias("vector")))


def weighted_concat(modalities: list[tuple[DataFrame, float]]) -> DataFrame:
    """item_id, vector: unit vectors times their modality's weight, one after the other."""
    a = align([m for m, _ in modalities])
    return a.select("item_id", F.concat(*[F.transform(unit(doubles(f"v{i}")), times(w)) for i, (_, w) in enumerate(modalities)]).alias("vector"))


def principal(rows: DataFrame, k: int, whiten: bool = False) -> DataFrame:
    """item_id, vector: projections of the centred vectors on the leading k axes (each axis with its largest loading positive); whiten: of unit variance."""
    from pyspark.ml.stat import Summarizer
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.feature import PCA

    x = rows.select("item_id", array_to_vector(doubles("vector")).alias("x"))
    model = PCA(k=k, inputCol="x", outputCol="y").fit(x)
    axes = model.pc.toArray()
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    one = x.select(Summarizer.mean(F.col("x")).alias("m"), Summarizer.variance(F.col("x")).alias("v")).first()
    if whiten:
        spread = np.sqrt(np.maximum(model.explainedVariance.toArray() * one["v"].toArray().sum(), 1e-12))
        axes = axes / spread
    shift = one["m"].toArray() @ axes
    cols = [F.array(*[F.lit(float(c)) for c in axes[:, j]]) for j in range(axes.shape[1])]
    v = vector_to_array("x")
    dots = [F.aggregate(F.zip_with(v, c, lambda p, q: p * q), F.lit(-float(s)), lambda a, b: a + b) for c, s in zip(cols, shift, strict=True)]
    return x.select("item_id", F.array(*dots).alias("vector"))


def explained_variance(rows: DataFrame, k: int = 50) -> DataFrame:
    """component, ratio, cumulative."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    x = rows.select(array_to_vector(doubles("vector")).alias("x"))
    first = rows.select(F.size("vector")).first()
    k = min(k, first[0] if first else 1)
    ratio = PCA(k=k, inputCol="x", outputCol="y").fit(x).explainedVariance.toArray()
    return rows.sparkSession.createDataFrame([(i + 1, float(r), float(c)) for i, (r, c) in enumerate(zip(ratio, ratio.cumsum(), strict=True))], "component int, ratio double, cumulative double")


def map2d(rows: DataFrame) -> DataFrame:
    """item_id, x, y: the first two principal components."""
    return principal(rows, 2).select("item_id", F.col("vector")[0].alias("x"), F.col("vector")[1].alias("y"))


def align_groups(rows: DataFrame, group_col: str, least: int = 10) -> DataFrame:
    """rows with the vectors of each group of at least `least` rows brought to the mean and deviation of all rows, then to length 1."""
    cells = rows.select(group_col, F.posexplode(doubles("vector")).alias("i", "x"))
    per = cells.groupBy(group_col, "i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"), F.count(F.lit(1)).alias("n"))
    per = per.filter(F.col("n") >= least).groupBy(group_col).agg(F.sort_array(F.collect_list(F.struct("i", "m", "s"))).alias("own"))
    every = cells.groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).agg(F.sort_array(F.collect_list(F.struct("i", "m", "s"))).alias("all"))
    out = rows.join(per, group_col, "left").crossJoin(F.broadcast(every))
    moved = F.transform(F.arrays_zip(doubles("vector").alias("x"), F.col("own"), F.col("all")), lambda z: (z["x"] - z["own"]["m"]) / (z["own"]["s"] + 1e-12) * z["all"]["s"] + z["all"]["m"])
    return out.withColumn("vector", unit(F.when(F.col("own").isNull(), doubles("vector")).otherwise(moved))).drop("own", "all")


def numbered_by_hash(rows: DataFrame, seed: int, bits: int = 12) -> DataFrame:
    """v, i: the vectors numbered from 0 without gaps in the order of a hash of item_id, in windows over 2^bits ranges of the hash; equal ids by vector."""
    h = F.xxhash64("item_id", F.lit(seed))
    ranged = rows.select("item_id", doubles("vector").alias("v"), h.alias("__h"), F.shiftright(h, 64 - bits).alias("__range"))
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    # one row for each range
    ahead = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__offset"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy("__h", "item_id", "v"))
    return ranged.withColumn("__k", within).join(F.broadcast(offsets), "__range").select("v", (F.col("__k") - 1 + F.col("__offset")).alias("i"))


def pair_cosine_stats(rows: DataFrame, pairs: int = 2000, seed: int = 1337) -> DataFrame:
    """One row over the cosines of about `pairs` pairs: each row meets partners at hash-chosen distances in the order of a hash, so no pair is computed but those."""
    n = rows.count()
    numbered = numbered_by_hash(rows, seed)
    each = max(1, -(-pairs // max(1, n)))
    take = min(n, pairs)
    left = numbered.filter(F.col("i") < take).select("i", F.col("v").alias("a"), F.explode(F.sequence(F.lit(1), F.lit(each))).alias("step"))
    left = left.withColumn("j", F.pmod(F.col("i") + 1 + F.pmod(F.xxhash64("i", "step"), F.lit(max(1, n - 1))), F.lit(n)))
    x = left.join(numbered.select(F.col("i").alias("j"), F.col("v").alias("b")), "j").filter("i <> j").select(cosine("a", "b").alias("s"))
    return cosine_summary(x)


def cosine_summary(x: DataFrame) -> DataFrame:
    q = F.percentile("s", F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99)))
    return x.agg(F.count("s").alias("pairs"), F.min("s").alias("cos_min"), F.max("s").alias("cos_max"), F.avg("s").alias("cos_mean"), F.stddev_pop("s").alias("cos_std"), q.alias("q")).select("pairs", "cos_min", "cos_max", "cos_mean", "cos_std", *[F.col("q")[i].alias(n) for i, n in enumerate(("cos_p01", "cos_p50", "cos_p99"))])


def dim_histogram(rows: DataFrame, vector: str = "vector") -> DataFrame:
    return rows.groupBy(F.size(vector).cast("long").alias("dim")).agg(F.count(F.lit(1)).alias("n"))


def modal_dim(rows: DataFrame, vector: str = "vector") -> int:
    first = dim_histogram(rows.filter(F.col(vector).isNotNull()), vector).filter("dim > 0").orderBy(F.desc("n"), "dim").first()
    if first is None:
        raise ValueError("no valid vectors")
    return int(first[0])


def duplicate_vectors(rows: DataFrame, digits: int = 4) -> DataFrame:
    """One row: n, duplicate_frac: 1 - distinct rounded vectors / rows."""
    r = rows.select(F.transform(doubles("vector"), lambda x: F.round(x, digits)).alias("v"))
    return r.agg(F.count(F.lit(1)).alias("n"), (1 - F.count_distinct("v") / F.count(F.lit(1))).alias("duplicate_frac"))


def norms(rows: DataFrame) -> DataFrame:
    return rows.select("item_id", norm(doubles("vector")).alias("norm"))
