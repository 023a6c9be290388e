"""Clusters: composition, purity, entropy, names, centroids, metrics, KMeans, sweep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.vectors import doubles, dot, norm, unit


def composition(clusters: DataFrame, items: DataFrame, label_col: str = "label") -> DataFrame:
    """cluster_id, label, n_items, frac. Items without a label count under ''."""
    joined = clusters.select("item_id", "cluster_id").join(items.select("item_id", F.col(label_col).alias("label")), "item_id", "left")
    counts = joined.groupBy("cluster_id", F.coalesce("label", F.lit("")).alias("label")).agg(F.count(F.lit(1)).alias("n_items"))
    return counts.withColumn("frac", F.col("n_items") / F.sum("n_items").over(Window.partitionBy("cluster_id")))


def ranked(comp: DataFrame) -> DataFrame:
    """Labels of a cluster in order: most items first, then by name."""
    return comp.withColumn("rank", F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("n_items"), "label")))


def dominant_label(comp: DataFrame, noise: int | None = -1) -> DataFrame:
    """cluster_id, n_items, dominant_label, dominant_frac; noise is left out; nothing but noise gives no rows."""
    per = comp if noise is None else comp.filter(F.col("cluster_id") != noise)
    first = ranked(per).filter("rank = 1").select("cluster_id", F.col("label").alias("dominant_label"), F.col("frac").alias("dominant_frac"))
    return per.groupBy("cluster_id").agg(F.sum("n_items").alias("n_items")).join(first, "cluster_id")


def purity(comp: DataFrame, noise: int | None = -1) -> DataFrame:
    """One row: items in their cluster's largest label over all items (null without clusters)."""
    per = comp if noise is None else comp.filter(F.col("cluster_id") != noise)
    each = per.groupBy("cluster_id").agg(F.max("n_items").alias("top"), F.sum("n_items").alias("n"))
    return each.agg((F.sum("top") / F.sum("n")).alias("purity"))


def purity_entropy(comp: DataFrame, base: float | None = None) -> DataFrame:
    """cluster_id, n_items, purity, entropy (natural, or of the base)."""
    term = F.col("frac") * F.ln("frac") / (1.0 if base is None else F.ln(F.lit(float(base))))
    return comp.groupBy("cluster_id").agg(F.sum("n_items").alias("n_items"), F.max("frac").alias("purity"), F.sum(-term).alias("entropy"))


def crosstab(comp: DataFrame, normalise: bool = False) -> DataFrame:
    """label, cluster_id, value for every pair, zeros too; normalise: shares of the label's row. Long form, so the number of clusters is no number of columns."""
    grid = comp.select("label").distinct().crossJoin(F.broadcast(comp.select("cluster_id").distinct()))  # labels x clusters, the table's own size
    full = grid.join(comp.select("label", "cluster_id", "n_items"), ["label", "cluster_id"], "left").withColumn("value", F.coalesce("n_items", F.lit(0)))
    if normalise:
        total = F.sum("value").over(Window.partitionBy("label"))
        full = full.withColumn("value", F.when(total > 0, F.col("value") / total).otherwise(F.lit(0.0)))
    return full.select("label", "cluster_id", "value")


def top_labels(comp: DataFrame, k: int = 5, names: DataFrame | None = None) -> DataFrame:
    """cluster_id, dominant_labels: array of (label, label_name, count, frac), most items first. names: label, label_name."""
    top = ranked(comp).filter(F.col("rank") <= k)
    if names is None:
        top = top.withColumn("label_name", F.col("label"))
    else:
        top = top.join(names.select("label", F.col("label_name").alias("given")), "label", "left").withColumn("label_name", F.coalesce("given", "label"))
    each = F.sort_array(F.collect_list(F.struct("rank", "label", "label_name", F.col("n_items").alias("count"), "frac")))
    return top.groupBy("cluster_id").agg(F.transform(each, lambda x: x.dropFields("rank")).alias("dominant_labels"))


def name_by_composition(comp: DataFrame, least_frac: float = 0.10, noise: int = -1, names: DataFrame | None = None) -> DataFrame:
    """cluster_id, n_items, purity, entropy, cluster_name: the two largest labels of at least least_frac, '(mixed)' without any."""
    top = ranked(comp).filter("rank <= 2").filter((F.col("frac") >= least_frac) & (F.col("label") != ""))
    if names is not None:
        top = top.join(names.select("label", F.col("label_name").alias("given")), "label", "left")
        pretty = F.when(F.col("given").isNotNull() & (F.col("given") != F.col("label")), F.concat("given", F.lit(" ("), "label", F.lit(")"))).otherwise(F.col("label"))
    else:
        pretty = F.col("label")
    parts = top.groupBy("cluster_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", pretty.alias("name")))), lambda x: x["name"]).alias("parts"))
    out = purity_entropy(comp).join(parts, "cluster_id", "left")
    body = F.when(F.col("parts").isNull(), F.lit("(mixed)")).otherwise(F.array_join("parts", " + "))
    name = F.when(F.col("cluster_id") == noise, F.lit("Noise / outliers")).otherwise(F.concat(F.lit("C"), F.col("cluster_id").cast("string"), F.lit(": "), body))
    return out.select("cluster_id", "n_items", "purity", "entropy", name.alias("cluster_name"))


def topic_names(comp: DataFrame, dominant: float = 0.75) -> DataFrame:
    """cluster_id, n, purity, name_short: "X dominant" from a share of `dominant` on or with one label, else "X + Y mix"."""
    per = comp.groupBy("cluster_id").agg(F.sum("n_items").alias("n"))
    pick = lambda r, c: F.max(F.when(F.col("rank") == r, F.col(c)))
    top = ranked(comp).filter("rank <= 2").groupBy("cluster_id").agg(pick(1, "label").alias("a"), pick(2, "label").alias("b"), pick(1, "frac").alias("purity"))
    topic = F.when((F.col("purity") >= dominant) | F.col("b").isNull(), F.concat("a", F.lit(" dominant"))).otherwise(F.concat("a", F.lit(" + "), "b", F.lit(" mix")))
    return per.join(top, "cluster_id").select("cluster_id", "n", "purity", F.concat(topic, F.lit(" · n="), F.col("n").cast("string")).alias("name_short"))


def centroids(members: DataFrame, key: str = "cluster_id", vector: str = "vector", normalise: bool = False) -> DataFrame:
    """key, n_items, vector: element-wise mean (normalise: of unit vectors, brought to length 1 again). Partial sums before the shuffle."""
    v = doubles(vector)
    v = unit(v) if normalise else v
    cells = members.select(key, F.posexplode(v).alias("i", "x")).groupBy(key, "i").agg(F.avg("x").alias("m"))
    mean = cells.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda c: c["m"]).alias("vector"))
    if normalise:
        mean = mean.withColumn("vector", unit("vector", add_eps=True))
    return members.groupBy(key).agg(F.count(F.lit(1)).alias("n_items")).join(mean, key)


def grouping_anchors(members: DataFrame, wide: str, narrow: str, vector: str = "vector", least: int = 25) -> DataFrame:
    """kind, wide, narrow, n_items, vector: mean vectors of each `wide` group, and of each pair and `narrow` group of at least `least` items: grouping sets in one pass."""
    cells = members.select(wide, narrow, F.posexplode(doubles(vector)).alias("i", "x"))
    cells.createOrReplaceTempView("__anchor_cells")
    sets = members.sparkSession.sql(
        f"SELECT `{wide}` AS wide, `{narrow}` AS narrow, i, avg(x) AS m, count(*) AS n, grouping(`{wide}`) AS gw, grouping(`{narrow}`) AS gn FROM __anchor_cells"
        f" GROUP BY GROUPING SETS ((`{wide}`, i), (`{wide}`, `{narrow}`, i), (`{narrow}`, i))"
    )
    kind = F.when((F.col("gw") == 0) & (F.col("gn") == 1), "wide").when(F.col("gw") == 1, "narrow").otherwise("pair")
    sets = sets.withColumn("kind", kind).filter((F.col("kind") == "wide") | (F.col("n") >= least))
    return sets.groupBy("kind", "wide", "narrow").agg(F.max("n").alias("n_items"), F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda c: c["m"]).alias("vector"))


def gini(clusters: DataFrame, noise: int = -1) -> DataFrame:
    """One row: Gini coefficient of the cluster sizes, noise left out."""
    sizes = clusters.filter(F.col("cluster_id") != noise).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    i = F.row_number().over(Window.orderBy("n", "cluster_id"))  # one row for each cluster
    k = sizes.withColumn("i", i)
    total = k.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"))
    return k.crossJoin(F.broadcast(total)).agg((F.sum((2 * F.col("i") - F.col("k") - 1) * F.col("n")) / (F.max("k") * F.max("s") + 1e-12)).alias("gini"))


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda p, q: p + q))


def silhouette(members: DataFrame, block_rows: int = 2048) -> DataFrame:
    """item_id, cluster_id, silhouette by exact euclidean distances: all pairs in blocks of vectors with numpy, sums for each item and cluster only."""
    import numpy as np
    import pyarrow as pa

    from orrery.operators.knn import blocks, paired

    sizes = members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    tagged = members.select("item_id", "cluster_id", doubles("vector").alias("vector"))
    packed = blocks(tagged, block_rows, extra="cluster_id")

    def sums(batches):
        """Blocks that follow one another with the same left block are summed before they leave."""
        number, ids, own, held = None, None, None, {}

        def left_over():
            for c, total in held.items():
                yield pa.RecordBatch.from_arrays([ids, own, pa.array(np.full(len(ids), c)), pa.array(total)], names=["item_id", "cluster_id", "other", "total"])

        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c: batch.column(batch.schema.get_field_index(c))[r]  # noqa: B023, E731
                a, b = (np.frombuffer(get(c).as_py(), np.float64).reshape(get("n_" + c[-1]).as_py(), -1) for c in ("matrix_l", "matrix_r"))
                if number != get("block_l").as_py():
                    yield from left_over()
                    number, ids, own, held = get("block_l").as_py(), get("ids_l").values, get("extra_l").values, {}
                groups, inverse = np.unique(get("extra_r").values.to_numpy(), return_inverse=True)
                order = np.argsort(inverse, kind="stable")
                cuts, b = np.searchsorted(inverse[order], np.arange(len(groups))), b[order]
                square = (b**2).sum(1)
                total = np.empty((len(a), len(groups)))
                for lo in range(0, len(a), 512):
                    part = a[lo : lo + 512]
                    far = part @ b.T
                    far *= -2
                    far += (part**2).sum(1)[:, None]
                    far += square
                    np.maximum(far, 0, out=far)
                    np.sqrt(far, out=far)
                    total[lo : lo + 512] = np.add.reduceat(far, cuts, axis=1)
                for g, c in enumerate(groups.tolist()):
                    held[c] = held[c] + total[:, g] if c in held else total[:, g]
        yield from left_over()

    kind = members.schema["item_id"].dataType.simpleString()
    each = paired(packed).mapInArrow(sums, f"item_id {kind}, cluster_id long, other long, total double").groupBy("item_id", "cluster_id", "other").agg(F.sum("total").alias("total"))
    mean = each.join(F.broadcast(sizes.select(F.col("cluster_id").cast("long").alias("other"), "size")), "other")
    own = F.col("other") == F.col("cluster_id")
    mean = mean.withColumn("mean", F.when(own, F.when(F.col("size") > 1, F.col("total") / (F.col("size") - 1))).otherwise(F.col("total") / F.col("size")))
    per = mean.groupBy("item_id", "cluster_id").agg(F.max(F.when(own, F.col("mean"))).alias("a"), F.min(F.when(~own, F.col("mean"))).alias("b"))
    value = F.when(F.col("a").isNull(), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return per.select("item_id", "cluster_id", value.alias("silhouette"))


def davies_bouldin(members: DataFrame) -> DataFrame:
    """One row: mean over clusters of the worst (spread + spread) / centroid distance."""
    c = centroids(members).select("cluster_id", F.col("vector").alias("centre"))
    spread = members.join(c, "cluster_id").groupBy("cluster_id").agg(F.avg(_distance(doubles("vector"), F.col("centre"))).alias("s"))
    s = spread.join(c, "cluster_id")
    left, right = (s.select(*[F.col(x).alias(f"{side}_{x}") for x in s.columns]) for side in "ab")
    pairs = left.crossJoin(right).filter("a_cluster_id <> b_cluster_id")  # clusters against clusters
    worst = pairs.groupBy("a_cluster_id").agg(F.max((F.col("a_s") + F.col("b_s")) / _distance(F.col("a_centre"), F.col("b_centre"))).alias("w"))
    return worst.agg(F.avg("w").alias("davies_bouldin"))


def calinski_harabasz(members: DataFrame) -> DataFrame:
    """One row: between-cluster over within-cluster dispersion, each by its degrees of freedom; from sums of coordinates alone."""
    x = members.select("cluster_id", F.posexplode(doubles("vector")).alias("i", "x"))
    per = x.groupBy("cluster_id", "i").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.count(F.lit(1)).alias("n"))
    cells = per.groupBy("i").agg(F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"), F.sum("s").alias("t"), F.sum("q").alias("q"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    t = cells.agg(F.sum("b").alias("b"), F.sum(F.col("t") * F.col("t") / F.col("n")).alias("g"), F.sum("q").alias("q"), F.max("n").alias("n"), F.max("k").alias("k"))
    return t.select((((F.col("b") - F.col("g")) / (F.col("k") - 1)) / ((F.col("q") - F.col("b")) / (F.col("n") - F.col("k")))).alias("calinski_harabasz"))


def score(noise: Column, purity_: Column, silhouette_: Column, db: Column) -> Column:
    """(1 - noise) * purity * max(0, silhouette) / (1 + max(0, davies_bouldin)); NaN and null count as 0."""
    z = lambda c: F.coalesce(F.nanvl(c.cast("double"), F.lit(0.0)), F.lit(0.0))
    return (1 - z(noise)) * z(purity_) * F.greatest(F.lit(0.0), z(silhouette_)) / (1 + F.greatest(F.lit(0.0), z(db)))


def best_run(runs: DataFrame, most_noise: float = 0.40) -> DataFrame:
    """The run to take: of low enough noise first, then by score, then the first one. runs: run_idx, noise_ratio, score."""
    return runs.withColumn("eligible", F.coalesce(F.col("noise_ratio") <= most_noise, F.lit(False))).orderBy(F.desc("eligible"), F.desc("score"), "run_idx").limit(1)


def kmeans(members: DataFrame, k: int, seed: int = 1337, normalise: bool = False) -> DataFrame:
    """item_id, cluster_id by Spark's KMeans."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = unit(doubles("vector")) if normalise else doubles("vector")
    x = members.select("item_id", array_to_vector(v).alias("features"))
    return KMeans(k=k, seed=seed).fit(x).transform(x).select("item_id", F.col("prediction").alias("cluster_id"))


def evaluate(members: DataFrame, comp: DataFrame, noise: int = -1) -> DataFrame:
    """One row: noise_ratio, n_clusters, silhouette, davies_bouldin, purity, score."""
    real = members.filter(F.col("cluster_id") != noise)
    parts = members.agg(F.avg((F.col("cluster_id") == noise).cast("double")).alias("noise_ratio"), F.count_distinct(F.when(F.col("cluster_id") != noise, F.col("cluster_id"))).alias("n_clusters"))
    parts = parts.crossJoin(silhouette(real).agg(F.avg("silhouette").alias("silhouette"))).crossJoin(davies_bouldin(real)).crossJoin(purity(comp, noise))  # single rows
    return parts.withColumn("score", score(F.col("noise_ratio"), F.col("purity"), F.col("silhouette"), F.col("davies_bouldin")))


def sweep(members: DataFrame, labels: DataFrame, ks: list[int], seeds: list[int]) -> DataFrame:
    """A row of evaluate() for each KMeans setting: run_idx, k, seed and the figures."""
    from functools import reduce

    rows = []
    for i, (k, seed) in enumerate((k, s) for k in ks for s in seeds):
        found = kmeans(members, k, seed)
        made = members.drop("cluster_id").join(found, "item_id")
        rows.append(evaluate(made, composition(found, labels)).select(F.lit(i).alias("run_idx"), F.lit(k).alias("k"), F.lit(seed).alias("seed"), "*"))
    return reduce(DataFrame.unionByName, rows)


def density_sweep(members: DataFrame, labels: DataFrame, dims: list[int], neighbours: list[int], min_cluster_sizes: list[int], min_samples: list[int], cut: float | None = None, levels: int = 16) -> DataFrame:
    """A row of evaluate() for each setting of projection and density: run_idx, dims, neighbours, min_cluster_size, min_samples and the figures; best_run takes its choice from them.

    Clusters are the flat cut at `cut`, or without one the most stable of the hierarchy at `levels` cuts. Vectors are projected once for each number of dimensions.
    """
    from itertools import product

    from orrery.operators.density import density_clusters, stable_clusters
    from orrery.operators.embed import principal
    from orrery.sources.io import ensure_checkpoint_dir

    spark = members.sparkSession
    ensure_checkpoint_dir(spark)
    projected = {d: principal(members, d).checkpoint() for d in dims}
    rows, schema = [], None
    for i, (d, k, size, samples) in enumerate(product(dims, neighbours, min_cluster_sizes, min_samples)):
        found = stable_clusters(projected[d], samples, size, k, levels) if cut is None else density_clusters(projected[d], cut, samples, size, k)
        found = found.checkpoint()
        one = evaluate(projected[d].join(found, "item_id"), composition(found, labels))
        schema = "run_idx int, dims int, neighbours int, min_cluster_size int, min_samples int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in one.schema)
        rows.append((i, d, k, size, samples, *one.first()))  # a row for each setting
    return spark.createDataFrame(rows, schema)


def nearest_clusters(cents: DataFrame, cluster_id: int, k: int = 10) -> DataFrame:
    """cluster_id, similarity of the k clusters next to one, itself included."""
    one = cents.filter(F.col("cluster_id") == cluster_id).select(unit("vector").alias("v"))
    return cents.crossJoin(F.broadcast(one)).select("cluster_id", dot(unit("vector"), F.col("v")).alias("similarity")).orderBy(F.desc("similarity"), "cluster_id").limit(k)


def norms_of(cents: DataFrame) -> DataFrame:
    return cents.select("cluster_id", norm("vector").alias("norm"))
