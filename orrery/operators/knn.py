"""Exact k nearest neighbours by cosine, in blocks of vectors; a join by random projections, where they save work."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.vectors import doubles, unit

#: Rows of a block: 2048 vectors of 512 doubles are 8 MB.
BLOCK_ROWS = 2048


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS, extra: str | None = None, n_blocks: int | None = None) -> DataFrame:
    """block, n, ids, matrix (row-major doubles), extra: the vectors of `item_id, vector` packed by a hash of the id."""
    count = n_blocks or max(1, -(-rows.count() // block_rows))
    kind = rows.schema["item_id"].dataType.simpleString()
    keep = [F.col(extra).cast("long").alias("extra")] if extra else [F.lit(0).cast("long").alias("extra")]
    spread = rows.select("item_id", doubles("vector").alias("vector"), *keep, F.pmod(F.xxhash64("item_id"), F.lit(count)).cast("int").alias("block"))
    spread = spread.repartition("block").sortWithinPartitions("block", "item_id")

    def pack(batches):
        from collections import defaultdict

        held: dict[int, list] = defaultdict(list)
        for batch in batches:
            block = batch.column(3).to_numpy()
            for b in np.unique(block):
                held[int(b)].append(batch.filter(pa.array(block == b)))
        for b, parts in held.items():
            whole = pa.Table.from_batches(parts).combine_chunks()
            sizes = whole.column("vector").combine_chunks().value_lengths()
            # a matrix has rows of one length
            for t in [whole.filter(pa.compute.equal(sizes, d)).combine_chunks() for d in sizes.unique()]:
                column = lambda c: t.column(c).combine_chunks()  # noqa: B023, E731
                m = column("vector").flatten().to_numpy()
                one = pa.array([0, t.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([t.num_rows]), pa.ListArray.from_arrays(one, column("item_id")), pa.array([m.tobytes()], pa.binary()), pa.ListArray.from_arrays(one, column("extra"))],
                    names=["block", "n", "ids", "matrix", "extra"],
                )

    return spread.mapInArrow(pack, f"block int, n long, ids array<{kind}>, matrix binary, extra array<long>")


def paired(left: DataFrame, right: DataFrame | None = None) -> DataFrame:
    """Each left block beside each right block.

    Blocks lie on a grid of about the square root of their number: a left block goes to the cells of its row, a right one to those of its column, and a cell
    joins what it has. So each vector is sent that many times, not once for each block of the other side; a cell's blocks are streamed and may spill.
    """
    right = left if right is None else right
    side = right.agg(F.greatest(F.lit(1), F.ceil(F.sqrt(F.max("block") + 1)).cast("int")).alias("__side"))  # one row
    cells = F.sequence(F.lit(0), F.col("__side") - 1)
    a = left.select(*[F.col(c).alias(f"{c}_l") for c in left.columns]).crossJoin(F.broadcast(side))
    a = a.withColumns({"__row": F.pmod("block_l", "__side"), "__column": F.explode(cells)}).drop("__side")
    b = right.select(*[F.col(c).alias(f"{c}_r") for c in right.columns]).crossJoin(F.broadcast(side))
    b = b.withColumns({"__row": F.explode(cells), "__column": F.pmod("block_r", "__side")}).drop("__side")
    return a.hint("merge").join(b, ["__row", "__column"]).drop("__row", "__column")


def knn_join(queries: DataFrame, base: DataFrame | None = None, k: int = 5, min_sim: float | None = None, block_rows: int = BLOCK_ROWS, digits: int = 6) -> DataFrame:
    """src, dst, rank, sim: the k most similar of base for each query (cosine rounded to digits; ties by dst), itself left out; then those of at least min_sim.

    Both sides are packed into blocks; each pair of blocks is one matrix product, which leaves at most k candidates for each query, and the
    candidates of all blocks meet in a window. Nothing is broadcast but the side of the grid. Zero vectors are similar to nothing (0).
    """
    q = queries.select("item_id", unit(doubles("vector")).alias("vector"))
    packed = blocks(q, block_rows)
    other = packed if base is None else blocks(base.select("item_id", unit(doubles("vector")).alias("vector")), block_rows)

    def best(batches):
        """Blocks that follow one another with the same left block share its k-th values: what lies below is left out at once."""
        number, top, held = None, None, []
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c: batch.column(batch.schema.get_field_index(c))[r]  # noqa: B023, E731
                a = np.frombuffer(get("matrix_l").as_py(), np.float64).reshape(get("n_l").as_py(), -1)
                b = np.frombuffer(get("matrix_r").as_py(), np.float64).reshape(get("n_r").as_py(), -1)
                src, dst = get("ids_l").values, get("ids_r").values
                if number != get("block_l").as_py():
                    yield from left_over(held, top)
                    number, top, held = get("block_l").as_py(), np.full((len(a), k), -np.inf), []
                order = pa.compute.sort_indices(dst)  # so that ties are by dst
                dst, b = dst.take(order), b[order.to_numpy()]
                own = np.flatnonzero(pa.compute.is_in(src, value_set=dst).to_numpy(zero_copy_only=False))
                lost = np.isnan(a).any() or np.isnan(b).any()
                for lo in range(0, len(a), 512):
                    sim = a[lo : lo + 512] @ b.T
                    if lost:
                        sim[np.isnan(sim)] = -np.inf
                    for i in own[(own >= lo) & (own < lo + 512)]:
                        sim[i - lo, pa.compute.equal(dst, src[i]).to_numpy(zero_copy_only=False)] = -np.inf
                    least = top[lo : lo + 512, -1]
                    if k < len(b) and np.isneginf(least).any():
                        least = np.maximum(least, np.partition(sim, -k, axis=1)[:, -k])
                    # rounding may bring a value up to the k-th one
                    row, column = np.divmod(np.flatnonzero(sim >= (least - 10.0**-digits)[:, None]), len(b))
                    value = np.round(sim[row, column], digits) + 0.0
                    real = np.isfinite(value)
                    row, column, value = row[real], column[real], value[real]
                    by = np.lexsort((column, -value, row))
                    row, column, value = row[by], column[by], value[by]
                    place = np.arange(len(row)) - np.searchsorted(row, row)
                    first = place < k
                    row, column, value, place = row[first], column[first], value[first], place[first]
                    if len(row):
                        hit, at = np.unique(row, return_inverse=True)
                        more = np.full((len(hit), k), -np.inf)
                        more[at, place] = value
                        top[lo + hit] = -np.sort(-np.concatenate([top[lo + hit], more], 1), axis=1)[:, :k]
                        held.append((lo + row, src.take(pa.array(lo + row)), dst.take(pa.array(column)), value))
        yield from left_over(held, top)

    def left_over(held, top):
        for row, src, dst, value in held:
            keep = value >= top[row, -1]
            if keep.any():
                yield pa.RecordBatch.from_arrays([src.filter(pa.array(keep)), dst.filter(pa.array(keep)), pa.array(value[keep])], names=["src", "dst", "sim"])

    kind = queries.schema["item_id"].dataType.simpleString()
    found = paired(packed, other).mapInArrow(best, f"src {kind}, dst {kind}, sim double")
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst"))
    out = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    out = out if min_sim is None else out.filter(F.col("sim") >= min_sim)
    return out.select("src", "dst", "rank", "sim")


#: Pairs of a matrix product that cost about as much as a pair that meets in a join of buckets.
PAIR_COST = 50


def approximate_join(rows: DataFrame, min_sim: float, tables: int = 8, bucket: float = 0.6, seed: int = 1337) -> DataFrame:
    """src, dst, sim (src < dst) of pairs of at least min_sim that share a bucket of random projections of the unit vectors: misses some.

    Buckets that hold too many pairs to save work (counted first: over 1 / PAIR_COST of all) are not joined; all pairs meet in matrix products then, and none is missed.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    from orrery.operators.pairs import similar

    x = rows.filter("item_id IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL) AND exists(vector, x -> x <> 0)").select("item_id", array_to_vector(unit(doubles("vector"))).alias("features"))
    if x.isEmpty():
        return similar(rows, min_sim)
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket, numHashTables=tables, seed=seed).fit(x)
    sizes = model.transform(x).select(F.posexplode("hashes")).groupBy("pos", "col").agg(F.count(F.lit(1)).alias("n"))
    meet, n = sizes.agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1)), F.sum("n") / tables).first()
    if min_sim <= 0 or meet * PAIR_COST > n * (n - 1):
        return similar(rows, min_sim)
    far = (2 - 2 * min_sim) ** 0.5
    pairs = model.approxSimilarityJoin(x, x, far, "d").filter("datasetA.item_id < datasetB.item_id")
    return pairs.select(F.col("datasetA.item_id").alias("src"), F.col("datasetB.item_id").alias("dst"), (1 - F.col("d") * F.col("d") / 2).alias("sim"))


def candidate_pairs(centroids: DataFrame, k: int = 5, min_sim: float = 0.3) -> DataFrame:
    """src_cluster_id, dst_cluster_id, similarity: the k nearest centroids of each, then those of at least min_sim."""
    named = centroids.select(F.col("cluster_id").cast("long").alias("item_id"), "vector")
    found = knn_join(named, k=k, min_sim=min_sim)
    return found.select(F.col("src").cast("int").alias("src_cluster_id"), F.col("dst").cast("int").alias("dst_cluster_id"), F.col("sim").alias("similarity"))


def distance_stats(knn: DataFrame) -> DataFrame:
    """One row over the neighbours' cosine distances."""
    x = knn.select((1 - F.col("sim")).alias("x"))
    q = F.percentile("x", F.array(F.lit(0.5), F.lit(0.95)))
    return x.agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), q.alias("q")).select("n", "mean", "std", F.col("q")[0].alias("p50"), F.col("q")[1].alias("p95"))


def within_label_rate(knn: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: mean over sources of the share of their neighbours with the same label. labels: item_id, label."""
    a, b = (labels.select(F.col("item_id").alias(side), F.col("label").alias(f"{side}_label")) for side in ("src", "dst"))
    each = knn.join(a, "src").join(b, "dst").groupBy("src").agg(F.avg((F.col("src_label") == F.col("dst_label")).cast("double")).alias("r"))
    return each.agg(F.avg("r").alias("within_label_rate"), F.count(F.lit(1)).alias("n_src"))


def wide(knn: DataFrame, k: int) -> DataFrame:
    """item_id, nn1.., nn_dist1..: one row for each source."""
    ranks = list(range(1, k + 1))
    pick = lambda r, c: F.max(F.when(F.col("rank") == r, c))
    return knn.groupBy(F.col("src").alias("item_id")).agg(*[pick(r, F.col("dst")).alias(f"nn{r}") for r in ranks], *[pick(r, 1 - F.col("sim")).alias(f"nn_dist{r}") for r in ranks])


def neighbours_json(knn: DataFrame, top: int = 5) -> DataFrame:
    """item_id, neighbors_json: [{id, dist, weight = exp(-dist)}], nearest first."""
    rows = knn.filter(F.col("rank") <= top).withColumn("dist", F.round(1 - F.col("sim"), 6))
    each = F.sort_array(F.collect_list(F.struct("rank", F.col("dst").alias("id"), "dist", F.round(F.exp(-F.col("dist")), 6).alias("weight"))))
    return rows.groupBy(F.col("src").alias("item_id")).agg(F.to_json(F.transform(each, lambda x: x.dropFields("rank"))).alias("neighbors_json"))
