"""Density-based clusters over a neighbour graph: a flat cut of the mutual-reachability hierarchy, or its most stable clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.graph import components
from orrery.operators.knn import knn_join
from orrery.sources.io import ensure_checkpoint_dir


def reachability(rows: DataFrame, min_samples: int = 5, neighbours: int = 15) -> DataFrame:
    """src, dst, reach: edges of the neighbour graph with the mutual reachability max(core(src), core(dst), distance).

    Distances are euclidean between unit vectors; a core distance is that to the min_samples-th neighbour.
    """
    near = knn_join(rows, k=max(neighbours, min_samples)).withColumn("d", F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("sim"))))
    core = near.filter(F.col("rank") == min_samples).select(F.col("src").alias("node"), F.col("d").alias("core"))
    out = near.filter(F.col("rank") <= neighbours).select("src", "dst", "d")
    for side in ("src", "dst"):
        out = out.join(core.select(F.col("node").alias(side), F.col("core").alias(f"{side}_core")), side)
    return out.select("src", "dst", F.greatest("d", "src_core", "dst_core").alias("reach"))


def density_clusters(rows: DataFrame, cut: float, min_samples: int = 5, min_cluster_size: int = 5, neighbours: int = 15) -> DataFrame:
    """item_id, cluster_id: components of the edges of reachability at most `cut`; those of fewer than min_cluster_size items are noise (-1). Clusters are numbered by size, then by their least item."""
    edges = reachability(rows, min_samples, neighbours).filter(F.col("reach") <= cut)
    comp = components(edges.select("src", "dst"), rows.select(F.col("item_id").alias("node")))
    sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_cluster_size)
    numbered = sizes.withColumn("cluster_id", F.row_number().over(Window.orderBy(F.desc("n"), "component")) - 1)
    return comp.join(numbered, "component", "left").select(F.col("node").alias("item_id"), F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"))


def hierarchy(edges: DataFrame, nodes: DataFrame, cuts: list[float], min_cluster_size: int) -> list[DataFrame]:
    """For each cut, ascending: comp, parent (its component at the next cut, itself at the last), size, held and below.

    The components of a cut are made of those of the cut before, so each edge is looked at once. `held` is the stability that a cluster has gathered
    from its finest cut up to this one: the sum, over cuts, of its items times the step of 1 / cut. `below` is the best sum of stabilities of clusters
    that it falls apart into, 0 for one that does not. Both are null for components of fewer than min_cluster_size items.
    """
    now = nodes.select(F.col("node").alias("comp"), F.lit(1).cast("long").alias("size"), F.lit(None).cast("double").alias("held"), F.lit(None).cast("double").alias("below")).checkpoint()
    left, found = edges.select("src", "dst", "reach").checkpoint(), []
    for i, cut in enumerate(cuts):
        merged = components(left.filter(F.col("reach") <= cut).select("src", "dst"), now.select(F.col("comp").alias("node"))).checkpoint()
        up = now.join(merged.withColumnsRenamed({"node": "comp", "component": "parent"}), "comp")
        if i:
            found.append(up)
        step = 1 / cut - (1 / cuts[i + 1] if i + 1 < len(cuts) else 0.0)
        kids = F.count("held")  # parts that are clusters themselves
        per = up.groupBy(F.col("parent").alias("comp")).agg(
            F.sum("size").alias("size"), kids.alias("kids"), F.max("held").alias("h"), F.max("below").alias("b"), F.sum(F.greatest("held", "below")).alias("best")
        )
        big = F.col("size") >= min_cluster_size
        held = F.col("size") * F.lit(step) + F.when(F.col("kids") == 1, F.col("h")).otherwise(0.0)
        below = F.when(F.col("kids") == 1, F.col("b")).when(F.col("kids") > 1, F.col("best")).otherwise(0.0)
        now = per.select("comp", "size", F.when(big, held).alias("held"), F.when(big, below).alias("below")).checkpoint()
        for side in ("src", "dst"):
            left = left.join(merged.select(F.col("node").alias(side), F.col("component").alias(f"{side}_c")), side).drop(side).withColumnRenamed(f"{side}_c", side)
        left = left.filter("src <> dst").checkpoint()
    return [*found, now.withColumn("parent", F.col("comp"))]


def stable_clusters(rows: DataFrame, min_samples: int = 5, min_cluster_size: int = 5, neighbours: int = 15, levels: int = 16, allow_single: bool = False) -> DataFrame:
    """item_id, cluster_id: the clusters of the reachability hierarchy with the largest sum of stabilities (excess of mass); items in none are noise (-1).

    The hierarchy is looked at in `levels` cuts at even shares of the edges' reachabilities, the largest included; with a cut for each different reachability it is
    the whole one. A cluster is born where its parent falls apart into two or more of at least min_cluster_size items, and lives as long as it does not
    itself; it is taken if it is as stable as the best of what it falls apart into. Its items are those it was born with. What is one component at the last cut is
    taken only if allow_single. Clusters are numbered by size, then by their least item. Each cut is a few joins on components; nothing is collected but the cuts.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    edges = reachability(rows, min_samples, neighbours).checkpoint()
    shares = [(i + 1) / levels for i in range(levels)]
    cuts = edges.agg(F.percentile_approx("reach", F.array(*[F.lit(x) for x in shares]), 100_000)).first()[0] or []
    return stable_in(edges, rows.select(F.col("item_id").alias("node")), sorted({max(c, 1e-9) for c in cuts}), min_cluster_size, allow_single)


def stable_in(edges: DataFrame, nodes: DataFrame, cuts: list[float], min_cluster_size: int, allow_single: bool = False) -> DataFrame:
    """stable_clusters over edges src, dst, reach and the cuts given, ascending."""
    levels = hierarchy(edges, nodes, cuts, min_cluster_size) if cuts else []
    top = None
    for depth, level in enumerate(reversed(levels)):
        if top is None:  # the last cut: its components have no parent in common but the root
            rivals = level.agg(F.count("held").alias("rivals"))  # one row
            born = level.crossJoin(F.broadcast(rivals)).withColumn("label", F.lit(None).cast(nodes.schema["node"].dataType)).withColumn("fresh", (F.col("rivals") > 1) | F.lit(allow_single))
        else:
            kids = level.groupBy("parent").agg(F.count("held").alias("rivals"))
            born = level.join(kids, "parent").join(top.select(F.col("comp").alias("parent"), "label"), "parent").withColumn("fresh", F.col("rivals") > 1)
        taken = F.col("fresh") & F.col("label").isNull() & F.col("held").isNotNull() & (F.col("held") >= F.col("below"))
        top = born.select("comp", F.when(taken, F.col("comp")).otherwise(F.col("label")).alias("label"))
        top = top.checkpoint() if depth % 4 == 3 else top
    if top is None:
        return nodes.select(F.col("node").alias("item_id"), F.lit(-1).alias("cluster_id"))
    first = components(edges.filter(F.col("reach") <= cuts[0]).select("src", "dst"), nodes)
    placed = first.join(top.withColumnRenamed("comp", "component"), "component", "left").select(F.col("node").alias("item_id"), "label")
    sizes = placed.filter("label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("least"))
    return placed.join(codes_by_size(sizes), "label", "left").select("item_id", F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"))


def codes_by_size(sizes: DataFrame) -> DataFrame:
    """label, cluster_id: numbers from 0, the largest first, then by the least item."""
    ordered = F.row_number().over(Window.orderBy(F.desc("n"), "least"))  # a row for each cluster
    return sizes.select("label", (ordered - 1).alias("cluster_id"))
