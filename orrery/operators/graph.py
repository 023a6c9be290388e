"""Property graph as two tables: building it, its quality, its structure, lookups in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.text import keyed_id

SIMILAR = ("rank", "distance", "similarity", "embedding_version", "pipeline_version")


def entities(items: DataFrame, clusters: DataFrame, label_names: DataFrame | None = None, cluster_names: DataFrame | None = None) -> DataFrame:
    """entity_id, entity_type, name, description of DATASET, LABEL, CLUSTER and ITEM nodes. Names: (label, label_name), (cluster_id, cluster_name)."""
    node = lambda prefix, key, kind, name, text: [keyed_id(prefix, key).alias("entity_id"), F.lit(kind).alias("entity_type"), name.alias("name"), text.alias("description")]
    source = items.filter("source IS NOT NULL").select("source").distinct()
    datasets = source.select(*node("dataset", F.col("source"), "DATASET", F.col("source"), F.concat(F.lit("Histopathology dataset source: "), "source")))
    label = items.filter("label IS NOT NULL").select("label").distinct()
    pretty: Column = F.col("label")
    if label_names is not None:
        label = label.join(label_names.select("label", "label_name"), "label", "left")
        pretty = F.when(F.coalesce("label_name", "label") != F.col("label"), F.concat("label_name", F.lit(" ("), "label", F.lit(")"))).otherwise(F.col("label"))
    labels = label.select(*node("label", F.col("label"), "LABEL", pretty, F.concat(F.lit("Tissue class label code="), "label")))
    cluster = clusters.filter("cluster_id IS NOT NULL").select(F.col("cluster_id").cast("int").cast("string").alias("c"), "cluster_id").distinct()
    shown: Column = F.concat(F.lit("C"), "c")
    if cluster_names is not None:
        cluster = cluster.join(cluster_names.select("cluster_id", "cluster_name"), "cluster_id", "left")
        shown = F.when(F.coalesce("cluster_name", F.lit("")) != "", F.concat(shown, F.lit(": "), "cluster_name")).otherwise(shown)
    groups = cluster.select(*node("cluster", F.col("c"), "CLUSTER", shown, F.concat(F.lit("Embedding cluster id="), "c")))
    text = F.coalesce(F.col("text"), F.lit("")) if "text" in items.columns else F.lit("")
    each = items.select(*node("item", F.col("item_id"), "ITEM", F.col("item_id"), text))
    return datasets.unionByName(labels).unionByName(groups).unionByName(each).dropDuplicates(["entity_id"])


def _edges(rows: DataFrame, src: Column, dst: Column, rel: str, evidence: Column, weight: Column, item: Column, extra: dict[str, Column] | None = None) -> DataFrame:
    key = F.concat_ws("|", src, F.lit(rel), dst, evidence)
    kinds = {"rank": "int", "distance": "double", "similarity": "double", "embedding_version": "string", "pipeline_version": "string"}
    more = [(extra[c] if extra else F.lit(None)).cast(kinds[c]).alias(c) for c in SIMILAR]
    return rows.select(
        keyed_id("edge", key).alias("edge_id"), src.alias("src"), dst.alias("dst"), F.lit(rel).alias("rel"), weight.cast("double").alias("weight"), keyed_id("prov", key).alias("provenance_id"), *more, item.alias("source_item_id"), evidence.alias("evidence")
    )


def edges(items: DataFrame, clusters: DataFrame, similar: DataFrame | None = None, embedding_version: str = "", pipeline_version: str = "") -> DataFrame:
    """Edges of items to labels, clusters and datasets, and of similar items (src, dst, rank, sim); with source_item_id and evidence for provenance()."""
    me = keyed_id("item", F.col("item_id"))
    one = F.lit(1.0)
    tagged = items.filter("label IS NOT NULL")
    out = _edges(tagged, me, keyed_id("label", F.col("label")), "HAS_LABEL", F.concat(F.lit("items.label="), "label"), one, F.col("item_id"))
    member = items.select("item_id").join(clusters.filter("cluster_id IS NOT NULL").select("item_id", F.col("cluster_id").cast("int").cast("string").alias("c")), "item_id")
    out = out.unionByName(_edges(member, me, keyed_id("cluster", F.col("c")), "IN_CLUSTER", F.concat(F.lit("cluster_id="), "c"), one, F.col("item_id")))
    part = items.filter("source IS NOT NULL")
    out = out.unionByName(_edges(part, me, keyed_id("dataset", F.col("source")), "PART_OF", F.concat(F.lit("items.source="), "source"), one, F.col("item_id")))
    if similar is not None:
        evidence = F.concat(F.lit("cosine_sim="), F.format_string("%.4f", F.col("sim")))
        extra = {"rank": F.col("rank"), "distance": 1 - F.col("sim"), "similarity": F.col("sim"), "embedding_version": F.lit(embedding_version), "pipeline_version": F.lit(pipeline_version)}
        out = out.unionByName(_edges(similar, keyed_id("item", F.col("src")), keyed_id("item", F.col("dst")), "SIMILAR_TO", evidence, F.col("sim"), F.col("src"), extra))
    return out.dropDuplicates(["edge_id"])


def provenance(edge_rows: DataFrame) -> DataFrame:
    confidence = F.when(F.col("rel") == "SIMILAR_TO", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("weight")))).otherwise(F.lit(1.0))
    kind = F.when(F.col("rel") == "SIMILAR_TO", "computed").otherwise("field")
    return edge_rows.select("provenance_id", "source_item_id", kind.alias("evidence_type"), "evidence", confidence.alias("confidence")).dropDuplicates(["provenance_id"])


def relationship_edges(links: DataFrame) -> DataFrame:
    """Edges between clusters from links: rel in capitals, weight = confidence or 1, attributes as JSON, an id from src, dst and rel."""
    src, dst = (keyed_id("cluster", F.col(c).cast("int").cast("string")) for c in ("src_cluster_id", "dst_cluster_id"))
    rel = F.upper(F.trim("relationship"))
    attributes = F.to_json(F.struct("similarity", "confidence", "rationale"))
    return links.select(F.substring(F.sha2(F.concat_ws("|", src, dst, rel).cast("binary"), 256), 1, 16).alias("edge_id"), src.alias("src"), dst.alias("dst"), rel.alias("rel"), F.coalesce("confidence", F.lit(1.0)).alias("weight"), attributes.alias("attributes_json"))


def labelled_similarity(edge_rows: DataFrame, nodes: DataFrame, items: DataFrame, label_col: str = "label") -> DataFrame:
    """SIMILAR_TO edges with src_item_id, dst_item_id, src_label, dst_label; edges with an end that is no item are left out."""
    item = nodes.filter(F.col("entity_type").isin("ITEM", "PATCH")).select("entity_id", F.col("name").alias("item_id"))
    label = items.select("item_id", F.coalesce(F.col(label_col).cast("string"), F.lit("")).alias("label"))
    known = item.join(label, "item_id", "left").select("entity_id", "item_id", "label")
    out = edge_rows.filter("rel = 'SIMILAR_TO'").select("src", "dst", "weight")
    for side in ("src", "dst"):
        out = out.join(known.select(F.col("entity_id").alias(side), F.col("item_id").alias(f"{side}_item_id"), F.coalesce("label", F.lit("")).alias(f"{side}_label")), side)
    return out


def within_label(sim: DataFrame) -> DataFrame:
    same = (F.col("src_label") == F.col("dst_label")).cast("double")
    return sim.groupBy(F.col("src_label").alias("label")).agg(F.count(F.lit(1)).alias("n_edges"), F.avg(same).alias("within_label_frac"))


def cross_label_pairs(sim: DataFrame, top: int = 25) -> DataFrame:
    """src_label, dst_label, n_edges, rate (of all cross edges, not of the top ones alone)."""
    counts = sim.filter("src_label <> dst_label").groupBy("src_label", "dst_label").agg(F.count(F.lit(1)).alias("n_edges"))
    rated = counts.withColumn("rate", F.col("n_edges") / F.sum("n_edges").over(Window.partitionBy()))  # a row for each pair of labels
    return rated.orderBy(F.desc("n_edges"), "src_label", "dst_label").limit(top)


def weight_stats(sim: DataFrame) -> DataFrame:
    """One row: n, min, max, mean, std (population), quantiles, number of distinct weights to 3 digits."""
    w = sim.select(F.col("weight").try_cast("double").alias("w")).filter("w IS NOT NULL AND NOT isnan(w)")
    q = F.percentile("w", F.array(*[F.lit(x) for x in (0.01, 0.05, 0.5, 0.95, 0.99)]))
    one = w.agg(F.count("w").alias("n_edges"), F.min("w").alias("min"), F.max("w").alias("max"), F.avg("w").alias("mean"), F.stddev_pop("w").alias("std"), q.alias("q"), F.count_distinct(F.round("w", 3)).alias("n_unique"))
    return one.select("n_edges", "min", "max", "mean", "std", *[F.col("q")[i].alias(n) for i, n in enumerate(("p01", "p05", "p50", "p95", "p99"))], "n_unique")


def weight_spikes(sim: DataFrame, top: int = 10) -> DataFrame:
    return sim.groupBy(F.round("weight", 3).alias("weight_rounded")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "weight_rounded").limit(top)


def degrees(edge_rows: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """node, out_degree, in_degree, degree: one union and one group-by instead of an outer join."""
    ends = edge_rows.select(F.explode(F.array(F.struct(F.col(src).alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col(dst).alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), F.count(F.lit(1)).alias("degree"))


def low_degree(sim: DataFrame, items: DataFrame, most: int = 3, label_col: str = "label") -> DataFrame:
    """item_id, label, degrees of items of at most `most` edges, isolated ones too."""
    deg = degrees(sim, "src_item_id", "dst_item_id").withColumnRenamed("node", "item_id")
    all_items = items.select("item_id", F.coalesce(F.col(label_col), F.lit("")).alias("label"))
    full = all_items.join(deg, "item_id", "left").fillna(0, ["out_degree", "in_degree", "degree"])
    return full.filter(F.col("degree") <= most)


def outlier_candidates(sim: DataFrame, least_out: int = 3, least_cross: float = 0.8) -> DataFrame:
    cross = (F.col("src_label") != F.col("dst_label")).cast("double")
    per = sim.groupBy(F.col("src_item_id").alias("item_id"), F.col("src_label").alias("label")).agg(F.count(F.lit(1)).alias("out_degree"), F.avg(cross).alias("cross_label_frac"), F.avg("weight").alias("avg_similarity"))
    return per.filter((F.col("out_degree") >= least_out) & (F.col("cross_label_frac") >= least_cross))


def counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def pair_mass(edge_rows: DataFrame, groups: DataFrame) -> DataFrame:
    """a, b, total, n_edges: weight between groups (node, group), each unordered pair once."""
    ends = edge_rows
    for side in ("src", "dst"):
        ends = ends.join(groups.select(F.col("node").alias(side), F.col("group").alias(f"{side}_group")), side)
    ends = ends.filter("src_group <> dst_group")
    return ends.groupBy(F.least("src_group", "dst_group").alias("a"), F.greatest("src_group", "dst_group").alias("b")).agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("n_edges"))


def bridge_scores(edge_rows: DataFrame, groups: DataFrame) -> DataFrame:
    ends = edge_rows
    for side in ("src", "dst"):
        ends = ends.join(groups.select(F.col("node").alias(side), F.col("group").alias(f"{side}_group")), side)
    return ends.filter("src_group <> dst_group").groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("bridge_score"))


def hubs_and_bridges(edge_rows: DataFrame, groups: DataFrame, hubs: int = 4, bridges: int = 2) -> DataFrame:
    """group, node, role: the nodes of highest degree of each group, then of the others those of highest bridge score, then hubs again up to hubs + bridges."""
    deg = degrees(edge_rows).select("node", "degree")
    full = groups.join(deg, "node", "left").join(bridge_scores(edge_rows, groups), "node", "left").fillna(0, ["degree", "bridge_score"])
    by_degree = Window.partitionBy("group").orderBy(F.desc("degree"), "node")
    full = full.withColumn("d", F.row_number().over(by_degree)).withColumn("hub", F.col("d") <= hubs)
    by_bridge = Window.partitionBy("group", "hub").orderBy(F.desc(F.round("bridge_score", 6)), "node")
    full = full.withColumn("b", F.row_number().over(by_bridge))
    role = F.when(F.col("hub"), "hub").when(F.col("b") <= bridges, "bridge")
    return full.withColumn("role", role).filter("role IS NOT NULL").select("group", "node", "role")


def representatives(members: DataFrame, most: int = 20, forced: DataFrame | None = None) -> DataFrame:
    """leaf, item_id: at most `most` items of each leaf, forced ones (item_id) first, then by id."""
    if forced is None:
        marked = members.withColumn("f", F.lit(0))
    else:
        marked = members.join(forced.select("item_id", F.lit(1).alias("f")).distinct(), "item_id", "left").fillna(0, ["f"])
    w = Window.partitionBy("leaf").orderBy(F.desc("f"), "item_id")
    return marked.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= most).select("leaf", "item_id")


def subgraph(edge_rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges of which both ends are among nodes (node)."""
    return edge_rows.join(nodes.select(F.col("node").alias("src")).distinct(), "src", "left_semi").join(nodes.select(F.col("node").alias("dst")).distinct(), "dst", "left_semi")


def items_subgraph(edge_rows: DataFrame, chosen: DataFrame, most_similar: int = 400) -> DataFrame:
    """The chosen nodes' (entity_id) best most_similar SIMILAR_TO edges, and all their other edges."""
    own = edge_rows.join(chosen.select(F.col("entity_id").alias("src")).distinct(), "src", "left_semi")
    near = own.filter("rel = 'SIMILAR_TO'").orderBy(F.desc("weight"), "src", "dst").limit(most_similar)
    return near.unionByName(own.filter("rel <> 'SIMILAR_TO'"))


def outgoing(edge_rows: DataFrame, node: str, rel: str | None = None, top: int = 20) -> DataFrame:
    found = edge_rows.filter(F.col("src") == node)
    found = found if rel is None else found.filter(F.col("rel") == rel)
    return found.orderBy("rel", F.desc("weight"), "dst").limit(top)


def bridge_edges(edge_rows: DataFrame, groups: DataFrame, top: int = 80) -> DataFrame:
    """src, dst, distance: the `top` closest edges between groups (node, group)."""
    ends = edge_rows.filter("rel = 'SIMILAR_TO'")
    for side in ("src", "dst"):
        ends = ends.join(groups.select(F.col("node").alias(side), F.col("group").alias(f"{side}_group")), side)
    return ends.filter("src_group <> dst_group").select("src", "dst", (1 - F.col("weight")).alias("distance")).orderBy("distance", "src", "dst").limit(top)


def degree_table(edge_rows: DataFrame, nodes: DataFrame, top: int = 20) -> DataFrame:
    """entity_id, entity_type, name, degree of the nodes with most edges."""
    deg = degrees(edge_rows).select(F.col("node").alias("entity_id"), "degree")
    return nodes.join(deg, "entity_id").select("entity_id", "entity_type", "name", "degree").orderBy(F.desc("degree"), "entity_id").limit(top)


def ego(edge_rows: DataFrame, centre: str, cap: int = 70) -> DataFrame:
    """Edges of the centre to its best `cap` neighbours, and among those."""
    near = edge_rows.filter((F.col("src") == centre) & (F.col("rel") == "SIMILAR_TO")).orderBy(F.desc("weight"), "dst").limit(cap).select(F.col("dst").alias("node"))
    return subgraph(edge_rows.filter("rel = 'SIMILAR_TO'"), near.union(edge_rows.sparkSession.createDataFrame([(centre,)], "node string")))


def simple_edges(edge_rows: DataFrame) -> DataFrame:
    """Parallel edges once, as in a simple directed graph."""
    return edge_rows.select("src", "dst").distinct()


def components(edge_rows: DataFrame, nodes: DataFrame | None = None, rounds: int = 40) -> DataFrame:
    """node, component (its least node): weakly connected components by alternating star contraction, checkpointed in spark.checkpoint.dir each round.

    Nodes without edges, from nodes (node), are components of their own. Rounds grow with the logarithm of the largest component.
    """
    from orrery.sources.io import ensure_checkpoint_dir

    ensure_checkpoint_dir(edge_rows.sparkSession)
    now = edge_rows.filter("src <> dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct().checkpoint()
    ends = edge_rows.select(F.col("src").alias("node")).union(edge_rows.select("dst")).distinct()
    before = None
    for _ in range(rounds):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now = small.filter("a <> b").distinct().checkpoint()
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before:
            every = ends if nodes is None else ends.union(nodes.select("node")).distinct()
            return every.join(now.select(F.col("a").alias("node"), F.col("b").alias("c")), "node", "left").select("node", F.coalesce("c", "node").alias("component"))
        before = mark
    raise RuntimeError(f"no end after {rounds} rounds")


def cyclic_part(edge_rows: DataFrame) -> DataFrame:
    """The edges without those of nodes that nothing leads to or from, again and again until all have both: no cycle is lost, and none is left of a graph without cycles."""
    now = edge_rows.checkpoint()
    left = now.count()
    while left:
        both = now.select(F.col("src").alias("node")).intersect(now.select(F.col("dst").alias("node")))
        now = subgraph(now, both).checkpoint()
        before, left = left, now.count()
        if left == before:
            break
    return now


def cycles(edge_rows: DataFrame, longest: int | None = None) -> DataFrame:
    """cycle: all simple directed cycles, each once, from its least node; with `longest`, those of at most so many edges.

    Without `longest` paths grow until none is left, checkpointed in spark.checkpoint.dir each step; there can be as many cycles as paths, however they are found.
    """
    e = simple_edges(edge_rows).filter("src <> dst")
    if longest is None:
        from orrery.sources.io import ensure_checkpoint_dir

        ensure_checkpoint_dir(edge_rows.sparkSession)
        e = cyclic_part(e)
    path = e.filter("src < dst").select(F.col("src").alias("start"), F.col("dst").alias("at"), F.array("src", "dst").alias("path"))
    loops = simple_edges(edge_rows).filter("src = dst").select(F.array("src").alias("cycle"))
    found = loops
    step = e.select(F.col("src").alias("at"), F.col("dst").alias("to"))
    edges_left = longest
    while (edges_left > 1) if longest is not None else not path.isEmpty():
        on = path.join(step, "at")
        if longest is None:
            on = on.checkpoint()
        else:
            edges_left -= 1
        found = found.union(on.filter("to = start").select(F.col("path").alias("cycle")))
        path = on.filter("to > start AND NOT array_contains(path, to)").select("start", F.col("to").alias("at"), F.concat("path", F.array("to")).alias("path"))
    return found


def health(edge_rows: DataFrame, nodes: DataFrame, comp: DataFrame | None = None) -> DataFrame:
    """One row: n_nodes, n_edges, n_orphans, n_components, largest_component, degree min, max, mean, p99. nodes: node; parallel edges count once."""
    e = simple_edges(edge_rows)
    every = nodes.select("node").union(e.select("src")).union(e.select("dst")).distinct()
    deg = every.join(degrees(e), "node", "left").select("node", F.coalesce("degree", F.lit(0)).alias("degree"))
    stats = deg.agg(
        F.count(F.lit(1)).alias("n_nodes"), F.sum((F.col("degree") == 0).cast("long")).alias("n_orphans"), F.min("degree").alias("degree_min"), F.max("degree").alias("degree_max"), F.avg("degree").alias("degree_mean"), F.percentile("degree", F.lit(0.99)).alias("degree_p99")
    )
    sizes = (comp or components(e, every)).groupBy("component").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("n_components"), F.max("n").alias("largest_component"))
    return stats.crossJoin(sizes).crossJoin(e.agg(F.count(F.lit(1)).alias("n_edges")))  # three single rows


def item_clusters(clusters: DataFrame, edge_rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """item_id, cluster_id: from the clusters table, else from the name of the item's IN_CLUSTER node."""
    item = nodes.filter("entity_type = 'ITEM'").select(F.col("entity_id").alias("src"), F.col("name").alias("item_id"))
    group = nodes.filter("entity_type = 'CLUSTER'").select(F.col("entity_id").alias("dst"), F.regexp_extract("name", r"^C(-?\d+)", 1).cast("int").alias("from_edge"))
    other = edge_rows.filter("rel = 'IN_CLUSTER'").select("src", "dst").join(item, "src").join(group, "dst").select("item_id", "from_edge")
    known = clusters.select("item_id", F.col("cluster_id").alias("from_table"))
    return item.select("item_id").join(known, "item_id", "left").join(other, "item_id", "left").select("item_id", F.coalesce("from_table", "from_edge").alias("cluster_id"))
