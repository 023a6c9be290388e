"""Queries: the knowledge graph, its quality and structure, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import export, graph, knn, ontology
from orrery.plans.relations import CLUSTERS, ITEMS, KNN, SIM, clusters, fused, items, sha_id, vector_items
from orrery.sources.io import table

Q: dict = {}
SQL: dict[str, str] = {}


def add(name, fn, sql=None):
    Q[name] = fn
    if sql:
        SQL[name] = sql


def rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def neighbours(s, d):
    return knn.knn_join(fused(s, d), k=5, min_sim=0.25)


def vector_graph(s, d):
    return graph.edges(vector_items(s, d), fused(s, d).select("item_id", "cluster_id"), neighbours(s, d))


def vector_nodes(s, d):
    return graph.entities(vector_items(s, d), fused(s, d).select("item_id", "cluster_id"))


def similar(s, d):
    return graph.labelled_similarity(vector_graph(s, d), vector_nodes(s, d), vector_items(s, d))


def groups(s, d):
    return fused(s, d).select(F.col("item_id").alias("node"), F.col("cluster_id").alias("group"))


def knn_edges(s, d):
    return neighbours(s, d).select("src", "dst", F.col("sim").alias("weight"), F.lit("SIMILAR_TO").alias("rel"))


NODES = f"""nodes AS (SELECT DISTINCT {sha_id('dataset', 'source')} AS entity_id, 'DATASET' AS entity_type, source AS name, 'Histopathology dataset source: ' || source AS description FROM items
UNION ALL SELECT DISTINCT {sha_id('label', 'label')}, 'LABEL', label, 'Tissue class label code=' || label FROM items
UNION ALL SELECT DISTINCT {sha_id('cluster', 'CAST(cluster_id AS VARCHAR)')}, 'CLUSTER', 'C' || cluster_id, 'Embedding cluster id=' || cluster_id FROM clusters
UNION ALL SELECT {sha_id('item', 'item_id')}, 'ITEM', item_id, text FROM items)"""
EDGES = f"""field_edges AS (SELECT {sha_id('item', 'item_id')} AS src, {sha_id('label', 'label')} AS dst, 'HAS_LABEL' AS rel, 'items.label=' || label AS evidence, item_id FROM items WHERE label IS NOT NULL
UNION ALL SELECT {sha_id('item', 'item_id')}, {sha_id('cluster', 'CAST(cluster_id AS VARCHAR)')}, 'IN_CLUSTER', 'cluster_id=' || cluster_id, item_id FROM items JOIN clusters USING (item_id)
UNION ALL SELECT {sha_id('item', 'item_id')}, {sha_id('dataset', 'source')}, 'PART_OF', 'items.source=' || source, item_id FROM items WHERE source IS NOT NULL)"""
add("kg_entities", lambda s, d: graph.entities(items(s, d), clusters(s, d)).withColumn("description", F.md5("description")), f"WITH {ITEMS}, {CLUSTERS}, {NODES} SELECT entity_id, entity_type, name, md5(description) AS description FROM nodes")
add(
    "kg_edges",
    lambda s, d: graph.edges(items(s, d), clusters(s, d)).select("edge_id", "src", "dst", "rel", "weight", "provenance_id"),
    f"WITH {ITEMS}, {CLUSTERS}, {EDGES} SELECT {sha_id('edge', chr(34) + 'k' + chr(34))} AS edge_id, src, dst, rel, 1.0::DOUBLE AS weight, {sha_id('prov', chr(34) + 'k' + chr(34))} AS provenance_id FROM (SELECT *, src || '|' || rel || '|' || dst || '|' || evidence AS k FROM field_edges)",
)
add(
    "kg_provenance",
    lambda s, d: graph.provenance(graph.edges(items(s, d), clusters(s, d))),
    f"WITH {ITEMS}, {CLUSTERS}, {EDGES} SELECT {sha_id('prov', 'k')} AS provenance_id, item_id AS source_item_id, 'field' AS evidence_type, evidence, 1.0::DOUBLE AS confidence FROM (SELECT *, src || '|' || rel || '|' || dst || '|' || evidence AS k FROM field_edges)",
)
add(
    "kg_similar_edges",
    lambda s, d: rounded(vector_graph(s, d).filter("rel = 'SIMILAR_TO'"), ["distance"]).select("src", "dst", "rank", "similarity", "distance", "evidence"),
    f"WITH {KNN} SELECT {sha_id('item', 'src')} AS src, {sha_id('item', 'dst')} AS dst, rank, sim AS similarity, round(1 - sim, 6) AS distance, 'cosine_sim=' || CAST(round(CAST(sim AS DECIMAL(10, 6)), 4) AS VARCHAR) AS evidence FROM knn",
)
add(
    "kg_similarity_qa",
    lambda s, d: rounded(graph.within_label(similar(s, d)), ["within_label_frac"]),
    f"WITH {SIM} SELECT src_label AS label, count(*) AS n_edges, round(avg(CASE WHEN src_label = dst_label THEN 1.0 ELSE 0.0 END), 6) AS within_label_frac FROM sim GROUP BY 1",
)
add("labelled_similarity", lambda s, d: similar(s, d).select("src_item_id", "dst_item_id", "weight", "src_label", "dst_label"), f"WITH {SIM} SELECT * FROM sim")
add(
    "cross_label_pairs",
    lambda s, d: rounded(graph.cross_label_pairs(similar(s, d), 25), ["rate"]),
    f"WITH {SIM}, c AS (SELECT src_label, dst_label, count(*) AS n_edges FROM sim WHERE src_label <> dst_label GROUP BY ALL) SELECT src_label, dst_label, n_edges, round(n_edges / sum(n_edges) OVER (), 6) AS rate FROM c ORDER BY n_edges DESC, src_label, dst_label LIMIT 25",
)
add(
    "weight_stats",
    lambda s, d: rounded(graph.weight_stats(similar(s, d)), ["mean", "std", "p01", "p05", "p50", "p95", "p99"]),
    f"WITH {SIM} SELECT count(*) AS n_edges, min(weight) AS min, max(weight) AS max, round(avg(weight), 6) AS mean, round(stddev_pop(weight), 6) AS std, " + ", ".join(f"round(quantile_cont(weight, {q}), 6) AS {n}" for q, n in ((0.01, "p01"), (0.05, "p05"), (0.5, "p50"), (0.95, "p95"), (0.99, "p99"))) + ", count(DISTINCT round(weight, 3)) AS n_unique FROM sim",
)
add("weight_spikes", lambda s, d: graph.weight_spikes(similar(s, d)), f"WITH {SIM} SELECT round(weight, 3) AS weight_rounded, count(*) AS n FROM sim GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
DEG = SIM + """,
ends AS (SELECT src_item_id AS node, 1 AS o, 0 AS i FROM sim UNION ALL SELECT dst_item_id, 0, 1 FROM sim),
deg AS (SELECT node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree, count(*) AS degree FROM ends GROUP BY 1)"""
add("degrees", lambda s, d: graph.degrees(similar(s, d), "src_item_id", "dst_item_id"), f"WITH {DEG} SELECT * FROM deg")
add("low_degree", lambda s, d: graph.low_degree(similar(s, d), vector_items(s, d)), f"WITH {DEG} SELECT item_id, label, coalesce(out_degree, 0) AS out_degree, coalesce(in_degree, 0) AS in_degree, coalesce(degree, 0) AS degree FROM fused LEFT JOIN deg ON node = item_id WHERE coalesce(degree, 0) <= 3")
add(
    "outlier_candidates",
    lambda s, d: rounded(graph.outlier_candidates(similar(s, d)), ["cross_label_frac", "avg_similarity"]),
    f"WITH {SIM}, p AS (SELECT src_item_id AS item_id, src_label AS label, count(*) AS out_degree, avg(CASE WHEN src_label <> dst_label THEN 1.0 ELSE 0.0 END) AS c, avg(weight) AS w FROM sim GROUP BY ALL) SELECT item_id, label, out_degree, round(c, 6) AS cross_label_frac, round(w, 6) AS avg_similarity FROM p WHERE out_degree >= 3 AND c >= 0.8",
)
add("node_type_counts", lambda s, d: graph.counts(graph.entities(items(s, d), clusters(s, d)), "entity_type"), f"WITH {ITEMS}, {CLUSTERS}, {NODES} SELECT entity_type AS value, count(*) AS n FROM nodes GROUP BY 1")
add("relation_counts", lambda s, d: graph.counts(graph.edges(items(s, d), clusters(s, d)), "rel"), f"WITH {ITEMS}, {CLUSTERS}, {EDGES} SELECT rel AS value, count(*) AS n FROM field_edges GROUP BY 1")
GROUPED = KNN + ", e AS (SELECT src, dst, sim AS weight, a.cluster_id AS sg, b.cluster_id AS dg FROM knn JOIN fused a ON a.item_id = src JOIN fused b ON b.item_id = dst)"
add("pair_mass", lambda s, d: rounded(graph.pair_mass(knn_edges(s, d), groups(s, d)), ["total"], 4), f"WITH {GROUPED} SELECT least(sg, dg) AS a, greatest(sg, dg) AS b, round(sum(weight), 4) AS total, count(*) AS n_edges FROM e WHERE sg <> dg GROUP BY ALL")
add("bridge_scores", lambda s, d: rounded(graph.bridge_scores(knn_edges(s, d), groups(s, d)), ["bridge_score"]), f"WITH {GROUPED} SELECT src AS node, round(sum(weight), 6) AS bridge_score FROM e WHERE sg <> dg GROUP BY 1")
add(
    "hubs_and_bridges",
    lambda s, d: graph.hubs_and_bridges(knn_edges(s, d), groups(s, d)),
    f"""WITH {GROUPED}, ends AS (SELECT src AS node FROM e UNION ALL SELECT dst FROM e), g AS (SELECT node, count(*) AS degree FROM ends GROUP BY 1), b AS (SELECT src AS node, sum(weight) AS s FROM e WHERE sg <> dg GROUP BY 1),
    f AS (SELECT item_id AS node, cluster_id, coalesce(degree, 0) AS degree, round(coalesce(s, 0), 6) AS s FROM fused LEFT JOIN g ON g.node = item_id LEFT JOIN b ON b.node = item_id), r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY degree DESC, node) <= 4 AS hub FROM f),
    q AS (SELECT *, row_number() OVER (PARTITION BY cluster_id, hub ORDER BY s DESC, node) AS k FROM r) SELECT cluster_id AS "group", node, CASE WHEN hub THEN 'hub' ELSE 'bridge' END AS role FROM q WHERE hub OR k <= 2""",
)
add("representatives", lambda s, d: graph.representatives(items(s, d).select(F.col("source").alias("leaf"), "item_id"), 3, items(s, d).filter("toxic = 1").select("item_id")), f"WITH {ITEMS} SELECT source AS leaf, item_id FROM items QUALIFY row_number() OVER (PARTITION BY source ORDER BY CASE WHEN toxic = 1 THEN 1 ELSE 0 END DESC, item_id) <= 3")
add("subgraph", lambda s, d: graph.subgraph(knn_edges(s, d), fused(s, d).filter("label = 'L0'").select(F.col("item_id").alias("node"))).select("src", "dst"), f"WITH {SIM} SELECT src_item_id AS src, dst_item_id AS dst FROM sim WHERE src_label = 'L0' AND dst_label = 'L0'")
add("outgoing_edges", lambda s, d: graph.outgoing(knn_edges(s, d), "7", "SIMILAR_TO", 3).select("src", "dst", "weight"), f"WITH {KNN} SELECT src, dst, sim AS weight FROM knn WHERE src = '7' ORDER BY sim DESC, dst LIMIT 3")
add("ego_graph", lambda s, d: graph.ego(knn_edges(s, d), "7").select("src", "dst"), f"WITH {KNN}, n AS (SELECT dst AS node FROM knn WHERE src = '7' UNION SELECT '7') SELECT src, dst FROM knn WHERE src IN (SELECT node FROM n) AND dst IN (SELECT node FROM n)")
add(
    "neighbour_table",
    lambda s, d: neighbours(s, d).filter("src IN ('3', '7')").join(fused(s, d).select(F.col("item_id").alias("dst"), "label"), "dst", "left").select("src", "dst", "label", "sim"),
    f"WITH {KNN} SELECT src, dst, label, sim FROM knn LEFT JOIN fused ON item_id = dst WHERE src IN ('3', '7')",
)
TREE = "edges AS (SELECT 'n' || n_nationkey AS src, 'r' || n_regionkey AS dst FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer)"


def tree(s, d):
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    n = table(s, d, "nation").select(key("n", "n_nationkey").alias("src"), key("r", "n_regionkey").alias("dst"))
    n = n.union(table(s, d, "supplier").select(key("s", "s_suppkey"), key("n", "s_nationkey")))
    return n.union(table(s, d, "customer").select(key("c", "c_custkey"), key("n", "c_nationkey")))


REGION = TREE + ", home AS (SELECT 'n' || n_nationkey AS node, 'r' || n_regionkey AS region FROM nation), member AS (SELECT node, region FROM home UNION ALL SELECT src, region FROM edges JOIN home ON dst = node UNION ALL SELECT DISTINCT region, region FROM home)"
add("graph_components", lambda s, d: graph.components(tree(s, d)), f"WITH {REGION} SELECT node, min(node) OVER (PARTITION BY region) AS component FROM member")
add(
    "graph_health",
    lambda s, d: rounded(graph.health(tree(s, d), table(s, d, "part").filter("p_partkey <= 3").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node"))), ["degree_mean", "degree_p99"]),
    f"""WITH {REGION}, ends AS (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges), deg AS (SELECT node, count(*) AS g FROM ends GROUP BY 1 UNION ALL SELECT 'p' || p_partkey, 0 FROM part WHERE p_partkey <= 3), z AS (SELECT region, count(*) AS n FROM member GROUP BY 1)
    SELECT count(*) AS n_nodes, CAST(sum(CASE WHEN g = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_orphans, min(g) AS degree_min, max(g) AS degree_max, round(avg(g), 6) AS degree_mean, round(quantile_cont(g, 0.99), 6) AS degree_p99, (SELECT count(*) FROM z) + (SELECT count(*) FROM part WHERE p_partkey <= 3) AS n_components, (SELECT max(n) FROM z) AS largest_component, (SELECT count(*) FROM edges) AS n_edges FROM deg""",
)
add(
    "graph_health_whole",
    lambda s, d: rounded(graph.health(tree(s, d), table(s, d, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node"))), ["degree_mean", "degree_p99"]),
    f"""WITH {REGION}, ends AS (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges), deg AS (SELECT node, count(*) AS g FROM ends GROUP BY 1 UNION ALL SELECT 'p' || p_partkey, 0 FROM part), z AS (SELECT region, count(*) AS n FROM member GROUP BY 1)
    SELECT count(*) AS n_nodes, CAST(sum(CASE WHEN g = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_orphans, min(g) AS degree_min, max(g) AS degree_max, round(avg(g), 6) AS degree_mean, round(quantile_cont(g, 0.99), 6) AS degree_p99, (SELECT count(*) FROM z) + (SELECT count(*) FROM part) AS n_components, (SELECT max(n) FROM z) AS largest_component, (SELECT count(*) FROM edges) AS n_edges FROM deg""",
)
add(
    "subtype_cycles",
    lambda s, d: graph.cycles(table(s, d, "nation").select((F.col("n_nationkey") % 4).alias("src"), ((F.col("n_nationkey") + F.col("n_regionkey")) % 4).alias("dst")), 3).select(F.array_join("cycle", ">").alias("cycle")),
    """WITH e AS (SELECT DISTINCT n_nationkey % 4 AS a, (n_nationkey + n_regionkey) % 4 AS b FROM nation) SELECT CAST(a AS VARCHAR) AS cycle FROM e WHERE a = b UNION ALL SELECT x.a || '>' || x.b FROM e x JOIN e y ON y.a = x.b AND y.b = x.a WHERE x.a < x.b
    UNION ALL SELECT x.a || '>' || x.b || '>' || y.b FROM e x JOIN e y ON y.a = x.b JOIN e z ON z.a = y.b AND z.b = x.a WHERE x.a < x.b AND x.a < y.b AND x.b <> y.b""",
)
add(
    "subtype_cycles_whole",
    lambda s, d: graph.cycles(table(s, d, "nation").select((F.col("n_nationkey") % 4).alias("src"), ((F.col("n_nationkey") + F.col("n_regionkey")) % 4).alias("dst"))).select(F.array_join("cycle", ">").alias("cycle")),
    """WITH RECURSIVE e AS (SELECT DISTINCT n_nationkey % 4 AS a, (n_nationkey + n_regionkey) % 4 AS b FROM nation), p AS (SELECT a AS s, b AS t, [a, b] AS path FROM e WHERE a < b
    UNION ALL SELECT p.s, e.b, list_append(path, e.b) FROM p JOIN e ON e.a = p.t WHERE e.b > p.s AND NOT list_contains(path, e.b))
    SELECT CAST(a AS VARCHAR) AS cycle FROM e WHERE a = b UNION ALL SELECT array_to_string(path, '>') FROM p JOIN e ON e.a = p.t AND e.b = p.s""",
)
add("cross_dataset_edges", lambda s, d: neighbours(s, d).join(fused(s, d).select(F.col("item_id").alias("src"), F.col("source").alias("a")), "src").join(fused(s, d).select(F.col("item_id").alias("dst"), F.col("source").alias("b")), "dst").agg(F.count(F.lit(1)).alias("n_edges"), F.round(F.avg((F.col("a") != F.col("b")).cast("double")), 6).alias("cross_ratio")), f"WITH {KNN} SELECT count(*) AS n_edges, round(avg(CASE WHEN a.source <> b.source THEN 1.0 ELSE 0.0 END), 6) AS cross_ratio FROM knn JOIN fused a ON a.item_id = src JOIN fused b ON b.item_id = dst")
add("item_clusters", lambda s, d: graph.item_clusters(clusters(s, d).filter("cluster_id > 3"), graph.edges(items(s, d), clusters(s, d)), graph.entities(items(s, d), clusters(s, d))), f"WITH {ITEMS}, {CLUSTERS} SELECT item_id, cluster_id FROM clusters")
add(
    "relationship_edges",
    lambda s, d: graph.relationship_edges(table(s, d, "nation").select(F.col("n_nationkey").alias("src_cluster_id"), F.col("n_regionkey").alias("dst_cluster_id"), F.lit(0.5).alias("similarity"), F.lit("subtype_of").alias("relationship"), F.lit(None).cast("double").alias("confidence"), F.lit("").alias("rationale"))).select("edge_id", "src", "dst", "rel", "weight"),
    f"WITH e AS (SELECT {sha_id('cluster', 'CAST(n_nationkey AS VARCHAR)')} AS src, {sha_id('cluster', 'CAST(n_regionkey AS VARCHAR)')} AS dst FROM nation) SELECT substr(sha256(src || '|' || dst || '|SUBTYPE_OF'), 1, 16) AS edge_id, src, dst, 'SUBTYPE_OF' AS rel, 1.0::DOUBLE AS weight FROM e",
)

# exports
add("export_nodes", lambda s, d: export.node_rows(graph.entities(items(s, d).withColumn("text", F.lit("t")), clusters(s, d))), f"WITH {ITEMS}, {CLUSTERS}, {NODES} SELECT entity_id AS \":ID\", entity_type AS \":LABEL\", name, CASE WHEN entity_type = 'ITEM' THEN 't' ELSE description END AS description FROM nodes")
add("export_relations", lambda s, d: export.relation_rows(graph.edges(items(s, d), clusters(s, d))), f"WITH {ITEMS}, {CLUSTERS}, {EDGES} SELECT src AS \":START_ID\", dst AS \":END_ID\", rel AS \":TYPE\", 1.0::DOUBLE AS weight FROM field_edges")
add(
    "export_triples",
    lambda s, d: export.triples(graph.entities(items(s, d).drop("text"), clusters(s, d)), graph.edges(items(s, d), clusters(s, d))),
    f"""WITH {ITEMS}, {CLUSTERS}, {NODES}, {EDGES}, n AS (SELECT '<http://example.org/histo/' || entity_id || '>' AS s, CASE entity_type WHEN 'ITEM' THEN 'PATCH' WHEN 'CLUSTER' THEN 'FEATURE' ELSE entity_type END AS t, name, CASE WHEN entity_type = 'ITEM' THEN '' ELSE description END AS dsc FROM nodes),
    e AS (SELECT '<http://example.org/histo/' || src || '>' AS s, CASE rel WHEN 'IN_CLUSTER' THEN 'HAS_FEATURE' ELSE rel END AS r, '<http://example.org/histo/' || dst || '>' AS o FROM field_edges)
    SELECT s, '<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>' AS p, '<http://example.org/histo/' || t || '>' AS o FROM n UNION SELECT s, '<http://example.org/histo/name>', '"' || name || '"' FROM n UNION SELECT s, '<http://example.org/histo/description>', '"' || dsc || '"' FROM n
    UNION SELECT s, '<http://example.org/histo/' || r || '>', o FROM e UNION SELECT s, '<http://example.org/histo/weight>', '"1.0"^^<http://www.w3.org/2001/XMLSchema#double>' FROM e""",
)
add("export_nodes_whole", lambda s, d: export.node_rows(graph.entities(items(s, d), clusters(s, d))), f"WITH {ITEMS}, {CLUSTERS}, {NODES} SELECT entity_id AS \":ID\", entity_type AS \":LABEL\", coalesce(name, '') AS name, coalesce(description, '') AS description FROM nodes")
QUOTED = lambda c: f"""'"' || replace(replace(replace(replace(coalesce({c}, ''), '\\', '\\\\'), '"', '\\"'), chr(10), '\\n'), chr(13), '\\r') || '"'"""
add(
    "export_triples_whole",
    lambda s, d: export.triples(graph.entities(items(s, d), clusters(s, d)), graph.edges(items(s, d), clusters(s, d))),
    f"""WITH {ITEMS}, {CLUSTERS}, {NODES}, {EDGES}, n AS (SELECT '<http://example.org/histo/' || entity_id || '>' AS s, CASE entity_type WHEN 'ITEM' THEN 'PATCH' WHEN 'CLUSTER' THEN 'FEATURE' ELSE entity_type END AS t, name, description FROM nodes),
    e AS (SELECT '<http://example.org/histo/' || src || '>' AS s, CASE rel WHEN 'IN_CLUSTER' THEN 'HAS_FEATURE' ELSE rel END AS r, '<http://example.org/histo/' || dst || '>' AS o FROM field_edges)
    SELECT s, '<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>' AS p, '<http://example.org/histo/' || t || '>' AS o FROM n UNION SELECT s, '<http://example.org/histo/name>', {QUOTED('name')} FROM n UNION SELECT s, '<http://example.org/histo/description>', {QUOTED('description')} FROM n
    UNION SELECT s, '<http://example.org/histo/' || r || '>', o FROM e UNION SELECT s, '<http://example.org/histo/weight>', '"1.0"^^<http://www.w3.org/2001/XMLSchema#double>' FROM e""",
)
add("export_metadata", lambda s, d: items(s, d).select("item_id", export.metadata(items(s, d), ["source", "quality", "absent"]).alias("m")).select("item_id", export.promote(F.col("m"), ["nothing", "source"]).alias("source"), F.get_json_object("m", "$.quality").cast("int").alias("quality")), f"WITH {ITEMS} SELECT item_id, source, quality FROM items")
LEVELS = "CASE WHEN contains(t, 'background') OR contains(t, 'empty') OR contains(t, 'glass') THEN 'BACK' WHEN contains(t, 'adipose') OR contains(t, 'fat') THEN 'ADI' WHEN contains(t, 'debris') OR contains(t, 'necros') OR contains(t, 'detrit') OR contains(t, 'dirt') THEN 'DEB' WHEN contains(t, 'lymph') OR contains(t, 'immune') THEN 'LYM' WHEN contains(t, 'mucus') OR contains(t, 'mucin') THEN 'MUC' WHEN contains(t, 'muscle') OR contains(t, 'muscular') THEN 'MUS' WHEN contains(t, 'stroma') OR contains(t, 'fibro') OR contains(t, 'connective') THEN 'STR' WHEN contains(t, 'normal mucosa') OR contains(t, 'normal colon') OR (contains(t, 'normal') AND contains(t, 'mucosa')) THEN 'NORM' WHEN contains(t, 'tumor') OR contains(t, 'adenocarcinoma') THEN 'TUM' WHEN starts_with(t, 'norm') THEN 'NORM' WHEN contains(t, 'carcinoma') THEN 'TUM' WHEN contains(t, 'no tissue') THEN 'BACK' WHEN contains(t, 'strom') THEN 'STR' ELSE 'NORM' END"
WORDS = ["adipose tissue", "lymphocytes", "colorectal adenocarcinoma", "smooth muscle", "debris", "normal mucosa", "empty slide"]


def labelled_parts(s, d):
    return table(s, d, "part").select(F.col("p_partkey").cast("string").alias("item_id"), F.element_at(F.array(*[F.lit(w) for w in WORDS]), (F.col("p_partkey") % len(WORDS) + 1).cast("int")).alias("label"), F.col("p_brand").alias("cluster_name"), F.col("p_name").alias("text"), F.col("p_type").alias("source"))


PARTS = "parts AS (SELECT CAST(p_partkey AS VARCHAR) AS item_id, [" + ", ".join(f"'{w}'" for w in WORDS) + f"][p_partkey % {len(WORDS)} + 1] AS label, p_brand AS cluster_name, p_name AS text, p_type AS source FROM part)"
add("canonical_class", lambda s, d: labelled_parts(s, d).select("item_id", export.canonical_class(F.col("label")).alias("class")), f"WITH {PARTS} SELECT item_id, {LEVELS} AS class FROM (SELECT *, lower(label) AS t FROM parts)")
add("ontology_path", lambda s, d: export.ontology(labelled_parts(s, d)).select("item_id", "class", F.element_at(F.split("ontology_path", " > "), 5).alias("l5"), F.length("semantic_text").alias("n")))
add("triage", lambda s, d: labelled_parts(s, d).select("item_id", export.triage(F.col("label")).alias("kind")), f"WITH {PARTS} SELECT item_id, CASE WHEN contains(label, 'carcinoma') THEN 'critical-bug-urgent' WHEN contains(label, 'debris') THEN 'wontfix-noise' ELSE 'feature-routine' END AS kind FROM parts")
add("presentation", lambda s, d: export.presentation(labelled_parts(s, d)).select("item_id", "display_label", "title"), f"WITH {PARTS}, p AS (SELECT item_id, label || ' · ' || right(item_id, 8) AS display_label, regexp_replace(cluster_name, '[^A-Za-z0-9 .,;:()/>%+-]', ' ', 'g') AS c FROM parts) SELECT item_id, display_label, trim(c) || ' | ' || display_label AS title FROM p")
add("tiles", lambda s, d: export.tiles(table(s, d, "part").select("p_partkey", (F.col("p_size") + 10).alias("width"), (F.col("p_size") * 2 + 7).alias("height")), 3).select("p_partkey", "tile", "x", "y", "tile_width", "tile_height"), """WITH i AS (SELECT p_partkey, p_size + 10 AS w, p_size * 2 + 7 AS h, t AS tile, t % 3 AS c, t // 3 AS r FROM part, range(9) g(t)) SELECT p_partkey, CAST(tile AS INTEGER) AS tile, CAST(floor(c * w / 3) AS BIGINT) AS x, CAST(floor(r * h / 3) AS BIGINT) AS y, CAST(floor((c + 1) * w / 3) - floor(c * w / 3) AS BIGINT) AS tile_width, CAST(floor((r + 1) * h / 3) - floor(r * h / 3) AS BIGINT) AS tile_height FROM i""")

COLLECTIONS = ["CRC_VAL_HE_7K", "HF_PCAM", "HF_LC25000", "HF_BACH", "HF_BREAKHIS_RCL_7500", "ORCA_ORAL_ANNOTATED_100", "OTHER"]
RAW = ["adipose tissue", "1", "0__squamous_carcinomas", "breast__insitu", "breast__malignant__ductal_carcinoma__40x", "dysplasia", "skin"]


def collected(s, d):
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("p_partkey") % 7 + 1).cast("int"))
    rows = table(s, d, "part").select(F.col("p_partkey").cast("string").alias("item_id"), pick(COLLECTIONS).alias("dataset_key"), pick(RAW).alias("raw_label"), (F.col("p_partkey") % 3).alias("cluster_id"))
    return ontology.with_levels(rows.withColumn("label", F.col("raw_label")))


PATHS = (
    "VALUES (0, 'Mesenchymal', 'Colorectal', 'Normal/Benign', 'Adipose Tissue'), (1, 'Epithelial', 'Lymph Node', 'Malignant/Invasive', 'Metastatic Carcinoma'), (2, 'Epithelial', 'Lung', 'Malignant/Invasive', 'Squamous Cell Carcinoma'), (3, 'Epithelial', 'Breast', 'Pre-Malignant/In Situ', 'Carcinoma in situ'),"
    " (4, 'Epithelial', 'Breast', 'Malignant/Invasive', 'Ductal Carcinoma'), (5, 'Epithelial', 'Oral Cavity', 'Pre-Malignant/In Situ', 'Dysplasia'), (6, 'Other Tissue', 'Generic', 'Unknown State', 'Skin')"
)
LEVELLED = f"lv AS (SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_partkey % 3 AS cluster_id, v.* FROM part JOIN ({PATHS}) v(k, l2, l3, l4, l5) ON p_partkey % 7 = k)"
add("ontology_levels", lambda s, d: collected(s, d).select("item_id", F.col("cluster_l2").alias("l2"), F.col("cluster_l3").alias("l3"), F.col("cluster_l4").alias("l4"), F.col("cluster_l5").alias("l5")), f"WITH {LEVELLED} SELECT item_id, l2, l3, l4, l5 FROM lv")
add("ontology_keys", lambda s, d: ontology.keyed(collected(s, d)).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), F.min("ontology_path").alias("path")))
add(
    "majority_names",
    lambda s, d: ontology.majority_names(collected(s, d)),
    f"""WITH {LEVELLED}, t AS (SELECT cluster_id, lvl, v, n, row_number() OVER (PARTITION BY cluster_id, lvl ORDER BY n DESC, v) AS r, n / sum(n) OVER (PARTITION BY cluster_id, lvl) AS share FROM (SELECT cluster_id, 'e' AS lvl, l5 AS v, count(*) AS n FROM lv GROUP BY ALL UNION ALL SELECT cluster_id, 'o', l3, count(*) FROM lv GROUP BY ALL UNION ALL SELECT cluster_id, 's', l4, count(*) FROM lv GROUP BY ALL)),
    p AS (SELECT cluster_id, max(CASE WHEN lvl = 'e' AND r = 1 THEN v END) AS e, max(CASE WHEN lvl = 'e' AND r = 2 THEN v END) AS e2, max(CASE WHEN lvl = 'e' AND r = 1 THEN share END) AS share, max(CASE WHEN lvl = 'o' AND r = 1 THEN v END) AS o, max(CASE WHEN lvl = 's' AND r = 1 THEN v END) AS st FROM t GROUP BY 1)
    SELECT cluster_id, CASE WHEN e2 IS NOT NULL AND share < 0.55 THEN o || ' — Mixed (' || st || '): ' || e || ', ' || e2 ELSE o || ' — ' || e || ' (' || st || ')' END AS cluster_name FROM p""",
)
add(
    "item_subgraph",
    lambda s, d: graph.items_subgraph(vector_graph(s, d), vector_nodes(s, d).filter("name IN ('3', '7', '11')"), 400).groupBy("rel").agg(F.count(F.lit(1)).alias("n")),
    f"WITH {KNN} SELECT 'SIMILAR_TO' AS rel, count(*) AS n FROM knn WHERE src IN ('3', '7', '11') UNION ALL SELECT r, 3 FROM (VALUES ('HAS_LABEL'), ('IN_CLUSTER'), ('PART_OF')) t(r)",
)

add(
    "bridge_edges",
    lambda s, d: rounded(graph.bridge_edges(knn_edges(s, d), groups(s, d), 20), ["distance"]),
    f"WITH {GROUPED} SELECT src, dst, round(1 - weight, 6) AS distance FROM e WHERE sg <> dg ORDER BY weight DESC, src, dst LIMIT 20",
)
add(
    "degree_table",
    lambda s, d: graph.degree_table(graph.edges(items(s, d), clusters(s, d)).filter("rel <> 'IN_CLUSTER'"), graph.entities(items(s, d), clusters(s, d)).filter("entity_type = 'LABEL'"), 3),
    f"WITH {ITEMS} SELECT {sha_id('label', 'label')} AS entity_id, 'LABEL' AS entity_type, label AS name, count(*) AS degree FROM items GROUP BY label ORDER BY degree DESC, 1 LIMIT 3",
)
add(
    "smallest_clusters",
    lambda s, d: clusters(s, d).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "cluster_id").limit(5),
    f"WITH {CLUSTERS} SELECT cluster_id, count(*) AS n FROM clusters GROUP BY 1 ORDER BY n, cluster_id LIMIT 5",
)
