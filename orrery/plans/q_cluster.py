"""Queries: cluster composition, names, centroids, metrics, neighbours, links."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions import vectors as vx
from orrery.operators import clusters as cl
from orrery.operators import density, knn, links
from orrery.plans.relations import CENTROIDS, COMPOSITION, FUSED, KNN, clusters, fused, items

Q: dict = {}
SQL: dict[str, str] = {}


def add(name, fn, sql=None):
    Q[name] = fn
    if sql:
        SQL[name] = sql


def rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def comp(s, d):
    return cl.composition(clusters(s, d), items(s, d))


def cents(s, d):
    return cl.centroids(fused(s, d))


add("label_composition", lambda s, d: rounded(comp(s, d), ["frac"]), f"WITH {COMPOSITION} SELECT cluster_id, label, n_items, round(frac, 6) AS frac FROM comp")
add(
    "dominant_label",
    lambda s, d: rounded(cl.dominant_label(comp(s, d)), ["dominant_frac"]),
    f"WITH {COMPOSITION} SELECT cluster_id, CAST(sum(n_items) AS BIGINT) AS n_items, max(CASE WHEN rank = 1 THEN label END) AS dominant_label, round(max(CASE WHEN rank = 1 THEN frac END), 6) AS dominant_frac FROM comp WHERE cluster_id <> -1 GROUP BY 1",
)
add("weighted_purity", lambda s, d: rounded(cl.purity(comp(s, d)), ["purity"]), f"WITH {COMPOSITION}, e AS (SELECT cluster_id, max(n_items) AS t, sum(n_items) AS n FROM comp WHERE cluster_id <> -1 GROUP BY 1) SELECT round(sum(t) / sum(n), 6) AS purity FROM e")
add("weighted_purity_with_noise", lambda s, d: rounded(cl.purity(comp(s, d), None), ["purity"]), f"WITH {COMPOSITION}, e AS (SELECT cluster_id, max(n_items) AS t, sum(n_items) AS n FROM comp GROUP BY 1) SELECT round(sum(t) / sum(n), 6) AS purity FROM e")
for base, log in ((None, "ln"), (2, "log2")):
    add(
        f"purity_entropy_{log}",
        lambda s, d, b=base: rounded(cl.purity_entropy(comp(s, d), b), ["purity", "entropy"]),
        f"WITH {COMPOSITION} SELECT cluster_id, CAST(sum(n_items) AS BIGINT) AS n_items, round(max(frac), 6) AS purity, round(sum(-frac * {log}(frac)), 6) AS entropy FROM comp GROUP BY 1",
    )
GRID = f"WITH {COMPOSITION}, g AS (SELECT l.label, c.cluster_id, coalesce(n_items, 0) AS v FROM (SELECT DISTINCT label FROM comp) l CROSS JOIN (SELECT DISTINCT cluster_id FROM comp) c LEFT JOIN comp USING (label, cluster_id))"
add("crosstab", lambda s, d: cl.crosstab(comp(s, d)), GRID + " SELECT label, cluster_id, v AS value FROM g")
add("crosstab_normalised", lambda s, d: rounded(cl.crosstab(comp(s, d), True), ["value"]), GRID + " SELECT label, cluster_id, round(v / sum(v) OVER (PARTITION BY label), 6) AS value FROM g")
add(
    "top_labels",
    lambda s, d: cl.top_labels(comp(s, d), 3).select("cluster_id", F.posexplode("dominant_labels").alias("place", "l")).select("cluster_id", "place", "l.label", F.col("l.count").alias("n"), F.round("l.frac", 6).alias("frac")),
    f"WITH {COMPOSITION} SELECT cluster_id, CAST(rank - 1 AS INTEGER) AS place, label, n_items AS n, round(frac, 6) AS frac FROM comp WHERE rank <= 3",
)
add(
    "cluster_names",
    lambda s, d: rounded(cl.name_by_composition(comp(s, d)), ["purity", "entropy"]),
    f"""WITH {COMPOSITION}, p AS (SELECT cluster_id, string_agg(label, ' + ' ORDER BY rank) AS parts FROM comp WHERE rank <= 2 AND frac >= 0.1 AND label <> '' GROUP BY 1),
    e AS (SELECT cluster_id, CAST(sum(n_items) AS BIGINT) AS n_items, round(max(frac), 6) AS purity, round(sum(-frac * ln(frac)), 6) AS entropy FROM comp GROUP BY 1)
    SELECT cluster_id, n_items, purity, entropy, CASE WHEN cluster_id = -1 THEN 'Noise / outliers' ELSE 'C' || cluster_id || ': ' || coalesce(parts, '(mixed)') END AS cluster_name FROM e LEFT JOIN p USING (cluster_id)""",
)
add(
    "topic_names",
    lambda s, d: rounded(cl.topic_names(comp(s, d), 0.6), ["purity"]),
    f"""WITH {COMPOSITION}, t AS (SELECT cluster_id, CAST(sum(n_items) AS BIGINT) AS n, max(CASE WHEN rank = 1 THEN label END) AS a, max(CASE WHEN rank = 2 THEN label END) AS b, max(CASE WHEN rank = 1 THEN frac END) AS purity FROM comp GROUP BY 1)
    SELECT cluster_id, n, round(purity, 6) AS purity, CASE WHEN purity >= 0.6 OR b IS NULL THEN a || ' dominant' ELSE a || ' + ' || b || ' mix' END || ' · n=' || n AS name_short FROM t""",
)
add(
    "named_members",
    lambda s, d: clusters(s, d).join(cl.name_by_composition(comp(s, d)).select("cluster_id", "cluster_name", "n_items"), "cluster_id", "left").select("item_id", "cluster_name", "n_items"),
    f"""WITH {COMPOSITION}, p AS (SELECT cluster_id, string_agg(label, ' + ' ORDER BY rank) AS parts FROM comp WHERE rank <= 2 AND frac >= 0.1 AND label <> '' GROUP BY 1), e AS (SELECT cluster_id, CAST(sum(n_items) AS BIGINT) AS n_items FROM comp GROUP BY 1)
    SELECT item_id, CASE WHEN cluster_id = -1 THEN 'Noise / outliers' ELSE 'C' || cluster_id || ': ' || coalesce(parts, '(mixed)') END AS cluster_name, n_items FROM clusters JOIN e USING (cluster_id) LEFT JOIN p USING (cluster_id)""",
)
add(
    "size_gini",
    lambda s, d: rounded(cl.gini(clusters(s, d)), ["gini"]),
    f"WITH {COMPOSITION}, z AS (SELECT cluster_id, count(*) AS n FROM clusters WHERE cluster_id <> -1 GROUP BY 1), i AS (SELECT n, row_number() OVER (ORDER BY n, cluster_id) AS i, count(*) OVER () AS k, sum(n) OVER () AS t FROM z) SELECT round(sum((2 * i - k - 1) * n) / (max(k) * max(t) + 1e-12), 6) AS gini FROM i",
)
add(
    "largest_clusters",
    lambda s, d: clusters(s, d).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "cluster_id").limit(5),
    f"WITH {COMPOSITION} SELECT cluster_id, count(*) AS n FROM clusters GROUP BY 1 ORDER BY n DESC, cluster_id LIMIT 5",
)
add(
    "centroids",
    lambda s, d: cents(s, d).select("cluster_id", "n_items", F.posexplode("vector").alias("i", "x")).select("cluster_id", "n_items", "i", F.round("x", 6).alias("x")),
    f"WITH {FUSED}, n AS (SELECT cluster_id, count(*) AS n_items FROM fused GROUP BY 1) SELECT cluster_id, n_items, CAST(i - 1 AS INTEGER) AS i, round(avg(vector[i]), 6) AS x FROM fused JOIN n USING (cluster_id), range(1, 65) r(i) GROUP BY cluster_id, n_items, i",
)
add(
    "unit_centroids",
    lambda s, d: cl.centroids(fused(s, d), normalise=True).select("cluster_id", F.round(vx.norm("vector"), 6).alias("norm"), F.round(F.element_at("vector", 1), 6).alias("first")),
    f"""WITH {FUSED}, u AS (SELECT cluster_id, i, avg(vector[i] / sqrt(list_inner_product(vector, vector))) AS m FROM fused, range(1, 65) r(i) GROUP BY ALL)
    SELECT cluster_id, round(sqrt(sum(m * m)) / (sqrt(sum(m * m)) + 1e-12), 6) AS norm, round(max(CASE WHEN i = 1 THEN m END) / sqrt(sum(m * m)), 6) AS first FROM u GROUP BY 1""",
)
add(
    "anchors",
    lambda s, d: cl.grouping_anchors(fused(s, d), "source", "label", least=25).select("kind", "wide", "narrow", "n_items", F.round(F.element_at("vector", 1), 6).alias("first")),
    f"""WITH {FUSED} SELECT 'wide' AS kind, source AS wide, NULL AS narrow, count(*) AS n_items, round(avg(vector[1]), 6) AS first FROM fused GROUP BY source
    UNION ALL SELECT 'pair', source, label, count(*), round(avg(vector[1]), 6) FROM fused GROUP BY source, label HAVING count(*) >= 25 UNION ALL SELECT 'narrow', NULL, label, count(*), round(avg(vector[1]), 6) FROM fused GROUP BY label HAVING count(*) >= 25""",
)
DIST = f"WITH {FUSED}, p AS (SELECT a.item_id AS i, a.cluster_id AS c, b.cluster_id AS o, sqrt(greatest(0, list_inner_product(a.vector, a.vector) + list_inner_product(b.vector, b.vector) - 2 * list_inner_product(a.vector, b.vector))) AS x FROM fused a JOIN fused b ON a.item_id <> b.item_id), m AS (SELECT i, c, o, avg(x) AS x FROM p GROUP BY ALL), s AS (SELECT i, c, max(CASE WHEN o = c THEN x END) AS a, min(CASE WHEN o <> c THEN x END) AS b FROM m GROUP BY ALL)"
add("silhouette", lambda s, d: cl.silhouette(fused(s, d)).select("item_id", F.col("cluster_id").cast("int").alias("cluster_id"), F.round("silhouette", 6).alias("silhouette")), DIST + " SELECT i AS item_id, c AS cluster_id, round(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM s")
add(
    "davies_bouldin",
    lambda s, d: rounded(cl.davies_bouldin(fused(s, d)), ["davies_bouldin"]),
    f"WITH {CENTROIDS}, s AS (SELECT cluster_id, avg(list_distance(f.vector, c.vector)) AS s FROM fused f JOIN cents c USING (cluster_id) GROUP BY 1), w AS (SELECT a.cluster_id, max((a.s + b.s) / list_distance(ca.vector, cb.vector)) AS w FROM s a JOIN s b ON a.cluster_id <> b.cluster_id JOIN cents ca ON ca.cluster_id = a.cluster_id JOIN cents cb ON cb.cluster_id = b.cluster_id GROUP BY 1) SELECT round(avg(w), 6) AS davies_bouldin FROM w",
)
add(
    "calinski_harabasz",
    lambda s, d: rounded(cl.calinski_harabasz(fused(s, d)), ["calinski_harabasz"]),
    f"""WITH {CENTROIDS}, g AS (SELECT list(m ORDER BY i) AS v FROM (SELECT i, avg(vector[i]) AS m FROM fused, range(1, 65) r(i) GROUP BY i)), n AS (SELECT cluster_id, count(*) AS n FROM fused GROUP BY 1),
    b AS (SELECT sum(n * list_distance(c.vector, g.v) ^ 2) AS b, count(*) AS k, sum(n) AS n FROM n JOIN cents c USING (cluster_id), g), w AS (SELECT sum(list_distance(f.vector, c.vector) ^ 2) AS w FROM fused f JOIN cents c USING (cluster_id))
    SELECT round((b / (k - 1)) / (w / (n - k)), 6) AS calinski_harabasz FROM b, w""",
)
add(
    "run_score",
    lambda s, d: items(s, d).groupBy("source").agg(F.avg((F.col("label") == "en").cast("double")).alias("p"), F.avg("quality").alias("q")).select("source", F.round(cl.score(F.lit(0.1), F.col("p"), F.col("q"), F.lit(1.5)), 6).alias("score")),
    f"WITH {COMPOSITION} SELECT source, round(0.9 * avg(CASE WHEN label = 'en' THEN 1.0 ELSE 0.0 END) * greatest(0, coalesce(avg(quality), 0)) / 2.5, 6) AS score FROM items GROUP BY 1",
)
add(
    "best_run",
    lambda s, d: cl.best_run(items(s, d).groupBy("source").agg(F.avg((F.col("label") != "en").cast("double")).alias("noise_ratio"), F.avg("n_chars").alias("score")).select(F.substring("source", 4, 9).cast("int").alias("run_idx"), "noise_ratio", "score")).select("run_idx", "eligible"),
    f"WITH {COMPOSITION} SELECT CAST(substr(source, 4) AS INTEGER) AS run_idx, avg(CASE WHEN label <> 'en' THEN 1.0 ELSE 0.0 END) <= 0.4 AS eligible FROM items GROUP BY source ORDER BY eligible DESC, avg(n_chars) DESC, run_idx LIMIT 1",
)
add("kmeans", lambda s, d: cl.kmeans(fused(s, d), 5))
add("sweep", lambda s, d: cl.sweep(fused(s, d).select("item_id", "vector"), fused(s, d).select("item_id", "label"), [3, 5], [1337]))

# neighbours
add("knn", lambda s, d: knn.knn_join(fused(s, d), k=5, min_sim=0.25), f"WITH {KNN} SELECT * FROM knn")
add(
    "knn_queries",
    lambda s, d: knn.knn_join(fused(s, d).filter("CAST(item_id AS BIGINT) % 50 = 0"), fused(s, d), k=10),
    f"WITH {FUSED}, p AS (SELECT a.item_id AS src, b.item_id AS dst, round(list_cosine_similarity(a.vector, b.vector), 6) AS sim FROM fused a JOIN fused b ON a.item_id <> b.item_id WHERE CAST(a.item_id AS BIGINT) % 50 = 0) SELECT src, dst, CAST(row_number() OVER w AS INTEGER) AS rank, sim FROM p WINDOW w AS (PARTITION BY src ORDER BY sim DESC, dst) QUALIFY rank <= 10",
)
add("knn_approximate", lambda s, d: knn.approximate_join(fused(s, d), 0.4))
add("knn_distance_stats", lambda s, d: rounded(knn.distance_stats(knn.knn_join(fused(s, d), k=5)), ["mean", "std", "p50", "p95"]), f"WITH {KNN}, x AS (SELECT 1 - sim AS x FROM top WHERE rank <= 5) SELECT count(*) AS n, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.95), 6) AS p95 FROM x")
add("knn_within_label_rate", lambda s, d: rounded(knn.within_label_rate(knn.knn_join(fused(s, d), k=5), fused(s, d)), ["within_label_rate"]), f"WITH {KNN}, e AS (SELECT src, avg(CASE WHEN a.label = b.label THEN 1.0 ELSE 0.0 END) AS r FROM top JOIN fused a ON a.item_id = src JOIN fused b ON b.item_id = dst WHERE rank <= 5 GROUP BY 1) SELECT round(avg(r), 6) AS within_label_rate, count(*) AS n_src FROM e")
add("knn_wide", lambda s, d: rounded(knn.wide(knn.knn_join(fused(s, d), k=3), 3), ["nn_dist1", "nn_dist2", "nn_dist3"]), f"WITH {KNN} SELECT src AS item_id, " + ", ".join(f"max(CASE WHEN rank = {i} THEN dst END) AS nn{i}, round(max(CASE WHEN rank = {i} THEN 1 - sim END), 6) AS nn_dist{i}" for i in (1, 2, 3)) + " FROM top WHERE rank <= 3 GROUP BY 1")
add(
    "neighbours_json",
    lambda s, d: knn.neighbours_json(knn.knn_join(fused(s, d), k=5), 5).select("item_id", F.get_json_object("neighbors_json", "$[0].id").alias("first_id"), F.get_json_object("neighbors_json", "$[4].dist").cast("double").alias("last_dist"), F.get_json_object("neighbors_json", "$[4].weight").cast("double").alias("last_weight")),
    f"WITH {KNN} SELECT src AS item_id, max(CASE WHEN rank = 1 THEN dst END) AS first_id, round(max(CASE WHEN rank = 5 THEN 1 - sim END), 6) AS last_dist, round(exp(-round(max(CASE WHEN rank = 5 THEN 1 - sim END), 6)), 6) AS last_weight FROM top WHERE rank <= 5 GROUP BY 1",
)

# links between clusters
PAIRS = CENTROIDS + """,
cp AS (SELECT a.cluster_id AS s, b.cluster_id AS t, round(list_cosine_similarity(a.vector, b.vector), 6) AS sim FROM cents a JOIN cents b ON a.cluster_id <> b.cluster_id),
cr AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY sim DESC, t) AS rank FROM cp),
links AS (SELECT s AS src_cluster_id, t AS dst_cluster_id, sim AS similarity, CASE (s + t) % 5 WHEN 0 THEN 'same_as' WHEN 1 THEN 'subtype_of' WHEN 2 THEN 'overlaps_with' WHEN 3 THEN 'related_to' ELSE 'unrelated' END AS relationship, round(abs(sim), 6) AS confidence FROM cr WHERE rank <= 4 AND sim >= -1)"""
NAMES = ["same_as", "subtype_of", "overlaps_with", "related_to", "unrelated"]


def made_links(s, d):
    pairs = knn.candidate_pairs(cents(s, d), 4, -1.0)
    rel = F.element_at(F.array(*[F.lit(n) for n in NAMES]), ((F.col("src_cluster_id") + F.col("dst_cluster_id")) % 5 + 1).cast("int"))
    return pairs.withColumns({"relationship": rel, "confidence": F.round(F.abs("similarity"), 6)})


def judged(s, d):
    return links.flags(links.evidence(made_links(s, d), fused(s, d), cents(s, d)))


SETS = PAIRS + """,
sets AS (SELECT cluster_id, list(DISTINCT source) AS sources, list(DISTINCT label) AS labels FROM fused GROUP BY 1),
ev AS (SELECT l.*, len(list_intersect(a.sources, b.sources)) / len(list_distinct(list_concat(a.sources, b.sources))) AS dj, len(list_intersect(a.labels, b.labels)) / len(list_distinct(list_concat(a.labels, b.labels))) AS lj FROM links l JOIN sets a ON a.cluster_id = src_cluster_id JOIN sets b ON b.cluster_id = dst_cluster_id),
fl AS (SELECT *, list_filter([CASE WHEN relationship = 'same_as' AND similarity < 0.75 THEN 'contradiction_same_as_low_sim<0.75' END, CASE WHEN relationship = 'subtype_of' AND similarity < 0.55 THEN 'contradiction_subtype_low_sim<0.55' END,
  CASE WHEN relationship = 'overlaps_with' AND similarity < 0.45 THEN 'contradiction_overlap_low_sim<0.45' END, CASE WHEN relationship = 'unrelated' AND similarity > 0.75 THEN 'contradiction_unrelated_high_sim>0.75' END,
  CASE WHEN similarity < 0.35 AND dj < 0.05 AND lj < 0.05 THEN 'evidence_weak_low_sim_low_overlap' END], lambda x: x IS NOT NULL) AS flags, similarity < 0.35 AND dj < 0.05 AND lj < 0.05 AS more FROM ev)"""
add("candidate_pairs", lambda s, d: knn.candidate_pairs(cents(s, d), 5, 0.05), f"WITH {PAIRS} SELECT s AS src_cluster_id, t AS dst_cluster_id, sim AS similarity FROM cr WHERE rank <= 5 AND sim >= 0.05")
add("nearest_clusters", lambda s, d: rounded(cl.nearest_clusters(cents(s, d), 0, 5), ["similarity"]), f"WITH {CENTROIDS} SELECT b.cluster_id, round(list_cosine_similarity(a.vector, b.vector), 6) AS similarity FROM cents a, cents b WHERE a.cluster_id = 0 ORDER BY list_cosine_similarity(a.vector, b.vector) DESC, b.cluster_id LIMIT 5")
add(
    "link_evidence",
    lambda s, d: rounded(links.evidence(made_links(s, d), fused(s, d), cents(s, d)), ["dataset_overlap_jaccard", "label_overlap_jaccard"]).select("src_cluster_id", "dst_cluster_id", "relationship", "centroid_similarity", "dataset_overlap_jaccard", "label_overlap_jaccard"),
    f"WITH {SETS} SELECT src_cluster_id, dst_cluster_id, relationship, similarity AS centroid_similarity, round(dj, 6) AS dataset_overlap_jaccard, round(lj, 6) AS label_overlap_jaccard FROM ev",
)
add("link_flags", lambda s, d: judged(s, d).select("src_cluster_id", "dst_cluster_id", F.array_join("flags", ";").alias("flags"), "needs_more_evidence"), f"WITH {SETS} SELECT src_cluster_id, dst_cluster_id, array_to_string(flags, ';') AS flags, more AS needs_more_evidence FROM fl")
add("link_flag_rates", lambda s, d: rounded(links.flag_rates(judged(s, d)), ["needs_more_rate"]), f"WITH {SETS} SELECT relationship, count(*) AS n, round(avg(CASE WHEN more THEN 1.0 ELSE 0.0 END), 6) AS needs_more_rate, CAST(sum(CASE WHEN len(flags) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged FROM fl GROUP BY 1")
add("review_order", lambda s, d: links.review_order(made_links(s, d), 3).select("src_cluster_id", "dst_cluster_id", "priority"), f"WITH {PAIRS} SELECT src_cluster_id, dst_cluster_id, CASE relationship WHEN 'same_as' THEN 0 WHEN 'subtype_of' THEN 1 WHEN 'overlaps_with' THEN 2 ELSE 3 END AS priority FROM links ORDER BY priority, confidence DESC, src_cluster_id, dst_cluster_id LIMIT 3")
add(
    "review_override",
    lambda s, d: links.with_review(made_links(s, d), links.review_template(made_links(s, d)).withColumn("human_relationship", F.when(F.col("src_cluster_id") == 1, " Same_As ").otherwise(""))).select("src_cluster_id", "dst_cluster_id", "relationship"),
    f"WITH {PAIRS} SELECT src_cluster_id, dst_cluster_id, CASE WHEN src_cluster_id = 1 THEN 'same_as' ELSE relationship END AS relationship FROM links",
)
add("cross_similarity", lambda s, d: rounded(links.all_cross_similarity(made_links(s, d), fused(s, d)), ["min", "max", "mean", "std", "p05", "p50", "p95"]), f"""WITH {PAIRS}, x AS (SELECT src_cluster_id, dst_cluster_id, list_cosine_similarity(a.vector, b.vector) AS x FROM links JOIN fused a ON a.cluster_id = src_cluster_id JOIN fused b ON b.cluster_id = dst_cluster_id)
    SELECT src_cluster_id, dst_cluster_id, count(*) AS pairs, round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(quantile_cont(x, 0.05), 6) AS p05, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.95), 6) AS p95 FROM x GROUP BY ALL""")
add("unique_names", lambda s, d: links.unique_names(comp(s, d).filter("cluster_id >= 0").groupBy("cluster_id").agg(F.max("label").alias("cluster_name"))), f"WITH {COMPOSITION}, n AS (SELECT cluster_id, max(label) AS name FROM comp WHERE cluster_id >= 0 GROUP BY 1) SELECT cluster_id, CASE WHEN row_number() OVER (PARTITION BY name ORDER BY cluster_id) > 1 THEN name || '-c' || cluster_id ELSE name END AS cluster_name FROM n")
add(
    "response_normalisation",
    lambda s, d: links.normal_response(items(s, d).select("item_id", F.to_json(F.struct(F.concat(F.lit(" "), "label").alias("cluster_name"), F.lit("A, b ,").alias("cluster_keywords"), F.upper(F.lit("same_as")).alias("relationship"), (F.col("n_chars") / 1000).alias("confidence"))).alias("response_json"))).select("item_id", "cluster_name", F.array_join("cluster_keywords", ";").alias("words"), "relationship", "confidence"),
    f"WITH {COMPOSITION} SELECT item_id, label AS cluster_name, 'a;b' AS words, 'same_as' AS relationship, least(1.0, n_chars / 1000) AS confidence FROM items",
)
add(
    "cross_references",
    lambda s, d: links.cross_references(cl.centroids(fused(s, d), normalise=True), fused(s, d).groupBy("cluster_id").agg(F.array_sort(F.collect_set("label")).alias("words")), fused(s, d).groupBy("cluster_id").agg(F.min("source").alias("state")), top=3).select("src", "dst", "relation_type", F.round("weight", 5).alias("weight")),
    f"""WITH {FUSED}, u AS (SELECT cluster_id, i, avg(vector[i] / sqrt(list_inner_product(vector, vector))) AS m FROM fused, range(1, 65) r(i) GROUP BY ALL), c AS (SELECT cluster_id, list(m ORDER BY i) AS v FROM u GROUP BY 1),
    info AS (SELECT cluster_id, list(DISTINCT label) AS w, min(source) AS st FROM fused GROUP BY 1),
    p AS (SELECT a.cluster_id AS src, b.cluster_id AS dst, round(list_cosine_similarity(a.v, b.v), 6) AS sim FROM c a JOIN c b ON a.cluster_id <> b.cluster_id), r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS rank FROM p),
    k AS (SELECT src, dst, sim, rank, len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) AS jac, greatest(0, least(1, (sim + 1) / 2)) AS half, a.st AS sa, b.st AS sb FROM r JOIN info a ON a.cluster_id = src JOIN info b ON b.cluster_id = dst WHERE rank <= 12),
    t AS (SELECT *, CASE WHEN sim >= 0.75 AND sa <> sb THEN 'CONTRASTS_WITH' WHEN sim >= 0.85 THEN 'SIMILAR_TO' WHEN sim >= 0.75 OR jac >= 0.25 THEN 'ASSOCIATED_WITH' END AS kind FROM k),
    o AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY kind IS NULL, rank) AS nth FROM t WHERE kind IS NOT NULL OR rank <= 3)
    SELECT CAST(src AS BIGINT) AS src, CAST(dst AS BIGINT) AS dst, coalesce(kind, 'ASSOCIATED_WITH') AS relation_type, round(round(CASE WHEN kind IS NULL THEN half ELSE 0.8 * half + 0.2 * jac END, 6), 5) AS weight FROM o WHERE nth <= 3""",
)

def stable_groups(s, d):
    """Vectors drawn apart by their label: the most stable clusters are the labels."""
    apart = F.concat(vx.unit("vector"), F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (i == F.col("cluster_id")).cast("double") * 3))
    return density.stable_clusters(fused(s, d).select("item_id", apart.alias("vector")), 3, 12, 8, levels=4)


add(
    "stable_clusters",
    stable_groups,
    f"WITH {FUSED}, g AS (SELECT cluster_id AS c, count(*) AS n, min(item_id) AS least FROM fused GROUP BY 1), c AS (SELECT c, CAST(row_number() OVER (ORDER BY n DESC, least) - 1 AS INTEGER) AS k FROM g) SELECT item_id, k AS cluster_id FROM fused JOIN c ON c = cluster_id",
)
add(
    "density_clusters",
    lambda s, d: density.density_clusters(fused(s, d), 1.16, 3, 4, 6),
    f"""WITH RECURSIVE {KNN}, nb AS (SELECT src, dst, rank, sqrt(greatest(0, 2 - 2 * sim)) AS d FROM top WHERE rank <= 6), core AS (SELECT src AS node, d AS c FROM nb WHERE rank = 3),
    e AS (SELECT src, dst FROM nb JOIN core a ON a.node = src JOIN core b ON b.node = dst WHERE greatest(d, a.c, b.c) <= 1.16), u AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e),
    reach AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM reach r JOIN u ON r.b = u.a), comp AS (SELECT item_id, least(item_id, coalesce(min(b), item_id)) AS k FROM fused LEFT JOIN reach ON a = item_id GROUP BY item_id),
    z AS (SELECT k, count(*) AS n FROM comp GROUP BY 1 HAVING count(*) >= 4), r AS (SELECT k, CAST(row_number() OVER (ORDER BY n DESC, k) - 1 AS INTEGER) AS cluster_id FROM z) SELECT item_id, coalesce(cluster_id, -1) AS cluster_id FROM comp LEFT JOIN r USING (k)""",
)
