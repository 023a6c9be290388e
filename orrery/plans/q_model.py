"""Queries: embeddings, text features, tests, models, joins, registry, windows over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions import vectors as vx
from orrery.operators import embed, registry, stats
from orrery.plans.relations import FUSED, ITEMS, fused, items
from orrery.sources.io import table
from orrery.streaming.manifest import windowed_counts

Q: dict = {}
SQL: dict[str, str] = {}


def add(name, fn, sql=None):
    Q[name] = fn
    if sql:
        SQL[name] = sql


def rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


add(
    "tfidf",
    lambda s, d: rounded(embed.tfidf(table(s, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("item_id"), "text"), max_features=200), ["tfidf"], 5),
    r"""WITH w AS (SELECT conv_id || '-' || turn AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}') AS w FROM conversations),
    t AS (SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w), c AS (SELECT id, term, count(*) AS tf FROM t GROUP BY ALL),
    k AS (SELECT term, sum(tf) AS total, count(*) AS df FROM c GROUP BY 1 ORDER BY total DESC, term LIMIT 200), v AS (SELECT id, term, tf, tf * (ln((1 + (SELECT count(*) FROM conversations)) / (1 + df)) + 1) AS v FROM c JOIN k USING (term))
    SELECT id, term, tf, round(v / sqrt(sum(v * v) OVER (PARTITION BY id)), 5) AS tfidf FROM v""",
)
add("tfidf_svd", lambda s, d: embed.tfidf_svd(table(s, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("item_id"), "text"), dims=8, max_features=128).select("item_id", F.transform("vector", lambda x: F.round(F.abs(x), 5)).alias("vector")))
add(
    "standardise",
    lambda s, d: embed.numeric_vectors(table(s, d, "part").withColumn("item_id", F.col("p_partkey").cast("string")), "item_id", ["p_size", "p_retailprice"]).select("item_id", "dim", F.round(F.col("vector")[0], 5).alias("a"), F.round(F.col("vector")[1], 5).alias("b")),
    "SELECT CAST(p_partkey AS VARCHAR) AS item_id, CAST(2 AS BIGINT) AS dim, round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 5) AS a, round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 5) AS b FROM part",
)
add(
    "fuse_modalities",
    lambda s, d: embed.fused([fused(s, d), fused(s, d).filter("label <> 'L4'").select("item_id", F.slice("vector", 1, 2).alias("vector"))]).select("item_id", F.size("vector").alias("dim"), F.round(F.element_at("vector", 66), 5).alias("last")),
    f"WITH {FUSED} SELECT item_id, 66 AS dim, round((vector[2] - avg(vector[2]) OVER ()) / stddev_pop(vector[2]) OVER (), 5) AS last FROM fused WHERE label <> 'L4'",
)
add(
    "weighted_concat",
    lambda s, d: embed.weighted_concat([(fused(s, d), 2.0), (fused(s, d), 0.5)]).select("item_id", F.round(vx.norm("vector"), 6).alias("norm"), F.round(F.element_at("vector", 1), 6).alias("first")),
    f"WITH {FUSED} SELECT item_id, round(sqrt(4.25), 6) AS norm, round(2 * vector[1] / sqrt(list_inner_product(vector, vector)), 6) AS first FROM fused",
)
add("pca_project", lambda s, d: embed.principal(fused(s, d), 2).select("item_id", F.round(F.col("vector")[0], 4).alias("x")))
add("map2d", lambda s, d: embed.map2d(fused(s, d)))
add(
    "align_groups",
    lambda s, d: embed.align_groups(fused(s, d), "source").select("item_id", F.round(F.element_at("vector", 1), 5).alias("first")),
    f"""WITH {FUSED}, x AS (SELECT item_id, source, i, vector[i] AS x FROM fused, range(1, 65) r(i)), g AS (SELECT source, i, avg(x) AS m, stddev_pop(x) AS s FROM x GROUP BY ALL), a AS (SELECT i, avg(x) AS m, stddev_pop(x) AS s FROM x GROUP BY 1),
    y AS (SELECT item_id, x.i, (x - g.m) / (g.s + 1e-12) * a.s + a.m AS y FROM x JOIN g ON g.source = x.source AND g.i = x.i JOIN a ON a.i = x.i) SELECT item_id, round(max(CASE WHEN i = 1 THEN y END) / sqrt(sum(y * y)), 5) AS first FROM y GROUP BY 1""",
)
add(
    "zero_vector_default",
    lambda s, d: items(s, d).select("item_id").join(fused(s, d).filter("label <> 'L1'").select("item_id", "vector"), "item_id", "left").select("item_id", F.round(vx.norm(vx.fit_dim("vector", 64)), 6).alias("norm")),
    f"WITH {FUSED}, {ITEMS} SELECT i.item_id, round(coalesce(sqrt(list_inner_product(vector, vector)), 0), 6) AS norm FROM items i LEFT JOIN (SELECT * FROM fused WHERE label <> 'L1') f ON f.item_id = i.item_id",
)
KS = "WITH x AS (SELECT n_chars AS x, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS a, CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS b FROM documents WHERE lang IN ('en', 'fr')), c AS (SELECT x, sum(a) AS a, sum(b) AS b FROM x GROUP BY 1), r AS (SELECT abs(sum(a) OVER (ORDER BY x) / sum(a) OVER () - sum(b) OVER (ORDER BY x) / sum(b) OVER ()) AS d, sum(a) OVER () AS na, sum(b) OVER () AS nb FROM c)"
KS_P = """, o AS (SELECT max(na) AS na, max(nb) AS nb, max(d) AS d, sqrt(max(na) * max(nb) / (max(na) + max(nb))) AS n FROM r), t AS (SELECT *, (n + 0.12 + 0.11 / n) * d AS t FROM o)
SELECT CAST(na AS BIGINT) AS n_a, CAST(nb AS BIGINT) AS n_b, round(d, 6) AS statistic, round(CASE WHEN t < 0.04 THEN 1 ELSE least(1, greatest(0, 2 * (SELECT sum((CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * t * t)) FROM range(1, 101) u(k)))) END, 6) AS p_value FROM t"""
lang = lambda s, d, l: table(s, d, "documents").filter(F.col("lang") == l).select(F.col("n_chars").alias("x"))  # noqa: E731, E741
add("ks_two_sample", lambda s, d: rounded(stats.ks_two_sample(lang(s, d, "en"), lang(s, d, "fr")).select("n_a", "n_b", "statistic", "p_value"), ["statistic", "p_value"]), KS + KS_P)
add(
    "chi2_contingency",
    lambda s, d: rounded(stats.chi2_contingency(items(s, d), "source", "label"), ["statistic"], 4),
    f"WITH {ITEMS}, c AS (SELECT source AS a, label AS b, count(*) AS o FROM items WHERE source IS NOT NULL AND label IS NOT NULL GROUP BY ALL), g AS (SELECT x.a, y.b, ra, rb, coalesce(o, 0) AS o, (SELECT sum(o) FROM c) AS n FROM (SELECT a, sum(o) AS ra FROM c GROUP BY 1) x CROSS JOIN (SELECT b, sum(o) AS rb FROM c GROUP BY 1) y LEFT JOIN c ON c.a = x.a AND c.b = y.b) SELECT round(sum((o - ra * rb / n) ^ 2 / (ra * rb / n)), 4) AS statistic, (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof, CAST(max(n) AS BIGINT) AS n FROM g",
)
add("permutation_test", lambda s, d: stats.permutation_test(lang(s, d, "en"), lang(s, d, "fr"), n_perm=200))
add(
    "effective_rank",
    lambda s, d: rounded(stats.effective_rank(table(s, d, "part"), "p_retailprice"), ["effective_rank"], 4),
    "WITH p AS (SELECT p_retailprice / sum(p_retailprice) OVER () AS p FROM part WHERE p_retailprice > 0) SELECT round(exp(-sum(p * ln(p + 1e-12))), 4) AS effective_rank FROM p",
)
add("separability", lambda s, d: stats.separability(fused(s, d), "source"))
add("cross_validation", lambda s, d: stats.cross_validated(fused(s, d), "source", folds=3))
add("confusion", lambda s, d: stats.confusion(items(s, d).filter("quality IS NOT NULL"), "quality", "toxic"), f"WITH {ITEMS} SELECT quality AS truth, toxic AS guess, count(*) AS n FROM items WHERE quality IS NOT NULL GROUP BY ALL")

# joins
add("inner_no_loss", lambda s, d: items(s, d).join(table(s, d, "documents").select(F.col("doc_id").cast("string").alias("item_id")), "item_id").agg(F.count(F.lit(1)).alias("n")), "SELECT count(*) AS n FROM documents")
add("left_two_tables", lambda s, d: table(s, d, "documents").join(table(s, d, "labels"), "doc_id", "left").join(table(s, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("cluster_id")), "doc_id", "left").select("doc_id", "quality", "cluster_id"), "SELECT doc_id, quality, e.label AS cluster_id FROM documents LEFT JOIN labels USING (doc_id) LEFT JOIN embeddings e ON e.vec_id = doc_id")
add("align_modalities", lambda s, d: embed.align([fused(s, d).filter("label <> 'L0'"), fused(s, d).filter("label <> 'L1'")]).select("item_id"), f"WITH {FUSED} SELECT item_id FROM fused WHERE label NOT IN ('L0', 'L1')")
add("taxonomy_map", lambda s, d: items(s, d).join(F.broadcast(s.createDataFrame([("en", "English"), ("de", "German")], "label string, label_name string")), "label", "left").select("item_id", F.coalesce("label_name", "label").alias("name")), f"WITH {ITEMS} SELECT item_id, CASE label WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' ELSE label END AS name FROM items")
add("memo_misses", lambda s, d: table(s, d, "events").select("user_id", "event_type").distinct().join(table(s, d, "events").filter("value > 50").select("user_id", "event_type").distinct(), ["user_id", "event_type"], "left_anti"), "SELECT DISTINCT user_id, event_type FROM events EXCEPT SELECT user_id, event_type FROM events WHERE value > 50")

# registry and time
add(
    "latest_outputs",
    lambda s, d: registry.latest_outputs(table(s, d, "events"), ["event_type"], [F.desc("ts"), F.desc("event_id")]).select("event_type", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at")),
    "SELECT event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1",
)
add(
    "table_fingerprint",
    lambda s, d: registry.table_fingerprint(table(s, d, "orders"), ["o_orderkey", "o_orderstatus"], ["o_orderkey"]),
    "SELECT (SELECT count(*) FROM orders) AS n_rows, 6 AS n_cols, sha256(string_agg(o_orderkey || '|' || o_orderstatus, chr(10) ORDER BY o_orderkey)) AS key_sha256 FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000)",
)
add(
    "windowed_counts",
    lambda s, d: rounded(windowed_counts(table(s, d, "events")), ["total"], 4).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")),
    "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
)
add("file_fingerprints", lambda s, d: registry.file_fingerprints(s, f"{d}/region.parquet").select("size", "sha256", "md5"))
