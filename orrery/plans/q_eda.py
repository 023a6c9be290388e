"""Queries: exploratory aggregates, projections, text."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions import text as tx
from orrery.functions import vectors as vx
from orrery.operators import critic, eda, embed, pairs, sampling
from orrery.plans.relations import CLUSTERS, FUSED, ITEMS, clusters, fused, items
from orrery.sources.images import class_in_path, split_of
from orrery.sources.io import table, union_all

Q: dict = {}
SQL: dict[str, str] = {}

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def add(name, fn, sql=None):
    Q[name] = fn
    if sql:
        SQL[name] = sql


def rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


add("label_distribution", lambda s, d: eda.label_distribution(items(s, d)), f"WITH {ITEMS} SELECT label AS value, count(*) AS n FROM items GROUP BY 1")
add(
    "image_size_summary",
    lambda s, d: eda.image_size_summary(table(s, d, "part").select(F.col("p_size").alias("width"), F.length("p_name").alias("height"))),
    "SELECT min(p_size) AS width_min, max(p_size) AS width_max, min(length(p_name)) AS height_min, max(length(p_name)) AS height_max, count(*) AS n FROM part",
)
add(
    "missingness",
    lambda s, d: rounded(eda.missingness(items(s, d)), ["missing_frac"]),
    f"""WITH {ITEMS}, m AS (SELECT """
    + ", ".join(f"round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS {c}" for c in ("item_id", "source", "label", "text", "n_chars", "quality", "toxic"))
    + """ FROM items) SELECT name AS "column", missing_frac FROM (UNPIVOT m ON COLUMNS(*) INTO NAME name VALUE missing_frac) LIMIT 50""",
)
add(
    "table_overview",
    lambda s, d: rounded(eda.overview(items(s, d)).drop("dtype"), ["missing_frac"]),
    f"WITH {ITEMS} "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_frac, CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unique FROM items" for c in ("item_id", "source", "label", "text", "n_chars", "quality", "toxic")),
)
LONG = "x AS (" + " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS x, l_returnflag AS g FROM lineitem" for c in FEATURES) + ")"
add(
    "describe",
    lambda s, d: rounded(eda.describe(table(s, d, "lineitem"), FEATURES), ["mean", "std", "min", "p25", "p50", "p75", "max"], 4),
    f'WITH {LONG} SELECT col, count(x) AS "count", round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, round(min(x), 4) AS min, round(quantile_cont(x, 0.25), 4) AS p25, round(quantile_cont(x, 0.5), 4) AS p50, round(quantile_cont(x, 0.75), 4) AS p75, round(max(x), 4) AS max FROM x GROUP BY col',
)
for bins in (10, 30, 100):
    add(
        f"numeric_hist_{bins}",
        lambda s, d, b=bins: rounded(eda.numeric_hist(table(s, d, "lineitem"), FEATURES, b), ["lo", "hi"], 4),
        f"""WITH {LONG}, s AS (SELECT col, min(x) AS a, max(x) AS b FROM x GROUP BY col),
        c AS (SELECT col, CAST(least(floor((x - a) / ((b - a) / {bins})), {bins - 1}) AS INTEGER) AS bin, count(*) AS n FROM x JOIN s USING (col) GROUP BY ALL)
        SELECT s.col, CAST(r.bin AS INTEGER) AS bin, round(a + r.bin * ((b - a) / {bins}), 4) AS lo, round(a + (r.bin + 1) * ((b - a) / {bins}), 4) AS hi, coalesce(n, 0) AS n
        FROM s CROSS JOIN range({bins}) r(bin) LEFT JOIN c ON c.col = s.col AND c.bin = r.bin""",
    )
add(
    "outlier_iqr",
    lambda s, d: rounded(eda.outlier_iqr(table(s, d, "lineitem"), FEATURES), ["outlier_frac", "lo", "hi"], 4),
    f"""WITH {LONG}, q AS (SELECT col, quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.75) AS b FROM x GROUP BY col), e AS (SELECT col, a - 1.5 * (b - a) AS lo, b + 1.5 * (b - a) AS hi FROM q)
    SELECT col, count(*) AS n, round(avg(CASE WHEN x < lo OR x > hi THEN 1.0 ELSE 0.0 END), 4) AS outlier_frac, round(min(lo), 4) AS lo, round(min(hi), 4) AS hi FROM x JOIN e USING (col) GROUP BY col""",
)
add(
    "correlations",
    lambda s, d: eda.correlations(table(s, d, "lineitem"), FEATURES),
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 4) AS r FROM lineitem" for a in FEATURES for b in FEATURES) + ")",
)
add(
    "rank_correlation",
    lambda s, d: eda.correlations(table(s, d, "part"), ["p_size", "p_retailprice"], "spearman"),
    """WITH r AS (SELECT rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2 AS p_size, rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2 AS p_retailprice FROM part)
    SELECT 'p_size' AS a, 'p_size' AS b, round(corr(p_size, p_size), 4) AS r FROM r UNION ALL SELECT 'p_size', 'p_retailprice', round(corr(p_size, p_retailprice), 4) FROM r
    UNION ALL SELECT 'p_retailprice', 'p_size', round(corr(p_size, p_retailprice), 4) FROM r UNION ALL SELECT 'p_retailprice', 'p_retailprice', round(corr(p_retailprice, p_retailprice), 4) FROM r""",
)
add(
    "group_stats",
    lambda s, d: eda.group_stats(table(s, d, "lineitem"), "l_returnflag", FEATURES),
    f'WITH {LONG} SELECT g AS "group", col, count(x) AS "count", round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std FROM x GROUP BY g, col',
)
add(
    "embedding_norms",
    lambda s, d: rounded(eda.embedding_norms(fused(s, d)), ["norm_min", "norm_max", "norm_mean", "norm_std"]),
    f"WITH {FUSED}, n AS (SELECT sqrt(list_inner_product(vector, vector)) AS x, len(vector) AS d FROM fused) SELECT count(*) AS n, max(d) AS dim, round(min(x), 6) AS norm_min, round(max(x), 6) AS norm_max, round(avg(x), 6) AS norm_mean, round(stddev_pop(x), 6) AS norm_std FROM n",
)
add("cluster_sizes", lambda s, d: eda.cluster_sizes(clusters(s, d)), f"WITH {CLUSTERS} SELECT cluster_id, count(*) AS n_items FROM clusters GROUP BY 1")
add(
    "cluster_size_summary",
    lambda s, d: eda.cluster_size_summary(clusters(s, d)),
    f"WITH {CLUSTERS}, z AS (SELECT cluster_id, count(*) AS n FROM clusters GROUP BY 1) SELECT count(*) AS n_clusters, min(n) AS size_min, max(n) AS size_max, CAST(sum(CASE WHEN cluster_id = -1 THEN 1 ELSE 0 END) AS BIGINT) AS n_noise_clusters FROM z",
)
add("noise_ratio", lambda s, d: rounded(eda.noise_ratio(clusters(s, d)), ["noise_ratio"]), f"WITH {CLUSTERS} SELECT round(avg(CASE WHEN cluster_id = -1 THEN 1.0 ELSE 0.0 END), 6) AS noise_ratio FROM clusters")
add(
    "text_length_ecdf",
    lambda s, d: rounded(eda.lengths(table(s, d, "conversations")), ["ecdf"]),
    "WITH c AS (SELECT CAST(length(coalesce(text, '')) AS INTEGER) AS length, count(*) AS n FROM conversations GROUP BY 1) SELECT length, n, round(sum(n) OVER (ORDER BY length) / sum(n) OVER (), 6) AS ecdf FROM c",
)
add(
    "vector_dims",
    lambda s, d: embed.dim_histogram(fused(s, d)),
    f"WITH {FUSED} SELECT CAST(len(vector) AS BIGINT) AS dim, count(*) AS n FROM fused GROUP BY 1",
)
add(
    "duplicate_vectors",
    lambda s, d: rounded(embed.duplicate_vectors(fused(s, d)), ["duplicate_frac"]),
    f"WITH {FUSED} SELECT count(*) AS n, round(1 - count(DISTINCT list_transform(vector, lambda x: round(x, 4))) / count(*), 6) AS duplicate_frac FROM fused",
)
add(
    "pair_cosine_stats",
    lambda s, d: rounded(pairs.all_pair_cosine_stats(fused(s, d)), ["cos_min", "cos_max", "cos_mean", "cos_std", "cos_p01", "cos_p50", "cos_p99"]),
    f"""WITH {FUSED}, p AS (SELECT list_cosine_similarity(a.vector, b.vector) AS s FROM fused a JOIN fused b ON a.item_id < b.item_id)
    SELECT count(*) AS pairs, round(min(s), 6) AS cos_min, round(max(s), 6) AS cos_max, round(avg(s), 6) AS cos_mean, round(stddev_pop(s), 6) AS cos_std, round(quantile_cont(s, 0.01), 6) AS cos_p01, round(quantile_cont(s, 0.5), 6) AS cos_p50, round(quantile_cont(s, 0.99), 6) AS cos_p99 FROM p""",
)
add("sampled_cosine_stats", lambda s, d: embed.pair_cosine_stats(fused(s, d)))
add("pca_variance", lambda s, d: embed.explained_variance(fused(s, d), 10))

# projections, filters, text
add("rename_prefix", lambda s, d: items(s, d).select("item_id", "label").select(*[F.col(c).alias("src_" + c) for c in ("item_id", "label")]), f"WITH {ITEMS} SELECT item_id AS src_item_id, label AS src_label FROM items")
add("range_filter", lambda s, d: items(s, d).filter("n_chars BETWEEN 500 AND 900 AND label = 'en'").select("item_id", "n_chars"), f"WITH {ITEMS} SELECT item_id, n_chars FROM items WHERE n_chars BETWEEN 500 AND 900 AND label = 'en'")
add("membership_filter", lambda s, d: items(s, d).join(table(s, d, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("item_id")), "item_id", "left_semi").select("item_id"), f"WITH {ITEMS} SELECT item_id FROM items WHERE item_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1)")
add("null_filter", lambda s, d: items(s, d).filter("quality IS NOT NULL").select("item_id", "quality"), f"WITH {ITEMS} SELECT item_id, quality FROM items WHERE quality IS NOT NULL")
add(
    "coerced_numbers",
    lambda s, d: table(s, d, "events").select("event_id", tx.number(F.get_json_object("props", "$.k")).alias("k")),
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events",
)
add("fill_defaults", lambda s, d: items(s, d).select("item_id", F.coalesce("quality", F.lit(-1)).alias("quality")), f"WITH {ITEMS} SELECT item_id, coalesce(quality, -1) AS quality FROM items")
add(
    "text_column",
    lambda s, d: tx.with_text(table(s, d, "conversations").select("conv_id", "turn", F.col("role").alias("title"), F.col("text").alias("summary"))).select("conv_id", "turn", F.length("text").alias("n"), F.md5("text").alias("hash")),
    r"""WITH t AS (SELECT conv_id, turn, trim(regexp_replace(concat_ws(' ', role, text), '\s+', ' ', 'g')) AS t FROM conversations) SELECT conv_id, turn, CAST(length(t) AS INTEGER) AS n, md5(t) AS hash FROM t""",
)
add(
    "leakage_scrub",
    lambda s, d: table(s, d, "pages").select("page_id", F.length(tx.scrub_leakage(F.col("html"), "class=")).alias("n")),
    "SELECT page_id, CAST(length(CASE WHEN contains(html, 'class=') THEN '' ELSE html END) AS INTEGER) AS n FROM pages",
)
add(
    "text_entropy_gate",
    lambda s, d: items(s, d).agg(F.count_distinct("text").alias("n_text"), F.count_distinct("label").alias("n_label")).withColumn("include", F.col("n_text") > F.greatest(F.lit(9), F.col("n_label"))),
    f"WITH {ITEMS} SELECT count(DISTINCT text) AS n_text, count(DISTINCT label) AS n_label, count(DISTINCT text) > greatest(9, count(DISTINCT label)) AS include FROM items",
)
add(
    "junk_names",
    lambda s, d: table(s, d, "part").select("p_partkey", tx.junk_name(F.substring("p_name", 1, 6)).alias("junk_name"), tx.short_description(F.col("p_type")).alias("short_desc")),
    "SELECT p_partkey, length(trim(lower(substr(p_name, 1, 6)))) < 3 OR regexp_matches(trim(lower(substr(p_name, 1, 6))), 'unknown|other|misc|artifact|noise|junk|background') AS junk_name, length(trim(p_type)) < 20 AS short_desc FROM part",
)
add("slugs", lambda s, d: table(s, d, "part").select("p_partkey", tx.slug(F.concat_ws(" / ", "p_name", "p_type")).alias("slug")), "SELECT p_partkey, regexp_replace(regexp_replace(lower(trim(p_name || ' / ' || p_type)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM part")
add("hash_ids", lambda s, d: items(s, d).select("item_id", tx.keyed_id("item", F.col("item_id")).alias("entity_id"), F.sha2(F.col("source").cast("binary"), 256).alias("sha"), F.md5("label").alias("md5")), f"WITH {ITEMS} SELECT item_id, 'item:' || substr(sha1(item_id), 1, 16) AS entity_id, sha256(source) AS sha, md5(label) AS md5 FROM items")
add("json_block", lambda s, d: table(s, d, "events").select("event_id", tx.json_block(F.concat(F.lit("say "), "props", F.lit(" end"))).alias("block"), tx.json_valid(F.col("props")).alias("valid")), "SELECT event_id, props AS block, json_valid(props) AS valid FROM events")
add(
    "path_parts",
    lambda s, d: table(s, d, "pages").select("page_id", F.element_at(F.split("url", "/"), -2).alias("folder"), F.regexp_replace(F.element_at(F.split("url", "/"), -1), r"\.[^.]*$", "").alias("stem"), class_in_path(F.col("url")).alias("class"), split_of(F.col("url")).alias("split")),
    r"""SELECT page_id, string_split(url, '/')[-2] AS folder, regexp_replace(string_split(url, '/')[-1], '\.[^.]*$', '') AS stem,
    coalesce(list_filter(string_split(url, '/'), lambda p: p IN ('ADI', 'BACK', 'DEB', 'LYM', 'MUC', 'MUS', 'NORM', 'STR', 'TUM'))[1], 'UNK') AS class, CASE WHEN contains(upper(url), 'VAL') OR suffix(upper(url), '_7K') THEN 'val' ELSE 'train' END AS split FROM pages""",
)
add(
    "vector_parse",
    lambda s, d: fused(s, d).select("item_id", F.round(vx.norm(vx.parse_vector(vx.vector_text("vector"))), 6).alias("norm"), F.size(vx.fit_dim(F.slice("vector", 1, 7), 10)).alias("dim")),
    f"WITH {FUSED} SELECT item_id, round(sqrt(list_inner_product(vector, vector)), 6) AS norm, 10 AS dim FROM fused",
)
add("unit_vectors", lambda s, d: fused(s, d).select("item_id", F.round(F.element_at(vx.unit("vector"), 1), 6).alias("first")), f"WITH {FUSED} SELECT item_id, round(vector[1] / sqrt(list_inner_product(vector, vector)), 6) AS first FROM fused")
add("head_rows", lambda s, d: items(s, d).orderBy("item_id").limit(20).select("item_id", "label"), f"WITH {ITEMS} SELECT item_id, label FROM items ORDER BY item_id LIMIT 20")

# unions and sets
add(
    "union_parts",
    lambda s, d: union_all([table(s, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("bal")), table(s, d, "supplier").select(F.col("s_suppkey").alias("key"))]),
    "SELECT c_custkey AS key, c_acctbal AS bal FROM customer UNION ALL SELECT s_suppkey, NULL FROM supplier",
)
add("distinct_rows", lambda s, d: items(s, d).select("source", "label").distinct(), f"WITH {ITEMS} SELECT DISTINCT source, label FROM items")
add("set_difference", lambda s, d: items(s, d).select("item_id").join(table(s, d, "labels").select(F.col("doc_id").cast("string").alias("item_id")), "item_id", "left_anti"), f"WITH {ITEMS} SELECT item_id FROM items EXCEPT SELECT CAST(doc_id AS VARCHAR) FROM labels")

# checks
add("key_check", lambda s, d: critic.key_check(table(s, d, "lineitem"), "l_orderkey"), "WITH p AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_duplicated FROM p")
add(
    "hierarchy_check",
    lambda s, d: critic.hierarchy_check(table(s, d, "part"), "p_brand", ["p_type", "p_name"]),
    """SELECT p_brand AS "group", 'p_type' AS level, count(DISTINCT p_type) AS n_distinct, CAST(sum(CASE WHEN trim(coalesce(p_type, '')) = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_blank FROM part GROUP BY 1
    UNION ALL SELECT p_brand, 'p_name', count(DISTINCT p_name), CAST(sum(CASE WHEN trim(coalesce(p_name, '')) = '' THEN 1 ELSE 0 END) AS BIGINT) FROM part GROUP BY 1""",
)
add(
    "critic_figures",
    lambda s, d: rounded(critic.figures(items(s, d), "item_id", ["n_chars"]).select("rows", "id_nunique", "missing__quality", "finite__n_chars"), ["missing__quality", "finite__n_chars"]),
    f"WITH {ITEMS} SELECT count(*) AS rows, count(DISTINCT item_id) AS id_nunique, round(avg(CASE WHEN quality IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing__quality, round(avg(CASE WHEN n_chars IS NULL THEN 0.0 ELSE 1.0 END), 6) AS finite__n_chars FROM items",
)
add("critic_issues", lambda s, d: critic.issue_table(s, [critic.run_critic(items(s, d), "items", "checkpoint", required_cols=["item_id", "mpp"], id_col="label", key_nonnull_cols=["quality"], finite_cols=["n_chars"])]).select("stage", "gate", "level", F.regexp_extract("issue", "^([a-z_]+)", 1).alias("issue")), "SELECT 'items' AS stage, 'checkpoint' AS gate, l AS level, i AS issue FROM (VALUES ('fail', 'missing_required_columns'), ('fail', 'id_not_unique'), ('fail', 'key_column_has_nulls'), ('warning', 'high_missingness'), ('warning', 'high_missingness')) t(l, i)")

# windows, samples
add("latest_per_key", lambda s, d: sampling.first_by_order(table(s, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id"), "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
add("factorize", lambda s, d: sampling.factorize(items(s, d), "source", "code").select("item_id", "code"), f"WITH {ITEMS} SELECT item_id, dense_rank() OVER (ORDER BY source) - 1 AS code FROM items")
add("group_mode", lambda s, d: sampling.mode(items(s, d), "source", "label"), f"WITH {ITEMS}, c AS (SELECT source, label AS mode, count(*) AS n FROM items GROUP BY ALL) SELECT source, mode, n FROM c QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, mode) = 1")
add("top_per_group", lambda s, d: sampling.top_per_group(table(s, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "rank"), "SELECT o_custkey, o_orderkey, CAST(row_number() OVER w AS INTEGER) AS rank FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) QUALIFY rank <= 3")
add("per_group_cap", lambda s, d: sampling.per_group(items(s, d), "item_id", "source", 5).groupBy("source").agg(F.count(F.lit(1)).alias("n")), f"WITH {ITEMS} SELECT source, least(count(*), 5) AS n FROM items GROUP BY 1")


def catalog_status(s, d):
    """The whole catalog over stand-in tables, each item run: name, status, n_columns, result (JSON)."""
    from orrery.plans import eda_catalog as ec

    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    line = table(s, d, "lineitem")
    morph = line.select(F.col("l_returnflag").alias("label"), *[F.col(measures[i % 4]).alias(c) for i, c in enumerate(ec.FEATURES)])
    vectors = fused(s, d).select("item_id", "vector", F.size("vector").cast("long").alias("dim"))
    tables = {"morph": morph, "items": items(s, d), "clusters": clusters(s, d), "members": fused(s, d), **{f"emb_{m}": vectors for m in ec.MODALITIES}}
    return s.createDataFrame(eda.evaluated(ec.items(), tables, functions=ec.FUNCTIONS), "name string, status string, n_columns int, result string")


add("eda_catalog", catalog_status)
