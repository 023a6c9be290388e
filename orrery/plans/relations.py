"""The canonical relations over the driver's tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.vectors import doubles
from orrery.sources.io import table

NOISE = -1


def items(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return docs.join(labels, "doc_id", "left").select(F.col("doc_id").cast("string").alias("item_id"), "source", F.col("lang").alias("label"), "text", "n_chars", "quality", "toxic")


def clusters(spark: SparkSession, d: str) -> DataFrame:
    number = F.when(F.col("source") == "src0", NOISE).otherwise(F.substring("source", 4, 9).cast("int"))
    return table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("item_id"), number.alias("cluster_id"))


def fused(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("item_id"), doubles("embedding").alias("vector"), F.col("label").alias("cluster_id"), F.concat(F.lit("L"), (F.col("vec_id") % 5).cast("string")).alias("label"), F.concat(F.lit("S"), (F.col("vec_id") % 3).cast("string")).alias("source"))


def vector_items(spark: SparkSession, d: str) -> DataFrame:
    return fused(spark, d).select("item_id", "source", "label", F.lit("").alias("text"))


ITEMS = "items AS (SELECT CAST(doc_id AS VARCHAR) AS item_id, source, lang AS label, text, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"
CLUSTERS = "clusters AS (SELECT CAST(doc_id AS VARCHAR) AS item_id, CASE WHEN source = 'src0' THEN -1 ELSE CAST(substr(source, 4) AS INTEGER) END AS cluster_id FROM documents)"
FUSED = "fused AS (SELECT CAST(vec_id AS VARCHAR) AS item_id, CAST(embedding AS DOUBLE[]) AS vector, label AS cluster_id, 'L' || (vec_id % 5) AS label, 'S' || (vec_id % 3) AS source FROM embeddings)"
COMPOSITION = ITEMS + ", " + CLUSTERS + """,
comp0 AS (SELECT cluster_id, coalesce(label, '') AS label, count(*) AS n_items FROM clusters LEFT JOIN items USING (item_id) GROUP BY ALL),
comp AS (SELECT *, n_items / sum(n_items) OVER (PARTITION BY cluster_id) AS frac, row_number() OVER (PARTITION BY cluster_id ORDER BY n_items DESC, label) AS rank FROM comp0)"""
KNN = FUSED + """,
pairs AS (SELECT a.item_id AS src, b.item_id AS dst, round(list_cosine_similarity(a.vector, b.vector), 6) AS sim FROM fused a JOIN fused b ON a.item_id <> b.item_id),
top AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS rank FROM pairs),
knn AS (SELECT src, dst, CAST(rank AS INTEGER) AS rank, sim FROM top WHERE rank <= 5 AND sim >= 0.25)"""
SIM = KNN + """,
sim AS (SELECT src AS src_item_id, dst AS dst_item_id, sim AS weight, a.label AS src_label, b.label AS dst_label FROM knn JOIN fused a ON a.item_id = src JOIN fused b ON b.item_id = dst)"""
CENTROIDS = FUSED + """,
cells AS (SELECT cluster_id, i, avg(vector[i]) AS m FROM fused, range(1, 65) r(i) GROUP BY ALL),
cents AS (SELECT cluster_id, list(m ORDER BY i) AS vector FROM cells GROUP BY ALL)"""


def sha_id(prefix: str, key: str) -> str:
    return f"'{prefix}:' || substr(sha1({key}), 1, 16)"
