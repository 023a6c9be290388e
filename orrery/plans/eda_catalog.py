"""The declarative catalog: which function over which table, built from a few rules."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from orrery.operators import clusters, eda, embed, knn

#: Numeric features and modalities.
FEATURES = ("mean_r", "mean_g", "mean_b", "std_r", "std_g", "std_b", "mean_gray", "std_gray", "tissue_coverage", "blur_var_lap", "sat_mean", "sat_std", "width", "height", "mpp")
FINE = ("mean_gray", "tissue_coverage", "blur_var_lap", "sat_mean")
MODALITIES = ("image", "text", "morph", "fused")


def nn_distance_stats(emb: DataFrame, k: int = 5) -> DataFrame:
    return knn.distance_stats(knn.knn_join(emb, k=k))


def label_purity(members: DataFrame, items: DataFrame) -> DataFrame:
    return clusters.purity(clusters.composition(members, items), None)


def metrics(members: DataFrame, clusters_of: DataFrame | None = None) -> DataFrame:
    """One row: silhouette, Davies-Bouldin, Calinski-Harabasz of members with their clusters, or of vectors and the clusters beside them."""
    from pyspark.sql import functions as F

    if clusters_of is not None:
        members = members.drop("cluster_id").join(clusters_of.select("item_id", "cluster_id"), "item_id")
    return clusters.silhouette(members).agg(F.avg("silhouette").alias("silhouette")).crossJoin(clusters.davies_bouldin(members)).crossJoin(clusters.calinski_harabasz(members))


FUNCTIONS = eda.FUNCTIONS | {
    "embedding_pca_variance": embed.explained_variance,
    "embedding_pairwise_cosine_stats": embed.pair_cosine_stats,
    "embedding_nn_distance_stats": nn_distance_stats,
    "cluster_label_purity": label_purity,
    "clustering_metrics": metrics,
}


def items() -> list[dict]:
    """64 entries: histograms and outliers of every feature, finer and coarser histograms of four, four functions of each modality, ten others."""
    made = partial(dict, kwargs={})
    out = [dict(name=f"hist_{c}", fn="numeric_hist", inputs={"df": "morph"}, kwargs={"cols": c}) for c in FEATURES]
    out += [dict(name=f"iqr_{c}", fn="outlier_iqr", inputs={"df": "morph"}, kwargs={"cols": c}) for c in FEATURES]
    out += [dict(name=f"hist_{c}_{b}", fn="numeric_hist", inputs={"df": "morph"}, kwargs={"cols": c, "bins": b}) for c in FINE for b in (10, 100)]
    for m in MODALITIES:
        out.append(made(name=f"norms_{m}", fn="embedding_norms", inputs={"emb": f"emb_{m}"}))
        out.append(made(name=f"pca_{m}", fn="embedding_pca_variance", inputs={"rows": f"emb_{m}"}) | {"kwargs": {"k": 10}})
        out.append(made(name=f"cosines_{m}", fn="embedding_pairwise_cosine_stats", inputs={"rows": f"emb_{m}"}))
        out.append(made(name=f"neighbours_{m}", fn="embedding_nn_distance_stats", inputs={"emb": f"emb_{m}"}))
    out.append(made(name="labels", fn="label_distribution", inputs={"items": "items"}))
    out.append(made(name="image_sizes", fn="image_size_summary", inputs={"items": "morph"}))
    out.append(made(name="missing_items", fn="missingness", inputs={"df": "items"}))
    out.append(made(name="morph_summary", fn="morph_summary", inputs={"df": "morph"}))
    out.append(made(name="morph_corr", fn="morph_corr", inputs={"df": "morph"}) | {"kwargs": {"cols": list(FINE)}})
    out.append(made(name="morph_by_label", fn="morph_group_stats", inputs={"df": "morph"}) | {"kwargs": {"group_col": "label", "cols": list(FINE)}})
    out.append(made(name="cluster_sizes", fn="cluster_size_distribution", inputs={"clusters": "clusters"}))
    out.append(made(name="cluster_noise", fn="cluster_noise_ratio", inputs={"clusters": "clusters"}))
    out.append(made(name="cluster_purity", fn="cluster_label_purity", inputs={"members": "clusters", "items": "items"}))
    out.append(made(name="cluster_metrics", fn="clustering_metrics", inputs={"members": "members"}))
    return out
