"""Links between clusters: evidence, flags, cross references, memoised calls, review."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.vectors import cosine, doubles, jaccard, unit

#: Allowed relations, and the similarity below (above, for unrelated) which each is contradicted.
RELATIONS = ("same_as", "subtype_of", "overlaps_with", "related_to", "unrelated")
SAME_AS, SUBTYPE, OVERLAP, UNRELATED = 0.75, 0.55, 0.45, 0.75
WEAK_SIMILARITY, WEAK_OVERLAP = 0.35, 0.05


def normal_relation(c: Column) -> Column:
    name = F.trim(F.lower(F.coalesce(c, F.lit(""))))
    return F.when(name.isin(*RELATIONS), name).otherwise(F.lit("related_to"))


def members_of(items: DataFrame, column: str) -> DataFrame:
    """cluster_id and the sorted distinct values of column in it."""
    return items.groupBy("cluster_id").agg(F.array_sort(F.collect_set(F.col(column).cast("string"))).alias(column))


def cross_similarity(links: DataFrame, items: DataFrame, sample: int = 50, seed: int = 1337) -> DataFrame:
    """src_cluster_id, dst_cluster_id, pairs, min, max, mean, std, p05, p50, p95 of the cosines between `sample` items of either cluster, chosen by a hash."""
    w = Window.partitionBy("cluster_id").orderBy(F.xxhash64("item_id", F.lit(seed)), "item_id")
    chosen = items.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= sample).select("cluster_id", doubles("vector").alias("v"))
    keys = ["src_cluster_id", "dst_cluster_id"]
    a = chosen.select(F.col("cluster_id").alias("src_cluster_id"), F.col("v").alias("a"))
    b = chosen.select(F.col("cluster_id").alias("dst_cluster_id"), F.col("v").alias("b"))
    x = links.select(*keys).distinct().join(a, "src_cluster_id").join(b, "dst_cluster_id").select(*keys, cosine("a", "b").alias("s"))
    q = F.percentile("s", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    out = x.groupBy(*keys).agg(F.count("s").alias("pairs"), F.min("s").alias("min"), F.max("s").alias("max"), F.avg("s").alias("mean"), F.stddev_pop("s").alias("std"), q.alias("q"))
    return out.select(*keys, "pairs", "min", "max", "mean", "std", *[F.col("q")[i].alias(n) for i, n in enumerate(("p05", "p50", "p95"))])


def all_cross_similarity(links: DataFrame, items: DataFrame, block_rows: int = 1024, bins: int = 4096) -> DataFrame:
    """cross_similarity over all pairs of items of either cluster, exactly: clusters of links in blocks, each pair of blocks one matrix product.

    The first pass leaves counts and sums in bins of the cosine; ranks say in which bins the percentiles lie, and the second pass leaves
    the distinct values of those bins with their counts. Null vectors are in no pair.
    """
    import numpy as np
    import pyarrow as pa

    from orrery.llm.common import small_batches
    from orrery.sources.io import ensure_checkpoint_dir

    small_batches(items.sparkSession)
    ensure_checkpoint_dir(items.sparkSession)
    keys = ["src_cluster_id", "dst_cluster_id"]
    kind = items.schema["cluster_id"].dataType.simpleString()
    links = links.select(*[F.col(k).cast(kind).alias(k) for k in keys]).distinct()
    sizes = items.groupBy("cluster_id").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("__n"))
    ready = items.filter("vector IS NOT NULL").select("cluster_id", "item_id", unit(doubles("vector")).alias("v")).join(sizes, "cluster_id").withColumn("block", F.pmod(F.xxhash64("item_id"), F.col("__n")))
    packed = ready.groupBy("cluster_id", "block").agg(F.transform(F.sort_array(F.collect_list(F.struct("item_id", "v"))), lambda x: x["v"]).alias("m")).checkpoint()
    a = packed.select(F.col("cluster_id").alias(keys[0]), F.col("m").alias("a"))
    b = packed.select(F.col("cluster_id").alias(keys[1]), F.col("m").alias("b"))

    def cosines(batch, r):
        x, y = (np.stack([np.asarray(v) for v in batch.column(batch.schema.get_field_index(c))[r].as_py()]) for c in "ab")
        sim = np.clip(np.round(x @ y.T, 12).ravel(), -1, 1) + 0.0
        return sim, np.minimum(((sim + 1) * (bins / 2)).astype(np.int64), bins - 1)

    def rows_of(batch, r, columns, names):
        own = [batch.column(batch.schema.get_field_index(k)).take(pa.array([r] * len(columns[0]))) for k in keys]
        return pa.RecordBatch.from_arrays([*own, *(pa.array(c) for c in columns)], names=[*keys, *names])

    def counted(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                sim, at = cosines(batch, r)
                there, inverse, n = np.unique(at, return_inverse=True, return_counts=True)
                low, high = np.full(len(there), 2.0), np.full(len(there), -2.0)
                np.minimum.at(low, inverse, sim)
                np.maximum.at(high, inverse, sim)
                yield rows_of(batch, r, [there, n, np.bincount(inverse, sim), np.bincount(inverse, sim * sim), low, high], ["bin", "n", "s", "q", "low", "high"])

    def within(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                sim, at = cosines(batch, r)
                chosen = sim[np.isin(at, batch.column(batch.schema.get_field_index("bins"))[r].as_py())]
                value, n = np.unique(chosen, return_counts=True)
                yield rows_of(batch, r, [value, n], ["value", "n"])

    head = f"src_cluster_id {kind}, dst_cluster_id {kind}"
    pairs = links.join(a, keys[0]).join(b, keys[1])
    per = pairs.mapInArrow(counted, f"{head}, bin long, n long, s double, q double, low double, high double").groupBy(*keys, "bin")
    per = per.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.min("low").alias("low"), F.max("high").alias("high")).checkpoint()
    total = per.groupBy(*keys).agg(F.sum("n").alias("pairs"), F.min("low").alias("min"), F.max("high").alias("max"), (F.sum("s") / F.sum("n")).alias("mean"), (F.sum("q") / F.sum("n")).alias("__q"))
    shares = (("p05", 0.05), ("p50", 0.5), ("p95", 0.95))
    ranks = total.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("name"), (F.col("pairs") - 1).cast("double").alias("last"), F.lit(q).alias("share")) for n, q in shares])).alias("w")).select(*keys, "w.name", (F.col("w.last") * F.col("w.share")).alias("at"))
    ranks = ranks.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))))
    line = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = per.select(*keys, "bin", F.col("n").alias("__n"), F.coalesce(F.sum("n").over(line), F.lit(0)).alias("ahead"))
    ranks = ranks.join(placed, keys).filter("rank >= ahead AND rank < ahead + __n").checkpoint()
    needed = ranks.groupBy(*keys).agg(F.array_sort(F.collect_set("bin")).alias("bins"))
    values = pairs.join(needed, keys).mapInArrow(within, f"{head}, value double, n long").groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    values = values.withColumn("bin", F.least(F.floor((F.col("value") + 1) * (bins / 2)), F.lit(bins - 1)))
    inside = Window.partitionBy(*keys, "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    met = ranks.join(values, [*keys, "bin"]).filter("rank - ahead >= before AND rank - ahead < before + n")
    low, high = F.min_by("value", "rank"), F.max_by("value", "rank")
    found = met.groupBy(*keys, "name").agg((low + (high - low) * (F.first("at") - F.floor(F.first("at")))).alias("x"))
    found = found.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, F.col("x"))).alias(n) for n, _ in shares])
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("__q") - F.col("mean") * F.col("mean"))).alias("std")
    return total.join(found, keys).select(*keys, "pairs", "min", "max", "mean", std, *[n for n, _ in shares])


def evidence(links: DataFrame, items: DataFrame, centroids: DataFrame | None = None, dataset_col: str = "source", label_col: str = "label") -> DataFrame:
    """links with relationship, confidence, centroid_similarity, dataset_overlap_jaccard, label_overlap_jaccard. Two empty sets overlap fully."""
    out = links.withColumns({"relationship": F.lower(F.trim(F.coalesce("relationship", F.lit("related_to")))), "confidence": F.coalesce(F.col("confidence").try_cast("double"), F.lit(0.0)), "centroid_similarity": F.col("similarity").try_cast("double")})
    empty = F.array().cast("array<string>")
    for column, name in ((dataset_col, "dataset_overlap_jaccard"), (label_col, "label_overlap_jaccard")):
        sets = members_of(items.filter(F.col(column).isNotNull()), column)
        for side in ("src", "dst"):
            out = out.join(sets.select(F.col("cluster_id").alias(f"{side}_cluster_id"), F.col(column).alias(f"__{side}")), f"{side}_cluster_id", "left")
        out = out.withColumn(name, jaccard(F.coalesce("__src", empty), F.coalesce("__dst", empty), 1.0)).drop("__src", "__dst")
    if centroids is not None:
        for side in ("src", "dst"):
            out = out.join(centroids.select(F.col("cluster_id").alias(f"{side}_cluster_id"), doubles("vector").alias(f"__{side}")), f"{side}_cluster_id", "left")
        out = out.withColumn("centroid_similarity", F.coalesce("centroid_similarity", F.when(F.col("__src").isNotNull() & F.col("__dst").isNotNull(), cosine("__src", "__dst")))).drop("__src", "__dst")
    return out


def flags(with_evidence: DataFrame) -> DataFrame:
    """with_evidence plus flags (contradictions of relation and similarity) and needs_more_evidence. A NaN similarity is there, and contradicts nothing."""
    s = F.col("centroid_similarity")
    is_number = s.isNotNull() & ~F.isnan(s)
    rel = F.col("relationship")
    weak = is_number & (s < WEAK_SIMILARITY) & (F.col("dataset_overlap_jaccard") < WEAK_OVERLAP) & (F.col("label_overlap_jaccard") < WEAK_OVERLAP)
    raised = F.array(
        F.when(s.isNull(), "missing_centroid_similarity"),
        F.when(is_number & (rel == "same_as") & (s < SAME_AS), f"contradiction_same_as_low_sim<{SAME_AS}"),
        F.when(is_number & (rel == "subtype_of") & (s < SUBTYPE), f"contradiction_subtype_low_sim<{SUBTYPE}"),
        F.when(is_number & (rel == "overlaps_with") & (s < OVERLAP), f"contradiction_overlap_low_sim<{OVERLAP}"),
        F.when(is_number & (rel == "unrelated") & (s > UNRELATED), f"contradiction_unrelated_high_sim>{UNRELATED}"),
        F.when(weak, "evidence_weak_low_sim_low_overlap"),
    )
    return with_evidence.withColumns({"flags": F.filter(raised, lambda x: x.isNotNull()), "needs_more_evidence": s.isNull() | weak})


def flag_rates(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("relationship").agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce("needs_more_evidence", F.lit(True)).cast("double")).alias("needs_more_rate"), F.sum((F.size("flags") > 0).cast("long")).alias("n_flagged"))


def review_order(links: DataFrame, top: int = 3) -> DataFrame:
    """The links to look at first: same_as, subtype_of, overlaps_with, others; then by confidence."""
    priority = F.when(F.col("relationship") == "same_as", 0).when(F.col("relationship") == "subtype_of", 1).when(F.col("relationship") == "overlaps_with", 2).otherwise(3)
    return links.withColumn("priority", priority).orderBy("priority", F.desc("confidence"), "src_cluster_id", "dst_cluster_id").limit(top)


def review_template(links: DataFrame) -> DataFrame:
    return links.withColumns({c: F.lit("") for c in ("human_decision", "human_relationship", "human_notes")})


def with_review(links: DataFrame, reviewed: DataFrame) -> DataFrame:
    """links in which a reviewer's relationship, where given, replaces the other."""
    keys = ["src_cluster_id", "dst_cluster_id"]
    given = reviewed.select(*keys, F.when(F.trim("human_relationship") != "", normal_relation(F.col("human_relationship"))).alias("__human"))
    return links.join(given, keys, "left").withColumn("relationship", F.coalesce("__human", "relationship")).drop("__human")


def signature(*parts: Column) -> Column:
    """sha256 of the parts' JSON: the evidence a call depends on."""
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])).cast("binary"), 256)


def cluster_prompt(summary: DataFrame) -> Column:
    return F.concat_ws("\n", F.lit("Name and describe this cluster."), F.concat(F.lit("cluster_id: "), F.col("cluster_id").cast("string")), F.concat(F.lit("n_items: "), F.col("n_items").cast("string")), F.concat(F.lit("dominant_labels: "), F.to_json("dominant_labels")), F.lit("Return JSON only."))


def latest(memory: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last record of each key."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return memory.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def memoised(requests: DataFrame, memory: DataFrame, call: Callable[[Iterator], Iterator], keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(answers of all requests, memory with the new ones). call: a mapInPandas function from requests' columns to memory's, run for keys not in memory alone."""
    known = memory.dropDuplicates(keys)
    misses = requests.join(known.select(*keys), keys, "left_anti")
    fresh = misses.mapInPandas(call, memory.schema)
    grown = memory.unionByName(fresh)
    return requests.select(*keys).join(known.unionByName(fresh).dropDuplicates(keys), keys, "left"), grown


def normal_response(rows: DataFrame) -> DataFrame:
    """rows of response_json as cluster_name, cluster_description, cluster_keywords, relationship, confidence (0 to 1, 0.5 where none)."""
    get = lambda k: F.get_json_object("response_json", f"$.{k}")
    words = F.coalesce(F.from_json(get("cluster_keywords"), "array<string>"), F.split(F.coalesce(get("cluster_keywords"), F.lit("")), ","))
    words = F.filter(F.transform(words, lambda w: F.trim(F.lower(w))), lambda w: w != "")
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(get("confidence").try_cast("double"), F.lit(0.5))))
    return rows.withColumns({"cluster_name": F.trim(F.lower(F.coalesce(get("cluster_name"), F.lit("")))), "cluster_description": F.trim(F.coalesce(get("cluster_description"), F.lit(""))), "cluster_keywords": words, "relationship": normal_relation(get("relationship")), "confidence": confidence})


def unique_names(rows: DataFrame, order: str = "cluster_id") -> DataFrame:
    """rows with cluster_name in lower case, never empty, and unique: later ones of a name get "-c" and their id."""
    name = F.trim(F.lower(F.coalesce("cluster_name", F.lit(""))))
    name = F.when(name == "", F.concat(F.lit("cluster-c"), F.col("cluster_id").cast("string"))).otherwise(name)
    named = rows.withColumn("__n", name)
    nth = F.row_number().over(Window.partitionBy("__n").orderBy(order))
    return named.withColumn("cluster_name", F.when(nth > 1, F.concat("__n", F.lit("-c"), F.col("cluster_id").cast("string"))).otherwise(F.col("__n"))).drop("__n")


def cross_references(cents: DataFrame, keywords: DataFrame, states: DataFrame, top: int = 8, strict: float = 0.85, loose: float = 0.75) -> DataFrame:
    """src, dst, relation_type, weight, similarity: at most `top` of the max(2 * top, 12) nearest clusters of each.

    cents: cluster_id, unit vector. keywords: cluster_id, words. states: cluster_id, state. SIMILAR_TO from strict, ASSOCIATED_WITH from loose or a keyword Jaccard of
    0.25; CONTRASTS_WITH where similar clusters differ in state. Fewer than top: filled with the nearest others, ASSOCIATED_WITH.
    """
    from orrery.operators.knn import knn_join

    near = knn_join(cents.select(F.col("cluster_id").cast("long").alias("item_id"), "vector"), k=max(2 * top, 12))
    info = keywords.join(states, "cluster_id", "left").select(F.col("cluster_id").cast("long").alias("id"), "words", "state")
    for side in ("src", "dst"):
        near = near.join(info.select(F.col("id").alias(side), F.col("words").alias(f"{side}_w"), F.col("state").alias(f"{side}_s")), side)
    jac = jaccard("src_w", "dst_w", 0.0)
    half = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("sim") + 1) / 2))
    near = near.withColumns({"jac": jac, "half": half})
    kind = F.when((F.col("sim") >= loose) & (F.col("src_s") != F.col("dst_s")), "CONTRASTS_WITH").when(F.col("sim") >= strict, "SIMILAR_TO").when((F.col("sim") >= loose) | (F.col("jac") >= 0.25), "ASSOCIATED_WITH")
    near = near.withColumn("kind", kind)
    # first the related ones in order, then the others among the nearest `top`
    order = Window.partitionBy("src").orderBy(F.col("kind").isNull(), "rank")
    near = near.filter(F.col("kind").isNotNull() | (F.col("rank") <= top)).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= top)
    weight = F.when(F.col("kind").isNull(), F.col("half")).otherwise(0.8 * F.col("half") + 0.2 * F.col("jac"))
    return near.select("src", "dst", F.coalesce("kind", F.lit("ASSOCIATED_WITH")).alias("relation_type"), F.round(weight, 6).alias("weight"), F.col("sim").alias("similarity"))


def json_call(call, prompt: str, attempts: int = 3, pause: float = 1.0, sleep=time.sleep) -> dict:
    """The JSON object in what call(prompt) answers: the answer itself or its outermost braces. A failure is tried again after a pause that grows each time.

    RuntimeError with the last cause after `attempts` failures.
    """
    last: Exception | None = None
    for attempt in range(1, attempts + 1):
        try:
            answer = (call(prompt) or "").strip()
            inner = answer[answer.find("{") : answer.rfind("}") + 1]
            for candidate in (answer, inner):
                try:
                    found = json.loads(candidate)
                except ValueError:
                    continue
                if isinstance(found, dict):
                    return found
            raise ValueError("no JSON object in the answer")
        except Exception as error:  # whatever the service throws
            last = error
            if attempt < attempts:
                sleep(pause * attempt)
    raise RuntimeError(f"no answer after {attempts} attempts: {last}") from last
