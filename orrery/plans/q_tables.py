"""Queries: tables written to the shared folder and read back, the manifest, samples, fits whose figures SQL can tell."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from orrery.operators import embed, registry, sampling
from orrery.plans.relations import FUSED, ITEMS, fused, items
from orrery.sources import io
from orrery.sources.io import table

Q: dict = {}
SQL: dict[str, str] = {}


def add(name, fn, sql=None):
    Q[name] = fn
    if sql:
        SQL[name] = sql


def place(s, name):
    """A new path in the folder that all executors share."""
    return f"{io.ensure_checkpoint_dir(s)}/{name}-{uuid.uuid4().hex}"


def by_csv(s, d):
    """Whole texts with line ends, quotes, nulls and white space at both ends."""
    path = place(s, "csv")
    rows = items(s, d).select("item_id", F.concat(F.lit(" "), "text", F.lit('\n"a",\\ ')).alias("text"), "quality", F.array("label", "source").alias("both"))
    io.save_csv(rows, path)
    back = io.read_csv(s, path, "item_id string, text string, quality int, both string")
    return back.select("item_id", F.md5("text").alias("hash"), "quality", F.from_json("both", "array<string>")[1].alias("source"))


def by_json(s, d):
    path = place(s, "json")
    io.save_json(items(s, d).select("item_id", "text", "quality"), path)
    return s.read.schema("item_id string, text string, quality int").json(path).select("item_id", F.md5("text").alias("hash"), "quality")


def by_parts(s, d):
    path = place(s, "parts")
    io.save_parquet(items(s, d).select("item_id", "label", "text"), path, ["label"])
    return s.read.parquet(path).select("item_id", "label", F.md5("text").alias("hash"))


def manifest_rows(s, d):
    path = place(s, "manifest")
    for name in ("region", "nation", "region"):
        registry.register(s, path, "load", name, f"{name}.parquet", table(s, d, name))
    every = registry.load(s, path)
    last = registry.latest_outputs(every, ["stage", "artifact"], [F.desc("created_at_utc")])
    return last.select("stage", "artifact", "path", "rows", "cols").crossJoin(every.agg(F.count(F.lit(1)).alias("n_logged")))  # one row


def taxonomy_names(s, d):
    """Labels named by a taxonomy; a code without a name stands for itself."""
    names = io.taxonomy(s, {"labels": {"en": {"name": "English"}, "de": {"name": "German"}, "fr": None}})
    return items(s, d).join(F.broadcast(names), "label", "left").select("item_id", "label_name")  # three rows


def whitened(s, d):
    """Means, variances and products of whitened axes: 0, 1 and 0."""
    v = F.col("vector")
    return embed.principal(fused(s, d), 3, whiten=True).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.round(F.avg(v[i]) + 1, 4).alias(f"mean_{i}") for i in range(3)],
        *[F.round(F.var_samp(v[i]), 4).alias(f"var_{i}") for i in range(3)],
        *[F.round(F.covar_samp(v[i], v[j]) + 1, 4).alias(f"cov_{i}{j}") for i, j in ((0, 1), (0, 2), (1, 2))],
    )


add("csv_round_trip", by_csv, f"WITH {ITEMS} SELECT item_id, md5(' ' || text || chr(10) || '\"a\",\\ ') AS hash, quality, source FROM items")
add("json_round_trip", by_json, f"WITH {ITEMS} SELECT item_id, md5(text) AS hash, quality FROM items")
add("partitioned_round_trip", by_parts, f"WITH {ITEMS} SELECT item_id, label, md5(text) AS hash FROM items")
add("manifest_rows", manifest_rows, "SELECT 'load' AS stage, a AS artifact, a || '.parquet' AS path, CAST(n AS BIGINT) AS rows, CAST(c AS BIGINT) AS cols, CAST(3 AS BIGINT) AS n_logged FROM (SELECT 'region' AS a, count(*) AS n, (SELECT count(*) FROM (DESCRIBE region)) AS c FROM region UNION ALL SELECT 'nation', count(*), (SELECT count(*) FROM (DESCRIBE nation)) FROM nation)")
add("taxonomy_names", taxonomy_names, f"WITH {ITEMS} SELECT item_id, CASE label WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'fr' END AS label_name FROM items")
add("whitened_axes", whitened, "SELECT count(*) AS n, " + ", ".join(f"1.0::DOUBLE AS {c}" for c in ("mean_0", "mean_1", "mean_2", "var_0", "var_1", "var_2", "cov_01", "cov_02", "cov_12")) + " FROM embeddings")
add("file_listing", lambda s, d: io.listing(s, d, "*on.parquet").select(F.element_at(F.split("path", "/"), -1).alias("name"), (F.col("size") > 0).alias("filled")), "SELECT n || '.parquet' AS name, true AS filled FROM (VALUES ('region'), ('nation')) t(n)")

# samples: the first rows by the md5 of id and seed
ORDER = "md5(item_id || ':1337')"
add("simple_sample", lambda s, d: sampling.sample(items(s, d), "item_id", 64).select("item_id"), f"WITH {ITEMS} SELECT item_id FROM items ORDER BY {ORDER}, item_id LIMIT 64")
add(
    "stratified_sample",
    lambda s, d: sampling.stratified(items(s, d), "item_id", "label", 100).select("item_id", "label"),
    f"WITH {ITEMS}, r AS (SELECT item_id, label, row_number() OVER (PARTITION BY label ORDER BY {ORDER}, item_id) AS r FROM items) SELECT item_id, label FROM r WHERE r <= ceil(100 / (SELECT count(*) FROM (SELECT DISTINCT label FROM items))) ORDER BY {ORDER}, item_id LIMIT 100",
)
add("per_group_sample", lambda s, d: sampling.per_group(items(s, d), "item_id", "source", 5).select("item_id", "source"), f"WITH {ITEMS} SELECT item_id, source FROM items QUALIFY row_number() OVER (PARTITION BY source ORDER BY {ORDER}, item_id) <= 5")
