"""Edge cases of the operators on rows made by hand."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery import schemas
from orrery.functions import text as tx
from orrery.functions import vectors as vx
from orrery.operators import clusters as cl
from orrery.operators import critic, eda, embed, export, graph, knn, links, registry, sampling, stats
from orrery.plans import stages
from orrery.sources import datasets, images, io


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_noise_alone_has_no_purity(spark):
    comp = cl.composition(frame(spark, [("a", -1), ("b", -1)], "item_id string, cluster_id int"), frame(spark, [("a", "x"), ("b", "y")], "item_id string, label string"))
    assert rows(cl.purity(comp)) == [(None,)]
    assert rows(cl.dominant_label(comp)) == []
    assert rows(eda.noise_ratio(frame(spark, [(-1,), (-1,)], "cluster_id int"))) == [(1.0,)]


def test_label_ties_go_by_name(spark):
    comp = cl.composition(frame(spark, [(i, 1) for i in "abcd"], "item_id string, cluster_id int"), frame(spark, list(zip("abcd", "BABA")), "item_id string, label string"))
    assert rows(cl.dominant_label(comp)) == [(1, 4, "A", 0.5)]
    assert cl.name_by_composition(comp).first()["cluster_name"] == "C1: A + B"


def test_missing_labels_count_as_empty(spark):
    comp = cl.composition(frame(spark, [("a", 1), ("b", 1)], "item_id string, cluster_id int"), frame(spark, [("a", None)], "item_id string, label string"))
    assert rows(comp) == [(1, "", 2, 1.0)]
    assert cl.name_by_composition(comp).first()["cluster_name"] == "C1: (mixed)"


def test_histogram_edges(spark):
    one = eda.numeric_hist(frame(spark, [(3.0,), (3.0,), (None,)], "x double"), "x", 4)
    assert rows(one, "bin") == [("x", 0, 2.5, 2.75, 0), ("x", 1, 2.75, 3.0, 0), ("x", 2, 3.0, 3.25, 2), ("x", 3, 3.25, 3.5, 0)]
    top = eda.numeric_hist(frame(spark, [(0.0,), (1.0,), (4.0,)], "x double"), "x", 4)
    assert [r[4] for r in rows(top, "bin")] == [1, 1, 0, 1]


def test_iqr_needs_four_values(spark):
    assert rows(eda.outlier_iqr(frame(spark, [(1.0,), (2.0,), (3.0,)], "x double"), "x")) == [("x", 3, None, None, None)]


def link_rows(spark, similarity, relation="same_as"):
    items = frame(spark, [("a", 1, "s", "l"), ("b", 2, "t", "m")], "item_id string, cluster_id int, source string, label string")
    made = frame(spark, [(1, 2, similarity, relation, 0.5)], "src_cluster_id int, dst_cluster_id int, similarity double, relationship string, confidence double")
    return links.flags(links.evidence(made, items)).first()


def test_link_flags(spark):
    assert link_rows(spark, None)["flags"] == ["missing_centroid_similarity"]
    assert link_rows(spark, None)["needs_more_evidence"]
    assert link_rows(spark, math.nan)["flags"] == [] and not link_rows(spark, math.nan)["needs_more_evidence"]
    assert link_rows(spark, 0.8, "unrelated")["flags"] == ["contradiction_unrelated_high_sim>0.75"]
    weak = link_rows(spark, 0.1, "related_to")
    assert weak["flags"] == ["evidence_weak_low_sim_low_overlap"] and weak["needs_more_evidence"]


def test_jaccard_of_nothing(spark):
    e = F.array().cast("array<string>")
    one = spark.range(1).select(vx.jaccard(e, e, 1.0), vx.jaccard(e, e, 0.0), vx.jaccard(e, F.array(F.lit("a")), 1.0)).first()
    assert tuple(one) == (1.0, 0.0, 0.0)


def test_neighbours_of_equal_and_zero_vectors(spark):
    v = frame(spark, [("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [1.0, 0.0]), ("z", [0.0, 0.0])], "item_id string, vector array<double>")
    found = rows(knn.knn_join(v, k=2), "src", "rank")
    assert found[:4] == [("a", "b", 1, 1.0), ("a", "c", 2, 1.0), ("b", "a", 1, 1.0), ("b", "c", 2, 1.0)]
    assert all(s != d for s, d, *_ in found)
    assert [x[3] for x in found if x[0] == "z"] == [0.0, 0.0]


def test_neighbours_over_blocks(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8))
    v = frame(spark, [(f"{i:02}", r.tolist()) for i, r in enumerate(x)], "item_id string, vector array<double>")
    assert rows(knn.knn_join(v, k=3, block_rows=7)) == rows(knn.knn_join(v, k=3))


def test_ragged_vectors(spark):
    v = frame(spark, [("a", [1.0, 2.0, 3.0]), ("b", [1.0, 2.0, math.nan]), ("c", [1.0, 2.0]), ("d", None)], "item_id string, vector array<double>")
    assert embed.modal_dim(v) == 3
    fixed = rows(v.select("item_id", vx.fit_dim("vector", 3).alias("v")))
    assert [r[1] for r in fixed] == [[1.0, 2.0, 3.0], [1.0, 2.0, 0.0], [1.0, 2.0, 0.0], [0.0, 0.0, 0.0]]
    result = critic.run_critic(v.filter("vector IS NOT NULL"), "s", "g", min_rows=1, vector_col="vector")
    assert any("inconsistent" in f for f in result.fails)


@pytest.mark.parametrize(("text", "vector"), [("[1, 2.5]", [1.0, 2.5]), ("(1 2,3)", [1.0, 2.0, 3.0]), ("", None), ("1 x", None), ("\n1\t2", [1.0, 2.0])])
def test_vector_texts(spark, text, vector):
    assert frame(spark, [(text,)], "t string").select(vx.parse_vector("t")).first()[0] == vector


def test_name_collisions(spark):
    named = links.unique_names(frame(spark, [(1, "X"), (2, "x "), (3, "x"), (4, None)], "cluster_id int, cluster_name string"))
    assert rows(named, "cluster_id") == [(1, "x"), (2, "x-c2"), (3, "x-c3"), (4, "cluster-c4")]


def test_components_and_health(spark):
    e = frame(spark, [("a", "b", "r"), ("a", "b", "q"), ("c", "d", "r")], "src string, dst string, rel string")
    nodes = frame(spark, [(x,) for x in "abcde"], "node string")
    assert rows(graph.components(e, nodes)) == [("a", "a"), ("b", "a"), ("c", "c"), ("d", "c"), ("e", "e")]
    h = graph.health(e, nodes).first()
    assert (h["n_components"], h["n_orphans"], h["n_edges"], h["n_nodes"]) == (3, 1, 2, 5)


def test_long_chain_is_one_component(spark):
    e = frame(spark, [(i, i + 1) for i in range(200)], "src long, dst long")
    assert graph.components(e).select("component").distinct().collect()[0][0] == 0


def test_cycles(spark):
    e = frame(spark, [("a", "b"), ("b", "a"), ("b", "c"), ("c", "a"), ("d", "d")], "src string, dst string")
    assert sorted(r[0] for r in graph.cycles(e, 4).collect()) == [["a", "b"], ["a", "b", "c"], ["d"]]


def test_cycles_of_any_length(spark):
    ring = [(i, (i + 1) % 8) for i in range(8)]
    e = frame(spark, [*ring, (0, 4), (9, 0), (7, 10), (10, 11)], "src int, dst int")
    assert sorted(r[0] for r in graph.cycles(e).collect()) == [[0, 1, 2, 3, 4, 5, 6, 7], [0, 4, 5, 6, 7]]
    assert graph.cycles(frame(spark, [(0, 1), (1, 2), (0, 2)], "src int, dst int")).collect() == []


def test_degree_sum(spark):
    e = frame(spark, [("a", "b"), ("a", "c"), ("b", "c")], "src string, dst string")
    assert graph.degrees(e).agg(F.sum("degree")).first()[0] == 6


def test_critic_rules(spark):
    df = frame(spark, [("a", 1.0, None), ("a", math.inf, "x"), (None, 2.0, None)], "id string, x double, y string")
    r = critic.run_critic(df, "s", "g", required_cols=["id", "z"], id_col="id", min_rows=3, key_nonnull_cols=["id"], finite_cols=["x"])
    assert [f.split(":")[0] for f in r.fails] == ["missing_required_columns", "id_not_unique", "key_column_has_nulls", "non_finite_values"]
    assert [w.split(":")[0] for w in r.warnings] == ["high_missingness", "high_missingness"]
    assert critic.issue_table(spark, [r]).count() == 6


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "m")
    frame(spark, [("s", "a", "2020-01-01T00:00:00Z")], "stage string, artifact string, created_at_utc string").write.parquet(path)
    registry.register(spark, path, "s", "a", "/x", extra_json={"k": 1})
    found = registry.load(spark, path)
    assert found.count() == 2 and len(found.columns) == 14
    last = registry.latest_outputs(found, ["stage", "artifact"], [F.desc("created_at_utc")]).first()
    assert last["path"] == "/x" and last["extra_json"] == '{"k": 1}'


def test_stages_run_once_and_gates_stop(spark, tmp_path):
    calls = []

    def double(t):
        calls.append(1)
        return {"out": t["base"].select((F.col("id") * 2).alias("id"))}

    stage = stages.Stage("one", ["base"], ["out"], double, after=[lambda t: critic.run_critic(t["out"], "one", "checkpoint", min_rows=3)])
    root = str(tmp_path)
    tables, results = stages.run(spark, [stage], {"base": spark.range(3)}, root)
    assert sorted(r[0] for r in tables["out"].collect()) == [0, 2, 4] and results[0].passed
    stages.run(spark, [stage], {"base": spark.range(3)}, root)
    assert len(calls) == 1
    with pytest.raises(stages.GateFailed):
        stages.run(spark, [stage], {"base": spark.range(2)}, root, rebuild=True)


def test_schema_validation(spark):
    df = frame(spark, [("a", "x", 1)], "item_id string, cluster_id string, more int")
    assert schemas.validate(df, "clusters") == ["column cluster_id: string is not int"]
    assert "unexpected column: more" in schemas.validate(df, "clusters", strict=True)


def test_text_columns(spark):
    one = frame(spark, [("a  b", None, "l")], "caption string, notes string, label string")
    assert tx.with_text(one).first()["text"] == "a b"
    assert tx.with_text(one.select("label")).first()["text"] == "l"
    assert "Source=." in tx.with_text(one.select(F.lit(1).alias("k"))).first()["text"]
    with pytest.raises(ValueError, match="missing columns"):
        tx.require_columns(one, ["zzz"])


def test_ks_against_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=200), rng.normal(0.5, size=150)
    got = stats.ks_two_sample(frame(spark, [(float(x),) for x in a], "x double"), frame(spark, [(float(x),) for x in b], "x double")).first()
    grid = np.sort(np.concatenate([a, b]))
    want = np.abs(np.searchsorted(np.sort(a), grid, side="right") / 200 - np.searchsorted(np.sort(b), grid, side="right") / 150).max()
    assert got["statistic"] == pytest.approx(want) and 0 <= got["p_value"] < 0.01
    small = stats.ks_two_sample(frame(spark, [(1.0,)], "x double"), frame(spark, [(1.0,)], "x double")).first()
    assert small["statistic"] is None


def test_yates_for_two_by_two(spark):
    data = [("a", "x")] * 10 + [("a", "y")] * 5 + [("b", "x")] * 3 + [("b", "y")] * 12
    got = stats.chi2_contingency(frame(spark, data, "p string, q string"), "p", "q").first()
    assert got["statistic"] == pytest.approx(4.8869, abs=1e-3) and got["dof"] == 1


def test_permutation_test_sees_a_shift(spark):
    a = frame(spark, [(float(i),) for i in range(40)], "x double")
    b = frame(spark, [(float(i + 30),) for i in range(40)], "x double")
    assert stats.permutation_test(a, b, n_perm=100).first()["p_value"] < 0.05


def test_samples_are_stable(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    assert rows(sampling.sample(df, "id", 10)) == rows(sampling.sample(df.repartition(7), "id", 10))
    assert sampling.stratified(df, "id", "g", 10).count() == 10


def test_image_headers_and_items(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (7).to_bytes(4, "big") + (5).to_bytes(4, "big")
    (tmp_path / "TUM").mkdir()
    (tmp_path / "TUM" / "a.png").write_bytes(png)
    (tmp_path / "TUM" / "b.jpg").write_bytes(b"nothing")
    got = rows(images.items_from_folder(spark, str(tmp_path), "S", "train").select("item_id", "width", "height", "text"))
    assert got == [("S::train::TUM::a", 7, 5, "Histopathology patch. Dataset=S. Split=train. TileSize=7x5. MPP=0.500."), ("S::train::TUM::b", -1, -1, "Histopathology patch. Dataset=S. Split=train. TileSize=-1x-1. MPP=0.500.")]


def test_pixel_features(spark):
    x = np.zeros((8, 8, 3), np.uint8)
    x[:4] = 200
    f = images.pixel_features(x)
    assert f["mean_r"] == 100 and f["tissue_coverage"] == 0.5
    assert np.linalg.norm(images.histogram_vector(x)) == pytest.approx(1) and len(images.histogram_vector(x)) == 54
    found = images.features_of(frame(spark, [("a", bytearray(x.tobytes())), ("b", None)], "item_id string, content binary"), lambda b: np.frombuffer(b, np.uint8).reshape(8, 8, 3))
    assert [(r["item_id"], r["morph_error"], r["mean_g"]) for r in found.orderBy("item_id").collect()] == [("a", 0, 100.0), ("b", 1, None)]


def test_csv_and_json(spark, tmp_path):
    df = frame(spark, [(1, ["a", "b"], 'say "x",\ny')], "k int, v array<string>, t string")
    io.save_csv(df, str(tmp_path / "c"))
    assert rows(io.read_csv(spark, str(tmp_path / "c"), "k int, v string, t string")) == [(1, '["a","b"]', 'say "x",\ny')]
    io.save_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 1


def test_graph_exports(spark, tmp_path):
    nodes = frame(spark, [("item:1", "ITEM", 'a "q"', None)], "entity_id string, entity_type string, name string, description string")
    edges = frame(spark, [("item:1", "cluster:1", "IN_CLUSTER", 0.5), ("item:1", "cluster:2", "IN_CLUSTER", 0.5)], "src string, dst string, rel string, weight double")
    t = {tuple(r) for r in export.triples(nodes, edges, "u:").collect()}
    assert ("<u:item:1>", "<u:HAS_FEATURE>", "<u:cluster:1>") in t and ("<u:item:1>", "<u:name>", '"a \\"q\\""') in t
    assert sum(p == "<u:weight>" for _, p, _ in t) == 1
    export.write_graph_csv(nodes, edges, str(tmp_path / "g"))
    assert spark.read.option("header", True).csv(str(tmp_path / "g/rels")).columns == [":START_ID", ":END_ID", ":TYPE", "weight"]


def test_export_problems(spark):
    df = frame(spark, [("1", "t", "", "l", "{", [1.0], math.nan, 0.0, 1, '[{"target_cluster_id": 1}]')], "id string, title string, body string, labels string, metadata string, vector array<double>, x double, y double, cluster_id int, cluster_xref string")
    assert {r[0] for r in critic.export_problems(df, 1).collect()} == {"non_finite_x", "invalid_json_metadata", "empty_body", "self_link"}


def test_catalog_runs_what_it_can(spark):
    items = frame(spark, [("a", "x")], "item_id string, label string")
    out = eda.run_catalog([{"name": "n1", "fn": "label_distribution", "inputs": {"items": "items"}}, {"name": "n2", "fn": "nothing"}, {"name": "n3", "fn": "label_distribution", "inputs": {"items": "gone"}}], {"items": items})
    assert [(n, s) for n, s, _ in out] == [("n1", "ok"), ("n2", "skipped"), ("n3", "error")]
    assert "result" in eda.payload("n1", {"fn": "x"}, out[0][2]).first()[0]


def test_dataset_registry(spark):
    r = datasets.Registry()
    r.add("k", lambda s, n: s.range(n), "p", "t")
    assert r.load(spark, "k", n=3).count() == 3 and rows(r.catalog(spark)) == [("k", "p", "t", "")]
    with pytest.raises(ValueError, match="unknown dataset"):
        r.load(spark, "z")


def test_memoised_calls_only_misses(spark):
    requests = frame(spark, [(1, "s1"), (2, "s2")], "cluster_id int, signature string")
    memory = frame(spark, [(1, "s1", "old")], "cluster_id int, signature string, answer string")

    def call(frames):
        for f in frames:
            yield f.assign(answer="new")

    answers, grown = links.memoised(requests, memory, call, ["cluster_id", "signature"])
    assert rows(answers) == [(1, "s1", "old"), (2, "s2", "new")] and grown.count() == 2


def test_streamed_manifest(spark, tmp_path):
    from orrery.streaming.manifest import keep_latest, manifest_stream

    for i in range(3):
        registry.register(spark, str(tmp_path / "m"), "s", f"a{i % 2}", f"/p{i}")
    keep_latest(manifest_stream(spark, str(tmp_path / "m"), 1), str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination()
    last = max(int(p.name) for p in (tmp_path / "state").iterdir())
    assert spark.read.parquet(str(tmp_path / "state" / str(last))).count() == 2


def test_plot_index(spark, tmp_path):
    path = str(tmp_path / "plots")
    a = registry.add_plot(spark, path, "s", "t", "/p.png", ["x"])
    assert registry.add_plot(spark, path, "s", "t", "/p.png", is_core=True) == a
    assert registry.plots(spark, path).count() == 1


def test_catalog_items_are_run(spark):
    import json

    items = frame(spark, [("a", "x"), ("b", "x")], "item_id string, label string")
    boom = lambda items: items.select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    spec = [{"name": "good", "fn": "label_distribution", "inputs": {"items": "items"}}, {"name": "bad", "fn": "boom", "inputs": {"items": "items"}}, {"name": "none", "fn": "nothing"}]
    out = {n: (status, json.loads(text)) for n, status, _, text in eda.evaluated(spec, {"items": items}, functions=eda.FUNCTIONS | {"boom": boom})}
    assert out["good"][0] == "ok" and out["good"][1]["result"] == [{"value": "x", "n": 2}]
    assert out["bad"][0] == "error" and "boom" in out["bad"][1]["reason"] and out["none"][0] == "skipped"


def test_rows_are_numbered_without_gaps(spark):
    rows = frame(spark, [(str(i % 900), [float(i), 1.0]) for i in range(1000)], "item_id string, vector array<double>")
    got = [tuple(r) for r in embed.numbered_by_hash(rows, 1337, 3).orderBy("i").collect()]
    assert [i for _, i in got] == list(range(1000))
    want = rows.orderBy(F.xxhash64("item_id", F.lit(1337)), "item_id", "vector").collect()
    assert [v for v, _ in got] == [r["vector"] for r in want]
    assert got == [tuple(r) for r in embed.numbered_by_hash(rows.repartition(7), 1337, 12).orderBy("i").collect()]


def test_sampled_pairs_of_many_rows(spark):
    n = 2_000_000
    rows = spark.range(n).select(F.col("id").cast("string").alias("item_id"), F.array((F.col("id") % 97).cast("double"), F.lit(1.0)).alias("vector"))
    assert embed.pair_cosine_stats(rows).first()["pairs"] == 2000


def test_health_counts_every_part(spark):
    from orrery.plans import catalog

    data = "/root/testdata/sf0.001"
    parts = spark.read.parquet(f"{data}/part.parquet").count()
    assert catalog.queries()["graph_health_whole"](spark, data).first()["n_orphans"] == parts > 3


def test_cross_similarity_takes_all_pairs(spark, tmp_path):
    from orrery.plans import q_cluster

    r = np.random.default_rng(3)
    group = [i % 8 if i < 200 else 0 for i in range(1500)]
    vectors = r.normal(size=(1500, 4)).astype(np.float32) + np.eye(8, 4, dtype=np.float32)[group]
    vectors[7] = 0
    made = [(i, [float(x) for x in v], g) for i, (v, g) in enumerate(zip(vectors, group, strict=True))]
    frame(spark, made, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = q_cluster.Q["cross_similarity"](spark, str(tmp_path)).collect()
    norm = np.linalg.norm(vectors.astype(float), axis=1)
    unit = vectors / np.maximum(norm, 1e-12)[:, None]
    assert len(got) > 8 and max(x["pairs"] for x in got) == 1325 * 25
    for x in got:
        s = (unit[np.array(group) == x["src_cluster_id"]] @ unit[np.array(group) == x["dst_cluster_id"]].T).ravel()
        want = [len(s), s.min(), s.max(), s.mean(), s.std(), *np.quantile(s, [0.05, 0.5, 0.95])]
        assert np.allclose([x[c] for c in ("pairs", "min", "max", "mean", "std", "p05", "p50", "p95")], want, atol=2e-6)


def test_exports_hold_whole_texts(spark, tmp_path):
    import duckdb

    from orrery.plans import catalog

    texts = ['a "b" \\ c', "two\nlines\r\nand $1 \\n", None, "", "größer 😀\t" + "long, " * 20_000]
    frame(spark, [(i, t, "en", f"src{i % 2}", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    frame(spark, [(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    for name in ("export_nodes_whole", "export_triples_whole"):
        result = con.execute(catalog.oracle_sql()[name])
        columns = [c[0] for c in result.description]
        got = [tuple(r[c] for c in columns) for r in catalog.queries()[name](spark, str(tmp_path)).collect()]
        assert sorted(got) == sorted(result.fetchall())
    nodes = catalog.queries()["export_nodes_whole"](spark, str(tmp_path)).filter("`:LABEL` = 'ITEM'")
    assert {r["name"]: r["description"] for r in nodes.collect()} == {str(i): t or "" for i, t in enumerate(texts)}


def test_permutations_keep_the_sizes_of_both_sides(spark):
    """All 252 choices of 5 of 10 values (each twice) by brute force, against many shufflings."""
    import itertools

    a, b = [1.0, 2.0, 3.0, 4.0, 9.0] * 2, [2.0, 5.0, 6.0, 7.0, 8.0] * 2
    values = a + b
    frame = lambda v: spark.createDataFrame([(x,) for x in v], "x double")
    r = stats.permutation_test(frame(a), frame(b), n_perm=4000).first()
    gap = abs(sum(a) / 10 - sum(b) / 10)
    total = sum(values)
    draws = [sum(c) for c in itertools.combinations(values, 10)]
    exact = sum(abs(s / 10 - (total - s) / 10) >= gap - 1e-9 for s in draws) / len(draws)
    assert (r["n_a"], r["n_b"]) == (10, 10) and r["statistic"] == pytest.approx(-(gap))
    assert r["p_value"] == pytest.approx(exact, abs=0.03)
    assert stats.permutation_test(frame(a), frame(b), n_perm=50).first() == stats.permutation_test(frame(a).repartition(3), frame(b), n_perm=50).first()
    # equal sides: no shuffling is closer
    assert stats.permutation_test(frame(a), frame(a), n_perm=50).first()["p_value"] == 1.0
    assert stats.permutation_test(frame(a[:3]), frame(b)).first()["p_value"] is None


def test_running_sums_over_ranges(spark):
    from orrery.operators.lines import average_ranks, codes, running

    rows = [(float(i * 7 % 50), i) for i in range(300)] + [(None, 1)]
    df = spark.createDataFrame(rows, "x double, n int").repartition(3)
    distinct = df.groupBy("x").agg(F.sum("n").alias("n"))
    got = sorted(((r["x"], r["upto"]) for r in running(distinct, ["x"], {"upto": "n"}).collect()), key=lambda t: (t[0] is not None, t[0]))
    total, want = 0, []
    for x in [None, *sorted({r[0] for r in rows if r[0] is not None})]:
        total += sum(n for v, n in rows if v == x)
        want.append((x, total))
    assert got == want
    assert [r[1] for r in sorted(((r["x"], r["code"]) for r in codes(df.filter("x IS NOT NULL"), "x", "code").collect()))] == list(range(50))
    ranks = {r["x"]: r["rank"] for r in average_ranks(df.filter("x IS NOT NULL"), "x").collect()}
    assert ranks[0.0] == 3.5 and ranks[49.0] == 297.5
    assert codes(df.limit(0), "x", "code").collect() == []


def test_every_pair_of_blocks_meets_once(spark):
    from orrery.operators.knn import paired

    left = spark.createDataFrame([(i,) for i in range(11)], "block int")
    right = spark.createDataFrame([(i,) for i in range(7)], "block int")
    assert sorted(map(tuple, paired(left, right).select("block_l", "block_r").collect())) == [(i, j) for i in range(11) for j in range(7)]
    assert sorted(map(tuple, paired(left).select("block_l", "block_r").collect())) == [(i, j) for i in range(11) for j in range(11)]


def test_recall_of_the_approximate_join(spark):
    r = np.random.default_rng(8)
    centres = r.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + r.normal(scale=0.1, size=16)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "item_id long, vector array<double>")
    v = np.array([x for _, x in rows])
    v /= np.linalg.norm(v, axis=1)[:, None]
    true = {(i, j) for i, j in zip(*np.nonzero(v @ v.T >= 0.9)) if i < j}
    got = {(x["src"], x["dst"]) for x in knn.approximate_join(df, 0.9).collect()}
    assert len(true) > 1000 and got <= true | {p for p in got if (v @ v.T)[p] > 0.9 - 1e-6} and len(got & true) >= 0.9 * len(true)


def test_kendall_against_all_pairs(spark):
    from orrery.operators.kendall import kendall

    r = np.random.default_rng(5)
    x, y = r.integers(0, 12, 300), r.integers(0, 9, 300)
    y = np.where(r.random(300) < 0.5, x // 2, y)
    sign = np.sign(x[:, None] - x[None]) * np.sign(y[:, None] - y[None])
    tied = lambda v: ((v[:, None] == v[None]).sum() - 300) / 2
    every = 300 * 299 / 2
    want = sign.sum() / 2 / ((every - tied(x)) * (every - tied(y))) ** 0.5
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(x, y)] + [(None, 1), (2, None)], "a int, b int")
    assert kendall(df, "a", "b", 3) == pytest.approx(want)
    assert kendall(df.withColumn("c", F.lit(1)), "a", "c") is None and kendall(df.limit(0), "a", "b") is None
    got = {(t["a"], t["b"]): t["r"] for t in eda.correlations(df, method="kendall").collect()}
    assert got["a", "b"] == got["b", "a"] == round(want, 4) and got["a", "a"] == 1.0


def test_catalog_from_yaml(spark, tmp_path):
    from orrery.plans import eda_catalog

    text = """
items:
- {name: h, fn: numeric_hist, inputs: {morph: morph_df}, kwargs: {col: a, bins: 4}}
- {name: c, fn: morph_corr, inputs: {morph: morph_df}, kwargs: {method: spearman}}
- {name: g, fn: morph_group_stats, inputs: {morph: morph_df}}
- {name: n, fn: embedding_nn_distance_stats, inputs: {emb: fused_df}, kwargs: {k: 2}}
- {name: v, fn: embedding_pca_variance, inputs: {emb: fused_df}, kwargs: {n_components: 2}}
- {name: p, fn: cluster_label_purity, inputs: {items: items_df, clusters: clusters_df}}
- {name: m, fn: clustering_metrics, inputs: {fused: fused_df, clusters: clusters_df}}
- {name: u, fn: nothing_known}
- {name: e, fn: label_distribution, inputs: {items: absent_df}}
"""
    (tmp_path / "c.yaml").write_text(text)
    v = [[1.0, 0.0, 0.1], [0.9, 0.1, 0.0], [0.0, 1.0, 0.2], [0.1, 0.9, 0.0]]
    tables = {
        "morph_df": frame(spark, [(str(i), "x" if i < 2 else "y", float(i), float(i * i)) for i in range(4)], "item_id string, label string, a double, b double"),
        "fused_df": frame(spark, [(str(i), v[i]) for i in range(4)], "item_id string, vector array<double>"),
        "items_df": frame(spark, [(str(i), "xy"[i // 2]) for i in range(4)], "item_id string, label string"),
        "clusters_df": frame(spark, [(str(i), i // 2) for i in range(4)], "item_id string, cluster_id int"),
    }
    got = {n: (status, result) for n, status, _, result in eda.evaluated(eda.read_catalog(str(tmp_path / "c.yaml")), tables, None, eda_catalog.FUNCTIONS)}
    assert {n: s for n, (s, _) in got.items()} == {**dict.fromkeys("hcgnvpm", "ok"), "u": "skipped", "e": "error"}, got
    assert '"r":1.0' in got["c"][1] and '"purity":1.0' in got["p"][1].replace(" ", "")


def test_json_call_tries_again():
    answers, pauses = iter([RuntimeError("busy"), "no braces", 'so: {"a": {"b": 1}} and on']), []

    def call(_):
        x = next(answers)
        if isinstance(x, Exception):
            raise x
        return x

    assert links.json_call(call, "p", 3, 2.0, pauses.append) == {"a": {"b": 1}} and pauses == [2.0, 4.0]
    with pytest.raises(RuntimeError, match="after 2 attempts: no JSON"):
        links.json_call(lambda _: "[1]", "p", 2, 0, pauses.append)


def test_run_state_log_and_health(spark, tmp_path):
    from orrery.runtime import Run, Unhealthy

    run = Run(spark, str(tmp_path / "run"))
    assert run.state().collect() == [] and not run.done("one")
    with run.step("one", stage="s", rows=3):
        pass
    with pytest.raises(ValueError), run.step("two"):
        raise ValueError("broken")
    again = Run(spark, str(tmp_path / "run"))
    assert again.done("one") and not again.done("two")
    last = {r["step"]: r for r in again.state().collect()}
    assert last["two"]["status"] == "error" and "broken" in last["two"]["detail"] and last["one"]["duration_s"] >= 0
    assert again.health_check({"t": 1}, ["t"], [str(tmp_path)])["free_gb"] > 0
    with pytest.raises(Unhealthy, match="no table u; no path"):
        again.health_check({}, ["u"], [str(tmp_path / "absent")])


def test_stages_run_again_for_other_inputs(spark, tmp_path):
    runs = []

    def double(t):
        runs.append(1)
        return {"out": t["in"].select((F.col("x") * 2).alias("x"))}

    stage = stages.Stage("s", ["in"], ["out"], double)
    path = str(tmp_path / "in")
    spark.range(3).withColumnRenamed("id", "x").write.parquet(path)
    go = lambda df: sorted(r[0] for r in stages.run(spark, [stage], {"in": df}, str(tmp_path / "root"))[0]["out"].collect())
    assert go(spark.read.parquet(path)) == go(spark.read.parquet(path)) == [0, 2, 4] and len(runs) == 1
    assert go(spark.read.parquet(path).filter("x > 0")) == [2, 4] and len(runs) == 2
    spark.range(5, 7).withColumnRenamed("id", "x").write.mode("overwrite").parquet(path)
    assert go(spark.read.parquet(path)) == [10, 12] and len(runs) == 3
    memory = spark.createDataFrame([(1,), (2,)], "x long")
    assert go(memory) == go(spark.createDataFrame([(2,), (1,)], "x long")) == [2, 4] and len(runs) == 4
    assert go(spark.createDataFrame([(3,)], "x long")) == [6] and len(runs) == 5


def png(pixels, colour, depth=8, palette=None, filters=(0, 1, 2, 3, 4)):
    """A PNG written line by line with the filters in turn."""
    import struct
    import zlib

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    height, width = pixels.shape[:2]
    raw = pixels.reshape(height, -1).astype(">u2" if depth == 16 else np.uint8).view(np.uint8).reshape(height, -1).astype(int)
    step = raw.shape[1] // width
    out, above = b"", np.zeros(raw.shape[1], int)
    for y, line in enumerate(raw):
        left, corner = np.append(np.zeros(step, int), line)[: len(line)], np.append(np.zeros(step, int), above)[: len(line)]
        p = left + above - corner
        by = np.abs(np.stack([p - left, p - above, p - corner]))
        paeth = np.choose(by.argmin(0), [left, above, corner])
        kind = filters[y % len(filters)]
        out += bytes([kind]) + ((line - [0 * line, left, above, (left + above) // 2, paeth][kind]) % 256).astype(np.uint8).tobytes()
        above = line
    head = struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, 0)
    extra = chunk(b"PLTE", palette.astype(np.uint8).tobytes()) if palette is not None else b""
    return images.PNG_HEAD + chunk(b"IHDR", head) + extra + chunk(b"IDAT", zlib.compress(out)) + chunk(b"IEND", b"")


def test_png_and_image_operators(spark, tmp_path):
    r = np.random.default_rng(1)
    rgb = r.integers(0, 256, (11, 7, 3))
    assert (images.decode_png(png(rgb, 2)) == rgb).all()
    rgba = r.integers(0, 256, (6, 5, 4))
    assert (images.decode_png(png(rgba, 6)) == rgba[..., :3]).all()
    gray = r.integers(0, 256, (5, 9, 1))
    assert (images.decode_png(png(gray, 0)) == gray).all()
    deep = r.integers(0, 1 << 16, (5, 4, 3))
    assert (images.decode_png(png(deep, 2, 16)) == deep >> 8).all()
    palette, index = r.integers(0, 256, (9, 3)), r.integers(0, 9, (4, 6, 1))
    assert (images.decode_png(png(index, 3, 8, palette)) == palette[index[..., 0]]).all()
    for broken in (b"", b"GIF89a", png(rgb, 2)[:60]):
        with pytest.raises(Exception):
            images.decode_png(broken)
    (tmp_path / "a.png").write_bytes(png(rgb, 2))
    (tmp_path / "b.png").write_bytes(b"broken")
    items = frame(spark, [(n, f"file:{tmp_path}/{n}.png") for n in "ab"], "item_id string, image_path string")
    found = images.contents(spark, items)
    vectors = {x["item_id"]: x for x in images.histogram_embeddings(found).collect()}
    assert np.allclose(vectors["a"]["vector"], images.histogram_vector(rgb), atol=1e-6) and vectors["a"]["dim"] == 54 and not any(vectors["b"]["vector"])
    features = {x["item_id"]: x for x in images.features_of(found).collect()}
    assert features["a"]["mean_r"] == pytest.approx(rgb[..., 0].mean()) and features["b"]["morph_error"] == 1 and features["b"]["mean_r"] is None


def test_density_sweep_gives_a_row_for_each_setting(spark):
    r = np.random.default_rng(2)
    centres = r.normal(size=(3, 6)) * 5
    rows_ = [(str(i), (centres[i % 3] + r.normal(scale=0.05, size=6)).tolist()) for i in range(45)]
    members, labels = frame(spark, rows_, "item_id string, vector array<double>"), frame(spark, [(str(i), f"l{i % 3}") for i in range(45)], "item_id string, label string")
    got = cl.density_sweep(members, labels, [2], [5], [4], [3], 0.8)
    best = cl.best_run(got).first()
    assert got.count() == 1 and best["purity"] == 1.0 and best["n_clusters"] >= 2


def test_load_script_has_a_statement_for_each_relation():
    script = export.load_script(["IN_CLUSTER", "SIMILAR_TO"])
    assert script.count("LOAD CSV") == 3 and script.index("CONSTRAINT") < script.index("LOAD CSV") and "MERGE (s)-[x:`SIMILAR_TO`]->(t)" in script


def test_tfidf_svd_against_numpy(spark):
    r = np.random.default_rng(6)
    terms = [f"w{i}" for i in range(12)]
    docs = frame(spark, [(f"d{i:02d}", " ".join(r.choice(terms, 9))) for i in range(30)], "item_id string, text string")
    cells = embed.tfidf(docs, max_features=12, most=1).collect()
    a = np.zeros((30, 12))
    for x in cells:
        a[int(x["id"][1:]), terms.index(x["term"])] = x["tfidf"]
    want = a @ np.linalg.svd(a, full_matrices=False)[2][:4].T
    want /= np.linalg.norm(want, axis=1)[:, None]
    got = np.array([x["vector"] for x in embed.tfidf_svd(docs, dims=4, max_features=12, most=1).orderBy("item_id").collect()])
    assert np.allclose(got @ got.T, want @ want.T, atol=1e-6)  # axes are free in sign, cosines are not


def test_explained_variance_against_numpy(spark):
    x = np.random.default_rng(7).normal(size=(60, 5)) * [5, 3, 2, 1, 0.5]
    got = embed.explained_variance(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)], "item_id long, vector array<double>"), 5).orderBy("component").collect()
    ratio = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.allclose([g["ratio"] for g in got], ratio / ratio.sum()) and abs(got[-1]["cumulative"] - 1) < 1e-9


def test_density_sweep_without_a_cut(spark):
    r = np.random.default_rng(9)
    members = frame(spark, [(f"n{i:02d}", (np.eye(3)[i % 3] + r.normal(scale=0.02, size=3)).tolist()) for i in range(36)], "item_id string, vector array<double>")
    labels = frame(spark, [(f"n{i:02d}", f"g{i % 3}") for i in range(36)], "item_id string, label string")
    one = cl.density_sweep(members, labels, [2], [6], [8], [3], levels=3).first()
    assert (one["n_clusters"], one["noise_ratio"], one["purity"]) == (3, 0.0, 1.0)
