"""Levels of single labels."""

import pytest
from pyspark.sql import functions as F

from orrery.operators import density, ontology


@pytest.mark.parametrize(
    ("key", "label", "want"),
    [
        ("HF_PCAM", "0", ("Lymph Node", "Normal/Benign", "Normal Lymph Node Tissue")),
        ("HF_LC25000", "1__adenocarcinoma", ("Colorectal", "Malignant/Invasive", "Adenocarcinoma")),
        ("HF_LC25000", "benign", ("Generic", "Normal/Benign", "Benign/Normal Tissue")),
        ("HF_BACH", "Invasive_Carcinoma", ("Breast", "Malignant/Invasive", "Invasive Carcinoma")),
        ("HF_BREAKHIS_RCL_7500", "breast__benign__adenosis__40x", ("Breast", "Normal/Benign", "Benign Breast Lesion")),
        ("HF_BREAKHIS_RCL_7500", "breast__malignant__papillary__100x", ("Breast", "Malignant/Invasive", "Papillary Carcinoma")),
        ("ORCA_ORAL_ANNOTATED_100", "OSCC", ("Oral Cavity", "Malignant/Invasive", "Squamous Cell Carcinoma")),
        ("NCT_CRC_HE_100K", "MUS", ("Colorectal", "Structural", "Smooth Muscle")),
        ("x", None, ("Generic", "Unknown State", "Unknown")),
    ],
)
def test_levels(spark, key, label, want):
    df = spark.createDataFrame([("i", key, label, label)], "item_id string, dataset_key string, label string, raw_label string")
    r = ontology.with_levels(df).first()
    assert (r["cluster_l3"], r["cluster_l4"], r["cluster_l5"]) == want
    assert len(r["ontology_path"].split(" > ")) == 7


def test_keys_are_dense(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "ontology_path string")
    assert sorted(tuple(r) for r in ontology.keyed(df).collect()) == [("a", 0), ("b", 1), ("b", 1)]


def test_density_separates_groups(spark):
    rows = [(f"a{i}", [1.0, i * 0.01]) for i in range(8)] + [(f"b{i}", [-1.0, i * 0.01]) for i in range(6)] + [("z", [0.0, -1.0])]
    df = spark.createDataFrame(rows, "item_id string, vector array<double>")
    got = {r[0]: r[1] for r in density.density_clusters(df, 0.2, 2, 3, 6).collect()}
    assert {got[f"a{i}"] for i in range(8)} == {0} and {got[f"b{i}"] for i in range(6)} == {1} and got["z"] == -1
    assert df.select(F.count("*")).first()[0] == len(got)


def plain_stable(edges, nodes, cuts, least, single):
    """Excess of mass over the tree of components at the cuts, by recursion."""

    def parts(members, cut):
        root = {m: m for m in members}

        def up(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b, d in edges:
            if d <= cut and a in root and b in root:
                root[up(a)] = up(b)
        out = {}
        for m in members:
            out.setdefault(up(m), set()).add(m)
        return [p for p in out.values() if len(p) >= least]

    step = [1 / c - (1 / cuts[i + 1] if i + 1 < len(cuts) else 0) for i, c in enumerate(cuts)]

    def best(members, level):
        """Stability of the cluster born here, and the best clusters within: (sum, list)."""
        born, own = members, 0.0
        while True:
            own += len(members) * step[level]
            inner = parts(members, cuts[level - 1]) if level else []
            if len(inner) != 1:
                break
            members, level = inner[0], level - 1
        below = [best(p, level - 1) for p in inner]
        total = sum(t for t, _ in below)
        return (own, [born]) if own >= total else (total, [c for _, cs in below for c in cs])

    top = parts(set(nodes), cuts[-1])
    if len(top) == 1 and not single:
        members, level = top[0], len(cuts) - 1
        while level and len(inner := parts(members, cuts[level - 1])) == 1:
            members, level = inner[0], level - 1
        found = [c for p in (inner if level else []) for c in best(p, level - 1)[1]]
    else:
        found = [c for p in top for c in best(p, len(cuts) - 1)[1]]
    return {frozenset(c) for c in found}


def grouped_items(df):
    out = {}
    for item, cluster in df.collect():
        if cluster >= 0:
            out.setdefault(cluster, set()).add(item)
    assert sorted(out) == list(range(len(out))) and [len(out[c]) for c in sorted(out)] == sorted(map(len, out.values()), reverse=True)
    return {frozenset(c) for c in out.values()}


def test_stable_clusters_against_a_plain_tree(spark):
    import random

    r = random.Random(12)
    nodes = [f"n{i:02d}" for i in range(40)]
    for trial, (least, single) in enumerate([(3, False), (4, True), (2, False)]):
        near = lambda a, b: 0.2 if a // 8 == b // 8 else 0.6 if a // 16 == b // 16 else 1.5
        edges = [(nodes[a], nodes[b], round(near(a, b) * r.uniform(0.5, 1.5), 1 + trial)) for a, b in (sorted(r.sample(range(38), 2)) for _ in range(150))]
        cuts = sorted({d for _, _, d in edges})[:: 1 if trial == 0 else 9] + [3.0]
        got = density.stable_in(spark.createDataFrame(edges, "src string, dst string, reach double"), spark.createDataFrame([(n,) for n in nodes], "node string"), cuts[-8:], least, single)
        assert got.count() == len(nodes)
        assert grouped_items(got) == plain_stable(edges, nodes, cuts[-8:], least, single)


def test_stable_clusters_of_different_density(spark):
    """Two dense groups beside a loose one, and a stray. A group of 15 cannot fall apart into two of 8."""
    import numpy as np

    r = np.random.default_rng(3)
    turn = lambda a: [float(np.cos(a)), float(np.sin(a))]
    angles = [*r.uniform(0, 0.02, 15), *r.uniform(0.1, 0.12, 15), *r.uniform(1.6, 2.4, 15), 3.4]
    df = spark.createDataFrame([(f"n{i:02d}", turn(a)) for i, a in enumerate(angles)], "item_id string, vector array<double>")
    found = grouped_items(density.stable_clusters(df, 3, 8, 8, levels=6))
    assert {frozenset(f"n{i:02d}" for i in range(s, s + 15)) for s in (0, 15)} <= found
    assert density.stable_clusters(df.limit(0)).count() == 0
