"""Figures of all pairs and similar pairs against plain numpy."""

import math

import numpy as np
import pytest

from orrery.operators import knn, pairs


def plain(rows):
    out = []
    for i, (p, a) in enumerate(rows):
        for q, b in rows[i + 1 :]:
            if p is None or q is None or p == q or a is None or b is None:
                continue
            size = np.linalg.norm(a) * np.linalg.norm(b)
            if size == 0 or len(a) == len(b):
                out.append(0.0 if size == 0 else float(np.dot(a, b)) / size)
    return np.array(out)


def test_all_pairs_of_more_rows_than_20_000(spark):
    n, kinds = 20_500, 40
    v = np.random.default_rng(4).normal(size=(kinds, 8))
    df = spark.createDataFrame([(str(i), v[i % kinds].tolist()) for i in range(n)], "item_id string, vector array<double>")
    got = pairs.all_pair_cosine_stats(df).first()
    u = v / np.linalg.norm(v, axis=1)[:, None]
    c = np.bincount(np.arange(n) % kinds)
    i, j = np.triu_indices(kinds)
    s, w = (u @ u.T)[i, j], np.where(i == j, c[i] * (c[i] - 1) // 2, c[i] * c[j])
    order = np.argsort(s)
    upto, total, mean = np.cumsum(w[order]), w.sum(), (s * w).sum() / w.sum()
    want = [s.min(), s.max(), mean, np.sqrt(((s - mean) ** 2 * w).sum() / total), *(s[order][np.searchsorted(upto, (total - 1) * p, "right")] for p in (0.01, 0.5, 0.99))]
    assert got["pairs"] == total == n * (n - 1) // 2 and list(got)[1:] == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("case", ["plain", "copies", "odd", "one", "none"])
def test_all_pairs_of_odd_rows(spark, case):
    v = np.random.default_rng(5).normal(size=(60, 4)).tolist()
    rows = {
        "plain": [(str(i), x) for i, x in enumerate(v)],
        "copies": [(str(i), v[0] if i < 50 else x) for i, x in enumerate(v)],
        "odd": [(str(i // 2), x) for i, x in enumerate(v)] + [("z", [0.0] * 4), ("y", [1.0, 2.0]), ("x", [0.0, 0.0]), ("w", []), ("0", [0.0, 0.0]), (None, v[1]), ("n", None)],
        "one": [("a", v[0])],
        "none": [],
    }[case]
    got = pairs.all_pair_cosine_stats(spark.createDataFrame(rows, "item_id string, vector array<double>").repartition(3)).first()
    s = plain(rows)
    want = [s.min(), s.max(), s.mean(), s.std(), *np.quantile(s, [0.01, 0.5, 0.99])] if len(s) else [None] * 7
    assert got["pairs"] == len(s) and list(got)[1:] == (pytest.approx(want, abs=1e-8) if len(s) else want)


def test_all_pairs_with_nan(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [math.nan, 1.0]), ("d", [1.0, 1.0])]
    got = pairs.all_pair_cosine_stats(spark.createDataFrame(rows, "item_id string, vector array<double>")).first()
    assert got["pairs"] == 6 and got["cos_min"] == 0 and math.isnan(got["cos_max"]) and math.isnan(got["cos_mean"]) and math.isnan(got["cos_p99"])


def test_buckets_that_save_nothing_are_not_joined(spark):
    r = np.random.default_rng(6)
    rows = [(str(i), x) for i, x in enumerate(r.normal(size=(300, 16)).tolist())] + [("z", [0.0] * 16)]
    df = spark.createDataFrame(rows, "item_id string, vector array<double>")
    found = knn.approximate_join(df, 0.4)
    assert "DATASETA" not in found._jdf.queryExecution().toString().upper()
    want = {(min(p, q), max(p, q)): s for i, (p, a) in enumerate(rows) for q, b in rows[i + 1 :] if (s := np.dot(a, b) / max(1e-12, np.linalg.norm(a) * np.linalg.norm(b))) >= 0.4}
    got = {(x["src"], x["dst"]): x["sim"] for x in found.collect()}
    assert len(want) > 1000 and got == pytest.approx(want)


def test_buckets_that_save_work_are_joined(spark):
    r = np.random.default_rng(7)
    angle = r.random(2000) * 2 * math.pi
    df = spark.createDataFrame([(i, [math.cos(t), math.sin(t)]) for i, t in enumerate(angle.tolist())], "item_id long, vector array<double>")
    found = knn.approximate_join(df, 0.999999, 2, 0.01)
    assert "DATASETA" in found._jdf.queryExecution().toString().upper()
    i, j = np.triu_indices(2000, 1)
    near = np.cos(angle[i] - angle[j]) >= 0.999999
    want = set(zip(i[near].tolist(), j[near].tolist()))
    got = {(x["src"], x["dst"]) for x in found.collect()}
    assert len(want) > 500 and len(got & want) >= 0.9 * len(want)


def test_neighbours_over_several_blocks_with_ties(spark):
    r = np.random.default_rng(8)
    v = np.round(r.normal(size=(120, 3)))
    rows = [(str(i), x) for i, x in enumerate(v.tolist())] + [("nan", [math.nan, 1.0, 0.0]), ("7", [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "item_id string, vector array<double>").repartition(4)
    got = {}
    for x in knn.knn_join(df, k=4, block_rows=9).collect():
        got.setdefault((x["src"], x["rank"]), (x["dst"], x["sim"]))
    for p, a in rows[:120]:
        if p == "7":
            continue
        other = sorted((-round(float(np.dot(a, b)) / max(1e-12, np.linalg.norm(a) * np.linalg.norm(b)), 6) + 0.0, q) for q, b in rows if q not in (p, "nan"))
        assert [(q, s) for q, s in (got[p, k] for k in (1, 2, 3, 4))] == [(q, pytest.approx(-s)) for s, q in other[:4]]
