"""The catalog's items that are alike are run together, with the rows that each has alone."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators import eda


def test_alike_items_are_run_once(spark):
    rows = [(float(i), float(i * i), 3.0, None, float("nan") if i % 3 else 1.0 * i) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(3)
    calls = []

    def counted(fn):
        def run(df, cols, bins=30):
            calls.append((fn.__name__, cols))
            return fn(df, cols, bins) if fn is eda.numeric_hist else fn(df, cols)

        return run

    hist, iqr = counted(eda.numeric_hist), counted(eda.outlier_iqr)
    functions = {"numeric_hist": hist, "outlier_iqr": iqr, "norm": lambda x: calls.append(("norm", x)) or x.agg(F.count(F.lit(1)).alias("n"))}
    items = [{"name": f"{f}_{c}", "fn": f, "inputs": {"df": "t"}, "kwargs": {"cols": c}} for f in ("numeric_hist", "outlier_iqr") for c in "abcde"]
    items += [{"name": f"ten_{c}", "fn": "numeric_hist", "inputs": {"df": "t"}, "kwargs": {"col": c, "bins": 10}} for c in "ab"]
    items += [{"name": f"norm_{t}", "fn": "norm", "inputs": {"x": t}} for t in ("t", "u", "v")]
    tables = {"t": df, "u": df, "v": df.limit(7)}
    kept, eda.BY_COLUMN = eda.BY_COLUMN, (hist, iqr)
    try:
        got = eda.evaluated(items, tables, None, functions)
    finally:
        eda.BY_COLUMN = kept
    assert len(calls) == 5
    assert [r[0] for r in got] == [i["name"] for i in items] and {r[1] for r in got} == {"ok"}
    for item, (name, _, n, text) in zip(items, got):
        ((_, _, alone),) = eda.run_catalog([item], tables, None, functions)
        one = json.loads(eda.payload(name, {k: v for k, v in item.items() if k != "name"}, alone).first()[0])
        key = lambda r: json.dumps(r, sort_keys=True)
        both = json.loads(text)
        assert n == len(alone.columns) and both["spec"] == one["spec"] and sorted(both["result"], key=key) == sorted(one["result"], key=key)


def test_one_bad_column_leaves_the_others(spark):
    df = spark.createDataFrame([(float(i),) for i in range(9)], "a double")
    items = [{"name": c, "fn": "numeric_hist", "inputs": {"df": "t"}, "kwargs": {"cols": c, "bins": 2}} for c in ("a", "gone", "a")]
    got = eda.evaluated(items, {"t": df})
    assert [(n, s) for n, s, _, _ in got] == [("a", "ok"), ("gone", "error"), ("a", "ok")]
    assert [(r["lo"], r["n"]) for r in sorted(json.loads(got[0][3])["result"], key=lambda r: r["bin"])] == [(0.0, 4), (4.0, 5)]


@pytest.mark.parametrize("value", [5.0, 0.0])
def test_hist_of_one_value(spark, value):
    df = spark.createDataFrame([(value, None), (value, None)], "a double, b double")
    assert sorted(map(tuple, eda.numeric_hist(df, ["a", "b"], 2).collect())) == [("a", 0, value - 0.5, value, 0), ("a", 1, value, value + 0.5, 2)]


def test_percentiles_of_long_columns(spark):
    r = np.random.default_rng(3)
    n = 30_011
    x = {"a": r.normal(size=n), "b": r.integers(0, 3, n).astype(float), "c": np.exp(r.normal(size=n) * 9), "few": np.where(np.arange(n) < 3, np.arange(n), np.nan), "none": np.full(n, np.nan)}
    x["c"][:5] = 1e300
    df = spark.createDataFrame([tuple(map(float, t)) for t in zip(*x.values())], ", ".join(f"{c} double" for c in x)).repartition(3)
    shares = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = eda.percentiles(df, list(x), shares, 0)
    for c, found in zip(x, got):
        v = x[c][~np.isnan(x[c])]
        assert found == ([None] * 5 if c == "none" else pytest.approx(np.quantile(v, shares, method="linear").tolist())), c
    assert got == [[None if v is None else pytest.approx(v) for v in f] for f in eda.percentiles(df, list(x), shares)]
