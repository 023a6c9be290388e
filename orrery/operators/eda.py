"""Exploratory aggregates; each takes DataFrames and gives a DataFrame. FUNCTIONS is the registry that a catalog names."""

from __future__ import annotations

import inspect
import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.text import missing
from orrery.functions.vectors import doubles, norm
from orrery.operators.kendall import kendall
from orrery.operators.lines import average_ranks, running

NUMERIC = ("double", "float", "long", "integer", "short", "byte", "decimal")


def numeric_columns(df: DataFrame, skip: tuple[str, ...] = ("item_id",)) -> list[str]:
    return [f.name for f in df.schema if f.dataType.typeName() in NUMERIC and f.name not in skip]


def long_form(df: DataFrame, cols: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """keep, col, x: one row for each value of the columns."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("x")) for c in cols]))
    return df.select(*keep, pairs.alias("p")).select(*keep, "p.*")


def label_distribution(items: DataFrame, label_col: str = "label") -> DataFrame:
    return items.groupBy(F.col(label_col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def image_size_summary(items: DataFrame) -> DataFrame:
    return items.agg(F.min("width").alias("width_min"), F.max("width").alias("width_max"), F.min("height").alias("height_min"), F.max("height").alias("height_max"), F.count(F.lit(1)).alias("n"))


def missingness(df: DataFrame, top: int = 50) -> DataFrame:
    """column, missing_frac of the `top` columns with most nulls, in one pass."""
    one = df.agg(*[F.avg(missing(df, c).cast("double")).alias(c) for c in df.columns])
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_frac")) for c in df.columns])).alias("r")).select("r.*")
    return rows.orderBy(F.desc("missing_frac"), "column").limit(top)


def overview(df: DataFrame) -> DataFrame:
    """column, dtype, missing_frac, n_unique (null counts as a value): one pass of exact distinct counts."""
    aggs = []
    for i, c in enumerate(df.columns):
        gone = missing(df, c)
        aggs += [F.avg(gone.cast("double")).alias(f"m{i}"), (F.count_distinct(F.when(~gone, F.col(c))) + F.max(gone.cast("int"))).alias(f"u{i}")]
    one = df.agg(*aggs)
    kinds = dict(df.dtypes)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"), F.col(f"m{i}").alias("missing_frac"), F.col(f"u{i}").cast("long").alias("n_unique")) for i, c in enumerate(df.columns)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def real(c: str) -> Column:
    """A column's numbers as doubles: NaN is null."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def by_column(one: DataFrame, cols: list[str], fields: dict[str, Callable[[int], Column]]) -> DataFrame:
    """col and the fields (column number -> value) of one row of aggregates, one row for each column."""
    rows = [F.struct(F.lit(c).alias("col"), *[make(i).alias(name) for name, make in fields.items()]) for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


#: Distinct values of a column, about, that one task holds.
MOST_AT_ONCE = 100_000


def percentiles(df: DataFrame, cols: list[str], shares: list[float], at_once: int = MOST_AT_ONCE) -> list[list[float | None]]:
    """For each column its exact percentiles, interpolated; computed at once.

    Columns of few distinct values share a scan. Those of many are counted by value and ranked by ranges, so that no task holds a column's values.
    """
    values = [real(c) for c in cols]
    one = df.agg(*[f for v in values for f in (F.count(v), F.approx_count_distinct(v))]).first()
    sizes, kinds = one[::2], one[1::2]
    out: list[list[float | None]] = [[None] * len(shares) for _ in cols]
    short = [i for i, n in enumerate(kinds) if 0 < n <= at_once]
    if short:
        found = df.agg(*[F.percentile(values[i], F.array(*map(F.lit, shares))) for i in short]).first()
        for i, x in zip(short, found, strict=True):
            out[i] = list(x)
    for i, n in enumerate(kinds):
        if n > at_once:
            places = [(sizes[i] - 1) * q for q in shares]
            ranks = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
            counts = running(df.select(values[i].alias("x")).filter("x IS NOT NULL").groupBy("x").agg(F.count(F.lit(1)).alias("n")), ["x"], {"upto": "n"})
            hit = counts.select("x", "n", "upto", F.explode(F.array(*[F.lit(r).cast("long") for r in ranks])).alias("rank")).filter("rank >= upto - n AND rank < upto")
            at = {r["rank"]: r["x"] for r in hit.collect()}
            ends = [(at[math.floor(p)], at[math.ceil(p)], p) for p in places]
            out[i] = [lo if lo == hi else (math.ceil(p) - p) * lo + (p - math.floor(p)) * hi for lo, hi, p in ends]
    return out


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """col, count, mean, std (sample), min, p25, p50, p75, max: exact percentiles, which are computed at once."""
    cols = cols or numeric_columns(df)
    q = percentiles(df, cols, [0.25, 0.5, 0.75])
    aggregates = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = df.agg(*[f(real(c)).alias(f"{name}{i}") for i, c in enumerate(cols) for name, f in aggregates.items()])
    plain = lambda name: lambda i: F.col(f"{name}{i}")
    share = lambda j: lambda i: F.lit(q[i][j]).cast("double")
    fields = {n: plain(n) for n in ("count", "mean", "std", "min")} | {"p25": share(0), "p50": share(1), "p75": share(2), "max": plain("max")}
    return by_column(one, cols, fields).filter(F.col("count") > 0)


def numeric_hist(df: DataFrame, cols: list[str] | str, bins: int = 30) -> DataFrame:
    """col, bin, lo, hi, n: equal bins from least to greatest value, the last one closed, empty ones with 0. Many columns share two scans.

    A column of one value x is spread over x - 0.5 to x + 0.5. Columns without values have no rows.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    values = [real(c) for c in cols]
    ends = df.agg(*[f(v).alias(f"{f.__name__}{i}") for i, v in enumerate(values) for f in (F.min, F.max)])  # one row
    apart = [F.when(F.col(f"min{i}") == F.col(f"max{i}"), 0.5).otherwise(0.0) for i in range(len(cols))]
    span = ends.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("col"), (F.col(f"min{i}") - apart[i]).alias("a"), (F.col(f"max{i}") + apart[i]).alias("b")) for i, c in enumerate(cols)])).alias("s")).select("s.*").filter("a IS NOT NULL")
    edges = ends.select(*[(F.col(f"min{i}") - apart[i]).alias(f"__a{i}") for i in range(len(cols))], *[((F.col(f"max{i}") + apart[i] - (F.col(f"min{i}") - apart[i])) / bins).alias(f"__w{i}") for i in range(len(cols))])
    # a column's number and a bin in it are one number
    at = [F.when(v.isNotNull(), F.least(F.floor((v - F.col(f"__a{i}")) / F.col(f"__w{i}")), F.lit(bins - 1)).cast("int") + i * bins) for i, v in enumerate(values)]
    found = df.crossJoin(F.broadcast(edges)).select(F.explode(F.array(*at)).alias("at")).filter("at IS NOT NULL").groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    every = span.select("i", "col", "a", "b", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("b") - F.col("a")) / bins
    out = every.withColumn("at", F.col("i") * bins + F.col("bin")).join(found, "at", "left")
    return out.select("col", "bin", (F.col("a") + F.col("bin") * width).alias("lo"), (F.col("a") + (F.col("bin") + 1) * width).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"))


def outlier_iqr(df: DataFrame, cols: list[str] | str, k: float = 1.5) -> DataFrame:
    """col, n, outlier_frac, lo, hi: values beyond k interquartile ranges; nulls but n for fewer than 4 values. The percentiles are computed at once."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    edge = [(None, None) if a is None else (a - k * (b - a), b + k * (b - a)) for a, b in percentiles(df, cols, [0.25, 0.75])]
    lo, hi = (lambda i, s=s: F.lit(edge[i][s]).cast("double") for s in (0, 1))
    one = df.agg(*[f for i, c in enumerate(cols) for f in (F.count(real(c)).alias(f"n{i}"), F.avg(((real(c) < lo(i)) | (real(c) > hi(i))).cast("double")).alias(f"f{i}"))])
    enough = lambda i, c: F.when(F.col(f"n{i}") >= 4, c)
    return by_column(one, cols, {"n": lambda i: F.col(f"n{i}"), "outlier_frac": lambda i: enough(i, F.col(f"f{i}")), "lo": lambda i: enough(i, lo(i)), "hi": lambda i: enough(i, hi(i))}).filter("n > 0")


def numeric_columns(df: DataFrame, leave_out: tuple[str, ...] = ("item_id",)) -> list[str]:
    """The columns of numbers."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in leave_out]


def correlations(df: DataFrame, cols: list[str] | None = None, method: str = "pearson") -> DataFrame:
    """a, b, r for every ordered pair of columns (all of numbers where none are given), rounded to 4 digits; one pass. Kendall: tau-b, a pair of columns at a time. Spearman: pearson of average ranks among the values that are not null."""
    cols = numeric_columns(df) if cols is None else cols
    if method == "kendall":
        found = [(a, b, kendall(df, a, b)) for i, a in enumerate(cols) for b in cols[i:]]
        found += [(b, a, r) for a, b, r in found if a != b]
        return df.sparkSession.createDataFrame([(a, b, None if r is None else round(r, 4)) for a, b, r in found], "a string, b string, r double")
    if method == "spearman":
        for c in cols:
            df = df.join(average_ranks(df.filter(F.col(c).isNotNull()), c).withColumnRenamed("rank", f"__{c}"), c, "left")
        df = df.select(*[F.col(f"__{c}").alias(c) for c in cols])
    elif method != "pearson":
        raise ValueError(f"method {method} is not supported")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.round(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), 4).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs) for x, y in {(a, b), (b, a)}]
    return one.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def group_stats(df: DataFrame, group_col: str = "label", cols: list[str] | None = None) -> DataFrame:
    """group, col, count, mean, std (sample), rounded to 4 digits; rows without a group are left out."""
    cols = numeric_columns(df, ("item_id", group_col)) if cols is None else cols
    x = long_form(df.filter(F.col(group_col).isNotNull()), cols, (group_col,)).filter("x IS NOT NULL AND NOT isnan(x)")
    return x.groupBy(F.col(group_col).alias("group"), "col").agg(F.count("x").alias("count"), F.round(F.avg("x"), 4).alias("mean"), F.round(F.stddev_samp("x"), 4).alias("std"))


def embedding_norms(emb: DataFrame, vector: str = "vector") -> DataFrame:
    n = emb.select(norm(doubles(vector)).alias("x"), F.size(vector).alias("d"))
    return n.agg(F.count(F.lit(1)).alias("n"), F.max("d").cast("long").alias("dim"), F.min("x").alias("norm_min"), F.max("x").alias("norm_max"), F.avg("x").alias("norm_mean"), F.stddev_pop("x").alias("norm_std"))


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_items"))


def cluster_size_summary(clusters: DataFrame, noise: int = -1) -> DataFrame:
    sizes = cluster_sizes(clusters)
    return sizes.agg(F.count(F.lit(1)).alias("n_clusters"), F.min("n_items").alias("size_min"), F.max("n_items").alias("size_max"), F.sum((F.col("cluster_id") == noise).cast("long")).alias("n_noise_clusters"))


def noise_ratio(clusters: DataFrame, noise: int = -1) -> DataFrame:
    return clusters.agg(F.avg((F.col("cluster_id") == noise).cast("double")).alias("noise_ratio"))


def lengths(df: DataFrame, text_col: str = "text") -> DataFrame:
    """length, n, ecdf of the text lengths."""
    counts = df.groupBy(F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    size = counts.agg(F.sum("n").alias("all"))
    return running(counts, ["length"], {"upto": "n"}).crossJoin(F.broadcast(size)).select("length", "n", (F.col("upto") / F.col("all")).alias("ecdf"))


#: Names that a catalog may use. The embedding and clustering functions are added by their modules.
FUNCTIONS: dict[str, Callable[..., DataFrame]] = {
    "label_distribution": label_distribution,
    "image_size_summary": image_size_summary,
    "missingness": missingness,
    "morph_summary": describe,
    "numeric_hist": numeric_hist,
    "outlier_iqr": outlier_iqr,
    "morph_corr": correlations,
    "morph_group_stats": group_stats,
    "embedding_norms": embedding_norms,
    "cluster_size_distribution": cluster_sizes,
    "cluster_noise_ratio": noise_ratio,
}


#: Arguments of a catalog file, and what they are called here.
CATALOG_ARGUMENTS = {"col": "cols", "n_components": "k", "sample_pairs": "pairs", "feature_cols": "cols"}


def read_catalog(path: str) -> list[dict]:
    """The items {name, fn, inputs, kwargs} of a YAML catalog {items: [...]}; an item without a name or function is an error."""
    import yaml

    with open(path) as f:
        found = (yaml.safe_load(f) or {}).get("items") or []
    for item in found:
        if not item.get("name") or not item.get("fn"):
            raise ValueError(f"an item without name or fn: {item}")
    return found


def bound(fn: Callable[..., DataFrame], inputs: dict[str, DataFrame], kwargs: dict) -> DataFrame:
    """fn over tables and arguments: those that it knows by name, other tables in the order in which they are given to the parameters that are left, arguments by CATALOG_ARGUMENTS."""
    known = list(inspect.signature(fn).parameters)
    named = {k: v for k, v in inputs.items() if k in known}
    named |= {k if k in known else CATALOG_ARGUMENTS.get(k, k): v for k, v in kwargs.items()}
    free = [p for p in known if p not in named]
    named |= dict(zip(free, [v for k, v in inputs.items() if k not in known], strict=False))
    return fn(**named)


def run_catalog(items: list[dict], tables: dict[str, DataFrame], include: set[str] | None = None, functions: dict[str, Callable[..., DataFrame]] | None = None) -> list[tuple[str, str, DataFrame | str]]:
    """(name, status, result or reason) for each item {name, fn, inputs: argument -> table, kwargs}.

    An unknown fn is skipped, a missing table or a failing plan is an error; other items go on. Nothing is computed yet but
    what a function needs to plan.
    """
    known = functions or FUNCTIONS
    out: list[tuple[str, str, DataFrame | str]] = []
    for item in items:
        if include is not None and item["name"] not in include:
            continue
        fn = known.get(item["fn"])
        if fn is None:
            out.append((item["name"], "skipped", f"no function {item['fn']}"))
            continue
        try:
            out.append((item["name"], "ok", bound(fn, {a: tables[t] for a, t in (item.get("inputs") or {}).items()}, item.get("kwargs") or {})))
        except Exception as error:  # one item's failure is its result
            out.append((item["name"], "error", f"{type(error).__name__}: {error}"))
    return out


#: Functions whose rows for a list of columns are those for each column, told apart by `col`.
BY_COLUMN = (numeric_hist, outlier_iqr)


def payloads(asked: list[tuple[str, dict, str | None]], result: DataFrame) -> DataFrame:
    """One row of a JSON text {name, spec, result} for each (name, spec, column or None: all rows): for results of a few rows."""
    row = F.struct(*result.columns)
    rows = result.agg(*[F.collect_list(row if column is None else F.when(F.col("col") == column, row)).alias(f"r{i}") for i, (_, _, column) in enumerate(asked)])
    texts = []
    for i, (name, spec, _) in enumerate(asked):
        spec_text = F.create_map(*[x for k, v in spec.items() for x in (F.lit(str(k)), F.lit(str(v)))])
        texts.append(F.to_json(F.struct(F.lit(name).alias("name"), spec_text.alias("spec"), F.col(f"r{i}").alias("result"))).alias(f"p{i}"))
    return rows.select(*texts)


def payload(name: str, spec: dict, result: DataFrame) -> DataFrame:
    """One JSON text {name, spec, result}: for results of a few rows."""
    return payloads([(name, spec, None)], result).toDF("value")


def alike(items: list[dict], tables: dict[str, DataFrame], known: dict[str, Callable[..., DataFrame]]) -> list[list[tuple[dict, str | None]]]:
    """Items with the column each asks for, in lists that one call answers: those of the same function, DataFrames and arguments; of BY_COLUMN functions also those that differ by their one column."""
    out: dict[str, list[tuple[dict, str | None]]] = {}
    for n, item in enumerate(items):
        inputs = [(a, id(tables[t]) if t in tables else (t, n)) for a, t in (item.get("inputs") or {}).items()]
        kwargs = {CATALOG_ARGUMENTS.get(k, k): v for k, v in (item.get("kwargs") or {}).items()}
        column = kwargs.pop("cols") if known.get(item["fn"]) in BY_COLUMN and isinstance(kwargs.get("cols"), str) else None
        out.setdefault(repr((item["fn"], inputs, sorted(kwargs.items()), column is None)), []).append((item, column))
    return list(out.values())


def evaluated(items: list[dict], tables: dict[str, DataFrame], include: set[str] | None = None, functions: dict[str, Callable[..., DataFrame]] | None = None) -> list[tuple[str, str, int, str]]:
    """(name, status, number of columns, JSON) for each item of the catalog, run to its end: the payload where it is ok, else the reason. What fails on execution is an error too.

    Items that are alike are run together, and one by one where that fails.
    """
    named = [item for item in items if include is None or item["name"] in include]
    place = {id(item): n for n, item in enumerate(named)}
    todo, out = alike(named, tables, functions or FUNCTIONS), {}
    while todo:
        group = todo.pop(0)
        first, column = group[0]
        columns = list(dict.fromkeys(c for _, c in group))
        if len(columns) > 1:
            kwargs = {k: v for k, v in (first.get("kwargs") or {}).items() if CATALOG_ARGUMENTS.get(k, k) != "cols"}
            first = first | {"kwargs": kwargs | {"cols": columns}}
        ((_, status, result),) = run_catalog([first], tables, None, functions)
        if status == "ok":
            try:
                asked = [(item["name"], {k: v for k, v in item.items() if k != "name"}, c if len(columns) > 1 else None) for item, c in group]
                texts = payloads(asked, result).first()
                out |= {place[id(item)]: (item["name"], status, len(result.columns), text) for (item, _), text in zip(group, texts, strict=True)}
                continue
            except Exception as error:  # one item's failure is its result
                status, result = "error", f"{type(error).__name__}: {error}"
        if len(group) > 1 and status == "error":
            todo += [[one] for one in group]
            continue
        out |= {place[id(item)]: (item["name"], status, 0, json.dumps({"name": item["name"], "reason": result})) for item, _ in group}
    return [out[n] for n in range(len(named))]
