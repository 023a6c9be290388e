"""Cosines of all pairs of rows, as matrix products of blocks: their figures, and the pairs that are similar enough."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.vectors import doubles
from orrery.operators.knn import blocks, paired

#: A cosine as a whole number of KEY_BITS bits, in the order of cosines: steps of 7e-15, which is what a sum of 64 products is good for.
KEY_BITS, SPAN = 48, 1.03125
SCALE = 2**KEY_BITS / (2 * SPAN)
#: Bits of a key that one pass tells apart: a task counts 2^PASS_BITS keys for each percentile.
PASS_BITS = 16
#: Left rows of a product.
PART_ROWS = 512


def block_pairs(rows: DataFrame) -> DataFrame:
    """Each unordered pair of blocks once. Rows without an id, a vector or a coordinate are in no pair."""
    whole = rows.select("item_id", doubles("vector").alias("vector")).filter("item_id IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    return paired(blocks(whole)).filter("block_l <= block_r")


def products(batches) -> Iterator[tuple[pa.Array, int, pa.Array, np.ndarray, np.ndarray | None]]:
    """Left ids, the first left row, right ids, cosines of some left rows with all right ones, and which of them count (None: all): each pair of different ids once.

    Zero vectors have cosine 0 with all; other vectors of different length have none.
    """
    for batch in batches:
        for r in range(batch.num_rows):
            get = lambda c: batch.column(batch.schema.get_field_index(c))[r]  # noqa: B023, E731
            a, b = (np.frombuffer(get(f"matrix_{s}").as_py(), np.float64).reshape(get(f"n_{s}").as_py(), -1) for s in "lr")
            src, dst = get("ids_l").values, get("ids_r").values
            same, (na, nb) = get("block_l").as_py() == get("block_r").as_py(), (np.sqrt((m * m).sum(1)) for m in (a, b))
            if a.shape[1] != b.shape[1]:
                if not same or a.shape[1] < b.shape[1]:
                    differ = np.array(src.to_pylist(), object)[:, None] != np.array(dst.to_pylist(), object)[None]
                    yield src, 0, dst, np.zeros((len(a), len(b))), differ & ((na == 0)[:, None] | (nb == 0)[None])
                continue
            with np.errstate(invalid="ignore"):
                a, b = (m / np.where(n > 0, n, 1.0)[:, None] for m, n in ((a, na), (b, nb)))
            # a block lies in the order of its ids, and equal ids in one block
            code = np.concatenate([[0], np.cumsum(np.array(src[1:].to_pylist(), object) != np.array(src[:-1].to_pylist(), object))]) if same else None
            for lo in range(0, len(a), PART_ROWS):
                part = a[lo : lo + PART_ROWS] @ b.T
                yield src, lo, dst, part, None if code is None else code[lo : lo + PART_ROWS, None] < code[None]


def counted(batches) -> Iterator[np.ndarray]:
    for _, _, _, sim, count in products(batches):
        yield sim.ravel() if count is None else sim[count]


def keys(x: np.ndarray) -> np.ndarray:
    y = x + SPAN
    y *= SCALE
    return y.astype(np.int64)


def merged(p: tuple, q: tuple) -> tuple:
    """(n, mean, squared deviations, least, greatest, NaNs) of two sets together."""
    n = p[0] + q[0]
    if not n:
        return (0, 0.0, 0.0, math.inf, -math.inf, p[5] + q[5])
    d = q[1] - p[1]
    return (n, p[1] + d * q[0] / n, p[2] + q[2] + d * d * p[0] * q[0] / n, min(p[3], q[3]), max(p[4], q[4]), p[5] + q[5])


NONE = (0, 0.0, 0.0, math.inf, -math.inf, 0)
FIGURES = ("m", "mean", "spread", "least", "most", "nans")


def first_pass(batches):
    """prefix, bin, n of the keys' first bits, and in a row of its own (bin -1) what else a task has found."""
    all_, have = np.zeros(2**PASS_BITS, np.int64), NONE
    for x in counted(batches):
        nans = 0
        if len(x) and math.isnan(x.sum()):
            real = ~np.isnan(x)
            x, nans = x[real], int((~real).sum())
        if not len(x):
            have = merged(have, NONE[:5] + (nans,))
            continue
        mean = float(x.mean())
        off = x - mean
        have = merged(have, (len(x), mean, float(off @ off), float(x.min()), float(x.max()), nans))
        all_ += np.bincount(keys(x) >> (KEY_BITS - PASS_BITS), minlength=2**PASS_BITS)
    at = np.flatnonzero(all_)
    none = [pa.nulls(len(at), pa.int64() if c in ("m", "nans") else pa.float64()) for c in FIGURES]
    names = ["prefix", "bin", "n", *FIGURES]
    yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(at), np.int64)), pa.array(at), pa.array(all_[at]), *none], names=names)
    yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (0, -1, 0)] + [pa.array([v], k.type) for v, k in zip(have, none, strict=True)], names=names)


def next_pass(prefixes: list[int], bits: int):
    """prefix, bin, n of the PASS_BITS bits after the first `bits`, among the keys that begin with one of the prefixes."""

    def run(batches):
        found = np.zeros((len(prefixes), 2**PASS_BITS), np.int64)
        for x in counted(batches):
            k = keys(x[~np.isnan(x)] if len(x) and math.isnan(x.sum()) else x)
            head = k >> (KEY_BITS - bits)
            for i, p in enumerate(prefixes):
                mine = k[head == p] >> (KEY_BITS - bits - PASS_BITS)
                if len(mine):
                    found[i] += np.bincount(mine & (2**PASS_BITS - 1), minlength=2**PASS_BITS)
        row, at = np.nonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(prefixes, np.int64)[row]), pa.array(at), pa.array(found[row, at])], names=["prefix", "bin", "n"])

    return run


def all_pair_cosine_stats(rows: DataFrame) -> DataFrame:
    """One row over the cosines of all unordered pairs of rows with different ids: pairs, cos_min, cos_max, cos_mean, cos_std (population), cos_p01, cos_p50, cos_p99 (interpolated).

    No pair is a row: a task counts its products by their first bits. The percentiles are found bit by bit, in KEY_BITS / PASS_BITS passes over all
    pairs, to within 7e-15. The driver gets 2^PASS_BITS counts for each place of a percentile at most, whatever the number of rows.
    """
    met = block_pairs(rows)
    kinds = ", ".join(f"{c} {'long' if c in ('m', 'nans') else 'double'}" for c in FIGURES)
    each = F.collect_list(F.when(F.col("bin") < 0, F.struct(*FIGURES)))  # one for each task
    got = met.mapInArrow(first_pass, f"prefix long, bin long, n long, {kinds}").groupBy("prefix", "bin").agg(F.sum("n").alias("n"), each.alias("each")).toArrow().to_pandas()
    have = NONE
    for one in got.loc[got["bin"] < 0, "each"]:
        for x in one:
            have = merged(have, tuple(x[c] for c in FIGURES))
    real, nans = have[0], have[5]
    total = real + nans
    places = {p: (total - 1) * p for p in (0.01, 0.5, 0.99)} if total else {}
    #: rank among all cosines -> first bits of its key, and its rank among the keys with these bits
    at = {r: (0, r) for place in places.values() for r in (math.floor(place), math.ceil(place)) if r < real}
    got = got[got["bin"] >= 0]
    for bits in range(PASS_BITS, KEY_BITS + 1, PASS_BITS):
        for r, (prefix, rank) in at.items():
            own = got[got["prefix"] == prefix].sort_values("bin")
            upto = np.cumsum(own["n"].to_numpy())
            i = min(int(np.searchsorted(upto, rank, side="right")), len(upto) - 1)
            at[r] = (prefix << PASS_BITS | int(own["bin"].iloc[i]), max(0, rank - int(upto[i - 1] if i else 0)))
        if bits < KEY_BITS and at:
            got = met.mapInArrow(next_pass(sorted({p for p, _ in at.values()}), bits), "prefix long, bin long, n long").groupBy("prefix", "bin").agg(F.sum("n").alias("n")).toArrow().to_pandas()

    def value(rank: int) -> float:
        return min(max((at[rank][0] + 0.5) / SCALE - SPAN, have[3]), have[4]) if rank < real else math.nan

    def quantile(p: float) -> float | None:
        if not total:
            return None
        lo, hi = math.floor(places[p]), math.ceil(places[p])
        return value(lo) if lo == hi else (hi - places[p]) * value(lo) + (places[p] - lo) * value(hi)

    if not total:
        figures = (None,) * 4
    elif nans:
        figures = (have[3] if real else math.nan, math.nan, math.nan, math.nan)
    else:
        figures = (have[3], have[4], have[1], math.sqrt(max(0.0, have[2]) / real))
    row = (total, *figures, *(quantile(p) for p in (0.01, 0.5, 0.99)))
    return rows.sparkSession.createDataFrame([row], "pairs long, cos_min double, cos_max double, cos_mean double, cos_std double, cos_p01 double, cos_p50 double, cos_p99 double")


def similar(rows: DataFrame, min_sim: float) -> DataFrame:
    """src, dst, sim (src < dst): all pairs of different ids with a cosine of at least min_sim."""

    def run(batches):
        for src, lo, dst, sim, count in products(batches):
            found = sim >= min_sim
            row, column = np.divmod(np.flatnonzero(found if count is None else found & count), sim.shape[1])
            if len(row):
                yield pa.RecordBatch.from_arrays([src.take(pa.array(lo + row)), dst.take(pa.array(column)), pa.array(sim[row, column])], names=["src", "dst", "sim"])

    kind = rows.schema["item_id"].dataType.simpleString()
    found = block_pairs(rows).mapInArrow(run, f"src {kind}, dst {kind}, sim double")
    return found.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "sim")
