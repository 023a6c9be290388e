"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import fold, small_batches
from orrery.llm.textkit import mix, pieces, prefix_hash, power

#: Lengths of the n-grams, in characters (code points) of the lower-case text; hash buckets that they are counted in.
LENGTHS, BITS = (4, 5, 6, 7, 8), 20
#: Labelled documents that are learned from; n-gram buckets that get a weight.
TRAIN_DOCS, FEATURES = 6000, 8192
#: Slices of the count vectors, and tasks that count.
SLICES, COUNTERS = 16, 8
MODEL_ROUNDS, RIDGE = 300, 1e-4

_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[[9, 10, 11, 12, 13]] = 32


def buckets(data: np.ndarray, offsets: np.ndarray):
    """(bucket of each n-gram, its text), for each length in turn. data: lower-case UTF-8. N-grams do not cross texts; ASCII white space is a blank."""
    plain = _BLANK[data]
    prefix = prefix_hash(plain)
    inverse = power(len(prefix), True)
    at = np.append(np.flatnonzero((plain & 0xC0) != 0x80), len(plain))  # where characters begin
    ascii_ = len(at) == len(plain) + 1
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(at, offsets)))
    for n in LENGTHS:
        if len(text) < n:
            continue
        begin, end = (slice(0, len(text) - n + 1), slice(n, len(prefix))) if ascii_ else (at[: len(text) - n + 1], at[n:])
        h = mix((prefix[end] - prefix[begin]) * inverse[begin] + np.uint64(n))
        own = text[: len(h)]
        whole = own == text[n - 1 :]
        yield (h >> np.uint64(64 - BITS)).astype(np.int32)[whole], own[whole]


def present(column: pa.Array, wanted: np.ndarray | None = None):
    """(first row, texts, bucket, text) with each bucket once for each text it is in. wanted: flags of the buckets to look for."""
    for a, b, data, offsets in pieces(pc.utf8_lower(column)):
        keys = []
        for bucket, text in buckets(data, offsets):
            if wanted is not None:
                hit = np.flatnonzero(wanted[bucket])
                bucket, text = bucket[hit], text[hit]
            keys.append(text.astype(np.int64) << BITS | bucket)
        keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        keys.sort()
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
        yield a, b - a, (keys & ((1 << BITS) - 1)).astype(np.int64), keys >> BITS


def fit(x: tuple[np.ndarray, np.ndarray], y: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge-regularised logistic regression by accelerated gradient steps on features that are scale where present (feature numbers, first of each row)."""
    columns, bounds = x
    rows = np.repeat(np.arange(len(y)), np.diff(bounds))
    value = scale[columns]
    w, bias, n = np.zeros(len(scale)), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), len(y)
    v, vb = w.copy(), bias
    step = 4.0 / max(1e-9, np.bincount(rows, value**2, n).max() + 1)
    step = max(step, 4.0 / max(1e-9, 8 * np.bincount(rows, value**2, n).mean() + 1))
    best = (np.inf, w, bias)
    for t in range(1, MODEL_ROUNDS + 1):
        z = np.bincount(rows, value * v[columns], n) + vb
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        loss = float(np.mean(np.logaddexp(0, z) - y * z) + RIDGE / 2 * (v @ v))
        if loss > best[0] * 1.5:  # a step too long: halve it and go on from the best point
            step /= 2
            w, bias = best[1].copy(), best[2]
            v, vb = w.copy(), bias
            continue
        if loss < best[0]:
            best = (loss, v.copy(), vb)
        miss = (p - y) / n
        w2 = v - step * (np.bincount(columns, value * miss[rows], len(scale)) + RIDGE * v)
        b2 = vb - step * miss.sum()
        m = (t - 1) / (t + 2)
        v, vb = w2 + m * (w2 - w), b2 + m * (b2 - bias)
        w, bias = w2, b2
    return best[1], best[2]


def features(seen: np.ndarray, size: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """(log-count ratio of each bucket, flags of the n_features that tell the labels apart best), from documents with the bucket by label, and documents."""
    rate = (seen + 1.0) / (size[:, None] + 2.0)
    ratio = np.log(rate[1] / rate[0])
    usual = seen.sum(0) * (size[1] / size.sum())
    worth = (seen[1] - usual) ** 2 / np.maximum(usual, 0.5)
    wanted = np.zeros(seen.shape[1], bool)
    wanted[np.argsort(-worth, kind="stable")[:n_features]] = True
    return ratio, wanted & (seen.sum(0) >= 3)


def train(docs: DataFrame, labels: DataFrame, folds: int, held_out_fold: int, train_docs: int = TRAIN_DOCS, n_features: int = FEATURES, seed: int = 9) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias). Learned from about train_docs labelled documents outside the held-out fold, chosen by a hash of the id.

    Counts of documents with an n-gram are added up in COUNTERS tasks; the n_features buckets that tell the labels apart best
    (by chi squared of the documents of label 1) are the features, each scaled by its ratio.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.filter(fold("doc_id", folds) != held_out_fold)
    there = known.count()
    bound = int(min(1.0, train_docs / max(1, there)) * (1 << 30))
    known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) <= bound)
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "toxic")  # bounded by train_docs
    sample = sample.repartition(COUNTERS, F.xxhash64("doc_id", "text")).sortWithinPartitions("doc_id", "text")
    width = (1 << BITS) // SLICES

    def count(batches):
        seen = np.zeros((2, 1 << BITS), np.int32)
        size = np.zeros(2, np.int64)
        for batch in batches:
            y = batch.column(2).to_numpy()
            size += np.bincount(y, minlength=2)[:2]
            for a, n, bucket, text in present(batch.column(1)):
                for k in (0, 1):
                    seen[k] += np.bincount(bucket[y[a : a + n][text] == k], minlength=1 << BITS).astype(np.int32)
        for i in range(SLICES):
            yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "seen": [seen[:, i * width : (i + 1) * width].tobytes()], "size": [size.tobytes()]})

    def add(key, frame):
        import pandas as pd

        seen = sum(np.frombuffer(x, np.int32).astype(np.int64) for x in frame["seen"])
        size = sum(np.frombuffer(x, np.int64) for x in frame["size"])
        return pd.DataFrame({"slice": [key[0]], "seen": [seen.astype(np.int32).tobytes()], "size": [size.tobytes()]})

    kinds = "slice int, seen binary, size binary"
    slices = sorted(sample.mapInArrow(count, kinds).groupBy("slice").applyInPandas(add, kinds).collect())
    weights = np.zeros(1 << BITS, np.float32)
    size = np.frombuffer(bytes(slices[0][2]), np.int64) if slices else np.zeros(2, np.int64)
    if size.min() == 0:
        return weights, -10.0 if size[1] == 0 else 10.0
    seen = np.concatenate([np.frombuffer(bytes(s[1]), np.int32).reshape(2, -1) for s in slices], axis=1)
    ratio, wanted = features(seen, size, n_features)
    number = np.cumsum(wanted) - 1

    def rows(batches):
        for batch in batches:
            y = batch.column(2).to_numpy()
            for a, n, bucket, text in present(batch.column(1), wanted):
                bounds = np.searchsorted(text, np.arange(n + 1))
                ids = number[bucket].astype("<i4")
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column(0).slice(a, n), "toxic": pa.array(y[a : a + n], pa.int32()), "found": pa.array([ids[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())}
                )

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    data = sorted(sample.mapInArrow(rows, f"doc_id {id_kind}, toxic int, found binary").collect(), key=lambda r: (r[0], bytes(r[2])))
    found = [np.frombuffer(bytes(r[2]), "<i4") for r in data]
    bounds = np.concatenate([[0], np.cumsum([len(f) for f in found])])
    scale = ratio[wanted]
    w, bias = fit((np.concatenate(found), bounds), np.array([r[1] for r in data], float), scale)
    weights[wanted] = (w * scale).astype(np.float32)
    return weights, float(bias)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out_fold: int = 0, **options) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score (probability of label 1) and predicted (1 from a score of 0.5).

    The whole text counts: an n-gram of code points in Unicode lower case is a feature if it is anywhere in it. Null and empty texts get the score of no
    feature at all. A null doc_id is scored like any other (its fold is that of the empty text) and has no label. Labels of documents in the held-out fold are not read. Null labels are left out; of contradicting ones the higher counts.
    Without labels of both kinds every score is near 0 or near 1. Repeated rows are scored alike; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    weights, bias = train(docs, labels, folds, held_out_fold, **options)
    wanted = weights != 0

    def score(batches):
        for batch in batches:
            z = np.full(batch.num_rows, bias)
            for a, n, bucket, text in present(batch.column(1), wanted):
                z[a : a + n] += np.bincount(text, weights[bucket], n)
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double, predicted int")
    return scored.select("doc_id", (fold("doc_id", folds) == held_out_fold).alias("held_out"), "score", "predicted")
