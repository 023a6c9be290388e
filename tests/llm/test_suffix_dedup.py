import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import suffix_dedup as sd


def brute(rows, length):
    raw = [(k, (t or "").encode()) for k, t in rows]
    n = {}
    for _, t in raw:
        for s in range(len(t) - length + 1):
            n[t[s : s + length]] = n.get(t[s : s + length], 0) + 1
    out = []
    for k, t in raw:
        cover = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - length + 1):
            if n[t[s : s + length]] > 1:
                cover[s : s + length] = True
        kept = bytes(b for b, c in zip(t, cover) if not c)
        out.append((k, len(t), int(cover.sum()), int((cover[:-1] & ~np.concatenate([[False], cover[:-2]])).sum()) if len(t) else 0, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(seed, n=40):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 6)))
    passages = [" ".join(word() for _ in range(r.randint(4, 30))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(r.randint(0, 12))) for _ in range(4)]
        for _ in range(r.randint(0, 3)):
            parts.insert(r.randrange(len(parts)), r.choice(passages))
        out.append(" ".join(parts))
    return out + out[:2] + ["ab" * 60, "z" * 90, "ab" * 40 + "q", None, "", "x"]


@pytest.mark.parametrize(("seed", "shard_bytes"), [(1, 1 << 21), (2, 1 << 21), (3, 400), (4, 150)])
def test_against_all_substrings(spark, documents, seed, shard_bytes):
    rows = list(enumerate(texts(seed)))
    got = sd.suffix_dedup(documents(rows), 24, 8, shard_bytes)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 24)


def test_common_passage_in_many_shards(spark, documents):
    """Different surroundings share a passage, and pairs share a longer one: what is in two shards only is found by the merge."""
    r = random.Random(9)
    noise = lambda n: "".join(r.choice("klmnop") for _ in range(n))
    passage = noise(30)
    rows = []
    for i in range(60):
        tail = noise(12)
        rows += [(2 * i, noise(20) + passage + tail + noise(9)), (2 * i + 1, noise(20) + passage + tail + noise(9))]
    got = sd.suffix_dedup(documents(rows), 24, 8, 300)
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute(rows, 24)


def test_suffix_array_and_common_prefixes():
    r = np.random.default_rng(4)
    for n in (1, 2, 50, 3000):
        data = r.integers(97, 100, n).astype(np.uint8)
        data[n // 2 :] = data[: n - n // 2]
        sa = sd.suffix_array(data)
        raw = bytes(data)
        assert sa.tolist() == sorted(range(n), key=lambda i: raw[i:])
        lcp = sd.common_prefixes(data, sa, 40, 16)
        for k in range(1, n):
            a, b = raw[sa[k - 1] :].ljust(60, b"\0"), raw[sa[k] :].ljust(60, b"\0")
            plain = next((i for i in range(40) if a[i] != b[i]), 40)
            assert lcp[k] == plain or max(sa[k - 1], sa[k]) + lcp[k] >= n - 1


def test_repeated_rows_null_ids_and_clashes(spark, documents):
    long = "0123456789abcdefghijklmnopqrstuvwxyz"
    rows = [(1, long), (1, long), (None, long + "!"), (None, None), (1, "other")]
    docs = documents(rows).withColumns({"anchor": F.lit(1), "spans": F.lit(2), "begin": F.lit(3)})
    got = sd.suffix_dedup(docs, 24, 8)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 24)
    assert sd.suffix_dedup(docs.limit(0)).collect() == []


def test_equal_fingerprints_of_different_windows(spark):
    """Two shards of an anchor: the fingerprint 5 stands for two windows, told apart by the second hash."""

    def place(*rows):
        return np.array(list(rows), sd.PLACE).tobytes()

    rows = [
        (1, 0, np.array([5, 5, 9], np.uint64).tobytes(), place((1, 10, 0), (2, 10, 1), (3, 11, 7))),
        (1, 0, np.array([5, 9], np.uint64).tobytes(), place((2, 20, 4), (4, 20, 9))),
        (2, 0, np.array([5], np.uint64).tobytes(), place((2, 30, 0))),
    ]
    blobs = spark.createDataFrame(rows, "anchor long, slice int, prints binary, places binary").coalesce(1).sortWithinPartitions("anchor", "slice")
    assert sorted(map(tuple, sd.merged_marks(blobs, 24).collect())) == [(1, 10, [1], [25]), (1, 20, [4], [28])]


def test_int_ids_and_long_texts(spark, documents):
    r = random.Random(15)
    noise = lambda n: "".join(r.choice("klmnopé ") for _ in range(n))
    passage = noise(700)
    rows = [(0, noise(40_000) + passage + noise(10_000)), (1, noise(300) + passage[100:] + noise(50)), (2, "ab" * 20_000), (3, noise(399))]
    want = brute(rows, 400)
    for kind in ("int", "string"):
        docs = documents(rows).withColumn("doc_id", F.col("doc_id").cast(kind))
        got = sd.suffix_dedup(docs, 400, 64, 2000)
        assert got.schema["doc_id"].dataType.simpleString() == kind
        assert sorted((int(x[0]), *x[1:]) for x in map(tuple, got.collect())) == want
    assert [w[2] > 0 for w in want] == [True, True, True, False]


def test_regions_in_very_many_texts(spark):
    """Some regions hold most copies, others a few; both ways give the rows of a plain semi-join, for any bound."""
    r = random.Random(16)
    rows = [(r.choice([1, 1, 1, 2, 3, 4, 5, 6]), k, i) for i, k in enumerate(r.choices([7, 8, 9], k=400))]
    found = spark.createDataFrame(rows, "anchor long, region_key long, begin long")
    kinds = found.groupBy("anchor", "region_key").agg(F.count(F.lit(1)).alias("copies")).filter("anchor <> 6")
    want = sorted(x for x in rows if x[0] != 6)
    for most in (1, 5, 20, 10_000):
        assert kinds.filter(F.col("copies") * most > sum(1 for x in rows if x[0] != 6)).count() < max(most, 1)
        assert sorted(map(tuple, sd.in_repeated(found, kinds, most).select("anchor", "region_key", "begin").collect())) == want
    assert sd.in_repeated(found, kinds.limit(0)).count() == 0
