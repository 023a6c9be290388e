import functools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orrery.llm import toxicity as tx

BAD = ["vilething", "nastyword", "awfulness"]


def table(documents, n=600):
    r = random.Random(11)
    texts, labels = [], []
    for _ in range(n):
        w = ["".join(r.choice("aeinorst") for _ in range(r.randint(2, 8))) for _ in range(r.randint(20, 80))]
        toxic = r.random() < 0.2
        if toxic:
            for _ in range(3):
                w[r.randrange(len(w))] = r.choice(BAD).upper() if r.random() < 0.2 else r.choice(BAD)
        texts.append(" ".join(w))
        labels.append(int(toxic))
    return texts, labels, documents(texts)


def test_held_out_accuracy(spark, documents):
    texts, y, docs = table(documents)
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(y)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in tx.toxicity(docs, labels).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (i in set(held)) for i in got)
    assert sum(got[i]["predicted"] == y[i] for i in held) >= 0.97 * len(held)
    # what the held-out labels say makes no difference
    flipped = spark.createDataFrame([(i, 1 - t if i in set(held) else t) for i, t in enumerate(y)], "doc_id long, toxic int")
    assert {r["doc_id"]: r["score"] for r in tx.toxicity(docs, flipped).collect()} == {i: r["score"] for i, r in got.items()}


def grams(text):
    """All n-grams of a text, in plain Python."""
    low = "".join(" " if c in "\t\n\v\f\r" else c for c in text.lower())
    return {low[i : i + n] for n in tx.LENGTHS for i in range(len(low) - n + 1)}


@functools.cache
def bucket_of(gram):
    raw = np.frombuffer(gram.encode(), np.uint8)
    return next(int(b[0]) for b, t in tx.buckets(raw, np.array([0, len(raw)])) if len(b) == 1)


def test_ngrams_are_code_points():
    texts = ["Größe ÉTÉ", "日本語テキスト です", "abc", "a\tbcd\ne", "", "ascii only text"]
    found = {}
    for a, _, bucket, text in tx.present(pa.array(texts)):
        for b, t in zip(bucket.tolist(), text.tolist()):
            found.setdefault(a + t, set()).add(b)
    for i, t in enumerate(texts):
        assert found.get(i, set()) == {bucket_of(g) for g in grams(t)}
    assert grams("ÉTÉS") == grams("étés")


def test_ratios_and_scores_against_plain_ones(spark, documents, monkeypatch):
    texts, y, docs = table(documents, 150)
    texts = [t + (" ÄRGER straße" if v else " größe") for t, v in zip(texts, y)]
    docs = documents([*texts, None, ""])
    labels = spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")
    known = [i for i in range(150) if zlib.crc32(str(i).encode()) % 5]
    seen = {}
    for i in known:
        for b in {bucket_of(g) for g in grams(texts[i])}:
            seen.setdefault(b, [0, 0])[y[i]] += 1
    n = [sum(y[i] == k for i in known) for k in (0, 1)]
    held = {}
    real = tx.features
    monkeypatch.setattr(tx, "features", lambda *a: held.setdefault("got", (a, real(*a)))[1])
    weights, bias = tx.train(docs, labels, 5, 0)
    (counts, size, _), (ratio, wanted) = held["got"]
    assert size.tolist() == n
    for b, (x0, x1) in seen.items():
        assert counts[:, b].tolist() == [x0, x1]
        assert ratio[b] == pytest.approx(math.log((x1 + 1) / (n[1] + 2)) - math.log((x0 + 1) / (n[0] + 2)))
    assert counts.sum() == sum(map(sum, seen.values())) and not weights[~wanted].any()
    got = {r["doc_id"]: r["score"] for r in tx.toxicity(docs, labels).collect()}
    for i, t in enumerate([*texts, "", ""]):
        z = bias + sum(float(weights[b]) for b in {bucket_of(g) for g in grams(t)})
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-5)


def test_very_long_text(spark, documents):
    texts, y, _ = table(documents, 120)
    docs = documents([*texts, "clean words " * 200_000 + "vilething nastyword awfulness"])
    labels = spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")
    assert {r["doc_id"]: r["predicted"] for r in tx.toxicity(docs, labels).collect()}[120] == 1


def test_odd_rows(spark, documents, odd_texts):
    texts, y, _ = table(documents, 100)
    docs = documents(texts + odd_texts + [(None, "null id"), (5, texts[5])]).withColumns({"score": F.lit(9), "toxic": F.lit(1)})
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(y)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    got = tx.toxicity(docs, labels).collect()
    assert len(got) == 100 + len(odd_texts) + 2 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert tx.toxicity(docs.limit(0), labels).collect() == []
    none = tx.toxicity(docs, labels.limit(0)).collect()
    assert all(r["predicted"] == 0 for r in none)
