import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orrery.llm import quality as q
from orrery.llm.textkit import pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    w = WORD.findall(text or "")
    n = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeat = {j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(repeat)


def test_counts_against_plain_python(odd_texts):
    r = random.Random(5)
    texts = odd_texts + ["".join(r.choice("ab é#\n\t |日") for _ in range(r.randint(0, 60))) for _ in range(300)]
    column = pa.array(texts, pa.string())
    got = {c: np.concatenate([q.statistics(data, offsets)[c] for _, _, data, offsets in pieces(column, 50)]) for c in q.COUNTS}
    for i, t in enumerate(texts):
        assert tuple(int(got[c][i]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == plain(t), repr(t)


def test_junk_goes_and_clean_stays(spark, documents):
    r = random.Random(7)
    word = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9)))
    texts = []
    for i in range(400):
        w = [word() for _ in range(r.randint(60, 200))]
        texts.append(" ".join(x + "###" for x in w) if i % 20 == 0 else " ".join(w).upper() if i % 20 == 1 else " ".join(w))
    docs = documents(texts)
    labels = spark.createDataFrame([(i, int(i % 20 > 1)) for i in range(200)] + [(1, None), (None, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in q.quality_rules(docs, labels).collect()}
    assert sum(got[i]["kept"] for i in range(400) if i % 20 > 1) >= 358
    assert sum(got[i]["kept"] for i in range(400) if i % 20 <= 1) <= 2


def test_verdicts_against_plain_ones(spark, documents):
    r = random.Random(9)
    texts = [" ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) + ("##" if i % 9 == 0 else "") for _ in range(r.randint(40, 120))) for i in range(150)]
    docs = documents(texts)
    labels = spark.createDataFrame([(i, int(i % 9 > 0)) for i in range(100)], "doc_id long, quality int")
    got = {x["doc_id"]: x for x in q.quality_rules(docs, labels, trees=20, tree_sample=16).collect()}
    passing = [i for i in sorted(got) if not got[i]["base_failed"]]
    assert passing == [i for i, t in enumerate(texts) if plain(t)[0] >= 50]
    total = {c: sum(got[i][c] for i in passing) for c in q.COUNTS}
    prior = (total["word_chars"] / total["n_words"], total["n_letters"] / total["word_chars"], total["n_upper"] / total["n_letters"])
    x = {i: q.features({c: np.array([got[i][c]]) for c in q.COUNTS}, prior)[0] for i in got}
    chosen = {v["doc_id"] for v in docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < int(min(1, 320 / len(passing)) * (1 << 30))).collect()}
    rows = sorted((i, *(got[i][c] for c in q.COUNTS)) for i in passing if i in chosen)
    forest = q.grow(np.array([x[v[0]] for v in rows]), 20, 16, 5)

    def path(v, tree):
        feature, cut, child, length = tree
        node = 0
        while feature[node] >= 0:
            node = child[node] + (v[feature[node]] > cut[node])
        return length[node]

    usual = 2 * (sum(1 / k for k in range(1, 16))) - 2 * 15 / 16
    for i in got:
        assert got[i]["anomaly"] == pytest.approx(2 ** (-sum(path(x[i], t) for t in forest) / 20 / usual), rel=0.02)
    # the cut: at least 99.9 % of the good kept, best balanced accuracy
    labelled = [(min(1000, int(got[i]["anomaly"] * 1000)), i % 9 > 0) for i in passing if i < 100]
    good, bad = sum(g for _, g in labelled), sum(not g for _, g in labelled)
    value = {c: (sum(g and b <= c for b, g in labelled) / good, sum(not g and b > c for b, g in labelled) / bad) for c in range(1001)}
    best = max(a + b for a, b in value.values() if a >= 0.999)
    kept = [got[i]["kept"] for i in passing if i < 100]
    assert sum(k and g for k, (_, g) in zip(kept, labelled)) / good + sum(not k and not g for k, (_, g) in zip(kept, labelled)) / bad == pytest.approx(best)
    highest = max(got[i]["anomaly"] for i in got if got[i]["kept"])
    assert all(got[i]["kept"] == (got[i]["anomaly"] <= highest) for i in passing)


def test_int_ids_and_long_text(spark, documents):
    texts = ["word and other words " * 40, None, "many different words here " * 100_000]
    for kind in ("int", "string", "short"):
        docs = documents(texts).withColumn("doc_id", F.col("doc_id").cast(kind))
        labels = spark.createDataFrame([(0, 1)], f"doc_id {kind}, quality int")
        got = q.quality_rules(docs, labels)
        assert got.schema["doc_id"].dataType.simpleString() == docs.schema["doc_id"].dataType.simpleString()
        assert sorted(x["n_words"] for x in got.collect()) == [0, 160, 400_000]


def test_odd_texts_and_no_labels(spark, documents, odd_texts):
    docs = documents(odd_texts + odd_texts).withColumns({"n_words": F.lit(1), "kept": F.lit(2)})
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = q.quality_rules(docs, none).collect()
    assert len(got) == 2 * len(odd_texts)
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 50)
    assert q.quality_rules(docs.limit(0), none).collect() == []


def test_calibration_takes_the_middle_of_a_gap():
    assert 0.4 < q.calibrate([(300, 50, 0), (400, 50, 0), (600, 0, 30)], 0.999) < 0.6
    assert q.calibrate([(300, 50, 0)], 0.999) > 1
