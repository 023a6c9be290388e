import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from orrery.llm import decontaminate as dc


def words(r, n):
    return ["".join(r.choice("aeinorst") for _ in range(r.randint(2, 8))) for _ in range(n)]


def plain(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def bag(w):
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def weight(s):
    return sum(len(x.encode()) for x in s)


def best(doc, item):
    """Greatest weighted Jaccard of the item and a window of its size, over all windows."""
    d, i = plain(doc), plain(item)
    want, top = bag(i), 0.0
    if not set(want) & set(bag(d)):
        return 0.0
    for a in range(max(1, len(d) - len(i) + 1)):
        have = bag(d[a : a + len(i)])
        keys = set(want) | set(have)
        top = max(top, sum(min(want[k], have[k]) * weight(k) for k in keys) / sum(max(want[k], have[k]) * weight(k) for k in keys))
    return top


def test_against_all_windows(spark, documents, odd_texts):
    r = random.Random(17)
    items = [" ".join(words(r, r.randint(12, 60))) + "." for _ in range(12)]
    texts = []
    for _ in range(120):
        w = words(r, r.randint(30, 150))
        if r.random() < 0.6:
            item = r.choice(items).split()
            for _ in range(r.choice([0, 0, 0, 1, 1, 2, 4])):
                k = r.randrange(len(item))
                item[k : k + 1] = r.choice([[], ["changed"], [item[k], "more"], [item[k].upper() + "!"]])
            a = r.randrange(len(w))
            w[a:a] = item
        texts.append(" ".join(w))
    bench = spark.createDataFrame(list(enumerate(items)) + [(98, None), (99, ""), (None, items[0])], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["similarity"] for x in dc.leaks(documents(texts + odd_texts), bench).collect()}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            true = best(text, item)
            if (d, i) in got:
                assert 0.8 <= got[d, i] and abs(got[d, i] - true) < 1e-9
            else:
                assert true < 0.8
    assert {d for d, i in got if i == -1} == {d for d, i in got if i == 0}
    assert not {i for _, i in got} & {98, 99}


def test_runs_of_items_give_the_same(spark, documents):
    r = random.Random(19)
    items = [" ".join(words(r, 20)) for _ in range(9)]
    docs = documents([f"before this {x} and after that" for x in items] + ["clean text"])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    once = sorted(map(tuple, dc.leaks(docs, bench).collect()))
    assert [x[:2] for x in once] == [(i, i) for i in range(9)]
    assert sorted(map(tuple, dc.leaks(docs, bench, items_at_once=2).collect())) == once


def test_index_misses_nothing_within_the_radius():
    r = np.random.default_rng(3)
    items = dc.Items([(i, " ".join(f"w{x}" for x in r.integers(0, 999, 20))) for i in range(50)], 5, 0.8, 38)
    prints = items.index.prints
    for _ in range(200):
        value = np.unpackbits(prints[r.integers(50)].view(np.uint8), bitorder="little")
        value[r.choice(128, r.integers(0, 48), replace=False)] ^= 1
        value = np.packbits(value, bitorder="little").view("<u2")
        want = [i for i in range(50) if sum(bin(int(x)).count("1") for x in prints[i] ^ value) <= 38]
        assert items.index.near(value).tolist() == want


def test_all_windows_after_long_insertions_and_deletions(spark, documents):
    r = random.Random(29)
    items = [" ".join(words(r, r.randint(80, 200))) for _ in range(6)]
    items.append(" ".join(["same five words over again"] * 12))  # shingles that the item repeats
    texts = []
    for _ in range(90):
        item = r.choice(items).split()
        for _ in range(r.choice([1, 1, 2])):
            at, n = r.randrange(len(item)), r.randint(5, 20)
            item[at : at + (n if r.random() < 0.5 else 0)] = words(r, n) if r.random() < 0.5 else []
        w = words(r, r.randint(0, 60))
        a = r.randrange(len(w) + 1)
        texts.append(" ".join(w[:a] + item + w[a:] + (item[: len(item) // 2] if r.random() < 0.2 else [])))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["similarity"] for x in dc.leaks(documents(texts), bench).collect()}
    true = {(d, i): best(t, item) for d, t in enumerate(texts) for i, item in enumerate(items)}
    assert {k for k, s in true.items() if s >= 0.8} == set(got) and 20 < len(got) < 85
    assert all(abs(got[k] - true[k]) < 1e-9 for k in got)


def test_very_long_text(spark, documents):
    r = random.Random(31)
    item = " ".join(words(r, 60))
    line = " ".join(item.split()[:8])
    texts = [" ".join(words(r, 30_000)) + " " + item + " " + " ".join(words(r, 30_000)), (line + " ") * 8000]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = dc.leaks(documents(texts), bench).collect()
    assert [(x["doc_id"], x["window_start"], x["similarity"]) for x in got] == [(0, 30_000, 1.0)]


def test_clashing_column_and_empty_tables(spark, documents):
    docs = documents(["a b c d e f g"]).withColumn("leaks", F.lit(1))
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert [x["item_id"] for x in dc.mark(docs, bench).first()["leaks"]] == [1]
    assert dc.leaks(docs, bench.limit(0)).collect() == [] and dc.leaks(docs.limit(0), bench).collect() == []
