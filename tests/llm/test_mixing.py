import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import mixing as mx

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(documents, seed=1, n=300):
    r = random.Random(seed)
    texts = [" ".join(f"w{r.randrange(50)}" for _ in range(r.choice([0, 1, 5, 40, 200]))) for _ in range(n)]
    source = [r.choice(["a", "b", "b", "b", "c", "é", None]) for _ in range(n)]
    return documents(texts + ["long " * 4000], source=[*source, "c"])


def plain_targets(sizes, weights, most):
    """Shares by weight; what is above a limit is shared again among the others."""
    out, open_, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s], float(sum(sizes))
    while open_:
        share = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if share * weights[i] > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = share * weights[i]
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
            open_.remove(i)
    return out


def plain_mix(rows, seed=11, block_words=64, shards=8, most=3, weights=(1, 2, 3)):
    """Words that each shard takes of each row, from rows (doc_id, source, size, h): blocks laid out, quotas split, draws dealt, one word at a time."""
    sources = sorted({r[1] for r in rows}, key=lambda x: (x is None, x or ""))
    size = [sum(r[2] for r in rows if r[1] == s) for s in sources]
    aims = plain_targets(size, [weights[i % len(weights)] for i in range(len(sources))], most)
    quotas, lines = [], []
    for i, (s, z, aim) in enumerate(zip(sources, size, aims)):
        line = [r for r in sorted((r for r in rows if r[1] == s), key=lambda r: (r[3] % mx.BUCKETS, r[3])) for _ in range(r[2])]
        n = max(1, min(mx.MAX_BLOCKS, z // block_words))
        blocks = [line[b * z // n : (b + 1) * z // n] for b in range(n)]
        want, draws = min(round(aim), most * z), []
        order = mx.block_order(i, n, seed)
        while want > 0:
            block = blocks[order[len(draws) % n]]
            draws.append(block[:want])
            want -= len(draws[-1])
        quotas.append(len(draws))
        lines.append(draws)
    taken = Counter()
    for draws, quota in zip(lines, mx.split(np.array(quotas), shards, [seed, 0])):
        draws = iter(draws)
        for shard, q in enumerate(quota):
            for _ in range(q):
                taken.update((r[0], shard) for r in next(draws))
    return taken, dict(zip(sources, aims))


def test_targets_are_shared_again(spark):
    def level(sizes, weights, most):
        df = spark.createDataFrame(list(zip(sizes, map(float, weights))), "size long, weight double")
        v = mx.water_level(df, most)
        return [min(v * w, most * s) if s else 0.0 for s, w in zip(sizes, weights)]

    t = level([10, 100, 1000], [1, 2, 3], 3)
    assert t[0] == 30 and t[1] == 300 and abs(sum(t) - 1110) < 1e-9
    assert level([0, 5], [1, 2], 3) == [0.0, 5.0]
    assert level([], [], 3) == []
    r = random.Random(6)
    for _ in range(5):
        sizes, weights = [r.choice([0, 1, 7, 50, 1000]) for _ in range(12)], [r.randint(1, 3) for _ in range(12)]
        assert np.allclose(level(sizes, weights, 3), plain_targets(sizes, weights, 3))


def test_tree_splits_quotas_exactly():
    q = np.array([5, 0, 100, 17, 3_000_000])
    s = mx.split(q, 7, 1)
    assert (s.sum(1) == q).all() and (s >= 0).all()
    assert s.sum(0).max() - s.sum(0).min() <= 3
    assert (s == mx.split(q, 7, 1)).all()


def test_tree_draws_are_hypergeometric():
    # the first half's share of source 0 over many seeds against mean and variance of the law
    q = np.array([30, 50, 20])
    left = np.array([mx.split(q, 2, [s])[0, 0] for s in range(3000)])
    assert abs(left.mean() - 15) < 0.15
    assert abs(left.var() - 50 * 0.3 * 0.7 * 50 / 99) < 0.5


def test_every_block_is_drawn_once_in_a_round(spark):
    n, draws, cut = mx.quota(4, 10_007, 23_456.0, 3, 64, 11)
    plan = spark.createDataFrame([(4, 10_007, 23_456.0, n, draws, cut, [draws // 3, draws // 2, draws])], mx.SOURCE_PLAN)
    rows = mx.drawn_blocks(plan, 11).collect()
    assert len({(r["block"], r["round"]) for r in rows}) == len(rows) == draws
    assert [sum(r["out_shard"] == k for r in rows) for k in range(3)] == [draws // 3, draws // 2 - draws // 3, draws - draws // 2]
    assert sum((r["block"] + 1) * 10_007 // n - r["block"] * 10_007 // n - r["lost"] for r in rows) == 23_456


def test_against_the_plain_mix(spark, documents):
    docs = table(documents)
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    h = {r["doc_id"]: r["h"] for r in docs.select("doc_id", F.xxhash64("doc_id", "text").alias("h")).collect()}
    got = mx.mix_counts(docs, block_words=64).collect()
    want, aims = plain_mix([(r["doc_id"], source[r["doc_id"]], r["size"], h[r["doc_id"]]) for r in got])
    shards = {(r["doc_id"], x["out_shard"]): x["n_words"] for r in got for x in r["shard_words"] or []}
    assert shards == want
    for r in got:
        assert r["taken"] == sum(n for (i, _), n in want.items() if i == r["doc_id"]) <= 3 * r["size"]
        assert r["target"] == pytest.approx(aims[source[r["doc_id"]]])
        assert r["first_shard"] == min((s for i, s in want if i == r["doc_id"]), default=None)
    taken = Counter()
    for r in got:
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - t) <= 1 for s, t in aims.items())
    again = mx.mix_counts(docs.repartition(5), block_words=64).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_trees_of_some_sources_each(spark, documents, monkeypatch):
    monkeypatch.setattr(mx, "TREE_SOURCES", 2)
    docs = table(documents)
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    taken, target = Counter(), {}
    for r in mx.mix_counts(docs, block_words=64).collect():
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert len(target) == 5 and all(abs(taken[s] - t) <= 1 for s, t in target.items())


def test_documents_of_the_mix(spark, documents):
    docs = table(documents, 2).withColumns({"size": F.lit("own"), "target": F.lit(1), "block": F.lit(2), "m": F.create_map(F.lit(1), F.col("doc_id"))})
    mixed = mx.mixed_documents(docs, block_words=64)
    assert mixed.columns == docs.columns
    words = Counter()
    original = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixed.collect():
        assert r["text"] in original[r["doc_id"]] and r["n_chars"] == len(r["text"]) and r["size"] == "own" and r["m"] == {1: r["doc_id"]}
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert {r["doc_id"]: r["taken"] for r in mx.mix_counts(docs, block_words=64).collect() if r["taken"]} == words


def test_equal_rows_null_ids_and_empty_tables(spark, documents):
    docs = documents([(1, "a b c"), (1, "a b c"), (None, "d e f g"), (None, None), (2, "")], source=["s", "s", "t", None, "t"])
    got = mx.mix_counts(docs).collect()
    assert len(got) == 5 and sum(r["taken"] for r in got) == 10
    assert sum(len(WORD.findall(r["text"])) for r in mx.mixed_documents(docs).collect()) == 10
    assert mx.mix_counts(docs.limit(0)).collect() == [] and mx.mixed_documents(docs.limit(0)).collect() == []


def test_long_text_is_spread_over_shards(spark, documents):
    docs = documents(["w" * 7 + " " + "long text " * 60_000, "short"], source=["a", "a"])
    row = next(r for r in mx.mix_counts(docs).collect() if r["size"] > 1)
    assert len(row["shard_words"]) == 8 and row["taken"] == sum(x["n_words"] for x in row["shard_words"])


def test_shards_in_shuffled_order(spark, documents):
    docs = table(documents, 3)
    counted = {(r["doc_id"], x["out_shard"]): x["n_words"] for r in mx.mix_counts(docs, block_words=64).collect() for x in r["shard_words"] or []}
    rows = mx.mixed_shards(docs, block_words=64).collect()
    order = [(r["out_shard"], r["place"]) for r in rows]
    assert order == sorted(order) and len({k for k, _ in order}) == 8
    of_mix = Counter()
    for r in rows:
        of_mix[r["__row"]["doc_id"], r["out_shard"]] += len(WORD.findall(r["__row"]["text"]))
    assert of_mix == counted
    assert [tuple(r) for r in mx.mixed_documents(docs, block_words=64).collect()] == [tuple(r["__row"]) for r in rows]
    assert [r["__row"]["doc_id"] for r in rows] != sorted(r["__row"]["doc_id"] for r in rows)


def test_copies_are_taken_each_for_itself(spark, documents):
    docs = documents([(1, "w " * 500)] * 3 + [(2, "v " * 700)], source=["s"] * 4)
    got = mx.mix_counts(docs, block_words=16, weights=(1,)).collect()
    assert all(sum(x["n_words"] for x in r["shard_words"]) == r["taken"] == r["size"] for r in got)
    assert len({x["out_shard"] for r in got for x in r["shard_words"]}) == 8
    words = Counter()
    for r in mx.mixed_documents(docs, block_words=16, weights=(1,)).collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert words == {1: 1500, 2: 700}
