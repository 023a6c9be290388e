import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orrery.llm import jaccard_join as jj
from orrery.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, threshold=0.8):
    """(id, class, links) of each row by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))
    links = [0] * len(rows)

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[top(i)] = min(k, least.get(top(i), k))
    return sorted(((k, least.get(top(i)) if k is not None else None, links[i]) for i, (k, _) in enumerate(rows)), key=str)


def corpus(seed, groups=12):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = " ".join(r.choice(vocabulary) for _ in range(20))
    out = []
    for _ in range(groups):
        base = [r.choice(vocabulary) for _ in range(r.randint(6, 120))]
        for _ in range(r.randint(1, 5)):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            out.append(" ".join(w) + (" " + common if r.random() < 0.3 else ""))
    return out + out[:3]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, documents, odd_texts, seed):
    rows = list(enumerate(corpus(seed) + odd_texts)) + [(None, "one two three"), (None, None)]
    got = jj.jaccard_join(documents(rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_split_buckets_lose_nothing(spark, documents, monkeypatch):
    monkeypatch.setattr(jj, "UNIT_MEMBERS", 3)
    rows = list(enumerate(corpus(3)))
    got = jj.jaccard_join(documents(rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_repeated_ids_and_clashing_columns(spark, documents):
    docs = documents([(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words here now and then"), (2, "a b c d e f")]).withColumns({"node": F.lit(1), "k1": F.lit(2), "text_key": F.lit(3), "class_id": F.lit(4)})
    got = sorted(tuple(r) for r in jj.jaccard_join(docs).collect())
    assert got == [(1, 1, 0), (1, 1, 2), (1, 1, 2), (2, 1, 2)]
    left = jj.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == [(1, "a b c d e f"), (1, "other words here now and then")]


def test_empty_table(spark, documents):
    assert jj.jaccard_join(documents(["x"]).limit(0)).collect() == []


def test_pruning_keeps_likely_pairs():
    for n in (20, 60, 120):
        need = jj.least_matches(n, 0.8, 1e-6)
        assert 0 < need < 0.8 * n
    assert jj.least_matches(20, 0.8, 1e-2) > jj.least_matches(20, 0.8, 1e-6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=15))
def test_components(spark, pairs):
    got = dict(tuple(r) for r in components(spark.createDataFrame(pairs, "a long, b long")).collect())
    parent = {x: x for p in pairs for x in p}
    for _ in parent:
        for a, b in pairs:
            parent[a] = parent[b] = min(parent[a], parent[b])
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: parent[x] for x in linked}
