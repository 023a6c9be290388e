import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orrery.llm import langid as li

PATH = public_tokenizers.path("piece_bpe_32k.model")


def table(documents, n=400):
    r = random.Random(13)
    parts = {"en": ["the", "ing", "tion", "and", "er"], "de": ["sch", "ung", "ver", "keit", "ein"], "fr": ["eau", "tion", "les", "oi", "que"]}
    texts, lang = [], []
    for i in range(n):
        k = list(parts)[i % 3]
        texts.append(" ".join("".join(r.choice(parts[k]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(3, 40))))
        lang.append(k if i % 11 else None)
    return texts, lang


def plain_score(word, names, prob):
    """Log-probability of a word by the plain forward sum in long logarithms."""
    marked = "▁" + word
    value = [np.zeros(prob.shape[1])]
    for k in range(1, len(marked) + 1):
        ways = [value[a] + np.log(prob[names[marked[a:k]]]) for a in range(max(0, k - 20), k) if marked[a:k] in names]
        value.append(np.logaddexp.reduce([*ways, value[k - 1] + np.log(prob[-1])]))
    return value[-1]


def column(words):
    return pa.array(words, pa.large_string())


def test_forward_sums_all_segmentations():
    vocabulary = li.pieces(PATH)
    prob = np.full((len(vocabulary.names) + 1, 1), 1e-3)
    prob[-1] = 1e-6
    words = ["then", "a", "écoles", "zzzq"]
    got = np.exp(li.word_scores(column(words), prob, vocabulary))[:, 0]
    for w, g in zip(words, got):
        marked = "▁" + w
        total = 0.0
        for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
            bounds = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(marked)]
            p = 1.0
            for a, b in zip(bounds, bounds[1:]):
                p *= (1e-3 if marked[a:b] in vocabulary.names else 0.0) + (1e-6 if b - a == 1 else 0.0)
            total += p
        assert g == pytest.approx(total, rel=1e-9), w


def test_long_words_are_whole_and_finite():
    vocabulary = li.pieces(PATH)
    names = {p: i for i, p in enumerate(vocabulary.names)}
    prob = np.random.default_rng(2).uniform(1e-7, 1e-3, (len(names) + 1, 3))
    prob[-1] = np.exp(li.UNKNOWN)
    words = ["ᚠ" * 60, "ꙮ" * 5000, "hello" + "ꙮ" * 47, "straße" * 400, "a" * 49, "the"]
    got = li.word_scores(column(words), prob, vocabulary)
    assert np.isfinite(got).all()
    for w, g in zip(words, got):
        assert g == pytest.approx(plain_score(w, names, prob), rel=1e-12), w[:20]
    assert np.ptp(got[0]) == 0 and np.ptp(got[1]) == 0  # nothing known: no language is likelier
    for slab in (50, 333, 1000):
        for w, g in zip(words, got):
            assert li.word_scores(column([w]), prob, vocabulary, slab)[0] == pytest.approx(g, rel=1e-12)


def test_expected_counts_are_the_derivative():
    vocabulary = li.pieces(PATH)
    names = {p: i for i, p in enumerate(vocabulary.names)}
    prob = np.random.default_rng(4).uniform(1e-6, 1e-3, len(names) + 1)
    words, counts = ["the", "anderen" * 9, "q", "écoles"], np.array([3.0, 1.0, 2.0, 1.0])
    use = li.Lattice(column(words), vocabulary).expected(prob, counts)
    for piece in (names["▁the"], names["and"], names["er"], len(names)):
        more = prob.copy()
        more[piece] *= 1 + 1e-6
        step = sum(c * (plain_score(w, names, more[:, None])[0] - plain_score(w, names, prob[:, None])[0]) for w, c in zip(words, counts)) / 1e-6
        assert use[piece] == pytest.approx(step, rel=1e-3, abs=1e-3)


def test_words_are_runs_of_letters():
    words, word, text = li.words_of(pa.array(["Größe, x2y ² été_A", None, "", "12 3", "ß"]))
    assert [[words[w].as_py() for w in word[text == i]] for i in range(5)] == [["größe", "x", "y", "été", "a"], [], [], [], ["ß"]]


def test_query_against_the_plain_sum(spark, documents, odd_texts):
    texts, lang = table(documents, 90)
    texts = texts + odd_texts + ["ᚠ" * 60, "hello " + "ꙮ" * 47, "12 34 !"]
    docs = documents(texts, lang=lang + [None] * (len(texts) - 90))
    languages, prob = li.train(docs, PATH, 60)
    vocabulary = li.pieces(PATH)
    names = {p: i for i, p in enumerate(vocabulary.names)}
    cache = {}
    for r in li.detect(docs.select("doc_id", "text"), languages, prob, PATH).collect():
        words = re.findall(r"[^\W\d_]+", (r["text"] or "").lower())
        for w in words:
            if w not in cache:
                cache[w] = plain_score(w, names, prob)
        if not words:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        total = sum(cache[w] for w in words)
        best = int(np.argmax(total))
        assert r["score"] == pytest.approx(1 / np.exp(total - total[best]).sum(), abs=1e-6)
        if np.sort(total)[-1] - np.sort(total)[-2] > 1e-6:
            assert r["lang_pred"] == languages[best]
        else:
            assert r["score"] <= 0.5 + 1e-9


def test_held_out_accuracy(spark, documents):
    texts, lang = table(documents)
    got = {r["doc_id"]: r for r in li.identify(documents(texts, lang=lang), train_docs=300).collect()}
    truth = {i: ["en", "de", "fr"][i % 3] for i in got}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i in got)
    assert sum(got[i]["lang_pred"] == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    lied = [x if i not in set(held) else "xx" for i, x in enumerate(lang)]
    again = {r["doc_id"]: r["lang_pred"] for r in li.identify(documents(texts, lang=lied), train_docs=300).collect()}
    assert again == {i: r["lang_pred"] for i, r in got.items()}


def test_odd_rows(spark, documents, odd_texts):
    texts, lang = table(documents, 60)
    docs = documents(texts + odd_texts + ["12 34 !", (None, "the end")], lang=lang + [None] * (len(odd_texts) + 2)).withColumns({"score": F.lit("s"), "lang_pred": F.lit(1)})
    got = li.identify(docs).collect()
    assert len(got) == 60 + len(odd_texts) + 2
    by = {r["doc_id"]: r for r in got}
    assert all(by[60 + i]["lang_pred"] == "und" and by[60 + i]["score"] == 0 for i in (0, 1, 2)) and by[60 + len(odd_texts)]["lang_pred"] == "und"
    assert li.identify(docs.limit(0)).collect() == []
    assert {r["lang_pred"] for r in li.identify(documents(["the"], lang=[None])).collect()} == {"und"}
