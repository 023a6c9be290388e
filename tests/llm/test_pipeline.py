import random
from collections import Counter

import corpus_pipeline as cp
from orrery.llm import decontaminate, jaccard_join, langid, mixing

from pyspark.sql import functions as F


def make(spark, tmp_path, extra=False):
    r = random.Random(23)
    parts = {"en": ["the", "ing", "tion", "and"], "de": ["sch", "ung", "ver", "keit"]}
    word = lambda k: "".join(r.choice(parts[k]) for _ in range(r.randint(1, 4)))
    items = [" ".join(word("en") + str(i) for i in range(20)) for _ in range(3)]
    rows = []
    for i in range(120):
        k = "en" if i % 3 else "de"
        w = [word(k) + ("x" * (i % 2)) for _ in range(r.randint(20, 60))]
        if i % 20 == 5:
            w[5:5] = items[i % 3].split()
        rows.append([i, " ".join(w), k if i % 7 else None, f"s{i % 4}" if i % 13 else None, 0])
    rows += [[500 + i, rows[i][1], rows[i][2], "s0", 0] for i in range(10)]
    rows += [[600, None, None, None, None], [601, "", "en", "s1", 0], [602, "12 34", "en", "s1", 5], [None, rows[1][1] + " nullid", "en", "s2", 9]]
    docs = spark.createDataFrame([tuple(x) for x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        docs = docs.withColumns({c: F.lit(1) for c in ("size", "score", "leaks", "held_out", "lang_pred", "block", "node")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_against_the_plain_ones(spark, tmp_path):
    d = make(spark, tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    bench = spark.read.parquet(f"{d}/benchmark.parquet")
    columns = docs.columns
    key = lambda df: Counter((r["doc_id"], r["text"]) for r in df.collect())
    one = cp.language_id(spark, docs, d)
    sure = [r for r in langid.identify(docs).collect() if r["lang_pred"] != "und" and r["score"] >= 0.5]
    assert one.columns == columns and key(one) == Counter((r["doc_id"], r["text"]) for r in sure)
    assert one.filter("lang IS NULL").count() == 0
    two = cp.near_duplicates(spark, one, d)
    kept = {r["doc_id"] for r in jaccard_join.jaccard_join(one).collect() if r["doc_id"] == r["class_id"]}
    assert two.columns == columns and {r["doc_id"] for r in two.collect()} == kept and not {500, 501} & kept
    three = cp.decontamination(spark, two, d)
    leaked = {r["doc_id"] for r in decontaminate.leaks(two, bench).collect()}
    assert leaked and three.columns == columns and {r["doc_id"] for r in three.collect()} == {r["doc_id"] for r in two.collect()} - leaked
    four = cp.mixing(spark, three, d)
    assert four.columns == columns
    words = Counter()
    for r in four.collect():
        words[r["doc_id"]] += len(r["text"].split())
    assert words == Counter({r["doc_id"]: r["taken"] for r in mixing.mix_counts(three).collect() if r["taken"]})
    five = cp.sharding(spark, four, d)
    assert five.count() == four.count() and key(five) == key(four)


def test_run_gives_the_last_stage(spark, tmp_path):
    d = make(spark, tmp_path, extra=True)
    out = cp.run(spark, d)
    rows = out.collect()
    assert {"doc_id", "shard", "slot", "held_out", "leaks"} <= set(out.columns) and len(rows) > 80
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert cp.run(spark, str(tmp_path)).collect() == []
