import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orrery.llm import tokenfile as tf

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from(["byte", "bit"]), st.sampled_from([8, 64, 4096]))
def test_planes_round_trip(ids, planes, block):
    assert tf.unpack(tf.pack(np.array(ids, np.uint32), planes, block)).tolist() == ids


def test_not_a_chunk():
    with pytest.raises(ValueError, match="not a chunk"):
        tf.unpack(b"nothing at all here")


def test_words_give_the_tokenizers_ids():
    encode, whole = tf.encoder(PATH), Tokenizer.from_file(PATH)
    r = random.Random(1)
    letters = list("abcXYZ '’ssttvelld!?.,09²½\t\n  \x1c\x85\xa0éÉÇßÀµªº×÷ÿŸİΣσςáë<|>日本") + ["<|endoftext|>", "'re", "'LL", "I'm", "don't"]
    latin = [c for c in letters if all(ord(x) < 256 for x in c)]
    for i in range(4000):
        text = "".join(r.choice(latin if i % 2 else letters) for _ in range(r.randint(0, 25)))
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_files_against_the_tokenizer(spark, documents, odd_texts, planes, tmp_path):
    r = random.Random(2)
    texts = odd_texts + [" ".join(r.choice(["Alpha,", "beta's", "γ", "9"]) for _ in range(r.randint(0, 90))) for _ in range(150)]
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    docs = documents(rows).repartition(5).withColumns({"part": F.lit(1), "ids": F.lit(2)})
    got = {x["doc_id"]: x for x in tf.write_and_read(docs, str(tmp_path / "t"), planes=planes, chunk_ids=500).collect()}
    whole, start = Tokenizer.from_file(PATH), 0
    for doc_id, text in sorted(rows):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        assert (got[doc_id]["start"], got[doc_id]["n_tokens"], got[doc_id]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    index = spark.read.parquet(str(tmp_path / "t" / "index"))
    assert index.agg(F.sum("n_ids")).first()[0] == start and index.count() > 3


def test_repeated_ids_and_empty_table(spark, documents):
    got = sorted(tuple(r) for r in tf.write_and_read(documents([(1, "a"), (1, "a"), (None, "b")])).select("start", "n_tokens").collect())
    assert got == [(0, 2), (2, 2), (4, 2)]
    assert tf.write_and_read(documents(["x"]).limit(0)).collect() == []
