"""A corpus pipeline: language, near duplicates, benchmark leaks, source mix, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import stored, table
from orrery.llm.decontaminate import mark
from orrery.llm.jaccard_join import one_of_each
from orrery.llm.langid import UNDETERMINED, identify
from orrery.llm.mixing import mixed_documents
from orrery.llm.ring_sharding import ring_shards

#: A language less likely than this, against the others known, is none.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; where lang is null it becomes the predicted one."""
    found = identify(docs.select("doc_id", "text", "lang", F.struct("*").alias("__row")), ("doc_id", "text", "__row"))
    sure = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    own = [F.col("__row").getField(c) for c in docs.columns]
    return sure.select(*[(F.coalesce(v, "lang_pred") if c == "lang" else v).alias(c) for c, v in zip(docs.columns, own, strict=True)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    marked = mark(docs, table(spark, sf_dir, "benchmark"), "__leaks")
    return marked.filter(F.size("__leaks") == 0).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a document as often as it is taken, cut where a block is."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and place."""
    return ring_shards(docs)


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", mixing),
    ("ring_sharding", sharding),
]

#: Several stages are not expressible in SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's rows written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
