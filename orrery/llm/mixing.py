"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import WORD, numbered, small_batches, stored
from orrery.llm.textkit import mix

#: Words in a block, where a source has enough of them; blocks of a source at most.
BLOCK_WORDS, MAX_BLOCKS = 4096, 1 << 16
#: Hash buckets of a source that the prefix sums over its permuted documents run over.
BUCKETS = 4096
#: Output shards.
SHARDS = 8
#: Sources whose quotas one tree splits: their blocks stay below the 10^9 that an exact hypergeometric draw takes.
TREE_SOURCES = 4096

SOURCE_PLAN = "sid long, source_size long, target double, n long, draws long, cut long, ends array<long>"
DRAWS = "sid long, block long, round long, out_shard int, lost long"
PIECE = "out_shard int, round long, from_word long, n_words long"


def water_level(sources: DataFrame, most: float) -> float:
    """The level v at which the targets min(v * weight, most * size) add up to the sum of sizes.

    It rises step by step: sources that reach their limit leave, and what they leave is shared by weight among the others. Each step is
    one aggregate over (size, weight); it ends when no source leaves.
    """
    full_before, level = -1, 0.0
    while True:
        full = F.col("weight") * F.lit(level) > F.col("size") * F.lit(float(most))
        row = sources.filter("size > 0").agg(
            F.coalesce(F.sum("size"), F.lit(0)).alias("total"),
            F.sum(full.cast("int")).alias("n"),
            F.sum(F.when(full, F.col("size") * F.lit(float(most))).otherwise(0.0)).alias("taken"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        total = int(row["total"])
        if not total or not row["weight"] or row["n"] == full_before:
            return level
        full_before = row["n"]
        level = (total - row["taken"]) / row["weight"]


def split(quotas: np.ndarray, shards: int, seed) -> np.ndarray:
    """Blocks of each source in each shard (sources x shards): a node of the tree draws its left half's blocks from its own without replacement."""
    out = np.zeros((len(quotas), shards), np.int64)
    seeds = [int(x) for x in np.atleast_1d(seed)]

    def node(q: np.ndarray, first: int, n: int) -> None:
        if n == 1:
            out[:, first] = q
            return
        half, total = n // 2, int(q.sum())
        rng = np.random.default_rng([*seeds, first, n])
        left = np.zeros_like(q)
        rest, need = total, total * half // n
        for i in np.flatnonzero(q):  # marginals: a hypergeometric draw for each source, given those before it
            rest -= int(q[i])
            left[i] = rng.hypergeometric(int(q[i]), rest, need) if need else 0
            need -= int(left[i])
        node(left, first, half)
        node(q - left, first + half, n - half)

    node(quotas.astype(np.int64), 0, shards)
    return out


def block_order(sid: int, n: int, seed: int) -> np.ndarray:
    """The permutation in which a source's blocks are drawn."""
    return np.random.default_rng([seed, sid]).permutation(n)


def quota(sid: int, size: int, target: float, most: float, block_words: int, seed: int) -> tuple[int, int, int]:
    """(blocks, draws, words that the last draw leaves out) with which a source's draws take its target, rounded.

    Block b holds the words from b * size // n to (b + 1) * size // n of the source's line.
    """
    n = max(1, min(MAX_BLOCKS, size // block_words))
    want = min(round(target), int(most * size))
    if want <= 0:
        return n, 0, 0
    rounds, rest = divmod(want, size)
    block = block_order(sid, n, seed).astype(object if size >= 1 << 46 else np.int64)
    taken = np.cumsum((block + 1) * size // n - block * size // n)
    whole = int(np.searchsorted(taken, rest)) + 1 if rest else 0
    return n, rounds * n + whole, int(taken[whole - 1]) - rest if rest else 0


def tree_plan(sources: DataFrame, most: float, shards: int, seed: int, block_words: int) -> DataFrame:
    """SOURCE_PLAN of (sid, size, target): each source's quota of blocks and where each shard's draws end. A tree for every TREE_SOURCES sources."""
    per_tree = max(1, min(TREE_SOURCES, (10**9 - 1) // (MAX_BLOCKS * int(np.ceil(most) + 1))))

    def plan(key, frame):
        frame = frame.sort_values("sid")
        rows = [quota(s, z, t, most, block_words, seed) for s, z, t in zip(frame["sid"].tolist(), frame["size"].tolist(), frame["target"].tolist(), strict=True)]
        ends = np.cumsum(split(np.array([r[1] for r in rows], np.int64), shards, [seed, int(key[0])]), axis=1)
        made = frame[["sid"]].assign(source_size=frame["size"], target=frame["target"], n=[r[0] for r in rows], draws=[r[1] for r in rows], cut=[r[2] for r in rows])
        return made.assign(ends=list(ends))

    return sources.select("sid", "size", "target").groupBy(F.floor(F.col("sid") / per_tree).alias("tree")).applyInPandas(plan, SOURCE_PLAN)


def drawn_blocks(plan: DataFrame, seed: int) -> DataFrame:
    """A row of DRAWS for each draw of each shard: the shards draw one after the other from the permuted blocks, so no block is drawn twice in a round."""
    schema = pa.schema([("sid", pa.int64()), ("block", pa.int64()), ("round", pa.int64()), ("out_shard", pa.int32()), ("lost", pa.int64())])

    def run(batches):
        for batch in batches:
            for sid, n, draws, cut, ends in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if not draws:
                    continue
                d = np.arange(draws)
                lost = np.zeros(draws, np.int64)
                lost[-1] = cut
                columns = [np.full(draws, sid), block_order(sid, n, seed)[d % n], d // n, np.searchsorted(np.array(ends), d, side="right").astype(np.int32), lost]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return plan.select("sid", "n", "draws", "cut", "ends").repartition("sid").mapInArrow(run, DRAWS)


def identity(docs: DataFrame) -> list:
    """Two 64-bit hashes by which equal rows of docs are known; a column that cannot be hashed, such as a map, is hashed as JSON."""
    columns = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema]
    return [F.xxhash64("doc_id", "text").alias("__h"), F.xxhash64(F.lit(1), *columns).alias("__g")]


def mixed_rows(
    docs: DataFrame,
    weights: tuple[float, ...] = (1, 2, 3),
    most: float = 3,
    shards: int = SHARDS,
    seed: int = 11,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row for each row of docs: doc_id, source, __h, __g (see identity), size, source_size, target, sid (number of the source), at (first word's place in the
    source's line; null without words) and pieces, the parts of the row that shards take.

    The documents of a source lie in a line, in the order of a hash; the line is cut into blocks of about block_words words. The source's
    quota of blocks, repeats counted, is split exactly among the output shards by a tree of multivariate-hypergeometric
    draws. The shards then draw their quotas one after the other along a permutation of the blocks, gone through once for each repeat, so draws
    are disjoint. A piece is the part of a row in a drawn block: out_shard, round, from_word, n_words. The last block of a source is cut so that its words are its target, rounded.

    Sizes are words; a null text has none. Sources are ordered by code point, null last, and weigh `weights` in turn. A target stops at
    `most` times the source's size. Equal rows lie side by side and are taken each for itself. Null ids are ids like any other. An empty table gives none.

    The texts are read once, for sizes and hashes. No step meets a source's rows in one task: lines are summed in BUCKETS buckets, draws are joined
    by block. Sources are numbered and planned in tasks too; the driver sees the water level alone.
    """
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("__s")
    slim = docs.select("doc_id", "source", key, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *identity(docs))
    slim = stored(slim.withColumn("__bucket", F.pmod("__h", F.lit(BUCKETS)).cast("int")), "mix-sizes")
    totals = slim.groupBy("__s", "source", "__bucket").agg(F.sum("size").alias("__sum"))
    sources = numbered(totals.groupBy("__s", "source").agg(F.sum("__sum").alias("size")), [F.col("source").asc_nulls_last()], "sid")
    sources = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int")))
    level = water_level(sources, most)
    sources = sources.withColumn("target", F.when(F.col("size") > 0, F.least(F.col("weight") * F.lit(level), F.col("size") * F.lit(float(most)))).otherwise(0.0))
    plan = stored(tree_plan(sources, most, shards, seed, block_words), "mix-plan")

    ahead = Window.partitionBy("__s").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__s", "__bucket", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__offset"))
    offsets = offsets.join(sources.select("__s", "sid"), "__s").join(plan.select("sid", "source_size", "target", "n"), "sid")
    line = Window.partitionBy("__s", "__bucket").orderBy("__h", "doc_id", "__g").rowsBetween(Window.unboundedPreceding, -1)
    lined = slim.withColumn("__before", F.coalesce(F.sum("size").over(line), F.lit(0))).join(offsets, ["__s", "__bucket"])
    lined = lined.withColumn("at", F.when(F.col("size") > 0, F.col("__before") + F.col("__offset")))
    carried = ("doc_id", "source", "__h", "__g", "size", "source_size", "target")
    lined = stored(lined.select(*carried, "sid", "at", "n"), "mix-lines")

    # block b begins at floor(b * S / n): word w is in block floor(((w + 1) * n - 1) / S)
    block_of = lambda w: F.expr(f"(({w} + 1) * n - 1) div source_size")
    parts = lined.filter("size > 0").withColumn("block", F.explode(F.sequence(block_of("at"), block_of("(at + size - 1)"))))
    parts = parts.join(drawn_blocks(plan, seed), ["sid", "block"], "left")
    parts = parts.withColumns({"__lo": F.greatest("at", F.expr("block * source_size div n")), "__hi": F.least(F.expr("at + size"), F.expr("(block + 1) * source_size div n - lost"))})
    piece = F.when(F.col("out_shard").isNotNull() & (F.col("__hi") > F.col("__lo")), F.struct("out_shard", "round", (F.col("__lo") - F.col("at")).alias("from_word"), (F.col("__hi") - F.col("__lo")).alias("n_words")))
    rows = parts.groupBy("sid", "at").agg(*[F.first(c).alias(c) for c in carried], F.sort_array(F.collect_list(piece)).alias("pieces"))
    none = lined.filter("size = 0").select(*carried, "sid", "at", F.array().cast(f"array<struct<{PIECE.replace(' ', ':').replace(',:', ',')}>>").alias("pieces"))
    return rows.select(*carried, "sid", "at", "pieces").unionByName(none)


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words that the shards take, repeats counted), first_shard and shard_words of each document; see mixed_rows.

    shard_words: (out_shard, n_words) of the shards that take words of the document, in their order; taken is their sum; both are null or 0 where none does.
    """
    rows = mixed_rows(docs.select("doc_id", "text", "source"), **options)
    n_words = lambda s: F.aggregate(F.filter("pieces", lambda p: p["out_shard"] == s), F.lit(0).cast("long"), lambda a, p: a + p["n_words"])
    rows = rows.withColumn("shard_words", F.transform(F.array_sort(F.array_distinct(F.col("pieces.out_shard"))), lambda s: F.struct(s.alias("out_shard"), n_words(s).alias("n_words"))))
    taken = F.aggregate("shard_words", F.lit(0).cast("long"), lambda a, s: a + s["n_words"])
    some = F.when(F.size("shard_words") > 0, F.col("shard_words"))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), some[0]["out_shard"].alias("first_shard"), some.alias("shard_words"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """mixed_shards in the columns of docs, in the same partitions and order."""
    return mixed_shards(docs, **options).select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])


def mixed_shards(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: out_shard, place, and __row in the columns of docs, with the text of the words taken; each round's part of a document in a shard is a row.

    Partitions hold the shards one after the other, each in the order of place: written, the files in the order of
    their names are the shards in turn, shuffled. A shard has as many partitions as spark.sql.shuffle.partitions allows it, by ranges of place.

    Pieces that meet in a round and shard are one row. A whole document keeps its text as it is; a part runs from its first
    word to its last one. n_chars, where docs has it, is that of the new text.

    The texts are shuffled twice: to meet their pieces (equal rows as one text, so a group of copies is not one task's), and into the shards.
    """
    small_batches(docs.sparkSession)
    columns = docs.columns
    shards, seed = options.get("shards", SHARDS), options.get("seed", 11)
    taken = mixed_rows(docs, **options).filter(F.size("pieces") > 0).select("__h", "__g", F.xxhash64("__h", "at", F.lit(seed)).alias("__base"), "size", "pieces")
    texts = docs.select(*identity(docs), F.struct(*[F.col(c) for c in columns]).alias("__row"), F.col("text").alias("__whole"))
    one = Window.partitionBy("__h", "__g").orderBy(F.lit(1))
    texts = texts.withColumn("__nth", F.row_number().over(one)).filter("__nth = 1").drop("__nth")
    rows = texts.join(taken, ["__h", "__g"]).select("__row", "__whole", "__base", "size", "pieces")
    schema = T.StructType([rows.schema["__row"], T.StructField("__text", T.StringType()), T.StructField("out_shard", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("__from", T.LongType())])

    def cut(batches):
        for batch in batches:
            made: list[tuple[int, str, int, int, int]] = []
            for i, (text, base, size, pieces) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(1, 5)), strict=True)):
                spans: list[list[int]] = []
                for p in pieces:  # in the order of shard, round, word
                    s, r, lo, n = p["out_shard"], p["round"], p["from_word"], p["n_words"]
                    if spans and spans[-1][:2] == [s, r] and spans[-1][3] == lo:
                        spans[-1][3] = lo + n
                    else:
                        spans.append([s, r, lo, lo + n])
                word = None if all((lo, hi) == (0, size) for _, _, lo, hi in spans) else [m.span() for m in re.finditer(WORD, text)]
                for s, r, lo, hi in spans:
                    made.append((i, text if (lo, hi) == (0, size) else text[word[lo][0] : word[hi - 1][1]], s, base + r, lo))
            if made:
                at, texts_, shard, place, begin = zip(*made, strict=True)
                place = mix(np.array([p % (1 << 64) for p in place], np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(texts_, pa.string()), pa.array(shard, pa.int32()), pa.array(place), pa.array(begin, pa.int64())], names=schema.names)

    new = {"text": F.col("__text"), "n_chars": F.char_length("__text").cast("long")}
    made = rows.mapInArrow(cut, schema)
    each = max(1, -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards))
    made = made.repartitionById(shards * each, F.expr(f"int(out_shard * {each} + shiftright((shiftright(place, 32) + 2147483648L) * {each}, 32))"))
    made = made.sortWithinPartitions("out_shard", "place", "__from")
    return made.select("out_shard", "place", F.struct(*[new[c].alias(c) if c in new else F.col("__row").getField(c).alias(c) for c in columns]).alias("__row"))
