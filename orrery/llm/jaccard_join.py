"""N-gram Jaccard join with Bayesian candidate pruning."""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import WORD, small_batches, stored
from orrery.llm.components import components
from orrery.llm.textkit import group_starts, grouped, minhash, mix, pieces, seeds, shingle_sets, word_hashes

#: Words in a shingle and least similarity; MinHash values in a band, and bands; values compared at a time; tolerance.
SHINGLE, SIMILARITY = 5, 0.8
BAND, BANDS, STEP, TOLERANCE = 5, 24, 20, 1e-6
#: Members and shingles of a bucket that are compared in one unit; larger buckets are split into pairs of chunks of this size.
UNIT_MEMBERS, UNIT_SHINGLES = 1024, 1 << 19


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """Least number of equal values among n with which the posterior P(similarity >= threshold), from a uniform prior, is at least tolerance.

    The posterior of m matches is Beta(m + 1, n - m + 1); its upper tail at t is the binomial sum of C(n + 1, k) t^k (1 - t)^(n + 1 - k) over k <= m.
    """
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n


def signatures(docs: DataFrame, k: int, band: int, bands: int) -> DataFrame:
    """doc_id, text_key (a hash of the text), k1 and k2 (128-bit key of the set of shingles), n (shingles), values (MinHash, 32 bits each), buckets (a 64-bit key for each band)."""
    salts = seeds(bands, 31)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(1)):
                words, first = word_hashes(data, offsets)
                values, bounds = shingle_sets(words, first, k)
                size = np.diff(bounds)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (mix(values + np.uint64(5)), mix(values ^ np.uint64(0x5DEECE66D)))]
                k1, k2 = (mix(s[bounds[1:]] - s[bounds[:-1]] + size.astype(np.uint64)).view(np.int64) for s in sums)
                v = minhash(values, bounds, band * bands)
                h = np.zeros((len(size), bands), np.uint64)
                for j in range(band):
                    h = mix(h + v[:, j::band].astype(np.uint64) + np.uint64(j + 1))
                h = mix(h ^ salts).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * bands), pa.array(h.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(k1), pa.array(k2), pa.array(size.astype(np.int64)), pa.array([r.tobytes() for r in v], pa.binary()), lists], names=["doc_id", "text_key", "k1", "k2", "n", "values", "buckets"]
                )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(run, f"doc_id {kind}, text_key long, k1 long, k2 long, n long, values binary, buckets array<long>")


def survivors(values: np.ndarray, left: np.ndarray, right: np.ndarray, step: int, least: list[int]) -> np.ndarray:
    """Numbers of the pairs that are left after comparing step values at a time, dropping pairs with too few matches so far."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    for i, need in enumerate(least):
        if not len(alive):
            break
        part = slice(i * step, (i + 1) * step)
        matches = matches + (values[left[alive], part] == values[right[alive], part]).sum(1)
        keep = matches >= need
        alive, matches = alive[keep], matches[keep]
    return alive


def pair_blocks(starts: np.ndarray, chunk: np.ndarray, split: np.ndarray, most: int = 1 << 18):
    """(left rows, right rows) of all pairs within groups, in blocks. split groups pair rows of different chunks alone."""
    sizes = np.diff(starts)
    for s in np.unique(sizes[(sizes > 1) & (sizes <= 64) & ~split]):
        at = starts[:-1][(sizes == s) & ~split]
        i, j = np.triu_indices(int(s), 1)
        per = max(1, most // len(i))
        for a in range(0, len(at), per):
            yield (at[a : a + per, None] + i).ravel(), (at[a : a + per, None] + j).ravel()
    for g in np.flatnonzero(split | (sizes > 64)):
        lo, hi = int(starts[g]), int(starts[g + 1])
        if split[g]:
            cut = lo + int((chunk[lo:hi] == chunk[lo]).sum())
            lefts, rights = np.arange(lo, cut), np.arange(cut, hi)
            per = max(1, most // max(1, len(rights)))
            for a in range(0, len(lefts) if len(rights) else 0, per):
                own = lefts[a : a + per]
                yield np.repeat(own, len(rights)), np.tile(rights, len(own))
            continue
        per = max(1, most // (hi - lo))
        for a in range(lo, hi, per):
            own = np.arange(a, min(a + per, hi))
            left, right = np.repeat(own, hi - lo), np.tile(np.arange(lo, hi), len(own))
            keep = left < right
            yield left[keep], right[keep]


def candidates(units: DataFrame, band: int, bands: int, step: int, threshold: float, tolerance: float) -> DataFrame:
    """(bucket, i, j, node, weight, partners): the members of each unit that have a pair left, with the partners (nodes) of a member's pairs.

    units: bucket, i, j, chunk, band_no, node, n, weight, values, buckets, all rows of a unit side by side. A pair is looked at in the first band in which
    both members share a bucket, and nowhere else.
    """
    total = band * bands
    least = [least_matches(min(total, (i + 1) * step), threshold, tolerance) for i in range(-(-total // step))]
    keys = ("bucket", "i", "j")
    schema = pa.schema([("bucket", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("node", pa.int64()), ("weight", pa.int64()), ("partners", pa.list_(pa.int64()))])

    def run(batches):
        for rows in grouped(batches, keys, 1 << 25):
            n = rows.num_rows
            column = lambda c: rows.column(c).combine_chunks().to_numpy(zero_copy_only=False)  # noqa: E731, B023
            values = np.frombuffer(b"".join(rows.column("values").to_pylist()), np.uint32).reshape(n, total)
            buckets = rows.column("buckets").combine_chunks()
            buckets = (buckets.chunk(0) if isinstance(buckets, pa.ChunkedArray) else buckets).flatten().to_numpy().reshape(n, bands)
            node, size, weight, chunk, band_no = (column(c) for c in ("node", "n", "weight", "chunk", "band_no"))
            bucket, i_of, j_of = (column(c) for c in keys)
            starts = np.append(group_starts(rows, keys), n)
            split = i_of[starts[:-1]] != j_of[starts[:-1]]
            found_l, found_r = [], []
            for left, right in pair_blocks(starts, chunk, split):
                # sizes alone rule out a pair: the similarity is at most the smaller over the larger
                small, large = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
                keep = small >= threshold * large - 1e-9
                left, right = left[keep], right[keep]
                alive = survivors(values, left, right, step, least)
                left, right = left[alive], right[alive]
                earlier = np.argmax(buckets[left] == buckets[right], axis=1) < band_no[left]
                found_l.append(left[~earlier])
                found_r.append(right[~earlier])
            left = np.concatenate(found_l) if found_l else np.empty(0, np.int64)
            right = np.concatenate(found_r) if found_r else np.empty(0, np.int64)
            if not len(left):
                continue
            order = np.argsort(left, kind="stable")
            left, right = left[order], right[order]
            members = np.unique(np.concatenate([left, right]))
            cuts = np.append(np.searchsorted(left, members), len(left)).astype(np.int32)
            partners = pa.ListArray.from_arrays(pa.array(cuts), pa.array(node[right]))
            made = [bucket[members], i_of[members], j_of[members], node[members], weight[members]]
            yield pa.RecordBatch.from_arrays([*(pa.array(m, f.type) for m, f in zip(made, schema, strict=False)), partners], schema=schema)

    return units.mapInArrow(run, "bucket long, i int, j int, node long, weight long, partners array<long>")


def verified(members: DataFrame, k: int, threshold: float) -> DataFrame:
    """(node, links, root) for the members of each unit with a pair whose exact similarity is at least threshold: what it adds to the node's links, and the least node of those it is linked to in the unit."""
    keys = ("bucket", "i", "j")
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(batches):
        for rows in grouped(batches, keys, 1 << 25):
            n = rows.num_rows
            sets: list[tuple[np.ndarray, ...]] = []
            text = rows.column("text").combine_chunks()
            for _, _, data, offsets in pieces(text.chunk(0) if isinstance(text, pa.ChunkedArray) else text):
                words, first = word_hashes(data, offsets)
                sets.append(shingle_sets(words, first, k))
            values = np.concatenate([v for v, _ in sets])
            bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b) for _, b in sets]))])
            _, dense = np.unique(values, return_inverse=True)
            flag = np.zeros(int(dense.max(initial=0)) + 1, bool)
            node = rows.column("node").combine_chunks().to_numpy()
            weight = rows.column("weight").combine_chunks().to_numpy()
            partners = rows.column("partners").to_pylist()
            links = np.zeros(n, np.int64)
            root = np.arange(n)

            def top(x: int) -> int:
                while root[x] != x:  # noqa: B023
                    root[x] = root[root[x]]  # noqa: B023
                    x = root[x]  # noqa: B023
                return x

            starts = np.append(group_starts(rows, keys), n)
            size = np.diff(bounds)
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                place = dict(zip(node[lo:hi].tolist(), range(lo, hi), strict=True))
                for a in range(lo, hi):
                    if not partners[a] or place[int(node[a])] != a:  # a row that is there twice
                        continue
                    own = dense[bounds[a] : bounds[a + 1]]
                    flag[own] = True
                    others = np.array([place[p] for p in partners[a]])
                    lengths = size[others]
                    cuts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                    at = np.repeat(bounds[others] - cuts, lengths) + np.arange(int(lengths.sum()))
                    shared = np.add.reduceat(flag[dense[at]].astype(np.int64), cuts)
                    flag[own] = False
                    near = others[shared >= threshold * (size[a] + lengths - shared) - 1e-9]
                    if len(near):
                        links[a] += weight[near].sum()
                        links[near] += weight[a]
                        for b in near.tolist():
                            x, y = top(a), top(b)
                            if x != y:
                                root[max(x, y, key=lambda z: node[z])] = min(x, y, key=lambda z: node[z])  # noqa: B023
            hit = np.flatnonzero(links)
            if len(hit):
                made = [node[hit], links[hit], node[[top(int(x)) for x in hit]]]
                yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()) for m in made], schema=schema)

    return members.mapInArrow(run, "node long, links long, root long")


def jaccard_classes(docs: DataFrame, k: int = SHINGLE, threshold: float = SIMILARITY, band: int = BAND, bands: int = BANDS, step: int = STEP, tolerance: float = TOLERANCE) -> DataFrame:
    """One row for each row of docs: doc_id, text_key (xxhash64 of the text), class_id (the least doc_id it is linked to, directly or through others), class_text (that one's text_key) and n_links (other rows at a similarity of at least threshold).

    The similarity of two texts is the Jaccard coefficient of their sets of k-word shingles (words as written, between ASCII white space;
    a text of 1 to k - 1 words is one shingle). Texts with equal sets form a class, which one of them stands for; its
    copies count in links but are never paired. Representatives that share a MinHash band meet in a bucket. Their pairs are compared a
    few MinHash values at a time, and dropped when the posterior probability of reaching the threshold falls below
    tolerance; those left are verified exactly. A pair at the threshold itself shares none of the bands with a chance of
    (1 - 0.8^5)^24 = 7e-5 and is dropped by the posterior with one of about 1e-6; at a similarity of 0.9, 2e-9 in all.

    Buckets are not capped: one over UNIT_MEMBERS members or UNIT_SHINGLES shingles is split into chunks, and each pair of chunks is a unit of
    work. Pairs are never rows: a unit returns its members' numbers of links and one root for each.

    Null or empty texts: alone in their class, no links. Null ids: a null class_id, no part in links. Rows with the same doc_id are rows
    of their own, also in the numbers of links. Empty table: no rows. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    signed = stored(signatures(docs, k, band, bands), "signatures")
    usable = signed.filter("n > 0 AND doc_id IS NOT NULL")
    # a class's node is the first half of its key; its text is that of the least doc_id
    one = [F.first(c).alias(c) for c in ("n", "values", "buckets")]
    classes = usable.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "text_key")).alias("of"), F.count(F.lit(1)).alias("weight"), *one)
    classes = stored(classes.withColumnRenamed("k1", "node"), "classes")

    placed = classes.select("node", "n", F.posexplode("buckets").alias("band_no", "bucket"))
    full = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles")).filter("members > 1")
    chunks = F.greatest(F.ceil(F.col("members") / UNIT_MEMBERS), F.least(F.ceil(F.col("shingles") / UNIT_SHINGLES), F.col("members"))).cast("int")
    met = placed.drop("n").join(full.select("bucket", chunks.alias("chunks")), "bucket")
    met = met.withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(77)), F.col("chunks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.select("bucket", "band_no", "node", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    units = met.join(classes.select("node", "n", "weight", "values", "buckets"), "node")
    units = units.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "chunk", "node")
    left = candidates(units, band, bands, step, threshold, tolerance)

    texts = docs.select(F.struct("doc_id", F.xxhash64("text").alias("text_key")).alias("of"), "text")
    members = left.join(classes.select("node", "of"), "node").join(texts, "of").drop("of")
    members = members.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    linked = stored(verified(members, k, threshold), "links")

    roots = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    found = linked.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.select("node", "k2", "of", "weight").join(found, "node", "left").join(roots, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    least = known.groupBy("component").agg(F.min("of").alias("__class"))
    known = known.join(least, "component").select(F.col("node").alias("__1"), F.col("k2").alias("__2"), "__class", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("__links"))
    out = signed.select("doc_id", "text_key", "k1", "k2", "n")
    mine = (out["k1"] == known["__1"]) & (out["k2"] == known["__2"]) & (out["n"] > 0) & out["doc_id"].isNotNull()
    return out.join(known, mine, "left").select(
        "doc_id", "text_key", F.coalesce("__class.doc_id", "doc_id").alias("class_id"), F.coalesce("__class.text_key", "text_key").alias("class_text"), F.coalesce("__links", F.lit(0)).cast("long").alias("n_links")
    )


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id and n_links of jaccard_classes()."""
    return jaccard_classes(docs, **options).select("doc_id", "class_id", "n_links")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs without those that have a near duplicate of a lesser doc_id in their class. Rows with an empty text or a null id all stay; of equal rows one does."""
    classes = jaccard_classes(docs, **options)
    gone = classes.filter(~((F.col("doc_id") == F.col("class_id")) & (F.col("text_key") == F.col("class_text")))).select(F.col("doc_id").alias("__i"), F.col("text_key").alias("__k")).distinct()
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    left = keyed.join(gone, (keyed["doc_id"] == gone["__i"]) & (keyed["__key"] == gone["__k"]), "left_anti")
    nth = F.row_number().over(Window.partitionBy("doc_id", "__key").orderBy(F.lit(0)))
    left = left.withColumn("__nth", nth)
    free = F.col("doc_id").isNull() | ~F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    return left.filter(free | (F.col("__nth") == 1)).select(*docs.columns)
