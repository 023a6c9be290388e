"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted-shingle similarity."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import small_batches
from orrery.llm.textkit import mix, pieces, prefix_hash, shingles, span_hash, utf8, word_spans

#: Words in a shingle, least similarity.
SHINGLE, SIMILARITY = 5, 0.8
#: Bits of a fingerprint, Hamming radius, bits of a block of the index. A similarity of 0.8 is a cosine of 0.89, so each bit differs with a chance of 0.151:
#: more than 38 of 128 with a chance of 1e-5.
BITS, RADIUS, BLOCK_BITS = 128, 38, 16
#: Items that are sent to the executors at once.
ITEMS_AT_ONCE = 20_000

#: Letters and digits stay; every other ASCII character separates words. (Texts come in lower case.)
_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[48:58], _PLAIN[97:123], _PLAIN[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)

HIT = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("window_start", T.LongType()), T.StructField("window_words", T.LongType()), T.StructField("similarity", T.DoubleType())])


def weighted_shingles(data: np.ndarray, offsets: np.ndarray, k: int):
    """(shingle hashes, their weights, first shingle of each text, words of each text). A shingle weighs the bytes of its words."""
    plain = _PLAIN[data]
    starts, ends, first = word_spans(plain, offsets)
    words = span_hash(prefix_hash(plain), starts, ends)
    hashes, begin = shingles(words, first, k)
    counts = np.diff(first)
    length = np.concatenate([[0], np.cumsum(ends - starts)])
    # the shingle's first word: its place among the text's shingles, from the text's first word on
    text = np.repeat(np.arange(len(counts)), np.diff(begin))
    at = first[text] + np.arange(len(hashes)) - begin[text]
    return hashes, (length[np.minimum(at + k, first[text + 1])] - length[at]).astype(np.int64), begin, counts


def fingerprint(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """SimHash of BITS bits, as 16-bit blocks: a bit is set where the weights of the shingles that have it outweigh the others'."""
    both = np.column_stack([hashes, mix(hashes + np.uint64(1))]).astype("<u8")
    bits = np.unpackbits(both.view(np.uint8).reshape(len(hashes), -1), axis=1, bitorder="little")
    votes = 2 * (weights @ bits.astype(np.int64)) - weights.sum()
    return np.packbits(votes > 0, bitorder="little").view("<u2")


def near_masks(flips: int) -> np.ndarray:
    """The values of a block with at most that many bits set."""
    values = np.arange(1 << BLOCK_BITS)
    return values[np.bitwise_count(values) <= flips]


class Index:
    """Multi-index over fingerprints: items by the value of each block. Within the radius of a fingerprint at least one block differs in few bits.

    With a budget of flips for each block that adds up to radius + 1 - blocks, a print that exceeds every block's budget is outside the radius; so
    looking up every value within the budget of one's own, block by block, finds all prints within the radius.
    """

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        blocks = BITS // BLOCK_BITS
        each, more = divmod(radius + 1, blocks)
        self.masks = [near_masks(each - (b >= more)) for b in range(blocks)]
        self.order = [np.argsort(prints[:, b], kind="stable") for b in range(blocks)]
        self.first = [np.searchsorted(prints[:, b][o], np.arange((1 << BLOCK_BITS) + 1)) for b, o in enumerate(self.order)]

    def near(self, value: np.ndarray) -> np.ndarray:
        """Items whose prints are within the radius of value, in ascending order: block lookups, then the whole distance."""
        found = np.zeros(len(self.prints), bool)
        for b, masks in enumerate(self.masks):
            probe = masks ^ int(value[b])
            lo, hi = self.first[b][probe], self.first[b][probe + 1]
            for x, y in zip(lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                found[self.order[b][x:y]] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.prints[rows] ^ value).sum(1) <= self.radius]


class Items:
    """Benchmark items with their shingles, the index of their fingerprints, and an index of their rarest shingles."""

    def __init__(self, rows: list[tuple[int, str]], k: int, threshold: float, radius: int):
        self.threshold = threshold
        data, offsets = utf8(pc.utf8_lower(pa.array([t for _, t in rows], pa.large_string())))
        hashes, weights, begin, words = weighted_shingles(data, offsets, k)
        full = np.flatnonzero(np.diff(begin))
        self.ids = np.array([rows[i][0] for i in full], np.int64)
        own = [(hashes[begin[i] : begin[i + 1]], weights[begin[i] : begin[i + 1]]) for i in full]
        self.words = words[full]
        self.sizes = np.array([len(h) for h, _ in own], np.int64)
        self.weight = np.array([w.sum() for _, w in own], np.int64)
        self.bags = [np.unique(h, return_counts=True) for h, _ in own]
        self.index = Index(np.array([fingerprint(h, w) for h, w in own], np.uint16).reshape(len(own), BITS // BLOCK_BITS), radius)
        _, inverse, times = np.unique(hashes, return_inverse=True, return_counts=True)
        frequency = times[inverse]
        keys, items = [], []
        for n, i in enumerate(full):
            # similarity needs a shared weight of threshold times the item's, so one of these rarest shingles is shared
            f, (h, w) = frequency[begin[i] : begin[i + 1]], own[n]
            order = np.lexsort((np.arange(len(f)), f))
            need = int(np.searchsorted(np.cumsum(w[order]), (1 - threshold) * w.sum(), side="right")) + 1
            rare = np.unique(h[order[:need]])
            keys.append(rare)
            items.append(np.full(len(rare), n))
        keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.items = (np.concatenate(items) if len(keys) else np.empty(0, np.int64))[order]
        self.flags = np.zeros(1 << 20, bool)
        self.flags[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def similarities(self, item: int, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Weighted Jaccard of the item's bag of shingles and each of the text's windows of its size (the whole text where it is shorter)."""
        values, times = self.bags[item]
        m = len(hashes)
        n = min(int(self.sizes[item]), m)
        slot = np.minimum(np.searchsorted(values, hashes), len(values) - 1)
        at = np.flatnonzero(values[slot] == hashes)
        order = np.argsort(slot[at], kind="stable")
        at, own = at[order], slot[at][order]
        # a shingle counts as often as the item has it: here, while its occurrence that many before is left of the window
        place = np.arange(len(at))
        allowed = times[own]
        rank = place - np.searchsorted(own, own, side="left")
        left = np.where(rank >= allowed, at[np.maximum(place - allowed, 0)], -1)
        lo, hi = np.maximum(left + 1, np.maximum(at - n + 1, 0)), np.minimum(at, m - n)
        some = lo <= hi
        lo, hi, w = lo[some], hi[some], weights[at[some]]
        steps = np.bincount(lo, w, m - n + 2) - np.bincount(hi + 1, w, m - n + 2)
        shared = np.rint(np.cumsum(steps)[: m - n + 1])
        total = np.concatenate([[0], np.cumsum(weights)])
        window = total[n:] - total[: m - n + 1]
        return shared / np.maximum(1, window + self.weight[item] - shared)

    def search(self, hashes: np.ndarray, weights: np.ndarray, begin: np.ndarray) -> list[dict[int, tuple[float, int]]]:
        """For each text: item -> (similarity, first word) of its best window, the first of equal ones."""
        out: list[dict[int, tuple[float, int]]] = [{} for _ in range(len(begin) - 1)]
        at = np.flatnonzero(self.flags[(hashes >> np.uint64(44)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return out
        lo, hi = np.searchsorted(self.keys, hashes[at], side="left"), np.searchsorted(self.keys, hashes[at], side="right")
        text = np.searchsorted(begin, at, side="right") - 1
        pairs = np.unique(np.concatenate([np.column_stack([text[lo + j < hi], self.items[(lo + j)[lo + j < hi]]]) for j in range(int((hi - lo).max(initial=0)))] or [np.empty((0, 2), np.int64)]), axis=0)
        for t, item in pairs.tolist():
            h, w = hashes[begin[t] : begin[t + 1]], weights[begin[t] : begin[t + 1]]
            alike = self.similarities(item, h, w)
            start = np.flatnonzero(alike >= self.threshold)
            n = min(int(self.sizes[item]), len(h))
            for a in start[np.argsort(-alike[start], kind="stable")].tolist():
                if item in self.index.near(fingerprint(h[a : a + n], w[a : a + n])):
                    out[t][item] = (float(alike[a]), a)
                    break
        return out


_built: dict = {}


def built(shared, *options) -> Items:
    """The items of a broadcast, built once in a worker process."""
    key = (shared.value[0], *options)
    if key not in _built:
        _built.clear()
        _built[key] = Items(shared.value[1], *options)
    return _built[key]


def mark(docs: DataFrame, benchmark: DataFrame, column: str = "leaks", k: int = SHINGLE, threshold: float = SIMILARITY, radius: int = RADIUS, items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """docs with one more column: an array of (item_id, window_start, window_words, similarity) for each item that the text holds.

    A window has as many k-word shingles as the item; it leaks the item if the weighted Jaccard of the two bags of shingles
    is at least threshold. A text without any of an item's rarest shingles has no such window. In the others all windows of the item's
    size are looked at: the weight that each shares with the item leaves those that can leak it, whose SimHash is looked up in the blocks of
    the items' fingerprints, which miss none within the radius. Reported is the most similar window whose fingerprint is within the radius of the item's, the
    first of equal ones. A window at the threshold itself is outside the radius with a chance of 1e-5.

    Words are runs of letters and digits, in lower case. A text or item of fewer than k words is one shingle. Null or empty texts leak nothing;
    null or empty items are left out; equal items are all reported; a null item_id is reported as -1.
    Items reach the executors in runs of at most items_at_once, a pass over docs for each run. A column of docs with the new column's
    name is replaced. Empty tables: no leaks.
    """
    spark = docs.sparkSession
    small_batches(spark)
    given = benchmark.select(F.coalesce(F.col("item_id").cast("long"), F.lit(-1)).alias("item_id"), "text").filter("text IS NOT NULL")
    runs = max(1, -(-given.count() // items_at_once))
    out = docs.drop(column)
    names = out.columns
    at = names.index("text")
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("window_start", pa.int64()), ("window_words", pa.int64()), ("similarity", pa.float64())]))
    for run in range(runs):
        part = given.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(runs)) == run)
        rows = sorted((r[0], r[1]) for r in part.collect())
        made = f"{column}_{run}" if runs > 1 else column
        shared = spark.sparkContext.broadcast((hashlib.sha256(repr(rows).encode()).hexdigest(), rows))  # at most items_at_once

        def look(batches, shared=shared, made=made):
            items = built(shared, k, threshold, radius)
            for batch in batches:
                found = []
                for _, _, data, offsets in pieces(pc.utf8_lower(batch.column(at))):
                    hashes, weights, begin, _ = weighted_shingles(data, offsets, k)
                    for hits in items.search(hashes, weights, begin):
                        found.append([(int(items.ids[i]), a, int(items.words[i]), s) for i, (s, a) in sorted(hits.items())])
                found = [[dict(zip(("item_id", "window_start", "window_words", "similarity"), x, strict=True)) for x in f] for f in found]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, made])

        out = out.mapInArrow(look, T.StructType([*out.schema.fields, T.StructField(made, T.ArrayType(HIT))]))
    if runs > 1:
        extra = [f"{column}_{r}" for r in range(runs)]
        out = out.withColumn(column, F.concat(*extra)).drop(*extra)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for each document and benchmark item in it: doc_id, item_id, window_start, window_words, similarity. See mark()."""
    marked = mark(docs.select("doc_id", "text"), benchmark, "__leaks", **options)
    return marked.select("doc_id", F.explode("__leaks").alias("leak")).select("doc_id", "leak.*")
