"""Removal of repeated byte strings by suffix arrays."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import arrow_type, small_batches, stored
from orrery.llm.textkit import group_starts, grouped, mix, pieces, power, prefix_hash, span_hash

#: Bytes of a repeated string, of an anchor in it, and of the regions in a shard's suffix array.
LENGTH, ANCHOR, SHARD_BYTES = 400, 64, 1 << 21
#: Regions that are broadcast because very many texts have them are fewer than this.
MOST_HOT = 10_000
_PLACE = 30  # bits of a position beside a hash


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of width values, by running minima of blocks from both sides."""
    n = len(values)
    if n < width:
        return values[:0]
    full = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    full[:n] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def runs(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """(text, first window's start in it, windows, anchor hash, region hash) of runs of windows with the same anchor.

    A window's anchor is its least string of `anchor` bytes, by a hash, the first of equal ones. Equal windows have equal anchors at the same
    place, so every window belongs to one run, and windows are equal only where anchors are. The region of a run: the bytes of its windows.
    """
    empty = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    if len(data) < length:
        return empty
    prefix = prefix_hash(data)
    grams = mix((prefix[anchor:] - prefix[:-anchor]) * power(len(prefix), True)[: len(prefix) - anchor])
    places = np.arange(len(grams), dtype=np.uint64)
    least = sliding_min((grams >> np.uint64(_PLACE) << np.uint64(_PLACE)) | places, length - anchor + 1)
    at = (least & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), windows)
    start = np.arange(len(text)) + np.repeat(offsets[:-1] - np.cumsum(windows) + windows, windows)
    if not len(start):
        return empty
    own = at[start]
    new = np.ones(len(start), bool)
    new[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    begin = start[first]
    return text[first], begin - offsets[text[first]], count, grams[own[first]], span_hash(prefix, begin, begin + count + length - 1)


def words8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a big-endian number; zeros after the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for i in range(8):
        out |= padded[i : i + len(data)] << np.uint64(56 - 8 * i)
    return out


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes.

    Larsson and Sadakane: suffixes in groups by their first h bytes; a group is numbered by its first slot; groups of more than one are sorted
    by the numbers of the groups h bytes on, which doubles h. Groups of one are never touched again.
    """
    n = len(data)
    key = words8(data)
    order = np.argsort(key, kind="stable").astype(np.int32)
    slots = np.arange(n, dtype=np.int32)
    sa = order.copy()
    rank = np.empty(n, np.int32)
    sorted_key = key[order]
    h = 8
    while True:
        new = np.ones(len(slots), bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        group = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[sa[slots]] = group
        alone = new & np.append(new[1:], True)
        slots = slots[~alone]
        if h >= n or not len(slots):
            return sa
        p = sa[slots].astype(np.int64)
        on = p + h
        second = np.where(on < n, rank[np.minimum(on, n - 1)].astype(np.int64) + 1, 0)
        key = rank[p].astype(np.int64) << 32 | second
        order = np.argsort(key, kind="stable")
        sa[slots] = p[order]
        sorted_key = key[order]
        h *= 2


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int, block: int = 256) -> np.ndarray:
    """Length of the common prefix of each slot's suffix and the one before it, at most `most`; 0 for the first slot.

    Kasai: from a position to the next the common prefix with its predecessor falls by one at most, so comparing goes on from there. The text is
    cut into blocks, and all blocks advance by one position at a time together.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    key = np.concatenate([words8(data), np.zeros(most + 8, np.uint64)])
    out = np.zeros(n, np.int32)
    base = np.arange(0, n, block)
    held = np.zeros(len(base), np.int64)
    for t in range(min(block, n)):
        i = base + t
        live = i < n
        if not live.all():
            base, held, i = base[live], held[live], i[live]
        held = np.maximum(held - 1, 0)
        j = before[i]
        held[j < 0] = 0
        todo = np.flatnonzero((j >= 0) & (held < most))
        while len(todo):
            h = held[todo]
            differ = key[np.minimum(i[todo] + h, n + most)] ^ key[np.minimum(j[todo] + h, n + most)]
            same = differ == 0
            # whole bytes before the highest bit that differs
            high = differ >> np.uint64(32)
            half = np.where(high > 0, high, differ & np.uint64(0xFFFFFFFF))
            top = np.frexp(half.astype(np.float64))[1] + np.where(high > 0, 32, 0)
            held[todo] = h + np.where(same, 8, (64 - top) // 8)
            todo = todo[same & (held[todo] < most)]
        held = np.minimum(held, most)
        out[i] = held
    lcp = out[sa]
    lcp[0] = 0
    return lcp


def repeated_windows(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Flags of the sorted starts whose window of `length` bytes begins at another of the starts too."""
    sa = suffix_array(data)
    lcp = common_prefixes(data, sa, length)
    number = np.full(len(data), -1, np.int64)
    number[starts] = np.arange(len(starts))
    slots = np.flatnonzero(number[sa] >= 0)
    flags = np.zeros(len(starts), bool)
    if len(slots) > 1:
        # the least common prefix over the slots from one start to the next
        cuts = np.column_stack([slots[:-1] + 1, slots[1:] + 1]).ravel()
        cuts = cuts[:-1] if cuts[-1] >= len(lcp) else cuts
        between = np.minimum.reduceat(lcp, cuts)[::2]
        twin = between >= length
        own = number[sa[slots]]
        flags[own[:-1][twin]] = True
        flags[own[1:][twin]] = True
    return flags


def intervals(flags: np.ndarray, region: np.ndarray, offset: np.ndarray, begin: np.ndarray, length: int):
    """(region, first byte, end byte) of maximal runs of flagged windows; windows in the order of region and offset, begin: where regions begin in their texts."""
    at = np.flatnonzero(flags)
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (region[at][1:] != region[at][:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    r = region[at[first]]
    return r, begin[r] + offset[at[first]], begin[r] + offset[at[last]] + length


def anchored(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """doc_id, text_key, anchor, region_key, begin, windows for each run of windows in each text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, _, data, offsets in pieces(batch.column(2)):
                text, begin, count, gram, region = runs(data, offsets, length, anchor)
                rows = pa.array(text + a)
                columns = [batch.column(0).take(rows), batch.column(1).take(rows), gram.view(np.int64), region.view(np.int64), begin, count.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["doc_id", "text_key", "anchor", "region_key", "begin", "windows"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, f"doc_id {kind}, text_key long, anchor long, region_key long, begin long, windows int")


def regions(wanted: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """wanted (anchor, region_key, sub, subs, alone and a region's text and place) with the region's bytes."""
    fields = ("anchor", "region_key", "sub", "subs", "alone", "begin", "windows")
    per_text = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct(*fields)).alias("parts"))
    w = per_text.select(F.col("doc_id").alias("__i"), F.col("text_key").alias("__k"), "parts")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    joined = texts.join(w, texts["doc_id"].eqNullSafe(w["__i"]) & (texts["text_key"] == w["__k"])).select("doc_id", "text_key", "text", "parts")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_key", *fields, "region"]

    def run(batches):
        for batch in batches:
            ids, keys, texts_, parts = (batch.column(i) for i in range(4))
            for r in range(batch.num_rows):
                text = texts_[r].as_py().encode()
                own = parts[r].values
                begin, count = own.field("begin").to_numpy(), own.field("windows").to_numpy()
                made = [text[a : a + n + length - 1] for a, n in zip(begin.tolist(), count.tolist(), strict=True)]
                again = pa.array(np.zeros(len(own), np.int64))
                yield pa.RecordBatch.from_arrays([ids.slice(r, 1).take(again), keys.slice(r, 1).take(again), *(own.field(f) for f in fields), pa.array(made, pa.binary())], names=names)

    return joined.mapInArrow(run, f"doc_id {kind}, text_key long, anchor long, region_key long, sub int, subs int, alone boolean, begin long, windows int, region binary")


MARKS = "doc_id {}, text_key long, starts array<long>, ends array<long>"
BLOBS = ", anchor long, slice int, prints binary, places binary"
#: Of a window: a second hash, its region, its first byte there (-1 where it is removed already).
PLACE = np.dtype([("check", "<u8"), ("region_key", "<i8"), ("offset", "<i8")])


def chained(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A hash of the `length` bytes (8 at least) from each of the places: their 8-byte words, mixed one into the other. words: see words8()."""
    out = np.full(len(at), length, np.uint64)
    for j in [*range(0, length - 7, 8), length - 8]:
        out = mix(out ^ words[at + j])
    return out


def shard_marks(parts: DataFrame, length: int) -> DataFrame:
    """Marks of each shard's suffix array, and for anchors in several shards the windows' fingerprints, cut into slices by value.

    A row has either doc_id, text_key, starts, ends (removed bytes of a region that is nowhere else as a whole) or anchor, slice, prints (sorted) and places (PLACE of each
    print's window). So a window of a split anchor is in one row, whatever the number of shards and slices.
    """
    kind = parts.schema["doc_id"].dataType.simpleString()
    keys = ("anchor", "sub")

    def run(batches):
        for rows in grouped(batches, keys, SHARD_BYTES):
            n = rows.num_rows
            column = lambda c: rows.column(c).combine_chunks()  # noqa: E731, B023
            raw = column("region").to_pylist()
            data = np.frombuffer(b"".join(raw), np.uint8)
            size = np.array([len(x) for x in raw], np.int64)
            at = np.cumsum(size) - size
            count = column("windows").to_numpy().astype(np.int64)
            region = np.repeat(np.arange(n), count)
            offset = np.arange(len(region)) - np.repeat(np.cumsum(count) - count, count)
            begin = column("begin").to_numpy()
            alone = column("alone").to_numpy(zero_copy_only=False)
            flags = repeated_windows(data, at[region] + offset, length)
            ids, text_keys = column("doc_id"), column("text_key")
            r, lo, hi = intervals(flags & alone[region], region, offset, begin, length)
            if len(r):
                own, cuts = np.unique(r, return_index=True)
                cuts = np.append(cuts, len(r)).astype(np.int32)
                take = pa.array(own)
                yield table(len(own), doc_id=ids.take(take), text_key=text_keys.take(take), starts=pa.ListArray.from_arrays(pa.array(cuts), pa.array(lo)), ends=pa.ListArray.from_arrays(pa.array(cuts), pa.array(hi)))
            subs = column("subs").to_numpy()
            bounds = np.append(group_starts(rows, keys), n)
            anchors, region_keys = column("anchor").to_numpy(), column("region_key").to_numpy()
            prefix = words = None
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if subs[a] < 2:
                    continue
                mine = np.flatnonzero((region >= a) & (region < b))
                place = at[region[mine]] + offset[mine]
                prefix = prefix if prefix is not None else prefix_hash(data)
                words = words if words is not None else words8(data)
                prints, check = span_hash(prefix, place, place + length), chained(words, place, length)
                known = flags[mine] | ~alone[region[mine]]
                order = np.lexsort((known, check, prints))
                prints, check, known, mine = prints[order], check[order], known[order], mine[order]
                keep = ~known
                keep[0] = True
                keep[1:] |= (prints[1:] != prints[:-1]) | (check[1:] != check[:-1])
                prints, check, known, mine = prints[keep], check[keep], known[keep], mine[keep]
                places = np.zeros(len(prints), PLACE)
                places["check"], places["region_key"], places["offset"] = check, region_keys[region[mine]], np.where(known, -1, offset[mine])
                edge = np.searchsorted(prints, (np.arange(subs[a], dtype=np.float64) * (2.0**64 / subs[a])).astype(np.uint64))
                edge = np.append(edge, len(prints))
                for s in np.flatnonzero(np.diff(edge)).tolist():
                    p = slice(int(edge[s]), int(edge[s + 1]))
                    yield table(1, anchor=pa.array([anchors[a]]), slice=pa.array([s], pa.int32()), prints=pa.array([prints[p].tobytes()], pa.binary()), places=pa.array([places[p].tobytes()], pa.binary()))

    id_type = arrow_type(parts, "doc_id")
    kinds = dict(doc_id=id_type, text_key=pa.int64(), starts=pa.list_(pa.int64()), ends=pa.list_(pa.int64()), anchor=pa.int64(), slice=pa.int32(), prints=pa.binary(), places=pa.binary())

    def table(n: int, **columns):
        return pa.RecordBatch.from_arrays([columns[c].cast(t) if c in columns else pa.nulls(n, t) for c, t in kinds.items()], schema=pa.schema(list(kinds.items())))

    return parts.mapInArrow(run, MARKS.format(kind) + BLOBS)


def merged_marks(blobs: DataFrame, length: int) -> DataFrame:
    """anchor, region_key, starts, ends (bytes of the region) of windows that are in several shards of an anchor: each shard's sorted fingerprints are looked up by binary search in the merged ones.

    Windows are taken for equal where two unrelated 64-bit hashes of their bytes are.
    """
    keys = ("anchor", "slice")

    def run(batches):
        for rows in grouped(batches, keys, 1 << 24):
            bounds = np.append(group_starts(rows, keys), rows.num_rows)
            anchors = rows.column("anchor")
            read = lambda c, i, t: np.frombuffer(rows.column(c)[i].as_py(), t)  # noqa: E731, B023
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                shards = [(read("prints", i, np.uint64), read("places", i, PLACE)) for i in range(a, b)]
                # each shard's different windows, merged; and how many shards have each
                single = []
                for prints, places in shards:
                    new = np.ones(len(prints), bool)
                    new[1:] = (prints[1:] != prints[:-1]) | (places["check"][1:] != places["check"][:-1])
                    single.append((prints[new], places["check"][new]))
                merged, check = (np.concatenate(x) for x in zip(*single, strict=True))
                order = np.lexsort((check, merged))
                merged, check = merged[order], check[order]
                first = np.flatnonzero(np.append(True, (merged[1:] != merged[:-1]) | (check[1:] != check[:-1])))
                shards_with = np.diff(np.append(first, len(merged)))
                merged, check = merged[first], check[first]
                for prints, places in shards:
                    at = np.searchsorted(merged, prints)
                    while (other := check[at] != places["check"]).any():  # equal fingerprints, different windows
                        at[other] += 1
                    found = places[(shards_with[at] > 1) & (places["offset"] >= 0)]
                    if not len(found):
                        continue
                    found = found[np.lexsort((found["offset"], found["region_key"]))]
                    r, o = found["region_key"], found["offset"]
                    new = np.ones(len(r), bool)
                    new[1:] = (r[1:] != r[:-1]) | (o[1:] != o[:-1] + 1)
                    first_ = np.flatnonzero(new)
                    last = np.append(first_[1:], len(r)) - 1
                    one = pa.array(np.arange(len(first_) + 1, dtype=np.int32))
                    lists = [pa.ListArray.from_arrays(one, pa.array(x)) for x in (o[first_], o[last] + length)]
                    yield pa.RecordBatch.from_arrays([anchors.take(pa.array([a] * len(first_))).combine_chunks(), pa.array(r[first_]), *lists], names=["anchor", "region_key", "starts", "ends"])

    return blobs.select("anchor", "slice", "prints", "places").mapInArrow(run, "anchor long, region_key long, starts array<long>, ends array<long>")


def in_repeated(found: DataFrame, repeated: DataFrame, most: int = MOST_HOT) -> DataFrame:
    """Rows of found whose region is one of repeated (anchor, region_key, copies).

    Regions with more than 1 / most of all copies, fewer than `most` of them at any size, are looked up in a broadcast, so that a region in very many
    texts is not one task's work; the other rows meet theirs by key.
    """
    keys = ["anchor", "region_key"]
    every = repeated.agg(F.sum("copies")).first()[0] or 0
    hot = F.broadcast(repeated.filter(F.col("copies") * most > every).select(*keys))  # fewer than `most` rows of two numbers
    rest = repeated.filter(F.col("copies") * most <= every).select(*keys)
    return found.join(hot, keys, "left_semi").unionByName(found.join(hot, keys, "left_anti").join(rest, keys, "left_semi"))


def removed_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text) and spans: the byte runs of each text that are covered by a string of `length` bytes that starts anywhere else too. Texts without such are left out."""
    found = stored(anchored(docs, length, anchor), "anchors")
    # counted before they meet, so that an anchor or region in very many texts is a few rows
    counted = found.groupBy("anchor", "region_key").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_key", "begin")).alias("of"), F.first("windows").alias("windows"))
    per_anchor = F.sum("copies").alias("__all"), F.count(F.lit(1)).alias("__kinds"), F.sum(F.col("windows") + length).alias("__bytes")
    sums = counted.groupBy("anchor").agg(*per_anchor).filter("__all > 1")
    kinds = stored(counted.join(sums, "anchor"), "regions")
    # a region that is there as a whole twice or more is removed everywhere; one of its copies stands for it in the suffix arrays
    whole = in_repeated(found, kinds.filter("copies > 1"))
    whole = whole.select("doc_id", "text_key", F.array("begin").alias("starts"), F.array(F.col("begin") + F.col("windows") + (length - 1)).alias("ends"))
    shards = kinds.filter("__kinds > 1").withColumn("subs", F.ceil(F.col("__bytes") / shard_bytes).cast("int"))
    several = shards.select(
        "anchor", "region_key", F.pmod(F.xxhash64("region_key"), F.col("subs")).cast("int").alias("sub"), "subs", (F.col("copies") == 1).alias("alone"), "of.doc_id", "of.text_key", "of.begin", "windows"
    )
    parts = regions(several, docs, length).repartition("anchor", "sub").sortWithinPartitions("anchor", "sub")
    marks = stored(shard_marks(parts, length), "marks")
    blobs = marks.filter("prints IS NOT NULL").repartition("anchor", "slice").sortWithinPartitions("anchor", "slice")
    columns = ["doc_id", "text_key", "starts", "ends"]
    split_ = several.filter("subs > 1 AND alone").select("anchor", "region_key", "doc_id", "text_key", "begin")
    moved = lambda c: F.transform(c, lambda x: x + F.col("begin")).alias(c)
    merged = merged_marks(blobs, length).join(split_, ["anchor", "region_key"]).select("doc_id", "text_key", moved("starts"), moved("ends"))
    every = whole.unionByName(marks.filter("starts IS NOT NULL").select(*columns)).unionByName(merged)
    return every.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))).alias("spans"))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, with_kept: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining bytes, if asked for).

    Removed is each byte covered by a string of `length` bytes that starts anywhere else as well, in the same text or another;
    overlaps count, and strings are judged on the input. Matches never cross texts.

    Each window of `length` bytes belongs to its anchor, the least string of `anchor` bytes in it by a hash; equal windows have equal anchors, so
    only regions around anchors that are found twice are candidates, and none is missed. Equal regions are counted, not kept. Different
    regions of an anchor come together in a shard: its suffix array (Larsson-Sadakane in numpy) and common prefixes (Kasai)
    show which windows are there twice. An anchor with over shard_bytes of different regions is split over several shards; what is in
    several of them is found by merging the shards' sorted windows with binary search.

    Regions are known by 64 bits of a hash within their anchor, itself 64 bits of another 64 bytes; windows of different shards by two unrelated hashes; in a shard bytes are compared.

    Null or empty texts: nothing to remove, the hash of no bytes. Rows that are equal count as copies. Null ids are ids like any other.
    Texts of fewer than `length` bytes are kept whole. Empty table: no rows.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = removed_spans(docs, length, anchor, shard_bytes)
    s = spans.select(F.col("doc_id").alias("__i"), F.col("text_key").alias("__k"), "spans")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("__key"))
    joined = texts.join(s, texts["doc_id"].eqNullSafe(s["__i"]) & (texts["__key"] == s["__k"]), "left").select("doc_id", "text", "spans")

    def run(batches):
        for batch in batches:
            out = []
            for text, spans_ in zip(batch.column(1), batch.column(2), strict=True):
                raw = (text.as_py() or "").encode()
                removed, n_spans, kept, end = 0, 0, [], 0
                if spans_.is_valid:
                    lo, hi = (spans_.values.field(i).to_numpy() for i in (0, 1))
                    order = np.argsort(lo, kind="stable")
                    lo, hi = lo[order], np.maximum.accumulate(hi[order])
                    first = np.concatenate([[0], np.flatnonzero(lo[1:] > hi[:-1]) + 1])
                    for a, b in zip(lo[first].tolist(), hi[np.append(first[1:], len(hi)) - 1].tolist(), strict=True):
                        kept.append(raw[end:a])
                        removed, n_spans, end = removed + b - a, n_spans + 1, b
                kept.append(raw[end:])
                left = b"".join(kept)
                out.append((len(raw), removed, n_spans, hashlib.sha256(left).hexdigest(), left))
            columns = [batch.column(0), *(pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_kept:
                columns, names = [*columns, pa.array([o[4] for o in out], pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept)
