"""Numpy over the bytes of many texts at once: words, hashes, shingles, MinHash."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once, where a text does not hold more itself.
CHUNK = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(salt))


_BYTES = seeds(256, 1)


@cache
def powers(bits: int, inverse: bool) -> np.ndarray:
    base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
    steps = np.full(1 << bits, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def power(n: int, inverse: bool = False) -> np.ndarray:
    return powers(max(21, int(n).bit_length()), inverse)[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one more for the end). Null: no bytes."""
    column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, chunk: int = CHUNK):
    """(first row, end row, bytes, offsets) of runs of rows with about chunk bytes each."""
    data, offsets = utf8(column)
    a, n = 0, len(column)
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + chunk, side="right")) - 1)
        b = min(b, n)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i], times the inverse base to the i, a hash of bytes i to j."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power(len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((prefix[ends] - prefix[starts]) * power(len(prefix), True)[starts])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without ASCII white space), and the number of the first word of each text."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and the number of the first word of each text."""
    starts, ends, first = word_spans(data, offsets)
    return span_hash(prefix_hash(data), starts, ends), first


def shingles(words: np.ndarray, first: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles, and the number of the first one of each text. short: a text of 1 to k - 1 words is one shingle."""
    n = len(words)
    total = np.zeros(n, np.uint64)
    salts = seeds(k, 7)
    counts = np.diff(first)
    end_of = np.repeat(first[1:], counts)
    at = np.arange(n)
    for j in range(k):
        whole = at + j < end_of
        shifted = np.zeros(n, np.uint64)
        shifted[: n - j] = words[j:]
        total += np.where(whole, shifted * salts[j] + salts[j], np.uint64(0))
    valid = at + k <= end_of
    if short:
        small = np.flatnonzero((counts > 0) & (counts < k))
        valid[first[:-1][small]] = True
    return mix(total)[valid], np.concatenate([[0], np.cumsum(valid)])[first]


def shingle_sets(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, distinct shingle hashes of each text, one after the other, and where each begins."""
    every, begin = shingles(words, first, k)
    own = [np.unique(every[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in own], dtype=np.int64)])
    return (np.concatenate(own) if own else every), bounds


def minhash(values: np.ndarray, bounds: np.ndarray, n: int, block: int = 1 << 15) -> np.ndarray:
    """n minima (uint32) for each set of values; a row of ones for an empty set."""
    a, b = seeds(n, 21) | np.uint64(1), seeds(n, 22)
    out = np.full((len(bounds) - 1, n), 0xFFFFFFFF, np.uint32)
    rows = np.flatnonzero(np.diff(bounds))
    i = 0
    while i < len(rows):
        j = max(i + 1, int(np.searchsorted(bounds[rows], bounds[rows[i]] + block)))
        part = values[bounds[rows[i]] : bounds[rows[j - 1] + 1]]
        cuts = bounds[rows[i:j]] - bounds[rows[i]]
        for k in range(n):
            out[rows[i:j], k] = np.minimum.reduceat(((part * a[k] + b[k]) >> np.uint64(32)).astype(np.uint32), cuts)
        i = j
    return out


def grouped(batches, keys: tuple[str, ...], most_bytes: int = 1 << 24):
    """Record batches cut where the keys change: each holds whole groups, and as many as fit into about most_bytes.

    The input is sorted by the keys. A single group larger than that comes whole; callers bound their groups.
    """
    held: list[pa.RecordBatch] = []
    held_bytes = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        held_bytes += batch.nbytes
        if held_bytes < most_bytes:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        last = group_starts(whole, keys)[-1]
        if last:
            yield whole.slice(0, last)
        rest = whole.slice(last)
        held = rest.to_batches()
        held_bytes = rest.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(rows: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """Row numbers at which a new group begins."""
    change = np.zeros(rows.num_rows, bool)
    change[0] = True
    for k in keys:
        v = rows.column(k).combine_chunks()
        v = (v.chunk(0) if isinstance(v, pa.ChunkedArray) else v).to_numpy(zero_copy_only=False)
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)
