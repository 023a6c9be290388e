"""Quality rules with an isolation forest on the rules' statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import arrow_type, small_batches, stored
from orrery.llm.textkit import pieces, prefix_hash, shingles, span_hash, word_hashes, word_spans

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")
#: The forest: trees, documents in a tree.
TREES, TREE_SAMPLE = 400, 256

#: Shares of repeated lines and words that ordinary texts with a boilerplate line reach; the forest sees what is above.
TOLERATED_DUP_LINES, TOLERATED_REPEATS = 0.3, 0.25
PRIOR_WORDS = 100


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of COUNTS for each text."""
    starts, ends, first = word_spans(data, offsets)
    n = len(offsets) - 1
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])
    white = (data == 32) | ((data >= 9) & (data <= 13))
    out = {"n_words": np.diff(first)}
    out["word_chars"] = total(((data & 0xC0) != 0x80) & ~white)
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    out["n_symbols"] = total(symbol[data])
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    out["n_upper"], out["n_letters"] = total(upper), total(upper | lower)

    prefix = prefix_hash(data)
    words = span_hash(prefix, starts, ends)
    # lines: from a text's begin or after a \n, to a \n or the text's end
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    own = np.searchsorted(offsets, line_starts, side="right") - 1
    next_break = np.concatenate([breaks, [len(data)]])[np.searchsorted(breaks, line_starts)]
    line_ends = np.minimum(next_break, offsets[own + 1])
    word_at = np.searchsorted(starts, line_starts)
    full = np.concatenate([starts, [len(data)]])[word_at] < line_ends
    line_starts, line_ends, own = line_starts[full], line_ends[full], own[full]
    out["n_lines"] = np.bincount(own, minlength=n)
    order = np.lexsort((line_starts, h := span_hash(prefix, line_starts, line_ends), own))
    again = np.zeros(len(order), bool)
    again[1:] = (own[order][1:] == own[order][:-1]) & (h[order][1:] == h[order][:-1])
    out["n_dup_lines"] = np.bincount(own[order][again], minlength=n)

    windows, begin = shingles(words, first, 3, short=False)
    repeat = np.zeros(n, np.int64)
    for i in range(n):
        w = windows[begin[i] : begin[i + 1]]
        if len(w) < 2:
            continue
        s = np.sort(w)
        twice = s[1:][s[1:] == s[:-1]]
        if len(twice):
            hit = np.isin(w, twice)
            covered = np.zeros(len(w) + 2, bool)
            for j in range(3):
                covered[j : j + len(w)] |= hit
            repeat[i] = covered.sum()
    out["n_repeat_words"] = repeat
    return out


def usual(words: int, chars: int, letters: int, upper: int) -> tuple[float, float, float]:
    """Characters a word, share of ASCII letters, and share of capitals among those, from sums over all documents that pass the base rules."""
    words, chars, letters = max(1, words), max(1, chars), max(1, letters)
    return chars / words, letters / chars, upper / letters


def features(s: dict[str, np.ndarray], prior: tuple[float, float, float]) -> np.ndarray:
    """What the forest sees (rows x features): rates, so that a text is not odd for its length alone.

    Rates that vary by chance in short texts are drawn towards those of all documents that pass the base rules, as if PRIOR_WORDS usual words were added.
    """
    words = np.maximum(s["n_words"], 1).astype(float)
    length, letters, upper = prior
    chars = s["word_chars"] + PRIOR_WORDS * length
    return np.column_stack(
        [
            chars / (words + PRIOR_WORDS),
            np.sqrt(s["n_symbols"] / words),
            (s["n_upper"] + PRIOR_WORDS * length * letters * upper) / (s["n_letters"] + PRIOR_WORDS * length * letters),
            (s["n_letters"] + PRIOR_WORDS * length * letters) / chars,
            np.maximum(s["n_dup_lines"] / np.maximum(s["n_lines"], 1) - TOLERATED_DUP_LINES, 0),
            np.maximum(s["n_repeat_words"] / words - TOLERATED_REPEATS, 0),
        ]
    ).astype(float)


def average_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n leaves."""
    n = np.maximum(np.asarray(n, float), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n > 1, 1.0, 0.0))


def grow(x: np.ndarray, trees: int, tree_sample: int, seed: int) -> list[tuple[np.ndarray, ...]]:
    """Isolation trees as arrays (feature, cut, left child, path length at a leaf); a feature of -1 marks a leaf."""
    rng = np.random.default_rng(seed)
    forest = []
    for _ in range(trees):
        own = x[rng.choice(len(x), min(tree_sample, len(x)), replace=False)]
        limit = int(np.ceil(np.log2(max(2, len(own)))))
        feature, cut, child, path = [-1], [0.0], [0], [0.0]
        todo = [(0, own, 0)]
        while todo:
            i, rows, depth = todo.pop()
            low, high = rows.min(0), rows.max(0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(rows) < 2 or not len(usable):
                path[i] = depth + float(average_path(len(rows)))
                continue
            f = int(rng.choice(usable))
            c = float(rng.uniform(low[f], high[f]))
            feature[i], cut[i], child[i] = f, c, len(feature)
            for part in (rows[rows[:, f] <= c], rows[rows[:, f] > c]):
                todo.append((len(feature), part, depth + 1))
                for column, value in ((feature, -1), (cut, 0.0), (child, 0), (path, 0.0)):
                    column.append(value)
        forest.append((np.array(feature), np.array(cut), np.array(child), np.array(path)))
    return forest


def anomaly(x: np.ndarray, forest: list[tuple[np.ndarray, ...]], tree_sample: int) -> np.ndarray:
    """2 to the minus mean path length over the mean path length of the sample size: near 1 for what is isolated early."""
    depth = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, cut, child, path in forest:
        node = np.zeros(len(x), np.int64)
        for _ in range(64):
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                break
            go = x[rows, np.maximum(f, 0)] > cut[node]
            node = np.where(inner, child[node] + go, node)
        depth += path[node]
    return 2.0 ** (-depth / len(forest) / max(1e-9, float(average_path(tree_sample))))


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each text, one row for each row of docs. Null and empty texts: zeros."""
    schema = pa.schema([("doc_id", arrow_type(docs, "doc_id")), *((c, pa.int64()) for c in COUNTS)])

    def run(batches):
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            parts = [statistics(data, offsets) for _, _, data, offsets in pieces(text)]
            if parts:
                columns = [pa.array(np.concatenate([p[c] for p in parts]), pa.int64()) for c in COUNTS]
                yield pa.RecordBatch.from_arrays([ids, *columns], schema=schema)

    kinds = ", ".join(["doc_id " + docs.schema["doc_id"].dataType.simpleString(), *(f"{c} long" for c in COUNTS)])
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, kinds)


def calibrate(bins: list[tuple[int, int, int]], least_kept: float) -> float:
    """The anomaly score above which documents go, from (score bin of 1000, good, bad) of labelled rows.

    Among the cuts that keep at least least_kept of the good rows, the one of the best balanced accuracy; the middle of
    the gap if several bins in a row do as well. Without rows of either label nothing goes.
    """
    good, bad = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not good or not bad:
        return 1.1
    best, at = -1.0, (1100, 1100)
    kept_good = kept_bad = 0
    table = {b[0]: b for b in bins}
    for cut in range(1001):
        _, g, b = table.get(cut, (cut, 0, 0))
        kept_good, kept_bad = kept_good + g, kept_bad + b
        value = kept_good / good + (bad - kept_bad) / bad
        if kept_good >= least_kept * good:
            if value > best + 1e-12:
                best, at = value, (cut, cut)
            elif abs(value - best) <= 1e-12 and at[1] == cut - 1:
                at = (at[0], cut)
    return ((at[0] + at[1]) / 2 + 1) / 1000


def quality_rules(docs: DataFrame, labels: DataFrame, trees: int = TREES, tree_sample: int = TREE_SAMPLE, least_kept: float = 0.999, seed: int = 5) -> DataFrame:
    """One row for each row of docs: doc_id, the counts of COUNTS, base_failed, anomaly (double) and kept.

    base_failed: fewer than 50 words, or more than half of the words in 3-word windows found twice or more in the text.
    The isolation forest's trees take tree_sample documents each from trees * tree_sample ones, chosen by a hash of the id among all
    that pass the base rules; the rates that features are drawn towards are those of all that pass. Path lengths over the random splits give the anomaly of every
    document. The threshold is calibrated on all labelled rows (quality 1 good, 0 bad) that pass the base rules, from
    counts in 1000 score bins; documents of the same anomaly share a verdict, and one at the threshold goes.

    Null text: no words, so it fails. Null labels are left out. Rows that labels repeats or contradicts count each time.
    Repeated documents are judged each for itself, alike. Empty tables: no rows; without labels the base rules alone decide.
    """
    small_batches(docs.sparkSession)
    counts = stored(document_statistics(docs), "quality-counts")
    counts = counts.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    passed = counts.filter("NOT base_failed")
    sums = passed.agg(F.count(F.lit(1)), *[F.sum(c) for c in ("n_words", "word_chars", "n_letters", "n_upper")]).first()
    prior = usual(*(int(x or 0) for x in sums[1:]))
    chance = min(1.0, trees * tree_sample / max(1, sums[0]))
    chosen = passed.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < int(chance * (1 << 30)))
    rows = chosen.select("doc_id", *COUNTS).toPandas().sort_values(["doc_id", *COUNTS])
    forest = grow(features({c: rows[c].to_numpy() for c in COUNTS}, prior), trees, tree_sample, seed) if len(rows) else None
    size = min(tree_sample, max(1, len(rows)))

    def score(batches):
        for batch in batches:
            s = {c: batch.column(batch.schema.get_field_index(c)).to_numpy() for c in COUNTS}
            value = anomaly(features(s, prior), forest, size) if forest and batch.num_rows else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], names=[*batch.schema.names, "anomaly"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts.schema) + ", anomaly double"
    scored = counts.mapInArrow(score, kinds)
    judged = scored.filter("NOT base_failed").join(labels.select("doc_id", "quality").filter("quality IS NOT NULL"), "doc_id")
    bins = judged.groupBy(F.least(F.floor(F.col("anomaly") * 1000), F.lit(1000)).cast("int").alias("bin")).agg(F.sum((F.col("quality") == 1).cast("long")), F.sum((F.col("quality") == 0).cast("long")))
    cut = calibrate([tuple(r) for r in bins.collect()], least_kept)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < cut))
