"""Language identification by unigram pieces, all segmentations summed."""

from __future__ import annotations

import hashlib
from functools import cache, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import fold, small_batches
from orrery.llm.textkit import mix, power, prefix_hash

#: What stands between words: everything but letters.
BETWEEN = r"[^\p{L}]+"
#: Documents that the pieces' probabilities are learned from, all languages together, and rounds of expectation maximisation.
TRAIN_DOCS, ROUNDS = 2400, 3
#: Log-probability of a character that no piece covers, and of pieces never expected in a language.
UNKNOWN, SMOOTHING = -16.0, 0.01
#: Words whose scores a worker keeps, and the bytes of the longest one kept.
KEPT_WORDS, KEPT_BYTES = 250_000, 64
#: Characters of words that are scored at once; a longer word is walked through in slabs of so many.
SLAB = 1 << 16
#: Characters after which the forward values are scaled to 1 again.
RESCALE = 16
UNDETERMINED = "und"
BEGIN = "▁"


class Pieces:
    """The lower-case pieces of letters in a public vocabulary, found in words by hashes of their UTF-8 bytes.

    The begin of a word alone is no piece, so a word that no piece covers is equally likely in every language.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
        self.names = sorted({p for p in found if p == p.lower() and p.lstrip(BEGIN).isalpha()})
        raw = [p.encode() for p in self.names]
        data, size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(p) for p in raw], np.int64)
        at = np.cumsum(size) - size
        keys = self.keys_of(prefix_hash(data), at, size)
        order = np.argsort(keys)
        self.keys, self.numbers = keys[order], order
        self.flags = np.zeros(1 << 22, bool)
        self.flags[(keys >> np.uint64(42)).astype(np.int64)] = True
        self.sizes = np.unique(size)
        self.longest = max(len(p) for p in self.names)

    @staticmethod
    def keys_of(prefix: np.ndarray, at: np.ndarray, size) -> np.ndarray:
        return mix((prefix[at + size] - prefix[at]) * power(len(prefix), True)[at] + np.asarray(size).astype(np.uint64))

    def find(self, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the start, its byte after the end, piece) of all pieces that begin at one of the bytes `at` and stop at `end` or before."""
        prefix = prefix_hash(data)
        hits: list[tuple[np.ndarray, ...]] = []
        alive = np.arange(len(at))
        for n in self.sizes.tolist():
            alive = alive[at[alive] + n <= end[alive]]
            if not len(alive):
                break
            keys = self.keys_of(prefix, at[alive], n)
            maybe = np.flatnonzero(self.flags[(keys >> np.uint64(42)).astype(np.int64)])
            slot = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
            same = self.keys[slot] == keys[maybe]
            who = alive[maybe[same]]
            hits.append((who, at[who] + n, self.numbers[slot[same]]))
        empty = np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*hits, strict=True)) if hits else (empty, empty, empty)


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(different words, the word at each place, the text at each place) of many texts; a word is a run of letters, in lower case."""
    plain = pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(column.cast(pa.large_string())), BETWEEN, " "), " ")
    lists = pc.split_pattern(pc.fill_null(plain, ""), " ")
    coded = lists.flatten().dictionary_encode()
    text = pc.list_parent_indices(lists).to_numpy()
    word = coded.indices.to_numpy()
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:  # a text without a letter is split into one empty word
        full = word != blank
        word, text = word[full], text[full]
    return coded.dictionary, word, text


class Lattice:
    """All pieces in the words, each written after U+2581, sorted by the character after their end; words are sorted by length, the longest first.

    The unknown piece is any one character. One word may be given as a slab: its characters from `begin` on, where pieces may reach back over `back` characters.
    """

    def __init__(self, words: pa.Array, vocabulary: Pieces, begin: int = 0, back: int = 0):
        words = words.cast(pa.large_string())
        marked = pc.binary_join_element_wise(pa.scalar(BEGIN, pa.large_string()), words, pa.scalar("", pa.large_string())) if begin == 0 else words
        offsets = np.frombuffer(marked.buffers()[1], np.int64, len(marked) + 1, marked.offset * 8)
        data = np.frombuffer(marked.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        at = np.flatnonzero((data & 0xC0) != 0x80)  # where characters begin
        first = np.searchsorted(at, offsets)
        length = np.diff(first)
        self.longest = vocabulary.longest
        self.order = np.argsort(-length, kind="stable")
        place = np.empty_like(self.order)
        place[self.order] = np.arange(len(place))
        own = np.repeat(np.arange(len(length)), length)
        char = np.arange(len(at)) - first[own]
        who, stop, piece = vocabulary.find(data, at, offsets[own + 1])
        start = char[who]
        end = np.searchsorted(at, stop) - first[own[who]]
        word = place[np.concatenate([own[who], own])]
        start, end = np.concatenate([start, char]), np.concatenate([end, char + 1])
        piece = np.concatenate([piece, np.full(len(own), -1)])
        if begin or back:
            start, end = start + begin - back, end + begin - back
            new = end > begin
            word, start, end, piece = word[new], start[new], end[new], piece[new]
        self.length = length[self.order] + begin - back
        key = np.argsort(end * len(length) + word, kind="stable")
        self.word, self.start, self.end, self.piece = word[key], start[key], end[key], piece[key]
        self.begin = begin
        self.by_end = np.searchsorted(self.end, np.arange(begin + 1, int(self.length.max(initial=begin)) + 2))
        # the first piece of each word at each end
        change = np.ones(len(key), bool)
        change[1:] = (self.word[1:] != self.word[:-1]) | (self.end[1:] != self.end[:-1])
        self.heads = np.flatnonzero(change)
        self.head_at = np.searchsorted(self.heads, self.by_end)

    def start_state(self, languages: int) -> tuple[np.ndarray, np.ndarray]:
        """The forward values of the last `longest` + 1 characters, and the logarithms of what they were divided by."""
        ring = np.zeros((self.longest + 1, len(self.length), languages))
        ring[0] = 1
        return ring, np.zeros((len(self.length), languages))

    def forward(self, prob: np.ndarray, state: tuple[np.ndarray, np.ndarray] | None = None, keep: np.ndarray | None = None) -> np.ndarray:
        """Log-probability of each word under each language, all segmentations summed (words as given x languages). prob's last row: the unknown piece.

        Values are divided by the greatest of the reachable ones every RESCALE characters, so a word of any length has a finite result.
        keep: room for the log of every forward value of the first language.
        """
        ring, scale = state if state is not None else self.start_state(prob.shape[1])
        size = self.longest + 1
        out = np.zeros_like(scale)
        live = len(self.length)
        for i in range(len(self.by_end) - 1):
            k, a, b = self.begin + 1 + i, self.by_end[i], self.by_end[i + 1]
            while live and self.length[live - 1] < k:
                live -= 1
            flow = ring[self.start[a:b] % size, self.word[a:b]] * prob[self.piece[a:b]]
            ring[k % size, :live] = np.add.reduceat(flow, self.heads[self.head_at[i] : self.head_at[i + 1]] - a, axis=0)
            if k % RESCALE == 0:
                top = ring[:, :live].max(0)
                ring[:, :live] /= top
                scale[:live] += np.log(top)
            if keep is not None:
                keep[:live, k] = np.log(ring[k % size, :live, 0]) + scale[:live, 0]
            done = live
            while done and self.length[done - 1] == k:
                done -= 1
            out[done:live] = np.log(ring[k % size, done:live]) + scale[done:live]
        result = np.empty_like(out)
        result[self.order] = out
        return result

    def expected(self, prob: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece under one language's probabilities, words weighted by counts."""
        n, size = len(self.length), self.longest + 1
        last = int(self.length.max(initial=0))
        ahead, back = np.full((n, last + 1), -np.inf), np.full((n, last + 1), -np.inf)
        ahead[:, 0] = 0
        whole = self.forward(prob[:, None], keep=ahead)[self.order, 0]
        ring, scale = np.zeros((size, n)), np.zeros(n)
        live = 0
        for k in range(last, 0, -1):
            ring[(k - self.longest) % size] = 0
            while live < n and self.length[live] >= k:
                ring[k % size, live] = 1
                live += 1
            back[:live, k] = np.log(ring[k % size, :live]) + scale[:live]
            a, b = self.by_end[k - 1], self.by_end[k]
            np.add.at(ring, (self.start[a:b] % size, self.word[a:b]), ring[k % size, self.word[a:b]] * prob[self.piece[a:b]])
            if k % RESCALE == 0:
                ring[k % size, :live] = 0
                top = ring[:, :live].max(0)
                ring[:, :live] /= top
                scale[:live] += np.log(top)
        use = np.exp(ahead[self.word, self.start] + np.log(prob)[self.piece] + back[self.word, self.end] - whole[self.word]) * counts[self.order][self.word]
        return np.bincount(np.where(self.piece < 0, len(prob) - 1, self.piece), use, len(prob))


def runs_of(words: pa.Array):
    """Rows of words that are scored together: about SLAB characters, words of like length side by side; a longer word alone."""
    size = pc.binary_length(words).to_numpy().astype(np.int64) + 4
    order = np.argsort(size, kind="stable")
    total = np.cumsum(size[order])
    a = 0
    while a < len(order):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + SLAB, side="right")))
        yield order[a:b]
        a = b


def word_scores(words: pa.Array, prob: np.ndarray, vocabulary: Pieces, slab: int = SLAB) -> np.ndarray:
    """Log-probability of each word under each language (words x languages)."""
    out = np.zeros((len(words), prob.shape[1]))
    for rows in runs_of(words):
        own = words.take(pa.array(rows))
        if len(rows) > 1 or len(own[0].as_py()) < slab:
            out[rows] = Lattice(own, vocabulary).forward(prob)
            continue
        text, state = BEGIN + own[0].as_py(), None
        for begin in range(0, len(text), slab):
            back = min(begin, vocabulary.longest)
            part = pa.array([text[begin - back : begin + slab] if begin else text[1:slab]], pa.large_string())
            lattice = Lattice(part, vocabulary, begin, back)
            state = state or lattice.start_state(prob.shape[1])
            out[rows] = lattice.forward(prob, state)
    return out


def learn(words: pa.Array, counts: np.ndarray, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language from its words' counts, by expectation maximisation; the last entry is the unknown piece's.

    A run of over 4096 letters counts as several words here (in scoring it is one).
    """
    vocabulary = pieces(path)
    n = len(vocabulary.names)
    long_ = np.flatnonzero(pc.utf8_length(words).to_numpy() > 4096)
    if len(long_):
        cut = [(w[i : i + 4096], c) for w, c in zip(words.take(pa.array(long_)).to_pylist(), counts[long_].tolist(), strict=True) for i in range(0, len(w), 4096)]
        rest = np.setdiff1d(np.arange(len(words)), long_)
        words = pa.concat_arrays([words.take(pa.array(rest)), pa.array([w for w, _ in cut], words.type)])
        counts = np.concatenate([counts[rest], [c for _, c in cut]])
    prob = np.full(n + 1, 1 / n)
    prob[-1] = np.exp(UNKNOWN)
    lattices = [(Lattice(words.take(pa.array(rows)), vocabulary), counts[rows].astype(float)) for rows in runs_of(words)]
    for _ in range(rounds):
        use = sum((x.expected(prob, w) for x, w in lattices), np.zeros(n + 1))
        known = use[:-1] + SMOOTHING
        prob = np.append(known / known.sum(), np.exp(UNKNOWN))
    return prob


def train(docs: DataFrame, path: str, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS, seed: int = 3) -> tuple[list[str], np.ndarray]:
    """(languages, piece probabilities of each (pieces + 1 x languages)) from rows with a text and a lang.

    About train_docs documents are used, the same number for each language, chosen by a hash of the id: that bounds the sample.
    """
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return [], np.zeros((0, 0))
    share = max(1, train_docs // len(sizes))
    bound = F.lit(0)
    for lang, n in sizes.items():
        bound = F.when(F.col("lang") == lang, F.lit(int(min(1.0, share / n) * (1 << 30)))).otherwise(bound)
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) <= bound)

    def fit(key, frame):
        import pandas as pd

        words, word, _ = words_of(pa.array(frame["text"], pa.large_string()))
        counts = np.bincount(word, minlength=len(words))
        order = np.array(pc.sort_indices(words))
        order = order[counts[order] > 0]
        prob = learn(words.take(pa.array(order)), counts[order], path, rounds)
        return pd.DataFrame({"lang": [key[0]], "prob": [prob.astype("<f8").tobytes()]})

    made = chosen.select("lang", "text").groupBy("lang").applyInPandas(fit, "lang string, prob binary").collect()
    made = sorted((r[0], np.frombuffer(bytes(r[1]), "<f8")) for r in made)
    return [m[0] for m in made], np.column_stack([m[1] for m in made])


class Memory:
    """Words that a worker has scored, and their scores, with one model."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.scores = np.empty((0, 0))

    def put(self, words: list[str], rows: np.ndarray) -> None:
        at = len(self.words)
        if not len(self.scores):
            self.scores = np.empty((1 << 14, rows.shape[1]))
        while at + len(rows) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.empty_like(self.scores)])
        self.scores[at : at + len(rows)] = rows
        self.words.update(zip(words, range(at, at + len(words)), strict=True))

    def look_up(self, words: pa.Array, prob: np.ndarray, vocabulary: Pieces) -> np.ndarray:
        """The scores of words, from the memory or computed now."""
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        names = words.to_pylist()
        at = np.fromiter((self.words.get(w, -1) for w in names), np.int64, len(names))
        fresh = np.flatnonzero(at < 0)
        out = np.empty((len(names), prob.shape[1]))
        if len(self.scores):
            out[at >= 0] = self.scores[at[at >= 0]]
        if len(fresh):
            out[fresh] = word_scores(words.take(pa.array(fresh)), prob, vocabulary)
            short = fresh[pc.binary_length(words).to_numpy()[fresh] <= KEPT_BYTES]
            self.put([names[i] for i in short], out[short])
        return out


@lru_cache(1)
def remembered(model: str) -> Memory:
    """The memory of a worker process; it stays from task to task, and goes when another model is used."""
    return Memory()


def detect(docs: DataFrame, languages: list[str], prob: np.ndarray, path: str) -> DataFrame:
    """docs with lang_pred and score: the language under which the text is likeliest, and its posterior for equal priors.

    Each word's probability is the sum over all its segmentations into pieces, by the forward algorithm, whatever its length; a text's is
    the product over its words. Words are runs of letters (Unicode class L) in lower case. A null text, one without a letter, or no languages: lang_pred `und`, score 0.
    Ties: the first language by name; letters that no language knows tell nothing, so alone they give each language the same. Columns of docs with these names are replaced.
    """
    small_batches(docs.sparkSession)
    plain = docs.drop("lang_pred", "score")
    model = hashlib.sha256(repr(languages).encode() + prob.tobytes()).hexdigest()
    at = plain.columns.index("text")

    def run(batches):
        vocabulary = pieces(path)
        memory = remembered(model)
        for batch in batches:
            words, word, text = words_of(batch.column(at))
            n = np.bincount(text, minlength=batch.num_rows)
            total = np.zeros((batch.num_rows, max(1, len(languages))))
            if languages and len(word):
                scores = memory.look_up(words, prob, vocabulary)
                for j in range(len(languages)):
                    total[:, j] = np.bincount(text, scores[word, j], batch.num_rows)
            best = total.argmax(1)
            with np.errstate(under="ignore", over="ignore"):
                score = 1 / np.exp(np.minimum(total - total[np.arange(len(best)), best][:, None], 0)).sum(1)
            sure = (n > 0) & (len(languages) > 0)
            names = [languages[b] if s else UNDETERMINED for b, s in zip(best, sure, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(np.where(sure, score, 0.0))], names=[*batch.schema.names, "lang_pred", "score"])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def identify(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "text"), path: str = public_tokenizers.path("piece_bpe_32k.model"), folds: int = 4, held_out_fold: int = 2, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """docs' columns with held_out, lang_pred and score. It learns from documents outside the held-out fold alone; see train() and detect()."""
    known = docs.filter(fold("doc_id", folds) != held_out_fold)
    languages, prob = train(known, path, train_docs)
    found = detect(docs.select(*columns), languages, prob, path)
    return found.withColumn("held_out", fold("doc_id", folds) == held_out_fold)
