"""Token ids in chunks of byte planes, compressed with zstandard, with a chunk index."""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.llm.common import shared_dir, small_batches

#: Ids in a block (the unit that is transposed), ids after which a chunk is closed, the id that ends a document, zstandard's level.
BLOCK_IDS, CHUNK_IDS, END_ID, LEVEL = 4096, 1 << 17, 1, 3
MAGIC = b"PLN1"
#: Distinct words whose ids a worker keeps.
KEPT_WORDS = 1_000_000
_SPACE = re.compile(r"[ \t\n\r\f\v]+")
#: The tokenizer's pattern over lower-case Latin-1: contractions, letters, single digits, others. (Fixed: it must cut as the vocabulary file says.)
_LETTER, _NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PATTERN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^ \t-\r\x85\xa0{_LETTER}{_NUMBER}]+")

CHUNKS = "part int, chunk int, first_id long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"
INDEX = "part int, chunk int, first_id long, n_ids long, n_docs int, n_bytes long"


def pack(ids: np.ndarray, planes: str = "byte", block: int = BLOCK_IDS, level: int = LEVEL) -> bytes:
    """MAGIC, plane kind, number of ids, block size, number of planes, each plane's compressed length, the planes.

    The ids (uint32, the last block padded with 0) are transposed block by block: plane p has the p-th byte (kind "byte") or
    bit (kind "bit") of every id. Planes that are zero everywhere have length 0.
    """
    import zstandard

    n = len(ids)
    full = np.zeros(-(-n // block) * block, np.uint32)
    full[:n] = ids
    octets = full.view(np.uint8).reshape(-1, block, 4)
    if planes == "byte":
        rows = octets.transpose(2, 0, 1)
    else:
        bits = np.unpackbits(octets, axis=2, bitorder="little")
        rows = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    squeeze = zstandard.ZstdCompressor(level=level)
    made = [squeeze.compress(np.ascontiguousarray(r)) if r.any() else b"" for r in rows]
    return b"".join([MAGIC, planes[:2].encode(), struct.pack("<QII", n, block, len(made)), struct.pack(f"<{len(made)}I", *map(len, made)), *made])


def unpack(payload: bytes) -> np.ndarray:
    """The ids of pack(), as uint32."""
    import zstandard

    if payload[:4] != MAGIC:
        raise ValueError("not a chunk of planes")
    kind = payload[4:6]
    n, block, count = struct.unpack_from("<QII", payload, 6)
    lengths = struct.unpack_from(f"<{count}I", payload, 22)
    blocks, at = -(-n // block), 22 + 4 * count
    width = block if kind == b"by" else block // 8
    rows = np.zeros((count, blocks, width), np.uint8)
    expand = zstandard.ZstdDecompressor()
    for p, size in enumerate(lengths):
        if size:
            rows[p] = np.frombuffer(expand.decompress(payload[at : at + size], blocks * width), np.uint8).reshape(blocks, width)
        at += size
    if kind == b"by":
        octets = rows.transpose(1, 2, 0)
    else:
        bits = np.unpackbits(rows, axis=2, bitorder="little")
        octets = np.packbits(bits.transpose(1, 2, 0), axis=2, bitorder="little")
    return np.ascontiguousarray(octets).reshape(-1).view(np.uint32)[:n]


class WordEncoder:
    """A tokenizer that never joins across white space, asked once for each distinct word that it meets.

    In texts of Latin-1 characters (which lower case and normal form C take one by one) words are the pieces that the
    tokenizer's own pattern cuts, in lower case; in others, and around special tokens, runs without white space.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        size = self.tokenizer.get_vocab_size()
        self.ends_word = np.array([str(self.tokenizer.id_to_token(i)).endswith("</w>") for i in range(size)])
        self.kept: dict[str, bytes] = {}

    def words(self, text: str) -> tuple[list[str], bool]:
        """The text's words, and whether they are the tokenizer's own."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return _SPACE.split(text), False
        if any(s in text for s in self.special):
            return _SPACE.split(text), False
        return _PATTERN.findall(text.lower()), True

    def __call__(self, text: str | None) -> bytes:
        """The ids of the text, as little-endian 32-bit integers."""
        words, whole = self.words(text) if text else ([], True)
        try:
            return b"".join(map(self.kept.__getitem__, words))
        except KeyError:
            pass
        if len(self.kept) > KEPT_WORDS:
            self.kept = {}
        self.learn([w for w in dict.fromkeys(words) if w not in self.kept], whole)
        return b"".join(map(self.kept.__getitem__, words))

    def learn(self, fresh: list[str], whole: bool) -> None:
        """Takes in new words: if each is one word to the tokenizer too, all are one text, whose ids are cut where a word ends."""
        if whole:
            ids = np.array(self.tokenizer.encode(" ".join(fresh), add_special_tokens=False).ids, "<u4")
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * 4
            if len(ends) == len(fresh) and (not fresh or ends[-1] == 4 * len(ids)):
                raw, a = ids.tobytes(), 0
                for w, b in zip(fresh, ends.tolist(), strict=True):
                    self.kept[w] = raw[a:b]
                    a = b
                return
        for w, e in zip(fresh, self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False), strict=True):
            self.kept[w] = np.array(e.ids, "<u4").tobytes()


@cache
def encoder(path: str) -> WordEncoder:
    """One for each worker process: what it has learned stays from task to task."""
    return WordEncoder(path)


def write_tokens(docs: DataFrame, path: str, tokenizer: str = public_tokenizers.path("word_bpe_49k.json"), planes: str = "byte", end_id: int = END_ID, chunk_ids: int = CHUNK_IDS) -> None:
    """Writes path/chunks and path/index: the ids of all texts in ascending doc_id order, end_id after each document.

    A chunk holds whole documents, about chunk_ids ids of them or one longer document; a part is a run of chunks, in the order of doc_id, written by one task.
    Chunks go through Spark's own writer, so the path can be in any store, and an attempt that fails or is repeated
    leaves nothing behind. The chunk index has a row for each chunk: its place, first id in the part, ids, documents, bytes.

    Null text: no ids but the end id. Null ids come first. Rows with equal ids are ordered by a hash of the text. An empty table gives an empty index.
    The tokenizer must drop white space between words (as its vocabulary file's description says); words are then encoded each for itself.
    """
    small_batches(docs.sparkSession)
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    schema = pa.schema(
        [("part", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())]
    )

    def run(batches):
        from pyspark import TaskContext

        part, chunk, first = TaskContext.get().partitionId(), 0, 0
        encode, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        ids: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def close():
            stream = np.frombuffer(b"".join(held), "<u4")
            made = [[part], [chunk], [first], [len(stream)], [ids], [[len(h) // 4 for h in held]], [pack(stream, planes)]]
            return pa.RecordBatch.from_arrays([pa.array(m, f.type) for m, f in zip(made, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = encode(text.as_py()) + end
                ids.append(doc_id)
                held.append(body)
                size += len(body) // 4
                if size >= chunk_ids:
                    yield close()
                    chunk, first, size, ids, held = chunk + 1, first + size, 0, [], []
        if held:
            yield close()

    ordered.mapInArrow(run, CHUNKS).write.parquet(f"{path}/chunks")
    chunks = docs.sparkSession.read.schema(CHUNKS).parquet(f"{path}/chunks")
    index = chunks.select("part", "chunk", "first_id", "n_ids", F.size("lengths").alias("n_docs"), F.octet_length("payload").cast("long").alias("n_bytes"))
    index.coalesce(1).write.parquet(f"{path}/index")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of the files: doc_id, start (ids before it), n_tokens, ids (32-bit little-endian, with the end id)."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))  # a row for each task that wrote
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("part_ids").over(ahead), F.lit(0)).alias("part_start"))
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")

    def run(batches):
        names = ["part", "doc_id", "start", "n_tokens", "ids"]
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"])
                bounds = np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int64)
                blobs = [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                n = len(blobs)
                columns = [np.full(n, row["part"], np.int32), pa.array(row["doc_ids"], pa.int64()), bounds[:-1] + row["first_id"], np.diff(bounds), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    found = chunks.mapInArrow(run, "part int, doc_id long, start long, n_tokens long, ids binary")
    found = found.join(offsets, "part", "left")
    return found.select("doc_id", (F.col("start") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of read_tokens()."""
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def write_and_read(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """The documents' digests, from files that it writes (to a fresh folder in the shared one, unless path is given) and reads back."""
    spark = docs.sparkSession
    where = path or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, where, **options)
    return digests(read_tokens(spark, where))


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())
