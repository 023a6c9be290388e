"""Chat formatting by token-level assembly."""

from __future__ import annotations

import base64
import hashlib
import re
from functools import cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import arrow_type, small_batches

#: Reserved ids, above the ids of the vocabulary.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
START_ID, END_ID = 50257, 50258


@cache
def encoding(path: str):
    """The byte-level vocabulary as a tiktoken encoding: every byte string survives a round trip."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in Path(path).read_bytes().splitlines() if x)}
    return tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def escape(text: str) -> str:
    """A backslash more inside every `<`, backslashes, `|`: no control string is left, and unescape() takes it away again."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """A role is one line: backslashes and line ends are written as two characters."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def assemble(segments: list[tuple[np.ndarray, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """All segments' ids in a row, and the loss mask: +1 where a learned segment starts, -1 where it ends, summed along."""
    ids = np.concatenate([s for s, _ in segments]) if segments else np.empty(0, np.int32)
    ends = np.cumsum([len(s) for s, _ in segments], dtype=np.int64)
    steps = np.zeros(len(ids) + 1, np.int32)
    for (s, learned), end in zip(segments, ends, strict=True):
        if learned:
            steps[end - len(s)] += 1
            steps[end] -= 1
    return ids.astype(np.int32), np.cumsum(steps)[:-1].astype(np.int8)


def rows(batches, *names):
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def spread_turns(conversations: DataFrame, part_ids: int) -> DataFrame:
    """Rows of conv_id, turn, role, text sorted within partitions, with `at`, the partition's number.

    A conversation is in one partition, but for those with more than 4 * part_ids bytes of text: these are dealt over consecutive partitions by
    turn, role and the beginning of the text, so that none is one task's work however long it is. The order within and along partitions is that of whole texts.
    """
    columns = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(*columns)
    sizes = rows.groupBy(F.col("conv_id").alias("__large")).agg(F.sum(F.octet_length("text")).alias("__bytes"))
    large = sizes.filter(F.col("__bytes") > 4 * part_ids).select("__large", F.lit(True).alias("__split"))
    marked = rows.join(large, F.col("conv_id").eqNullSafe(F.col("__large")), "left")
    within = [F.when(F.col("__split"), c) for c in (F.col("turn"), F.substring("role", 1, 32), F.substring("text", 1, 32))]
    ranged = marked.repartitionByRange("conv_id", *within).sortWithinPartitions(*columns)
    return ranged.select(*columns, F.spark_partition_id().alias("at"))


def format_chat(
    conversations: DataFrame,
    vocabulary: str = public_tokenizers.path("byte_bpe_50k.tiktoken"),
    learned_roles: tuple[str, ...] = ("assistant",),
    part_ids: int = 1 << 20,
) -> DataFrame:
    """One row for each conversation: conv_id, part, input_ids, loss_mask; a conversation over part_ids ids goes on in further parts, which ascend.

    A turn is START_ID, the role, a line end, the text, END_ID, a line end. Role and text are escaped, each is encoded
    for itself as ordinary text, and the reserved ids are spliced in between, so that content never
    yields a reserved id. The mask covers the text of learned roles, nothing else.

    Turns are read in the order of turn, role, text within a partition sorted by conversation; only the
    current part is held, so a conversation of any length needs bounded memory, and a long one is several tasks' work. Null text or role: empty.
    Rows without a turn come first. Rows without conv_id form a conversation with a null id. Equal turns are kept in the order
    of role and text. Other columns are ignored. Empty table: no rows.
    """
    small_batches(conversations.sparkSession)
    spread = spread_turns(conversations, part_ids)
    schema = pa.schema([("conv_id", arrow_type(conversations, "conv_id")), ("part", pa.int64()), ("input_ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.int8()))])

    def run(batches):
        enc = encoding(vocabulary)
        start, end = np.array([START_ID], np.int32), np.array([END_ID], np.int32)
        newline = np.array(enc.encode_ordinary("\n"), np.int32)
        encode = lambda s: np.array(enc.encode_ordinary(s), np.int32)
        ready: list[tuple] = []
        current, part, segments, size = None, 0, [], 0

        def batch():
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in ready], f.type) for i, f in enumerate(schema)], schema=schema)
            ready.clear()
            return out

        begun = False
        waiting = 0
        for conv, _, role, text, at in rows(batches, "conv_id", "turn", "role", "text", "at"):
            if begun and conv != current or size >= part_ids:
                ready.append((current, (at << 32) + part, *assemble(segments)))
                waiting += size
                part, segments, size = (0 if conv != current else part + 1), [], 0
                if waiting > 4 * part_ids or len(ready) >= 4096:
                    yield batch()
                    waiting = 0
            current, begun = conv, True
            body = encode(escape(text or ""))
            segments += [(start, False), (encode(escape_role(role or "")), False), (newline, False), (body, (role or "") in learned_roles), (end, False), (newline, False)]
            size += sum(len(s) for s, _ in segments[-6:])
        if begun:
            ready.append((current, (at << 32) + part, *assemble(segments)))
        if ready:
            yield batch()

    return spread.mapInArrow(run, f"conv_id {kind_of(conversations)}, part long, input_ids array<int>, loss_mask array<byte>")


def kind_of(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


#: What is counted of a part, and in sum of a conversation.
COUNTS = ("n_turns", "loss_chars", "formatted_chars", "n_ids", "n_loss_ids")


def decoded_parts(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """conv_id, part, turns and loss (the bytes that the digests are of), and COUNTS of each part, read from its ids and mask alone."""
    kinds = [("part", pa.int64()), ("turns", pa.binary()), ("loss", pa.binary()), *((c, pa.int64()) for c in COUNTS)]
    schema = pa.schema([("conv_id", arrow_type(formatted, "conv_id")), *kinds])

    def run(batches):
        enc = encoding(vocabulary)
        for batch in batches:
            out = []
            for conv, part, ids, mask in zip(*(batch.column(batch.schema.get_field_index(n)) for n in ("conv_id", "part", "input_ids", "loss_mask")), strict=True):
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy()
                turns, spoken_texts, shown = [], [], 0
                for a, b in zip(np.flatnonzero(ids == START_ID), np.flatnonzero(ids == END_ID), strict=True):
                    turn = enc.decode_bytes(ids[a + 1 : b].tolist()).decode()
                    role, _, text = turn.partition("\n")
                    turns.append(f"{unescape_role(role)}\n{unescape(text)}\n")
                    shown += len(TURN_START) + len(turn) + len(TURN_END) + 1
                    spoken = ids[a:b][mask[a:b] > 0]
                    if len(spoken):
                        spoken_texts.append(unescape(enc.decode_bytes(spoken.tolist()).decode()))
                said = "".join(spoken_texts)
                out.append((conv.as_py(), part.as_py(), "".join(turns).encode(), said.encode(), len(turns), len(said), shown, len(ids), int(mask.sum())))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return formatted.mapInArrow(run, f"conv_id {kind_of(formatted)}, part long, turns binary, loss binary, " + ", ".join(f"{c} long" for c in COUNTS))


def read_back(formatted: DataFrame, vocabulary: str = public_tokenizers.path("byte_bpe_50k.tiktoken")) -> DataFrame:
    """The digest of each formatted conversation, from its ids and mask alone.

    Parts are decoded where they lie; a conversation's bytes then meet in one task, which only hashes them, part by part.
    """
    parts = decoded_parts(formatted, vocabulary).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_ids", "n_loss_ids")
    schema = pa.schema([("conv_id", arrow_type(formatted, "conv_id")), *((n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names)])

    def run(batches):
        out, state, current = [], None, None

        def close():
            counts = dict(zip(COUNTS, state[2], strict=True)) | {"turns_sha256": state[0].hexdigest(), "loss_sha256": state[1].hexdigest()}
            out.append((current, *(counts[n] for n in names)))

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)
            out.clear()
            return made

        for conv, turns, loss, *counts in rows(batches, "conv_id", "turns", "loss", *COUNTS):
            if state is None or conv != current:
                if state is not None:
                    close()
                current, state = conv, [hashlib.sha256(), hashlib.sha256(), [0] * len(COUNTS)]
            state[0].update(turns)
            state[1].update(loss)
            state[2] = [a + b for a, b in zip(state[2], counts, strict=True)]
            if len(out) >= 4096:
                yield flush()
        if state is not None:
            close()
        if out:
            yield flush()

    return parts.mapInArrow(run, f"conv_id {kind_of(formatted)}, " + ", ".join(f"{n} {'string' if n.endswith('sha256') else 'long'}" for n in names))
