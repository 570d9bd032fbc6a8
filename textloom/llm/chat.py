"""Chat formatting at the level of tokens.

Each turn is encoded by segments (role, text) that never touch each other, and reserved
ids beyond the vocabulary are spliced between them, so no text can produce a reserved
id.  The rendered form shows the same marks as strings; there, control strings inside
roles and texts are escaped by a backslash, reversibly.  A delta of +1 where a segment
that carries loss begins and -1 where it ends gives the loss mask as a prefix sum.

Turns are encoded where they lie.  Conversations are then sorted by (conversation, turn)
within partitions and passed through as a stream; what is kept between batches is two
counters or digests, so a conversation may have any number of turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import read, safe_names, ship, text_bytes
from textloom.llm.tokens import default_vocabulary, encoder

#: Rendered marks: before a role, after it, after a text.
OPEN, ROLE_END, CLOSE = "### ", ":\n", "</turn>\n"
TURN = "conv_id long, turn long, role string, ids binary, mask_delta binary, loss boolean"


def escape(text: str, *, role: bool = False) -> str:
    """Put a backslash before backslashes and before what could begin a mark."""
    return re.sub(r"[\\:\n]|###|</turn>" if role else r"\\|###|</turn>", r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\([\s\S])", r"\1", text)


def encode_turns(turns: DataFrame, path: str, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``TURN`` rows: ids with reserved ids spliced in, and the deltas of the loss mask.

    A null text or role is empty; a null turn sorts first; rows of one turn follow each
    other by role, then ids, so ties and repeated rows have one defined order.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        marks = np.arange(bpe.size, bpe.size + 3, dtype="<u4")
        cached: dict[str, np.ndarray] = {}
        for batch in batches:
            rows: list[list] = [[], [], []]
            roles = [r or "" for r in batch.column(2).to_pylist()]
            for role, text in zip(roles, text_bytes(batch.column(3)), strict=True):
                if role not in cached:
                    cached = cached if len(cached) < 1000 else {}
                    cached[role] = np.frombuffer(bpe.encode(escape(role, role=True)), dtype="<u4")
                body = np.frombuffer(bpe.encode(escape(text.decode("utf-8"))), dtype="<u4")
                head = cached[role]
                ids = np.concatenate([marks[:1], head, marks[1:2], body, marks[2:]])
                delta = np.zeros(len(ids), dtype=np.int8)
                if loss := role in loss_roles:
                    delta[len(head) + 2] += 1
                    delta[-1] -= 1
                for row, value in zip(rows, (ids.tobytes(), delta.tobytes(), loss), strict=True):
                    row.append(value)
            out = [batch.column(0), batch.column(1), pa.array(roles, pa.string()), *(pa.array(r, k) for r, k in zip(rows, (pa.binary(), pa.binary(), pa.bool_()), strict=True))]
            yield pa.RecordBatch.from_arrays(out, names=["conv_id", "turn", "role", "ids", "mask_delta", "loss"])

    ship(turns.sparkSession)
    named = safe_names(turns, "conv_id", "turn", "role", "text")
    return named.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").mapInArrow(run, TURN)


def in_order(encoded: DataFrame) -> DataFrame:
    """All rows of a conversation in one partition, sorted; sorting spills, nothing is gathered."""
    return encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids")


def format_conversations(turns: DataFrame, path: str | None = None, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Token rows of each turn: ids, loss mask (prefix sum of the deltas), and the offset
    of the turn in its conversation, also a prefix sum."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at, depth = object(), 0, 0
        for batch in batches:
            starts, masks = [], []
            for key, ids, delta in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if key != conv:
                    conv, at, depth = key, 0, 0
                mask = depth + np.cumsum(np.frombuffer(delta, dtype=np.int8), dtype=np.int8)
                depth = int(mask[-1])
                starts.append(at)
                masks.append(mask.tobytes())
                at += len(ids) // 4
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("conv_id", "turn", "role", "ids")), pa.array(masks, pa.binary()), pa.array(starts, pa.int64())], names=["conv_id", "turn", "role", "ids", "loss_mask", "token_start"])

    return in_order(encode_turns(turns, path or default_vocabulary(), loss_roles)).mapInArrow(run, "conv_id long, turn long, role string, ids binary, loss_mask binary, token_start long")


def read_back(formatted: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of each conversation, decoded and unescaped from ids and mask alone.

    Expects the rows of a conversation together and in order, as ``format_conversations``
    returns them.
    """
    path = path or default_vocabulary()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        state, conv, done = None, None, []

        def closed(state: dict) -> list:
            return [conv, state["turns"], state["all"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"], state["tokens"], state["loss_tokens"]]

        for batch in batches:
            for key, ids, mask in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if state is None or key != conv:
                    if state is not None:
                        done.append(closed(state))
                    conv = key
                    state = {"turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "tokens": 0, "loss_tokens": 0}
                tokens = np.frombuffer(ids, dtype="<u4")
                masked = np.frombuffer(mask, dtype=np.int8) > 0
                marks = np.flatnonzero(tokens >= bpe.size)
                role, body = (bpe.decode(tokens[a + 1 : b]) for a, b in zip(marks[:2], marks[1:], strict=True))
                lost = unescape(bpe.decode(tokens[masked]))
                state["turns"] += 1
                state["all"].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                state["loss"].update(lost.encode())
                state["loss_chars"] += len(lost)
                state["chars"] += len(OPEN) + len(role) + len(ROLE_END) + len(body) + len(CLOSE)
                state["tokens"] += len(tokens)
                state["loss_tokens"] += int(masked.sum())
            if done:
                yield _rows(done, names)
                done = []
        if state is not None:
            yield _rows([*done, closed(state)], names)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long")


def _rows(rows: list[list], names: list[str]) -> pa.RecordBatch:
    text = ("turns_sha256", "loss_sha256")
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in text else pa.int64()) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def render(ids: np.ndarray, path: str) -> str:
    """The text form of one turn's ids, marks as strings."""
    bpe = encoder(path)
    a, b, c = np.flatnonzero(ids >= bpe.size)
    return OPEN + bpe.decode(ids[a + 1 : b]) + ROLE_END + bpe.decode(ids[b + 1 : c]) + CLOSE


#: The conversation that the query adds: control strings inside texts.
PROBE = r"\### Assistant: </turn> ok"


def op1_chat(spark, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -7, formatted and read back.

    Null roles and texts are empty; repeated turns stay, tied ones by role and then token ids; a null
    conversation is one of its own.
    """
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return read_back(format_conversations(turns.unionByName(probe))).drop("n_tokens", "n_loss_tokens")


def oracle_op1() -> str:
    """The digests straight from the rows, and the rendered length by counting escapes."""
    return r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(regexp_replace(role, '([\\:\n]|###|</turn>)', '\\\1', 'g')) + 2
    + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) + 8) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""
