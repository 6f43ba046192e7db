"""Chat formatting by token-level assembly.

Template of a turn: <|im_start|> role <|im_sep|> text <|im_end|>. The three marks are
reserved ids above the tokenizer's own. Role and text are encoded each by itself, as
ordinary text, and the reserved ids are spliced between, so no content can make a mark.
Content that looks like the beginning of a mark, "<" and "|" with any number of
backslashes between, gets one more backslash, which reading back takes away.

The loss mask is a prefix sum: +1 where an assistant's text begins, -1 where it ends.
Each turn is a row with its ids and mask; a conversation is its rows in order. Turns are
encoded where they are read; nothing holds a conversation in one piece. `read_back` walks
through the sorted rows of a task and keeps the digests of one conversation.

Defined cases: null text and role are empty, a null id is a conversation of its own. Turns
come by number, null first; repeated numbers by role, then text; repeated rows are
turns of their own. Columns that the operator doesn't name are ignored. An empty table
gives no row.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.common import mapped, texts

# The marks and their ids.
MARKS = {"<|im_start|>": 50257, "<|im_sep|>": 50258, "<|im_end|>": 50259}
START, SEPARATE, END = MARKS.values()
LOSS_ROLE = "assistant"
TURNS = "conv_id bigint, turn bigint, role string, text string, ids binary, loss binary"
READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, n_tokens bigint"
)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


_LOADED: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _LOADED:
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
        _LOADED[path].encode_special_tokens = True
    return _LOADED[path]


def id_bytes(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocabulary = sorted(tokenizer.get_vocab(with_added_tokens=False).items(), key=lambda x: x[1])
    table = [b""] * (max(MARKS.values()) + 1)
    for token, i in vocabulary:
        if all(c in byte_of for c in token):
            table[i] = bytes(byte_of[c] for c in token)
    for mark, i in MARKS.items():
        table[i] = mark.encode()
    return table


def assemble(roles: list[str], contents: list[str], tokenizer) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids and loss mask of each turn."""
    encoded = tokenizer.encode_batch_fast([escape(s) for s in (*roles, *contents)], add_special_tokens=False)
    encoded = [e.ids for e in encoded]
    n = len(roles)
    parts = [p for role, text in zip(encoded[:n], encoded[n:]) for p in ([START], role, [SEPARATE], text, [END])]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.array([i for p in parts for i in p], dtype="<u4")
    steps = np.zeros(len(ids) + 1, dtype=np.int64)
    spoken = np.flatnonzero([role == LOSS_ROLE for role in roles]) * 5 + 3
    np.add.at(steps, begin[spoken], 1)
    np.add.at(steps, begin[spoken + 1], -1)
    loss = np.cumsum(steps)[:-1].astype(np.uint8)
    edges = begin[::5]
    return [ids[a:b] for a, b in zip(edges, edges[1:])], [loss[a:b] for a, b in zip(edges, edges[1:])]


def turns(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokenizer: str | None = None,
) -> DataFrame:
    """A row for each turn: ids as little-endian 4-byte numbers, the loss mask as a byte for each id."""

    def work(batch: pa.RecordBatch) -> dict:
        roles, contents = (texts(batch[c]).to_pylist() for c in ("role", "text"))
        ids, loss = assemble(roles, contents, _tokenizer(tokenizer or default_tokenizer()))
        return {
            "conv_id": batch["conv_id"],
            "turn": batch["turn"],
            "role": pa.array(roles, pa.string()),
            "text": pa.array(contents, pa.string()),
            "ids": pa.array([x.tobytes() for x in ids], pa.binary()),
            "loss": pa.array([x.tobytes() for x in loss], pa.binary()),
        }

    needed = conversations.select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
    )
    return mapped(needed, work, TURNS)


class _Reader:
    """The digests of one conversation, fed turn by turn."""

    def __init__(self, conv_id, table: list[bytes]):
        self.conv_id, self.table = conv_id, table
        self.whole, self.spoken = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = self.n_tokens = 0

    def _text(self, ids: np.ndarray) -> str:
        return b"".join([self.table[i] for i in ids.tolist()]).decode()

    def add(self, ids: np.ndarray, loss: np.ndarray) -> None:
        self.formatted_chars += len(self._text(ids))
        self.n_tokens += len(ids)
        starts, ends = np.flatnonzero(ids == START), np.flatnonzero(ids == END)
        for start, end in zip(starts.tolist(), ends.tolist()):
            middle = start + int(np.argmax(ids[start:end] == SEPARATE))
            role, text = unescape(self._text(ids[start + 1 : middle])), unescape(self._text(ids[middle + 1 : end]))
            self.whole.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        spoken = unescape(self._text(ids[loss == 1]))
        self.loss_chars += len(spoken)
        self.spoken.update(spoken.encode())

    def row(self) -> tuple:
        return (
            self.conv_id, self.n_turns, self.whole.hexdigest(), self.loss_chars, self.spoken.hexdigest(),
            self.formatted_chars, self.n_tokens,
        )


def read_back(formatted: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Digests of each conversation, taken from the ids and masks alone; texts only order turns of one number."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [field.split(" ")[0] for field in READ.split(", ")]

    def rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    def run(batches):
        table = id_bytes(_tokenizer(tokenizer or default_tokenizer()))
        reader = None
        for batch in batches:
            done = []
            for conv_id, ids, loss in zip(*(batch[c].to_pylist() for c in ("conv_id", "ids", "loss"))):
                if reader is None or reader.conv_id != conv_id:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(conv_id, table)
                reader.add(np.frombuffer(ids, "<u4"), np.frombuffer(loss, np.uint8))
            if done:
                yield rows(done)
        if reader is not None:
            yield rows([reader.row()])

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "ids", "loss").mapInArrow(run, READ)
