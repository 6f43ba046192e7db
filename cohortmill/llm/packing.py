"""Harmonic packing of documents into token sequences.

A document's ids end with one end id. It is cut into pieces of the capacity C, and its rest
so that each piece fills its class: a piece of length n is of class k = C div n, and k pieces
of class k always fit into one sequence. A rest that would leave more than 3 % of its sequences
empty gives up a piece of the next smaller class's full length, C div (k + 1); rests of 64
ids and below stay whole.

Each class's sequences take exactly k pieces, in the order of the piece table: blocks of rows
count their classes, prefix sums over the counts tell each block where it begins, and every
block then fills its sequences without looking at others. Fewer than k pieces of each class
remain, under 10,000 for C = 2048 however many documents there are; they are packed
largest first into the fullest sequence that still takes them.

Defined cases: a null or empty text has the end id alone. Repeated rows and rows without an id
are packed like others. Columns that the operator doesn't name are ignored. An empty table
gives no sequence.
"""

from __future__ import annotations

import bisect
import os
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortmill.llm.common import code_words, mapped, split_words, stored, texts

CAPACITY = 2048
END_ID = 1
LEAST_FILL = 0.97
WHOLE = 64
BLOCK_ROWS = 20_000
CACHE_WORDS = 120_000
SLICE_BYTES = 8 << 20  # larger than others': a slice looks its different words up once
PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"
TAIL = ".,!?;:|"
MARK = "\x01"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokens:
    """Ids of whole texts by a tokenizer that never joins what white space parts.

    Its normal form lowers letters and its pre-tokens end at white space and between
    a letter or digit and punctuation, so a text's ids are those of its words, which are
    encoded once. Texts with combining marks or special strings go to the tokenizer whole.
    """

    def __init__(self, path: str):
        # A task has one core; threads of the tokenizer would take those of other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.mark = self._encode([MARK])[0]
        self.tails = [np.array(ids, "<u4") for ids in self._encode(list(TAIL))]

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Encode words, hundreds in one text with a mark between them."""
        odd = [w for w in words if MARK in w]
        for w, ids in zip(odd, self._encode(odd)):
            self.known[w] = np.array(ids, "<u4").tobytes()
        even = [w for w in words if MARK not in w] if odd else words
        groups = [even[i : i + 500] for i in range(0, len(even), 500)]
        for group, ids in zip(groups, self._encode([f" {MARK} ".join(g) for g in groups])):
            ids, size = np.array(ids, "<u4"), len(self.mark)
            hit = np.ones(max(0, len(ids) - size + 1), dtype=bool)
            for i, value in enumerate(self.mark):
                hit &= ids[i : i + len(hit)] == value
            ends = np.append(np.flatnonzero(hit), len(ids))
            begins = np.append(0, ends[:-1] + size)
            raw = ids.tobytes()
            self.known.update(
                zip(group, [raw[x:y] for x, y in zip((4 * begins).tolist(), (4 * ends).tolist())])
            )

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of different words; words not met for long are forgotten."""
        found = list(map(self.known.get, words))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        if not gaps:
            return found
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missed = [words[i] for i in gaps]
        self._learn([w for w in missed if w not in older])
        for i, word in zip(gaps, missed):
            if (ids := known.get(word)) is None:
                ids = known[word] = older[word]
            found[i] = ids
        return found

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different words in one array, with begin and size of each word's."""
        stem = pc.ascii_rtrim(words, TAIL)
        long = pc.subtract(pc.binary_length(words), pc.binary_length(stem))
        # One sign after a letter or digit is a token of its own; a word with more stays whole.
        apart = pc.and_(pc.equal(long, 1), pc.match_substring_regex(stem, r"[\pL\pN]$"))
        code, stems = code_words(pc.if_else(apart, stem, words))
        encoded = self._ids_of(stems.to_pylist())
        pool = np.frombuffer(b"".join(encoded), "<u4")
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        begin, size = (np.cumsum(sizes) - sizes)[code], sizes[code]
        apart = apart.to_numpy(zero_copy_only=False)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset + 1 : words.offset + 1 + len(words)]
        last = np.zeros(len(words), dtype=np.int64)
        last[apart] = data[ends[apart] - 1]
        lengths = np.array([len(t) for t in self.tails])
        tail_of = np.array([TAIL.find(chr(c)) for c in range(256)])[last]
        extra = np.where(apart, lengths[tail_of], 0)
        total = size + extra
        after = np.cumsum(total) - total
        ids = np.empty(total.sum(), "<u4")
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        ids[step + np.repeat(after, size)] = pool[step + np.repeat(begin, size)]
        for i, tail in enumerate(self.tails):
            rows = apart & (tail_of == i)
            for k, value in enumerate(tail.tolist()):
                ids[after[rows] + size[rows] + k] = value
        return ids, after, total

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        special = pc.match_substring_regex(column, r"<\||[\x{0300}-\x{036F}]")
        offsets, words = split_words(pc.ascii_lower(pc.if_else(special, "", column)))
        codes, distinct = code_words(words)
        pool, begin, sizes = self._word_ids(distinct)
        size = sizes[codes]
        before = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(before[-1]) + np.repeat(begin[codes] - before[:-1], size)
        ids = pool[place]
        out = [ids[a:b] for a, b in zip(before[offsets[:-1]].tolist(), before[offsets[1:]].tolist())]
        for row in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            out[row] = np.array(self._encode([column[row].as_py()])[0], "<u4")
        return out


_LOADED: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of this worker; its words stay known for the next task."""
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]


def cut(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of `n` ids."""
    lengths, rest = [capacity] * (n // capacity), n % capacity
    while rest > WHOLE and rest * (k := capacity // rest) < LEAST_FILL * capacity:
        lengths.append(capacity // (k + 1))
        rest -= lengths[-1]
    return [*lengths, rest] if rest else lengths


def pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids) of the documents' pieces; ids little-endian, 4 bytes each."""

    def work(batch: pa.RecordBatch) -> dict:
        tokens = word_tokens(tokenizer or default_tokenizer())
        rows = {name: [] for name in ("start", "length", "doc_tokens", "ids", "row")}
        for row, ids in enumerate(tokens.encode(texts(batch["text"]))):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            start = 0
            for length in cut(len(ids), capacity):
                rows["start"].append(start)
                rows["length"].append(length)
                rows["doc_tokens"].append(len(ids))
                rows["ids"].append(ids[start : start + length].tobytes())
                rows["row"].append(row)
                start += length
        out = {name: pa.array(rows[name], pa.int64()) for name in ("start", "length", "doc_tokens")}
        return {
            "doc_id": batch["doc_id"].take(pa.array(rows["row"], pa.int64())),
            "ids": pa.array(rows["ids"], pa.binary()),
            **out,
        }

    needed = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return mapped(needed, work, PIECES, SLICE_BYTES)


def numbered(found: DataFrame) -> DataFrame:
    """The pieces stored, each with a number: its task's in the upper bits, its row's in the lower."""
    return stored(found.withColumn("piece", F.monotonically_increasing_id()), "pieces")


PLACES = "piece bigint, sequence_id bigint, offset bigint"


def _fill_rest(capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def work(rest: pd.DataFrame) -> pd.DataFrame:
        """Largest first, each into the fullest sequence that takes it."""
        rest = rest.sort_values(["length", "piece"], ascending=[False, True])
        room: list[tuple[int, int]] = []  # (ids left, sequence), ascending
        number, offset, opened = [], [], 0
        for length in rest["length"].tolist():
            at = bisect.bisect_left(room, (length, -1))
            left, sequence = room.pop(at) if at < len(room) else (capacity, opened)
            opened += sequence == opened
            number.append(sequence)
            offset.append(capacity - left)
            bisect.insort(room, (left - length, sequence))
        sequences = np.array(number, dtype=np.int64) * (capacity + 1)
        return pd.DataFrame({"piece": rest["piece"], "sequence_id": sequences, "offset": np.array(offset, np.int64)})

    return work


def place(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(piece, sequence_id, offset) of each piece of a stored table with `piece` and `length`."""
    rows = table.select(
        "piece",
        "length",
        F.expr(f"int({capacity} div length)").alias("class"),
        F.expr(f"piece div {BLOCK_ROWS}").alias("block"),
    )
    counts = rows.groupBy("class", "block").agg(F.count("*").alias("n"))
    up_to = W.partitionBy("class").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    begins = counts.select(
        "class",
        "block",
        F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("before"),
        F.sum("n").over(W.partitionBy("class")).alias("total"),
    )
    own = F.row_number().over(W.partitionBy("class", "block").orderBy("piece")) - 1
    placed = (
        rows.withColumn("own", own)
        .join(begins, ["class", "block"])
        .withColumn("rank", F.col("before") + F.col("own"))
        .withColumn("whole", F.expr("rank < total div class * class"))
    )
    earlier = W.partitionBy("sequence_id").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    full = (
        placed.filter("whole")
        .withColumn("sequence_id", F.expr(f"rank div class * {capacity + 1} + class"))
        .select("piece", "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))
    )
    # Under `class` pieces of each class: a number that the documents don't move.
    rest = placed.filter("not whole").select(F.lit(0).alias("all"), "piece", "length")
    return full.unionByName(rest.groupBy("all").applyInPandas(_fill_rest(capacity), PLACES))


def with_places(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The columns of a numbered table, and the places of its pieces.

    Places are found from lengths alone; the other columns are shuffled once, to meet them.
    """
    return table.join(place(table, capacity).hint("shuffle_hash"), "piece").drop("piece")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The pieces of `docs` with their ids and places."""
    return with_places(numbered(pieces(docs, doc_id, text, **options)), options.get("capacity", CAPACITY))
