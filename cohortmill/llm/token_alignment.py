"""Cross-tokenizer alignment by external spill counting.

Two tokenizers, A and B, cut the same bytes: a space and the text. Byte offsets where
tokens of both end cut the text into groups; the A and the B token that end together are
linked. How often two ids are linked in all documents tells how well they stand for each other.

Counting is external. A slice of documents gives (pair, document, times) records, which are
radix-partitioned by the low bits of the B id, sorted by (B id, A id, document) and spilled as
one zstd run for each partition. The runs of a partition are dealt to slots of a bounded number
of records. A k-way heap merge over the heads of a slot's runs (pairs and their sums) counts the
pairs, slots are added up, and since pairs lie B-major, the highest count of a B id is that of
adjacent rows, at most A's vocabulary. A second pass over the slots streams each
run's bodies (documents and times) against the counts and sends contributions back, one vector
for each run, which are added by slice of documents. No B id, however common, comes to one task:
its records lie in as many slots as they need.

Neither tokenizer joins what a space parts if no white space follows it, so a text is the words
between its spaces, each aligned once and looked up after that. Texts with other white
space after a space, with a space at an end, or with U+2581 are aligned whole.

Defined cases: a null or empty text, and one whose tokens don't spell its bytes, has no tokens:
zeros and an empty digest. Repeated rows and rows without an id count like others, each has a
row. Ties for the highest count all count as best. Columns that the operator doesn't
name are ignored. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortmill.llm.chat import id_bytes
from cohortmill.llm.common import code_words, mapped, stored, texts

RADIX_BITS = 6
ID_BITS = 18  # of a token id
DOC_BITS = 16  # of a document's place in its slice
SLOT_RECORDS = 4_000_000
TEXT_BYTES = 2 << 20  # of a slice
CACHE_WORDS = 60_000
LONGEST_KNOWN = 100  # characters of a word that is kept
OFTEN = 2  # times a word is met in a slice to be kept
RUN_WORDS = 500
# Where words between spaces don't stand for themselves.
WHOLE = r"\x{2581}|^ | $| [\s\x0b\x1c-\x1f\x{85}\p{Z}]"

SLICES = (
    "batch bigint, place int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, bucket int, records bigint, head binary, body binary"
)
COUNTS = "bucket int, slot int, pair bigint, n bigint"
GIVEN = "batch bigint, best binary, total binary"
ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# (A tokens, B tokens, groups, the groups as text, pair codes as bytes) of a text; None where bytes differ.
Entry = tuple[int, int, int, bytes, bytes]


class Aligner:
    """Groups and links of texts; those of common words are kept, words not met for long are forgotten."""

    def __init__(self, path_a: str, path_b: str):
        # A task has one core; threads of the tokenizer would take those of other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = id_bytes(self.a)
        pieces = [(self.b.is_byte(i), self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(piece[1:-1], 16)]) if byte else piece.replace("▁", " ").encode() for byte, piece in pieces
        ]
        self.size_a, self.size_b = (np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b))
        # An id as text with the sign behind it: within a group, at its end, between groups.
        n = max(len(self.bytes_a), len(self.bytes_b))
        self.shown = np.array([f"{i}{sign}" for sign in ",|;" for i in range(n)], dtype="S")
        self.known: dict[str, Entry | None] = {}
        self.older: dict[str, Entry | None] = {}

    def align(self, contents: list[str]) -> list[Entry | None]:
        """The entry of each text, encoded as a whole."""
        spaced = [" " + text for text in contents]
        ids_a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        ids_b = self.b.encode(contents, num_threads=1)
        raw = [text.encode() for text in spaced]
        valid = [self._spells(a, b, text) for a, b, text in zip(ids_a, ids_b, raw)]
        good = [i for i, v in enumerate(valid) if v]
        flat_a, flat_b = ([x for i in good for x in ids[i]] for ids in (ids_a, ids_b))
        cut = iter(self._cut(flat_a, flat_b, np.array([len(raw[i]) for i in good], dtype=np.int64)))
        return [next(cut) if v else None for v in valid]

    def _spells(self, ids_a: list[int], ids_b: list[int], raw: bytes) -> bool:
        return all(
            b"".join(map(table.__getitem__, ids)) == raw for ids, table in ((ids_a, self.bytes_a), (ids_b, self.bytes_b))
        )

    def _cut(self, flat_a: list[int], flat_b: list[int], sizes: np.ndarray) -> list[Entry]:
        """The entries of texts of these sizes whose ids follow one another."""
        ids_a, ids_b = np.array(flat_a, dtype=np.int64), np.array(flat_b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        at = np.searchsorted(ends_b, ends_a)
        last_a = np.flatnonzero(ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a) if len(ends_b) else at
        last_b = at[last_a]
        pairs = pair_code(ids_a[last_a].astype(np.uint64), ids_b[last_b].astype(np.uint64)).tobytes()
        # Tokens in the order of the text form: of each group A's, then B's.
        group_a, group_b = (np.searchsorted(last, np.arange(len(ids))) for last, ids in ((last_a, ids_a), (last_b, ids_b)))
        before_b, upto_a = np.append(0, last_b + 1), np.append(0, last_a + 1)
        place_a = np.arange(len(ids_a)) + before_b[group_a]
        place_b = np.arange(len(ids_b)) + upto_a[group_b + 1]
        n = len(self.shown) // 3
        token = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        token[place_a], token[place_b] = ids_a, ids_b
        token[place_a[last_a]] += n
        token[place_b[last_b]] += 2 * n
        text = self.shown[token]
        length = np.char.str_len(text)
        text = text.tobytes().replace(b"\0", b"")
        # Where each text ends among groups, tokens and characters; the last sign is left out.
        bounds = np.searchsorted(ends_a[last_a], np.cumsum(sizes), side="right")
        groups = np.append(0, bounds)
        tokens_a, tokens_b = upto_a[groups], before_b[groups]
        signs = np.append(0, np.cumsum(length))[tokens_a + tokens_b]
        return [
            (a2 - a, b2 - b, g2 - g, text[c : c2 - 1], pairs[8 * g : 8 * g2])
            for a, a2, b, b2, g, g2, c, c2 in zip(
                *(x.tolist() for edges in (tokens_a, tokens_b, groups, signs) for x in (edges[:-1], edges[1:]))
            )
        ]

    def learn(self, words: list[str]) -> list[Entry | None]:
        """`align` of words, many in one text, as neither tokenizer joins what a space parts."""
        out: list[Entry | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if w and not w[0].isspace()]
        alone = [i for i, w in enumerate(words) if not w or w[0].isspace()]
        runs = [plain[i : i + RUN_WORDS] for i in range(0, len(plain), RUN_WORDS)]
        contents = [" ".join([words[i] for i in run]) for run in runs]
        spaced = [" " + text for text in contents]
        ids_a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        ids_b = self.b.encode(contents, num_threads=1)
        good, flat_a, flat_b = [], [], []
        for run, text, a, b in zip(runs, spaced, ids_a, ids_b):
            if self._spells(a, b, text.encode()):
                good += run
                flat_a += a
                flat_b += b
            else:  # some word of the run doesn't spell its bytes
                alone += run
        sizes = np.array([len(words[i].encode()) + 1 for i in good], dtype=np.int64)
        for i, entry in zip(good, self._cut(flat_a, flat_b, sizes)):
            out[i] = entry
        for i, entry in zip(alone, self.align([words[i] for i in alone])):
            out[i] = entry
        return out

    def of_words(self, words: list[str], often: list[bool]) -> list[Entry | None]:
        """The entries of different words; those met often are kept."""
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = [w for w in words if w not in known and w not in older]
        fresh = dict(zip(new, self.learn(new)))
        found = []
        for word, keep in zip(words, often):
            if word in known:
                found.append(known[word])
                continue
            entry = fresh[word] if word in fresh else older[word]
            found.append(entry)
            if keep and len(word) <= LONGEST_KNOWN:
                known[word] = entry
        return found


def pair_code(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Both ids in one number, ordered by radix partition, B id, A id."""
    id_bits, radix, rest = (np.uint64(n) for n in (ID_BITS, RADIX_BITS, ID_BITS - RADIX_BITS))
    low = b & np.uint64((1 << RADIX_BITS) - 1)
    return ((low << rest | b >> radix) << id_bits) | a


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(paths: tuple[str, str]) -> Aligner:
    """The aligner of this worker; its words stay known for the next task."""
    if paths not in _LOADED:
        _LOADED[paths] = Aligner(*paths)
    return _LOADED[paths]


def _packed(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def runs_of(pairs: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(partition, records, head, body) of each zstd run of a slice's links.

    A head has the partition's pairs in order, the number of documents of each and the sum of
    their times; a body has documents and times, pair by pair.
    """
    keys, times = np.unique(pairs << np.uint64(DOC_BITS) | place, return_counts=True)
    pair = keys >> np.uint64(DOC_BITS)
    docs = (keys & np.uint64((1 << DOC_BITS) - 1)).astype("<u2")
    first = np.flatnonzero(np.diff(pair, prepend=np.uint64(0xFFFFFFFFFFFFFFFF)))
    sums = np.add.reduceat(times, first) if len(first) else times
    sizes = np.diff(np.append(first, len(pair)))
    codes = pair[first]
    bucket = (codes >> np.uint64(2 * ID_BITS - RADIX_BITS)).astype(np.int64)
    edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(codes))
    for start, end in zip(edges.tolist(), edges[1:].tolist()):
        rows = slice(int(first[start]), int(first[end]) if end < len(first) else len(pair))
        steps = np.diff(codes[start:end], prepend=np.uint64(0))
        head = b"".join(
            [(end - start).to_bytes(8, "little"), steps.astype("<u8").tobytes(), sizes[start:end].astype("<u4").tobytes(),
             sums[start:end].astype("<u8").tobytes()]
        )
        body = np.concatenate([docs[rows].view(np.uint8), times[rows].astype("<u4").view(np.uint8)])
        yield (
            int(bucket[start]),
            rows.stop - rows.start,
            zstandard.ZstdCompressor(level=1).compress(head),
            _packed(body),
        )


def head_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, number of documents, sum of times of a run."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:8], "little")
    steps = np.frombuffer(raw, "<u8", n, 8)
    return np.cumsum(steps, dtype=np.uint64), np.frombuffer(raw, "<u4", n, 8 + 8 * n), np.frombuffer(raw, "<u8", n, 8 + 12 * n)


def body_of(data: bytes, records: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and times of a run."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    return np.frombuffer(raw, "<u2", records), np.frombuffer(raw, "<u4", records, 2 * records)


def spilled(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizers: tuple[str, str] | None = None
) -> DataFrame:
    """A row for each document, without a bucket, and one for each run of each slice, with its bucket."""

    def work(batch: pa.RecordBatch) -> dict:
        found = aligner(tokenizers or default_tokenizers())
        column = texts(batch["text"])
        n = len(column)
        if n >> DOC_BITS:
            raise ValueError("a slice has more documents than a record's number holds")
        whole = pc.match_substring_regex(column, WHOLE)
        lists = pc.split_pattern(pc.if_else(whole, "", column), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        codes, words = code_words(lists.flatten())
        words = words.to_pylist()
        entries = found.of_words(words, (np.bincount(codes, minlength=len(words)) >= OFTEN).tolist())
        rows = np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist()
        entries += found.align([column[row].as_py() for row in rows])
        own = dict(zip(rows, range(len(words), len(entries))))
        empty = (0, 0, 0, b"", b"")
        valid = np.array([e is not None for e in entries], dtype=bool)
        entries = [e or empty for e in entries]
        parts = [e[3] for e in entries]
        sizes = np.array([e[:3] for e in entries], dtype=np.int64).reshape(-1, 3)
        pool = np.frombuffer(b"".join([e[4] for e in entries]), np.uint64)
        begin = np.cumsum(sizes[:, 2]) - sizes[:, 2]
        counts, digests, used, place = np.zeros((n, 3), np.int64), [], [], []
        blank = pc.equal(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        for row in range(n):
            at = np.array([own[row]]) if row in own else codes[offsets[row] : offsets[row + 1]]
            if blank[row] or not valid[at].all():
                digests.append("")
                continue
            counts[row] = sizes[at].sum(axis=0)
            digests.append(hashlib.sha256(b";".join([parts[i] for i in at.tolist()])).hexdigest())
            used.append(at)
            place.append(np.full(len(at), row))
        used = np.concatenate(used) if used else np.zeros(0, np.int64)
        place = np.concatenate(place) if place else np.zeros(0, np.int64)
        links = sizes[used, 2]
        step = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links, links)
        pairs = pool[step + np.repeat(begin[used], links)]
        runs = list(runs_of(pairs, np.repeat(place, links).astype(np.uint64)))
        m = len(runs)
        first = batch["row"][0].as_py()
        plain = {
            "place": pa.array(range(n), pa.int32()), "doc_id": batch["doc_id"], "n_a": pa.array(counts[:, 0]),
            "n_b": pa.array(counts[:, 1]), "n_groups": pa.array(counts[:, 2]), "n_links": pa.array(counts[:, 2]),
            "groups_sha256": pa.array(digests, pa.string()),
        }
        spills = zip(["bucket", "records", "head", "body"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()])
        return {
            "batch": pa.array([first] * (n + m), pa.int64()),
            **{name: pa.concat_arrays([array, pa.nulls(m, array.type)]) for name, array in plain.items()},
            **{
                name: pa.concat_arrays([pa.nulls(n, kind), pa.array([run[i] for run in runs], kind)])
                for i, (name, kind) in enumerate(spills)
            },
        }

    needed = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
    )
    return mapped(needed, work, SLICES, TEXT_BYTES)


def slotted(runs: DataFrame, slot_records: int = SLOT_RECORDS) -> DataFrame:
    """The runs with the slot of their bucket; a slot has about `slot_records` records."""
    held = runs.groupBy("bucket").agg(F.ceil(F.sum("records") / slot_records).alias("slots"))
    # At most 2 ** RADIX_BITS rows.
    dealt = runs.join(F.broadcast(held), "bucket")
    return dealt.withColumn("slot", F.pmod(F.xxhash64("batch"), F.col("slots")).cast("int")).drop("slots")


def _merged(key: tuple, runs: pd.DataFrame) -> pd.DataFrame:
    """Sums of each pair of a slot, by a heap over its runs."""
    bucket, slot = key
    heads = []
    for data in runs["head"]:
        pairs, _, sums = head_of(data)
        heads.append(zip(pairs.tolist(), sums.tolist()))
    pairs, sums = [], []
    for pair, group in groupby(heapq.merge(*heads), key=itemgetter(0)):
        pairs.append(pair)
        sums.append(sum(n for _, n in group))
    return pd.DataFrame(
        {
            "bucket": np.full(len(pairs), bucket, np.int32),
            "slot": np.full(len(pairs), slot, np.int32),
            "pair": np.array(pairs, np.int64),
            "n": np.array(sums, np.int64),
        }
    )


def pair_counts(slots: DataFrame) -> DataFrame:
    """(bucket, slot, pair, n): the partial counts of each slot, from the runs' heads alone."""
    return slots.select("bucket", "slot", "head").groupBy("bucket", "slot").applyInPandas(_merged, COUNTS)


def totals(counts: DataFrame) -> DataFrame:
    """(bucket, pair, n, best): each pair's count over all slots, and whether it's its B id's highest."""
    summed = counts.groupBy("bucket", "pair").agg(F.sum("n").alias("n"))
    # Adjacent in the order of pairs; no more rows than A has ids.
    of_b = W.partitionBy("bucket", F.shiftright("pair", ID_BITS))
    return summed.withColumn("best", F.col("n") == F.max("n").over(of_b))


def _given(key: tuple, runs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """What each run of a slot gives its documents, by streaming its body against the counts."""
    known = known.sort_values("pair")
    pairs = known["pair"].to_numpy(np.uint64)
    n, best = known["n"].to_numpy(np.int64), known["best"].to_numpy(bool)
    rows = []
    for batch, records, head, body in zip(runs["batch"], runs["records"], runs["head"], runs["body"]):
        own, sizes, _ = head_of(head)
        docs, times = body_of(body, records)
        at = np.repeat(np.searchsorted(pairs, own), sizes)
        width, times = int(docs.max()) + 1, times.astype(np.int64)
        sums, hits = np.zeros(width, np.int64), np.zeros(width, np.int64)
        np.add.at(sums, docs, n[at] * times)
        np.add.at(hits, docs, best[at] * times)
        rows.append((batch, _packed(hits), _packed(sums)))
    return pd.DataFrame(rows, columns=["batch", "best", "total"])


def contributions(slots: DataFrame, counts: DataFrame, known: DataFrame) -> DataFrame:
    """(batch, best, total): vectors over a slice's documents, one for each run."""
    of_slot = counts.select("bucket", "slot", "pair").join(known, ["bucket", "pair"])
    right = of_slot.groupBy("bucket", "slot")
    return slots.groupBy("bucket", "slot").cogroup(right).applyInPandas(_given, GIVEN)


def _added(key: tuple, docs: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
    """The documents of a slice with the sum of their contributions."""
    sums = {name: np.zeros(len(docs), np.int64) for name in ("best", "total")}
    for name, out in sums.items():
        for data in given[name]:
            part = _unpacked(data, "<i8")
            out[: len(part)] += part
    docs = docs.sort_values("place")
    return docs.assign(n_best=sums["best"], count_sum=sums["total"])[[f.split(" ")[0] for f in ALIGNED.split(", ")]]


def align(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizers: tuple[str, str] | None = None,
    slot_records: int = SLOT_RECORDS,
) -> DataFrame:
    """Tokens, groups, links and link counts of each document."""
    spills = stored(spilled(docs, doc_id, text, tokenizers), "alignment-runs")
    slots = slotted(spills.filter("bucket IS NOT NULL").select("batch", "bucket", "records", "head", "body"), slot_records)
    counts = stored(pair_counts(slots), "alignment-counts")
    given = contributions(slots, counts, totals(counts))
    rows = spills.filter("bucket IS NULL").drop("bucket", "records", "head", "body")
    return rows.groupBy("batch").cogroup(given.groupBy("batch")).applyInPandas(_added, ALIGNED)


def links(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizers: tuple[str, str] | None = None
) -> DataFrame:
    """(a_id, b_id, n, best): how often two ids are linked, and whether the A id is a best one of the B id."""
    spills = stored(spilled(docs, doc_id, text, tokenizers), "alignment-runs")
    slots = slotted(spills.filter("bucket IS NOT NULL").select("batch", "bucket", "records", "head", "body"))
    b = F.shiftright("pair", ID_BITS)
    high = F.shiftright(b, ID_BITS - RADIX_BITS)
    low = b.bitwiseAND((1 << (ID_BITS - RADIX_BITS)) - 1)
    return totals(pair_counts(slots)).select(
        F.col("pair").bitwiseAND((1 << ID_BITS) - 1).alias("a_id"),
        F.shiftleft(low, RADIX_BITS).bitwiseOR(high).alias("b_id"),
        "n",
        "best",
    )
