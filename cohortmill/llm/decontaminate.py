"""Benchmark decontamination by SimHash over item-sized windows.

Words are runs of letters, digits and non-ASCII characters, A-Z lowered. For an item of
L words every window of L words (a shorter text is one window) that holds a 5-word shingle
of an item of that size gets a SimHash of its shingles; without such a shingle the final
similarity is 0. A multi-index of 8 blocks of 8 bits finds the items: of two fingerprints
within 23 bits some block differs in at most 2, and each item is filed under all block
values within 2 bits of its own, so no fingerprint within the radius is missed. At the
least similarity accepted about 10 bits differ (deviation 3). Candidates within the radius
are verified by the exact weighted Jaccard similarity of the shingles, repeats counted.

Items are held by every worker, in blocks of about `BLOCK_BYTES` of text at most, indexed once
for each worker and not for each task: a larger
benchmark takes one pass over the documents for each block. A document is searched
within its row, so nothing of the documents is shuffled.

Defined cases: null and empty texts match nothing, nor do null and empty items. An item of
under 5 words is one shingle as a whole and matches where just these words follow each other. Of windows equally similar the first
counts. Repeated items and rows each give their matches. Columns that the operator doesn't
name are passed through by `clean`. An empty benchmark leaves all documents.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmill.llm.common import positioned, slices, small_batches, split_words, texts

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS, BLOCK_BITS = 8, 8
BLOCK_BYTES = 4 << 20
WINDOWS = 4096
MATCHES = "doc_id bigint, item_id bigint, start bigint, length bigint, distance int, similarity double"

# Bytes as words see them: A-Z lowered, other ASCII than letters and digits a space.
_BYTE = np.array(
    [b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)],
    dtype=np.uint8,
)


def plain_words(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words of all texts, and where each text's words begin."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    buffers = [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(_BYTE[data].tobytes())]
    return split_words(pa.LargeStringArray.from_buffers(len(column), buffers[1], buffers[2]))


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(values: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash of each run of `size` values; of all values if they are fewer."""
    size = min(size, len(values))
    total = np.zeros(len(values) - size + 1, dtype=np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + values[i : i + len(total)]
    return _mix(total)


def word_hashes(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)


def window_fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of each run of `size` shingles."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(hashes) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    ones = total[size:] - total[:-size]
    return np.packbits(2 * ones > size, axis=1, bitorder="little").view(np.uint64).ravel()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two lists of shingles, each weighing as often as it occurs."""
    (u, n), (v, m) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / (len(a) + len(b) - both)


class BlockIndex:
    """Fingerprints by the values of their blocks, each filed under all values near its own."""

    def __init__(self, fingerprints: np.ndarray, radius: int = RADIUS):
        self.fingerprints, self.radius = fingerprints, radius
        values = np.arange(1 << BLOCK_BITS, dtype=np.uint64)
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius // BLOCKS
        self.filed = []
        for block in range(BLOCKS):
            own = (fingerprints >> np.uint64(BLOCK_BITS * block)) & np.uint64(len(values) - 1)
            at, item = np.nonzero(near[:, own.astype(np.int64)])
            self.filed.append((np.searchsorted(at, np.arange(len(values) + 1)), item))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, item, distance) of all pairs within the radius."""
        pairs = []
        for block, (begin, item) in enumerate(self.filed):
            value = ((queries >> np.uint64(BLOCK_BITS * block)) & np.uint64(len(begin) - 2)).astype(np.int64)
            count = begin[value + 1] - begin[value]
            query = np.repeat(np.arange(len(queries)), count)
            place = np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count) + begin[value][query]
            pairs.append(query * len(self.fingerprints) + item[place])
        pair = np.unique(np.concatenate(pairs))
        query, item = pair // len(self.fingerprints), pair % len(self.fingerprints)
        distance = np.bitwise_count(queries[query] ^ self.fingerprints[item])
        hit = distance <= self.radius
        return query[hit], item[hit], distance[hit]


def _found(codes: np.ndarray, offsets: np.ndarray, size: int, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place, row, index in `wanted`) of the runs of `size` known words, within a text, of a wanted hash."""
    none = np.zeros(0, dtype=np.int64)
    if not len(wanted) or len(codes) < size:
        return none, none, none
    known = codes >= 0
    run = known[: len(known) - size + 1].copy()
    for i in range(1, size):
        run &= known[i : i + len(run)]
    place = np.flatnonzero(run)
    row = np.searchsorted(offsets, place, side="right") - 1
    inside = place + size <= offsets[row + 1]
    place, row = place[inside], row[inside]
    total = np.zeros(len(place), dtype=np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + codes[place + i].astype(np.uint64)
    value = _mix(total)
    at = np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)
    hit = wanted[at] == value
    return place[hit], row[hit], at[hit]


class Benchmark:
    """A block of items, ready to be searched for."""

    def __init__(self, items: list[tuple[int, str]]):
        offsets, words = plain_words(texts(pa.array([text for _, text in items], pa.large_string())))
        words = words.to_pylist()
        lists = [words[a:b] for a, b in zip(offsets, offsets[1:])]
        self.ids = [item for item, _ in items]
        short: dict[int, dict[tuple, list[int]]] = {}
        self.vocabulary = pa.array(sorted(set(words)), pa.large_string())
        code = {w: i for i, w in enumerate(self.vocabulary.to_pylist())}
        self.shingles, sizes, anchors, anchor_sizes = {}, {}, [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for i, own in enumerate(lists):
            if 0 < len(own) < SHINGLE:
                short.setdefault(len(own), {}).setdefault(tuple(code[w] for w in own), []).append(i)
            elif own:
                self.shingles[i] = shingles(word_hashes(own))
                sizes.setdefault(len(own), []).append(i)
                anchors.append(np.unique(shingles(np.array([code[w] for w in own], dtype=np.uint64))))
                anchor_sizes.append(np.full(len(anchors[-1]), len(own), dtype=np.uint32))
        # Of each size under a shingle's: the hashes of the items in order, and the items by their words' codes.
        self.short = {
            size: (np.sort([shingles(np.array(key, dtype=np.uint64))[0] for key in own]), own)
            for size, own in short.items()
        }
        # Each anchor once, and the sizes of the items that hold it between two ends.
        held, of = np.concatenate(anchors), np.concatenate(anchor_sizes)
        order = np.lexsort((of, held))
        held, of = held[order], of[order]
        self.anchors, begin = np.unique(held, return_index=True)
        self.anchor_ends, self.anchor_sizes = np.append(begin, len(held)), of
        self.sizes = {
            size: (own, BlockIndex(np.concatenate([window_fingerprints(self.shingles[i], size - SHINGLE + 1) for i in own])))
            for size, own in sizes.items()
        }

    def search(self, column: pa.Array) -> Iterator[tuple[int, int, int, int, int, float]]:
        """(row, item, start, length, distance, similarity): each row's best window for each item found."""
        offsets, words = plain_words(texts(column))
        if not len(self.vocabulary):
            return
        codes = pc.fill_null(pc.index_in(words, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False)
        for size, (hashes, own) in self.short.items():
            place, row, at = _found(codes, offsets, size, hashes)
            if not len(place):
                continue
            # The first place of each item in each text.
            _, first = np.unique(np.stack([row, at]), axis=1, return_index=True)
            for p, r in zip(place[first].tolist(), row[first].tolist()):
                for i in own.get(tuple(codes[p : p + size].tolist()), ()):
                    yield r, i, p - int(offsets[r]), size, 0, 1.0
        place, row, at = _found(codes, offsets, SHINGLE, self.anchors)
        for r in np.unique(row).tolist():
            a, b = np.searchsorted(row, [r, r + 1])
            first, last = int(offsets[r]), int(offsets[r + 1])
            ends = self.anchor_ends
            wanted = sorted({s for i in np.unique(at[a:b]).tolist() for s in self.anchor_sizes[ends[i] : ends[i + 1]].tolist()})
            best: dict[int, tuple] = {}
            for size in wanted:
                self._windows(words, first, last, place[a:b], size, best)
            for i, (_, start, length, distance, alike) in sorted(best.items()):
                yield r, i, start, length, distance, alike

    def _windows(self, words, first: int, last: int, anchors: np.ndarray, size: int, best: dict) -> None:
        """Enter into `best` the item matches of a text's windows of `size` words that hold an anchor."""
        length = min(size, last - first)
        steps = np.zeros(last - first - length + 2, dtype=np.int32)
        np.add.at(steps, np.clip(anchors + SHINGLE - length - first, 0, len(steps) - 1), 1)
        np.add.at(steps, np.clip(anchors + 1 - first, 0, len(steps) - 1), -1)
        starts = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
        own, index = self.sizes[size]
        # Neighbouring windows are taken together, so many of them at a time.
        for begin in np.unique(starts // WINDOWS).tolist():
            part = starts[starts // WINDOWS == begin]
            low, high = int(part[0]), int(part[-1]) + length
            hashes = shingles(word_hashes(words[first + low : first + high].to_pylist()))
            prints = window_fingerprints(hashes, length - SHINGLE + 1)[part - low]
            for query, item, distance in zip(*(x.tolist() for x in index.search(prints))):
                start, i = int(part[query]), own[item]
                if i in best and best[i][0] >= 1.0:
                    continue
                alike = similarity(hashes[start - low : start - low + length - SHINGLE + 1], self.shingles[i])
                if alike >= SIMILARITY and (i not in best or alike > best[i][0]):
                    best[i] = (alike, start, length, distance, alike)


_LOADED: dict[str, Benchmark] = {}


def loaded(key: str, shared: Broadcast) -> Benchmark:
    """The index of a block, built once for a worker and kept for its next tasks; one at a time."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Benchmark(shared.value)
    return _LOADED[key]


def _key(block: list[tuple[int, str]]) -> str:
    return hashlib.sha256(repr(block).encode()).hexdigest()


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The items in lists of about BLOCK_BYTES of text at most; the benchmark's size is checked first."""
    small_batches(items.sparkSession)
    needed = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = needed.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = math.ceil(total / BLOCK_BYTES)
    for block in range(blocks):
        rows = needed.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block).collect()
        yield sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0], r[1]))


def matches(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """One row for each document and benchmark item found in it, with the best window."""
    spark = docs.sparkSession
    needed = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    found = spark.createDataFrame([], MATCHES)
    for block in item_blocks(items, item_id):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared, key=_key(block)):
            benchmark = loaded(key, shared)
            for batch in batches:
                for piece in slices(batch):
                    ids = piece["doc_id"].to_pylist()
                    rows = [(ids[r], benchmark.ids[i], *rest) for r, i, *rest in benchmark.search(piece["text"])]
                    if rows:
                        kinds = [pa.int64()] * 4 + [pa.int32(), pa.float64()]
                        arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                        yield pa.RecordBatch.from_arrays(
                            arrays, names=["doc_id", "item_id", "start", "length", "distance", "similarity"]
                        )

        found = found.unionByName(needed.mapInArrow(run, MATCHES))
    return found


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The rows of `docs`, in all their columns, that hold no benchmark item."""
    docs, (text,), named = positioned(docs, text)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    at = docs.columns.index(text)
    for block in item_blocks(items, item_id):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared, key=_key(block)):
            benchmark = loaded(key, shared)
            for batch in batches:
                for piece in slices(batch):
                    keep = np.ones(piece.num_rows, dtype=bool)
                    keep[[r for r, *_ in benchmark.search(piece.column(at))]] = False
                    yield piece.filter(pa.array(keep))

        docs = docs.mapInArrow(run, schema)
    return named(docs)
