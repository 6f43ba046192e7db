"""SimHash near-duplicates with pigeonring filtering.

Fingerprints: 64 bits, each the majority over the XXH64 hashes (seed 42) of a
text's word shingles. Two texts are linked if their fingerprints differ in at
most `radius` bits; components are the connected parts of the links.

Candidates. A fingerprint is a ring of 8 segments of 8 bits. By the pigeonring
principle two fingerprints within `radius` have a segment from which every chain of l
consecutive segments differs in at most l * radius / 8 bits in total. Chains whose
budget is below 1 must be equal, and of the longest chain whose budget is below 2 all
other segments but one must be equal. For radius 3: two equal segments, then two of
the next three, so 8 starts * 3 choices = 24 keys of 32 bits for a fingerprint. Pairs that
share a key must keep all chain budgets before their full distance is taken.

Only different fingerprints take part, so copies cost nothing. Keys held by one
fingerprint are dropped by a count. A key held by many (a large group of near copies)
is dealt to tiles of bounded size, one for each pair of its parts, so every pair
is compared and no task holds the group. A tile returns only links that join parts not
yet joined there: at most one less than its rows.

Defined cases: a null or empty text has fingerprint 0 and is linked like any other; a
text of fewer words than a shingle is one shingle. Repeated rows and ids share a
component by their fingerprint. A component's id is its smallest document id; rows
with a null id take part, and a component of such rows alone has a null id. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.common import mapped, positioned, signed, stored, texts

SEGMENTS = 8
WIDTH = 8
SEED = 42
TILE_ROWS = 2048
CHUNK = 1 << 15


# --- fingerprints ------------------------------------------------------------
def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of one text as an unsigned integer."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, CHUNK):
        pairs = zip(starts[i : min(n, i + CHUNK)].tolist(), last[i : i + CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, fp) of each row; `fp` holds the 64 bits as a bigint."""

    def work(batch: pa.RecordBatch) -> dict:
        column = texts(batch["text"]).cast(pa.large_binary()).to_pylist()
        values = np.array([fingerprint(t, shingle) for t in column], dtype=np.uint64)
        keys_ = np.array([xxhash.xxh64_intdigest(t, SEED) for t in column], dtype=np.uint64)
        return {
            "doc_id": batch["doc_id"],
            "text_key": pa.array(keys_.view(np.int64)),
            "fp": pa.array(values.view(np.int64)),
        }

    needed = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return mapped(needed, work, "doc_id bigint, text_key bigint, fp bigint")


# --- candidates --------------------------------------------------------------
def chain_budgets(radius: int) -> list[int]:
    """Bits that a chain of 1 .. 8 segments may differ in."""
    return [length * radius // SEGMENTS for length in range(1, SEGMENTS + 1)]


def key_masks(radius: int) -> list[int]:
    """For each key the bits that must be equal; a key is the number of its mask and these bits."""
    budgets = chain_budgets(radius)
    equal = budgets.count(0)
    if not equal:
        raise ValueError(f"radius {radius} leaves no segment equal; it must be below {SEGMENTS}")
    loose = budgets.count(1)
    segment = lambda i: ((1 << WIDTH) - 1) << (WIDTH * (i % SEGMENTS))
    masks = []
    for start in range(SEGMENTS):
        base = sum(segment(start + i) for i in range(equal))
        rest = [segment(start + equal + i) for i in range(min(loose, SEGMENTS - equal))]
        # A chain with one bit to spend: all its other segments but one are equal.
        masks += [base + sum(rest) - free for free in rest] or [base]
    return list(dict.fromkeys(masks))


def keys(distinct: DataFrame, radius: int) -> DataFrame:
    """(k, bits, fp): one row for each fingerprint and mask."""
    masks = F.array(*[F.lit(signed(m)).cast("bigint") for m in key_masks(radius)])
    return distinct.select("fp", F.posexplode(masks).alias("k", "mask")).select(
        "k", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), "fp"
    )


def within(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs keep all chain budgets from some segment, and then the full distance."""
    differ = a ^ b
    budgets = chain_budgets(radius)
    per = [np.bitwise_count((differ >> np.uint64(WIDTH * i)) & np.uint64(255)) for i in range(SEGMENTS)]
    some = np.zeros(len(a), dtype=bool)
    for start in range(SEGMENTS):
        total = np.zeros(len(a), dtype=np.uint8)
        fits = np.ones(len(a), dtype=bool)
        for length in range(SEGMENTS):
            total = total + per[(start + length) % SEGMENTS]
            fits &= total <= budgets[length]
        some |= fits
    hit = np.flatnonzero(some)
    return hit[np.bitwise_count(differ[hit]) <= radius]


class _Sets:
    """Disjoint sets over row numbers, with a label for each row."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Positions of the links that join two sets."""
        used, parent = [], {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for i, (x, y) in enumerate(zip(self.label[a].tolist(), self.label[b].tolist())):
            if (x := root(x)) != (y := root(y)):
                parent[max(x, y)] = min(x, y)
                used.append(i)
        if parent:
            moved = np.arange(len(self.label))
            moved[list(parent)] = [root(x) for x in parent]
            self.label = moved[self.label]
        return used


def tile_links(group: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the rows of each group; `group` is sorted, its runs are small."""
    sets, out_a, out_b = _Sets(len(fp)), [], []
    row, step = np.arange(len(fp) - 1), 1
    while len(row):
        row = row[(row + step < len(fp))]
        row = row[group[row] == group[row + step]]
        open_ = row[sets.label[row] != sets.label[row + step]]
        hit = open_[within(fp[open_], fp[open_ + step], radius)]
        hit = hit[sets.join(hit, hit + step)] if len(hit) else hit
        out_a.append(fp[hit])
        out_b.append(fp[hit + step])
        step += 1
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (fp[:0], fp[:0])


def links(distinct: DataFrame, radius: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): links whose connected parts are those of all pairs within `radius`."""
    keyed = keys(distinct, radius)
    shared = keyed.groupBy("k", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    # Parts of a key: one up to `tile_rows`, else as many as keep a part below half a tile.
    parts = F.when(F.col("n") <= tile_rows, 1).otherwise(F.ceil(F.col("n") * 3 / tile_rows)).cast("int")
    dealt = (
        keyed.join(shared, ["k", "bits"])
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            F.xxhash64("k", "bits", F.least("part", "other"), F.greatest("part", "other")).alias("tile"), "fp"
        )
        .repartition("tile")
        .sortWithinPartitions("tile", "fp")
    )

    def run(batches):
        def found(group, fp):
            a, b = tile_links(group, fp.view(np.uint64), radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

        group, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            group = np.concatenate([group, batch["tile"].to_numpy()])
            fp = np.concatenate([fp, batch["fp"].to_numpy()])
            # The last tile may go on in the next batch.
            cut = int(np.searchsorted(group, group[-1])) if len(group) else 0
            yield from found(group[:cut], fp[:cut])
            group, fp = group[cut:], fp[cut:]
        yield from found(group, fp)

    return dealt.mapInArrow(run, "a bigint, b bigint")


# --- components --------------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes that have a link; the root is the smallest node connected.

    Alternating stars: each node's larger neighbours, then its smaller ones, move to
    the smallest node seen. Minima are combined on the map side; a node with many
    neighbours is only ever the key of a join, which adaptive execution splits. Each
    half-step is a table in the shared folder; the driver sees a count and a checksum.
    """
    pairs = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "links",
    )
    before = None
    while (now := _digest(pairs)) != before:
        before = now
        around = pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(pairs.select("hi", "lo"))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("lo"), F.least("u", "m").alias("m")
        )
        pairs = stored(pairs.join(least, "lo").select("hi", F.col("m").alias("lo")).distinct(), "large-star")
        least = pairs.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = pairs.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        pairs = stored(moved.union(least).distinct(), "small-star")
    roots = pairs.select("lo").distinct()
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots.select("lo", "lo"))


def _digest(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def resolve(marked: DataFrame, radius: int = 3, tile_rows: int = TILE_ROWS) -> DataFrame:
    """`marked` rows (a stored table with doc_id and fp) with `root` and `component_id`."""
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    linked = stored(components(links(distinct, radius, tile_rows)), "components")
    joined = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    joined = stored(joined, "rooted")
    first = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = joined.select("fp", "root").join(first, "root")
    return marked.join(by_fp, "fp")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id) of each row of `docs`."""
    return resolve(stored(fingerprints(docs, shingle, doc_id, text), "marked"), radius)


def keep_one(
    docs: DataFrame, shingle: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of `docs` for each component: of its smallest id, one if that is repeated."""
    docs, (doc_id, text), named = positioned(docs, doc_id, text)
    found = near_duplicates(docs, shingle, radius, doc_id, text)
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("pick")
    key, own_id, own_text = "__key", "__doc_id", "__text_key"
    kept = found.groupBy("root").agg(pick).select(
        F.col("pick.doc_id").alias(own_id),
        F.col("pick.text_key").alias(own_text),
        F.xxhash64("pick.doc_id", "pick.text_key").alias(f"{key}_kept"),
    )
    number = docs[doc_id].cast("bigint")
    text_key = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    keyed = docs.withColumn(key, F.xxhash64(number, text_key))
    # One key to join on and to drop repeats by, so that texts are shuffled once.
    same = (F.col(key) == F.col(f"{key}_kept")) & number.eqNullSafe(F.col(own_id)) & (text_key == F.col(own_text))
    return named(keyed.join(kept, same).dropDuplicates([key, own_id, own_text]).select(*docs.columns))
