"""Quality rules by cross-document line frequency.

One pass over the texts makes a profile per row: word counts and a hash of each
normalised line (A-Z lowered, words joined by one space). Per host and line the
documents that hold it are counted, copies too. A line held by more than `min_docs`
documents and more than `max_share` of the host's is boilerplate and removed; a
document that keeps less than `min_left` of its words is depleted and rejected.

Defined cases: a null text is empty, a null host is the host without a name, a null
document id is an id of its own. Repeated rows each get their result, which depends
on host and text alone. An empty text has no words and fails the base rules. Lines
without a word are never counted. Columns the operator doesn't name are ignored by
`judge` and kept by `clean`. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.common import code_words, mapped, positioned, signed, split_words, stored, texts
from cohortmill.llm.lines import drop_lines, line_hashes, text_lines

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MIN_DOCS = 10
MAX_SHARE = 0.1
MIN_LEFT = 0.3

PROFILE = (
    "doc_id bigint, host string, text_key bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, lines array<struct<hash:bigint,words:int>>"
)
KEY = ["doc_id", "host", "text_key"]


def repeated_words(codes: np.ndarray, n_codes: int) -> int:
    """Words that lie in a 3-word window found at least twice."""
    if len(codes) < 4:
        return 0
    pairs = codes[:-1] * n_codes + codes[1:]
    if n_codes > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, inverse, counts = np.unique(pairs[:-1] * n_codes + codes[2:], return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(codes), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def _profile(batch: pa.RecordBatch) -> dict:
    column = texts(batch["text"])
    offsets, words = split_words(column)
    codes, _ = code_words(words)
    ends = np.concatenate([[0], np.cumsum([len(w) for w in words.to_pylist()])])
    rows = {name: [] for name in ("text_key", "n_symbols", "n_dup_lines", "n_repeat_words", "lines")}
    for i, text in enumerate(column.cast(pa.large_binary()).to_pylist()):
        own = codes[offsets[i] : offsets[i + 1]]
        used, local = np.unique(own, return_inverse=True)
        rows["n_repeat_words"].append(repeated_words(local, len(used)))
        rows["n_symbols"].append(len(text) - len(text.translate(None, SYMBOLS)))
        lines = text_lines(text)
        rows["n_dup_lines"].append(len(lines) - len(set(lines)))
        rows["lines"].append([{"hash": h, "words": n} for h, n in line_hashes(lines).items()])
        rows["text_key"].append(signed(xxhash.xxh64_intdigest(text, 42)))
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int32())]))
    return {
        "doc_id": batch["doc_id"],
        "host": batch["host"],
        "n_words": pa.array(np.diff(offsets), pa.int64()),
        "word_chars": pa.array(ends[offsets[1:]] - ends[offsets[:-1]], pa.int64()),
        **{name: pa.array(rows[name], pa.int64()) for name in rows if name != "lines"},
        "lines": pa.array(rows["lines"], kind),
    }


def profiles(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Word counts and line hashes of each row, stored."""
    needed = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        F.coalesce(F.col(host), F.lit("")).alias("host"),
    )
    return stored(mapped(needed, _profile, PROFILE), "line-profiles")


def frequent_lines(profile: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(host, hash) of the lines above the limits."""
    # A profile has each hash once, so documents are counted on the map side.
    held = profile.select("host", F.explode("lines.hash").alias("hash"))
    often = held.groupBy("host", "hash").agg(F.count("*").alias("n")).filter(F.col("n") > min_docs)
    hosts = profile.groupBy("host").agg(F.count("*").alias("host_docs"))
    return often.join(hosts, "host").filter(F.col("n") > F.lit(max_share) * F.col("host_docs")).select("host", "hash")


def judge(
    profile: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT
) -> DataFrame:
    """Each row's counts and verdicts, and the hashes of its removed lines.

    `profile` is read three times, so it has to be a stored table.
    """
    lines = profile.select(*KEY, F.explode("lines").alias("line")).select(*KEY, "line.hash", "line.words")
    # A table of its own: broadcast if Spark finds it small, else joined so that a hot line is split.
    frequent = stored(frequent_lines(profile, min_docs, max_share), "frequent-lines")
    removed = (
        lines.join(frequent, ["host", "hash"])
        .distinct()
        .groupBy(*KEY)
        .agg(F.sum("words").cast("bigint").alias("removed_words"), F.collect_list("hash").alias("removed"))
    )
    p, r = profile.drop("lines").alias("p"), removed.alias("r")
    same = [F.col(f"p.{name}").eqNullSafe(F.col(f"r.{name}")) for name in KEY]
    joined = p.join(r, same, "left").select(
        "p.*",
        F.coalesce("r.removed_words", F.lit(0).cast("bigint")).alias("removed_words"),
        F.coalesce("r.removed", F.array().cast("array<bigint>")).alias("removed"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = (F.col("n_words") - F.col("removed_words")) < F.lit(min_left) * F.col("n_words")
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The kept rows of `docs` in all their columns, without the removed lines."""
    docs, (doc_id, text, host), named = positioned(docs, doc_id, text, host)
    profile = profiles(docs, doc_id, text, host)
    kept = judge(profile, **limits).filter("kept").select(*KEY, "removed").distinct()
    return named(drop_lines(docs, kept, doc_id, text, host))
