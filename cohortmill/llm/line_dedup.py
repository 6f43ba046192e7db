"""Line deduplication by site-relative frequency.

For each host the share of its pages that contain a line is the pages with the line
over all pages of the host. A line above `max_ratio`, on at least `min_pages`
pages, is boilerplate of that site and is dropped wherever the site repeats it. Lines
are compared in normal form (A-Z lowered, words joined by one space).

Defined cases: each row is a page, repeated rows too. A null host is the host without
a name, a null text has no lines and stays null. Lines without a word stay. A page
may be left empty; no row is dropped. A share equal to the ratio is not above it.
Extra columns are passed through, whatever their names. An empty table gives none.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.common import mapped, positioned, stored, texts
from cohortmill.llm.lines import drop_lines, line_hashes, text_lines

MAX_RATIO = 0.08
# The least on which a line repeats; a host of one page has no boilerplate.
MIN_PAGES = 2
PAGES = "doc_id bigint, host string, n_lines bigint, hashes array<bigint>"


def _pages(batch: pa.RecordBatch) -> dict:
    counts, hashes = [], []
    for text in texts(batch["text"]).cast(pa.large_binary()).to_pylist():
        lines = text_lines(text)
        counts.append(len(lines))
        hashes.append(list(line_hashes(lines)))
    return {
        "doc_id": batch["doc_id"],
        "host": batch["host"],
        "n_lines": pa.array(counts, pa.int64()),
        "hashes": pa.array(hashes, pa.list_(pa.int64())),
    }


def pages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Line hashes of each page, stored; each hash once."""
    needed = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        F.coalesce(F.col(host), F.lit("")).alias("host"),
    )
    return stored(mapped(needed, _pages, PAGES), "page-lines")


def boilerplate(seen: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, hash, n_pages, host_pages) of the lines above the ratio.

    Hashes are different within a page, so pages are counted on the map side
    and a line on every page of a host sends one row per task.
    """
    totals = seen.groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = (
        seen.select("host", F.explode("hashes").alias("hash"))
        .groupBy("host", "hash")
        .agg(F.count("*").alias("n_pages"))
        .filter(F.col("n_pages") >= min_pages)
    )
    return counts.join(totals, "host").filter(F.col("n_pages") > F.lit(max_ratio) * F.col("host_pages"))


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """`docs` without the boilerplate lines of their hosts."""
    docs, (doc_id, text, host), named = positioned(docs, doc_id, text, host)
    seen = pages(docs, doc_id, text, host)
    lines = seen.select("doc_id", "host", F.explode("hashes").alias("hash"))
    # A table of its own: broadcast if Spark finds it small, else joined so that a hot line is split.
    often = stored(boilerplate(seen, max_ratio, min_pages).select("host", "hash"), "boilerplate")
    removed = (
        lines.join(often, ["host", "hash"])
        .groupBy("doc_id", "host")
        .agg(F.collect_set("hash").alias("removed"))
    )
    return named(drop_lines(docs, removed, doc_id, text, host, how="left"))
