"""Helpers the operators share: tables, stored steps, words of a text column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.session import scratch

# Bytes of text that a task works on at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` by way of a table in the shared folder: computed once, safe from lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python, where the session has Spark's default.

    A task holds some of them at a time, in the JVM and in Python, so their size is
    most of what texts take of an executor's memory.
    """
    name, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if spark.conf.get(name, default) == default:
        spark.conf.set(name, "16m")


def mapped(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | dict | None],
    schema: str,
    slice_bytes: int | None = None,
) -> DataFrame:
    """`work` on the Arrow batches of `df`, cut so that one call holds few texts.

    `work` returns a dict of columns in the order of `schema`. All columns of `df`
    are sent, so select before the call.
    """
    small_batches(df.sparkSession)
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, slice_bytes or SLICE_BYTES):
                out = work(piece)
                yield pa.RecordBatch.from_arrays([out[name] for name in names], names=names)
            # A worker lives on between tasks; what it doesn't use any more goes back.
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, slice_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    if not batch.num_rows:
        return
    lengths = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            lengths += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // slice_bytes
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:]):
        yield batch.slice(start, end - start)


def texts(column: pa.Array) -> pa.Array:
    """The column with null as the empty text, in a layout without an offset limit."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def split_words(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words `[^\\x20\\x09-\\x0D]+` of all texts in one array, and where each text's words begin."""
    lists = pc.ascii_split_whitespace(column)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return kept[offsets - offsets[0]], flat.filter(full)


def code_words(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A code for each word and the words by code."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def signed(value: int) -> int:
    """An unsigned 64-bit value as Spark's bigint."""
    return value - (1 << 64) if value >> 63 else value


def free_name(name: str, df: DataFrame) -> str:
    """`name`, made longer until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def positioned(docs: DataFrame, *used: str) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """`docs` with columns named by position, the new names of `used`, and how to get the old names back.

    So a column may have any name: one with a dot, or one that an operator gives to a column of its own.
    """
    names = docs.columns
    plain = [f"c{i}" for i in range(len(names))]
    return docs.toDF(*plain), [plain[names.index(name)] for name in used], lambda df: df.toDF(*names)


def sampled(df: DataFrame, size: int, key: str) -> DataFrame:
    """About `size` of the rows of `df`, by a hash of `key`; all if there are no more.

    The rows are counted and the hash's bound follows from the count, so no task and
    no driver sees more than its share of the sample.
    """
    n = df.count()
    if n <= size:
        return df
    buckets = 1 << 30
    return df.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(buckets)) < int(buckets * size / n))


def sha256_of(column) -> F.Column:
    return F.sha2(F.coalesce(column, F.lit("")).cast("binary"), 256)
