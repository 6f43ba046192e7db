"""Lines of a text by the hash of their normal form, and texts without some of them."""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmill.llm.common import free_name, signed, small_batches


def text_lines(text: bytes) -> list[bytes]:
    """The \\n-split lines that have a word."""
    return [line for line in text.split(b"\n") if line.strip()]


def line_key(line: bytes) -> int:
    """Hash of a line's normal form: A-Z lowered, words joined by one space."""
    return signed(xxhash.xxh64_intdigest(b" ".join(line.lower().split())))


def line_hashes(lines: list[bytes]) -> dict[int, int]:
    """Words by line hash; a line that is repeated adds its words each time."""
    found: dict[int, int] = {}
    for line in lines:
        key = line_key(line)
        found[key] = found.get(key, 0) + len(line.split())
    return found


def drop_lines(
    docs: DataFrame, verdict: DataFrame, doc_id: str, text: str, host: str, how: str = "inner"
) -> DataFrame:
    """`docs` in all their columns, without the lines whose hash is in `verdict.removed`.

    `verdict` has (doc_id, host, removed), and text_key where rows of one id may
    differ in their verdict. It is the small side and is hashed, so no text is sorted.
    """
    small_batches(docs.sparkSession)
    by_text = "text_key" in verdict.columns
    keys = {k: free_name(f"__{k}", docs) for k in ("doc_id", "host", "removed", *["text_key"] * by_text)}
    v = verdict.select(*[F.col(k).alias(name) for k, name in keys.items()]).hint("shuffle_hash")
    same = docs[doc_id].cast("bigint").eqNullSafe(F.col(keys["doc_id"]))
    same &= F.coalesce(docs[host], F.lit("")) == F.col(keys["host"])
    if by_text:
        same &= _text_key(docs[text]) == F.col(keys["text_key"])
    columns, at = docs.columns, docs.columns.index(text)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    joined = docs.join(v, same, how).select(*[docs[c] for c in columns], keys["removed"])

    def run(batches):
        for batch in batches:
            gone = batch.column(len(columns)).to_pylist()
            out = [_without(value, set(g)) if g else value for value, g in zip(batch.column(at).to_pylist(), gone)]
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[at] = pa.array(out, arrays[at].type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return joined.mapInArrow(run, schema)


def _text_key(text):
    """xxh64 of the text with seed 42, as Spark's own function gives it."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _without(text: str | None, gone: set[int]) -> str | None:
    if text is None:
        return None
    left = [line for line in text.encode().split(b"\n") if not line.strip() or line_key(line) not in gone]
    return b"\n".join(left).decode()
