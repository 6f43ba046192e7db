"""WARC archives as seekable Zstandard bundles.

Every page becomes a WARC/1.1 record. Records are written in frames: a frame is a group of whole
records, about FRAME_BYTES long, compressed by itself. A bundle is a file of frames that ends with
the seek table of the Zstandard seekable format (a skippable frame with the sizes of each frame,
compressed and not), so that any decoder reads the bundle from front to back and a reader with the
footer reads one frame. The index maps the identifier of each record to its bundle, frame, and
offset and length within the frame.

Of pages with equal payloads of at least `revisit_bytes`, the one with the largest page id
is a response record and the others are revisits (profile identical-payload-digest): they keep the
HTTP head, whose Content-Length is that of the full payload, the payload's digest, and the
response's identifier. Which page that is follows from the digests alone; payloads are moved once,
to meet the choice, and a digest that very many pages share is split by adaptive execution.

Tasks write bundles through pyarrow's file systems into the shared folder, each attempt under
a name of its own. The index is what Spark commits: bundles that it doesn't name are leftovers of
lost attempts and are never read. Neither writer nor reader holds more than a frame, or one
record if that is longer.

Defined cases: a null payload is empty, a null url is no url; urls are kept in URI form, other signs
escaped. A null page id is smaller than any other; a record without one says so by its missing header. Rows
that share the largest page id of their payload are all responses; they have one identifier. Columns that
the operator doesn't name are ignored. An empty table gives an empty index and no bundle.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm.common import small_batches, stored
from cohortmill.session import scratch

REVISIT_BYTES = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 3
# The seekable format's skippable frame and footer, the dates and names of records.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
URI_SIGNS = "!#$%&'()*+,/:;=?@[]~"

INDEX = "record_id string, bundle string, frame int, offset bigint, length bigint"
FRAMES = "bundle string, frame int, at bigint, stored bigint, size bigint"
HEADS = (
    "record_id string, page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string"
)
RECORDS = f"{HEADS}, payload binary"


def _names(schema: str) -> list[str]:
    return [field.split(" ")[0] for field in schema.split(", ")]


def place_of(url: str):
    """A file system and the path on it, of a URL or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(url)


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{digest}"


def encode_record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to=None, revisit=False) -> bytes:
    """The bytes of one record; a revisit has no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if revisit else http + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_id(page_id, digest)}>",
        f"WARC-Date: {DATE}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        # The URI form: signs that no URI has, line ends among them, are escaped.
        head.append(f"WARC-Target-URI: {quote(url, safe=URI_SIGNS)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def _page_of(identifier: str) -> int | None:
    number = identifier.strip("<>").split(":")[2]
    return int(number) if number else None


def decode_records(data: bytes) -> Iterator[tuple]:
    """The records of a frame, as (offset, length, the columns of RECORDS)."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        fields = _fields(data[at:end])
        start = end + 4
        stop = start + int(fields["Content-Length"])
        body = data.index(b"\r\n\r\n", start, stop) + 4
        http = _fields(data[start : body - 4])
        revisit = fields["WARC-Type"] == "revisit"
        payload = None if revisit else data[body:stop]
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if payload is not None:
            found = hashlib.sha1(payload).hexdigest()
            if found != digest or len(payload) != int(http["Content-Length"]):
                raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what its head says")
        page, url = fields.get("X-Page-ID"), fields.get("WARC-Target-URI")
        yield (
            at, stop + 4 - at, fields["WARC-Record-ID"].strip("<>"), None if page is None else int(page),
            url, fields["WARC-Type"],
            _page_of(fields["WARC-Refers-To"]) if revisit else None, int(http["Content-Length"]), digest, payload,
        )
        at = stop + 4


class BundleWriter:
    """A bundle that is being written: whole records into frames, the seek table at the end."""

    def __init__(self, out):
        self.out, self.buffer, self.frames, self.written = out, io.BytesIO(), [], 0
        self.press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, record: bytes) -> tuple[int, int]:
        """The frame of the record and its offset in there."""
        if self.buffer.tell() and self.buffer.tell() + len(record) > FRAME_BYTES:
            self.flush()
        place = len(self.frames), self.buffer.tell()
        self.buffer.write(record)
        return place

    def flush(self) -> None:
        data = self.buffer.getvalue()
        if data:
            frame = self.press.compress(data)
            self.out.write(frame)
            self.written += len(frame)
            self.frames.append((len(frame), len(data)))
            self.buffer = io.BytesIO()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.out.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """(place, size in the file, size) of each frame of an open bundle, from its footer."""
    size = source.size()
    source.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("a bundle without a seek table")
    source.seek(size - 9 - 8 * count)
    entries = struct.iter_unpack("<II", source.read(8 * count))
    at, frames = 0, []
    for packed, length in entries:
        frames.append((at, packed, length))
        at += packed
    return frames


def read_frame(source, at: int, packed: int, size: int) -> bytes:
    source.seek(at)
    return zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=size)


def chosen(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
) -> DataFrame:
    """(page_id, url, payload, digest, size, refers_to, revisit); a revisit's payload is null."""
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("size", F.octet_length("payload").cast("bigint"))
    large = F.col("size") >= revisit_bytes
    # Strong enough to stand for the bytes; the record itself shows SHA-1. Smaller
    # payloads are alone, with keys that spread them.
    own = F.when(large, F.sha2("payload", 256)).otherwise(F.xxhash64("page_id", "url").cast("string"))
    same = (
        rows.filter(large)
        .select("page_id", own.alias("same"))
        .groupBy("same")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    met = rows.withColumn("same", own).join(same, "same", "left")
    # No group, or the largest id of the group (all null counts as equal).
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return met.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.sha1("payload").alias("digest"),
        "size",
        F.when(revisit, F.col("refers_to")).alias("refers_to"),
        revisit.alias("revisit"),
    )


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = place_of(folder)
        bundle = name = None
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = []
            columns = (batch[c] for c in ("page_id", "url", "payload", "digest", "size", "refers_to", "revisit"))
            for row in zip(*columns):
                page, url, payload, digest, size, refers_to, revisit = (value.as_py() for value in row)
                record = encode_record(page, url, payload, digest, size, refers_to, revisit)
                if bundle is None:
                    # The name of an attempt is its own: a lost one leaves a file that no index names.
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    bundle = BundleWriter(files.open_output_stream(f"{base}/{name}", compression=None))
                frame, offset = bundle.add(record)
                rows.append((record_id(page, digest), f"{folder}/{name}", frame, offset, len(record)))
                if bundle.written >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_names(INDEX))
        if bundle is not None:
            bundle.close()

    return run


def write(pages: DataFrame, folder: str, **options) -> DataFrame:
    """Write the pages as bundles into `folder`, which exists; the stored index of their records.

    The folder must be one that all executors reach: a path, or a URL that pyarrow knows.
    """
    small_batches(pages.sparkSession)
    return stored(chosen(pages, **options).mapInArrow(_writer(folder), INDEX), "warc-index")


def new_folder(spark: SparkSession, name: str = "warc") -> str:
    """A new folder below the shared one, made for bundles."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch(spark, name))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return path.toString()


def frames(index: DataFrame) -> DataFrame:
    """The frames of all bundles that the index names, from their seek tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch["bundle"].to_pylist():
                files, path = place_of(bundle)
                with files.open_input_file(path) as source:
                    table = seek_table(source)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bundle] * len(table)), pa.array(range(len(table)), pa.int32())]
                    + [pa.array([f[i] for f in table], pa.int64()) for i in range(3)],
                    names=_names(FRAMES),
                )

    return index.select("bundle").distinct().mapInArrow(run, FRAMES)


def _reader(wanted: bool, schema: str):
    """Decode frames; with `wanted`, only the records at the offsets that come along."""
    names = _names(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            columns = batch.to_pydict()
            for i, (bundle, at, packed, size) in enumerate(zip(*(columns[c] for c in ("bundle", "at", "stored", "size")))):
                files, path = place_of(bundle)
                with files.open_input_file(path) as source:
                    data = read_frame(source, at, packed, size)
                if wanted:
                    places = columns["places"][i]
                    rows = [next(decode_records(data[p["offset"] : p["offset"] + p["length"]])) for p in places]
                else:
                    rows = list(decode_records(data))
                found = list(zip(*rows))[2 : 2 + len(names)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], names=names)

    return run


def read(index: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the bundles that the index names, frame by frame, payloads checked."""
    schema = RECORDS if payloads else HEADS
    # A frame is the unit of work: its row is small, its records are not.
    spread = frames(index).repartition(F.xxhash64("bundle", "frame"))
    return spread.mapInArrow(_reader(False, schema), schema)


def lookup(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records whose `record_id` is in `ids`; only their frames are read, each once."""
    asked = index.join(ids.select("record_id").distinct(), "record_id")
    places = F.collect_list(F.struct("offset", "length")).alias("places")
    by_frame = asked.groupBy("bundle", "frame").agg(places)
    return frames(asked).join(by_frame, ["bundle", "frame"]).mapInArrow(_reader(True, RECORDS), RECORDS)
