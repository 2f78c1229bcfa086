"""WARC in seekable Zstandard bundles.

A bundle file is a run of independent frames of whole records, a skippable frame that lists
where each record lies, and the seek table of the seekable Zstandard format as its last
frame. Readers without these notions can decompress a bundle as plain Zstandard; others read
the last bytes, look a record up and decompress one frame.

Writing: pages are read twice. The first pass keeps digests only, and the first page of each
payload comes from map-side minima; digests of one row need no lookup, the others are joined
with hot payloads salted (or broadcast while they measure small). The second pass builds
records and frames inside the tasks, with memory bounded by ``BUNDLE_BYTES`` or one record.
Bundles are written by Spark's own file writer, one row a file, so task retries and any
file system are its business: every bundle but its last three bytes is the row, and those
bytes, the end of the seek table's magic number, are the writer's line end.

Reading: every bundle is a row of ``binaryFile``; records come back frame by frame, and
``record_index`` and ``fetch`` use the tables alone.

Of records with equal payloads of at least ``least`` bytes, those of the smallest page id are
responses and the others revisit it. Null html is an empty payload. Null ids come last: they
revisit, or where no other row has the payload, are responses. Repeated rows of the smallest
id are all responses. Null urls leave the target URI out. An empty table writes no bundle
and reads back no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.tables import query, table
from listinglake.operators.skew import lookup_join
from listinglake.session import scratch_path, store

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 4 * 1024 * 1024
LEVEL = 3
#: Fixed values of the frame formats.
SKIPPABLE, INDEX_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1
SEEK_FOOTER = 9
#: The last three bytes of the little-endian seek magic, as the text writer's line end.
LINE_END = struct.pack("<I", SEEK_MAGIC)[1:].decode("utf-8")
DATE = "2000-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has no block, its payload's size is a header."""
    name = "null" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        payload = b""
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes, start: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at ``start``."""
    stop = data.index(b"\r\n\r\n", start)
    lines = data[start:stop].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {start}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = stop + 4
    end = block + int(headers["Content-Length"])
    return headers, data[block:end], end + 4


class Bundle:
    """Collects records into frames; ``close`` gives the bytes up to the line end."""

    def __init__(self) -> None:
        self.done: list[bytes] = []
        self.frames: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = self.bytes = 0
        self.places: list[str] = []

    def add(self, name: str, data: bytes) -> None:
        self.places.append(f"{len(self.frames)} {self.open_bytes} {len(data)} {name}")
        self.open.append(data)
        self.open_bytes += len(data)
        if self.open_bytes >= FRAME_BYTES:
            self._cut()

    def _cut(self) -> None:
        if self.open:
            frame = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(
                b"".join(self.open)
            )
            self.done.append(frame)
            self.frames.append((len(frame), self.open_bytes))
            self.bytes += len(frame)
            self.open, self.open_bytes = [], 0

    def close(self) -> bytes:
        self._cut()
        places = zstandard.ZstdCompressor(level=LEVEL).compress("\n".join(self.places).encode())
        self.done.append(struct.pack("<II", INDEX_MAGIC, len(places)) + places)
        # The record list is a frame of the table too, of no decompressed bytes.
        frames = [*self.frames, (len(self.done[-1]), 0)]
        entries = b"".join(struct.pack("<II", *frame) for frame in frames)
        footer = struct.pack("<IBI", len(frames), 0, SEEK_MAGIC)
        table_frame = struct.pack("<II", SKIPPABLE, len(entries) + SEEK_FOOTER) + entries + footer
        return b"".join([*self.done, table_frame])[:-3]


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed, decompressed) of each frame, from the footer alone."""
    count, _, magic = struct.unpack("<IBI", data[-SEEK_FOOTER:])
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    entries = data[-SEEK_FOOTER - 8 * count : -SEEK_FOOTER]
    found, offset = [], 0
    for number in range(count):
        size, plain = struct.unpack_from("<II", entries, 8 * number)
        found.append((offset, size, plain))
        offset += size
    return found


def places(data: bytes) -> list[tuple[str, int, int, int]]:
    """(record name, frame, offset within it, length) from the bundle's record list."""
    offset, size, _ = seek_table(data)[-1]
    magic, length = struct.unpack_from("<II", data, offset)
    if magic != INDEX_MAGIC or length + 8 != size:
        raise ValueError("no record list")
    listed = zstandard.ZstdDecompressor().decompress(data[offset + 8 : offset + size]).decode()
    found = []
    for line in listed.split("\n") if listed else ():
        frame, start, size, name = line.split(" ", 3)
        found.append((name, int(frame), int(start), int(size)))
    return found


def frame_bytes(data: bytes, frame: tuple[int, int, int]) -> bytes:
    offset, size, _ = frame
    return zstandard.ZstdDecompressor().decompress(data[offset : offset + size])


def with_originals(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to, revisit): narrow digests decide, pages stay in place."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    known = pages.select(
        "page_id", "url", "html", F.sha1(html).alias("_sha1"), F.octet_length(html).alias("_bytes")
    )
    repeated = store(
        known.where(F.col("_bytes") >= least)
        .groupBy("_sha1", "_bytes")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1")
        .drop("_rows"),
        "repeated-payloads",
    )
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return lookup_join(known, repeated, ["_sha1", "_bytes"], "left").select(
        "page_id",
        "url",
        "html",
        F.when(revisit, F.col("_first")).alias("refers_to"),
        revisit.alias("revisit"),
    )


def _bundles(batches):
    bundle = Bundle()
    for batch in batches:
        columns = [batch.column(n) for n in ("page_id", "url", "html", "refers_to", "revisit")]
        for number in range(batch.num_rows):
            page_id, url, html, refers_to, revisit = (c[number].as_py() for c in columns)
            payload = (html or "").encode("utf-8", "surrogatepass")
            bundle.add(str(page_id), record(page_id, url, payload, refers_to, revisit))
            if bundle.bytes >= BUNDLE_BYTES:
                yield pa.RecordBatch.from_pydict({"bundle": [bundle.close()]})
                bundle = Bundle()
    if bundle.places:
        yield pa.RecordBatch.from_pydict({"bundle": [bundle.close()]})


def write_archive(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Write one record a row of ``pages`` (page_id, url, html) as bundles below ``folder``."""
    bundles = with_originals(pages, least).mapInArrow(_bundles, "bundle binary")
    (
        bundles.select(F.col("bundle").cast("string").alias("value"))
        .write.option("lineSep", LINE_END)
        .option("maxRecordsPerFile", 1)
        .text(folder)
    )


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).where("length > 0")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """(record, url, record_type, payload_digest, payload_bytes, refers_to, payload, ...).

    ``path``, ``frame``, ``offset`` and ``length`` tell where the record was.
    """

    def run(batches):
        for batch in batches:
            for number in range(batch.num_rows):
                path, data = batch.column("path")[number].as_py(), batch.column("content")[number].as_py()
                table_ = seek_table(data)
                listed = places(data)
                at = 0
                for spot, frame in enumerate(table_[:-1]):
                    plain = frame_bytes(data, frame)
                    rows = []
                    while at < len(listed) and listed[at][1] == spot:
                        name, _, start, size = listed[at]
                        headers, block, end = parse(plain, start)
                        if end != start + size:
                            raise ValueError(f"{path}: record {name} is not as listed")
                        refers = headers.get("WARC-Refers-To")
                        rows.append(
                            {
                                "record": name,
                                "url": headers.get("WARC-Target-URI"),
                                "record_type": headers["WARC-Type"],
                                "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                                "payload_bytes": int(headers["X-Payload-Length"]),
                                "refers_to": refers and refers[len("<urn:page:") : -1],
                                "payload": None if headers["WARC-Type"] == "revisit" else block,
                                "path": path,
                                "frame": spot,
                                "offset": start,
                                "length": size,
                            }
                        )
                        at += 1
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)

    return _files(spark, folder).select("path", "content").mapInArrow(
        run,
        "record string, url string, record_type string, payload_digest string,"
        " payload_bytes bigint, refers_to string, payload binary, path string, frame int,"
        " offset bigint, length bigint",
    )


_RECORDS = pa.schema(
    [
        ("record", pa.string()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("refers_to", pa.string()),
        ("payload", pa.binary()),
        ("path", pa.string()),
        ("frame", pa.int32()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)


def record_index(spark: SparkSession, folder: str) -> DataFrame:
    """(record, path, frame, offset, length) of all records, from the bundles' lists."""

    def run(batches):
        for batch in batches:
            for number in range(batch.num_rows):
                path = batch.column("path")[number].as_py()
                found = places(batch.column("content")[number].as_py())
                columns = list(zip(*found, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.string()),
                        pa.array([path] * len(found), pa.string()),
                        pa.array(columns[1], pa.int32()),
                        pa.array(columns[2], pa.int64()),
                        pa.array(columns[3], pa.int64()),
                    ],
                    names=["record", "path", "frame", "offset", "length"],
                )

    return _files(spark, folder).select("path", "content").mapInArrow(
        run, "record string, path string, frame int, offset bigint, length bigint"
    )


def fetch(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(record, data) of the rows of ``wanted`` (record, path, frame, offset, length).

    Only the bundles named are read and only the frames named are decompressed.
    """
    spots = wanted.groupBy("path").agg(
        F.sort_array(F.collect_set(F.struct("frame", "offset", "length", "record"))).alias("spots")
    )

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                table_, last, plain = seek_table(row["content"]), -1, b""
                for spot in row["spots"]:
                    if spot["frame"] != last:
                        last = spot["frame"]
                        plain = frame_bytes(row["content"], table_[last])
                    data = plain[spot["offset"] : spot["offset"] + spot["length"]]
                    yield pa.RecordBatch.from_pydict(
                        {"record": [spot["record"]], "data": pa.array([data], pa.binary())}
                    )

    return (
        _files(spark, folder)
        .select("path", "content")
        .join(spots, "path")
        .mapInArrow(run, "record string, data binary")
    )


def _base32(hex_digest: str) -> str:
    """DuckDB expression: base32 of a 40-digit hex string, five bits at a time."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    value = (
        f"('0x' || rpad(substr({hex_digest}, (5 * i // 4 + 1)::bigint, 2), 2, '0'))::integer"
    )
    letter = f"substr('{letters}', ((({value} >> (3 - 5 * i % 4)::integer) & 31) + 1)::bigint, 1)"
    return f"list_aggregate(list_transform(range(32), lambda i: {letter}), 'string_agg', '')"


_SQL = f"""
    with known as (
        select page_id, sha1(coalesce(html, '')) as digest,
            octet_length(encode(coalesce(html, ''))) as bytes from pages),
    firsts as (select *, min(page_id) over (partition by digest, bytes) as first from known)
    select page_id, bytes::bigint as payload_bytes, {_base32("digest")} as payload_digest,
        case when first is not null and page_id is distinct from first
            then 'revisit' else 'response' end as record_type,
        case when page_id is distinct from first then first end as refers_to
    from firsts
"""


@query("op5_warc", _SQL)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "archive")
    write_archive(pages, folder)
    kind = pages.schema["page_id"].dataType.simpleString()
    return read_archive(spark, folder).select(
        F.when(F.col("record") != "None", F.col("record")).cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
