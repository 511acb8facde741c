"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a skippable frame at the end of a bundle is the seek table of the public seekable
format (compressed and decompressed size of each frame). An index maps record identifiers to (frame, offset inside the decompressed
frame, length), so one record is read by decompressing one frame. Bundles are rows of a table: Spark's writers and readers reach any
store, and a lost executor repeats only its own bundles.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, prepare, spread_join

SKIPPABLE_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1  # fixed values of the seekable format
FRAME_BYTES, BUNDLE_BYTES = 128 << 10, 4 << 20
MIN_REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"  # archives are reproducible; a crawl passes its own
BUNDLES = "bundle_id string, data binary, index array<struct<record_id:string,page_id:bigint,frame:int,offset:bigint,length:bigint>>"
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, record_id string, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{page_id}/{digest}'.encode()).digest()[:16], version=5)}"


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str = DATE) -> tuple[str, bytes]:
    """(record id, bytes) of a response with an HTTP block or of a revisit without body. Line ends and other controls in a URL are percent-encoded."""
    rid = record_id(page_id, digest)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{rid}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        head.insert(4, "WARC-Target-URI: " + "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head += [f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"Refers-To-Page-Id: {refers_to}"]
    return rid, "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each WARC record in data."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        start = end + 4
        stop = start + int(head["Content-Length"])
        yield head, data[start:stop]
        at = stop + 4


def seal(frames: Iterable[tuple[bytes, int]]) -> bytes:
    """A bundle: the frames and the footer with their sizes."""
    frames = list(frames)
    table = b"".join(struct.pack("<II", len(f), n) for f, n in frames) + struct.pack("<IBI", len(frames), 0, SEEK_MAGIC)
    return b"".join(f for f, _ in frames) + struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of each frame, from the footer alone."""
    n, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    out, at, base = [], 0, len(bundle) - 9 - 8 * n
    for i in range(n):
        size, raw = struct.unpack_from("<II", bundle, base + 8 * i)
        out.append((at, size, raw))
        at += size
    return out


def read_frame(bundle: bytes, frame: tuple[int, int, int]) -> bytes:
    start, size, raw = frame
    return zstandard.ZstdDecompressor().decompress(bundle[start : start + size], max_output_size=raw)


def read_at(bundle: bytes, frame: int, offset: int, length: int) -> bytes:
    """One record by its index entry; only its frame is decompressed."""
    return read_frame(bundle, seek_table(bundle)[frame])[offset : offset + length]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, serial = TaskContext.get().partitionId(), 0
    press = zstandard.ZstdCompressor(level=3)
    frames, index, frame, total = [], [], bytearray(), 0

    def close_frame() -> None:
        nonlocal frame
        if frame:
            frames.append((press.compress(bytes(frame)), len(frame)))
            frame = bytearray()

    def bundle() -> pa.RecordBatch:
        nonlocal frames, index, total, serial
        close_frame()
        row = {"bundle_id": [f"{part:06d}-{serial:06d}"], "data": [seal(frames)], "index": [index]}
        frames, index, total, serial = [], [], 0, serial + 1
        kind = pa.list_(pa.struct([("record_id", pa.string()), ("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array(row["bundle_id"]), pa.array(row["data"], pa.binary()), pa.array(row["index"], kind)], names=["bundle_id", "data", "index"])

    for batch in batches:
        cols = [batch.column(i) for i in range(batch.num_columns)]
        for i in range(batch.num_rows):
            page_id, url, payload, digest, refers_to, revisit = (c[i].as_py() for c in cols)
            rid, record = build_record(page_id, url, payload, digest, refers_to, revisit)
            index.append({"record_id": rid, "page_id": page_id, "frame": len(frames), "offset": len(frame), "length": len(record)})
            frame += record
            total += len(record)
            if len(frame) >= FRAME_BYTES:
                close_frame()
            if total >= BUNDLE_BYTES:
                yield bundle()
    if index:
        yield bundle()


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every record at the place that the index names, frame by frame."""
    names = [x.split(" ")[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    for batch in batches:
        for bundle, index in zip(batch.column(0), batch.column(1), strict=True):
            data, places = bundle.as_py(), index.as_py()
            table = seek_table(data)
            for number, group in groupby(places, key=itemgetter("frame")):
                frame, rows = read_frame(data, table[number]), []
                for place in group:
                    [(head, block)] = parse_records(frame[place["offset"] : place["offset"] + place["length"]])
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    revisit = head["WARC-Type"] == "revisit"
                    stated = base64.b32decode(head["WARC-Payload-Digest"][5:]).hex()
                    if head["WARC-Record-ID"][1:-1] != place["record_id"]:
                        raise ValueError(f"{place['record_id']}: another record stands at its place")
                    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != stated):
                        raise ValueError(f"{head['WARC-Record-ID']}: the payload is not the one that was written")
                    number_of = lambda k: int(head[k]) if k in head else None
                    rows.append((number_of("Page-Id"), size, stated, head["WARC-Type"], number_of("Refers-To-Page-Id"), head.get("WARC-Target-URI"), head["WARC-Record-ID"][1:-1], None if revisit else payload))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def plan_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to, revisit: of equal payloads of min_bytes or more that with the largest id is the response.

    Null body: empty payload. Rows that repeat the largest id are all responses. Ids sort before null; a group without any id is all responses."""
    body = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8").alias("payload"))
    body, large = body.withColumn("digest", F.sha1("payload")), F.length("payload") >= min_bytes
    keeper = body.where(large).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = spread_join(body.where(large), keeper, "digest", "page_id").unionByName(body.where(~large).withColumn("keeper", F.lit(None).cast("long")))
    revisit = F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("keeper")).alias("refers_to"), revisit.alias("revisit"))


def write_bundles(planned: DataFrame) -> DataFrame:
    """Write the planned records as bundles to a table in the shared folder and return it: bundle_id, data, index."""
    prepare(planned.sparkSession)
    return materialise(planned.mapInArrow(_pack, BUNDLES), "warc-bundles")


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles: ids, payload length and digest, type, reference, url, payload (null for revisits). Response payloads are
    checked against their digest."""
    prepare(bundles.sparkSession)
    return bundles.select("data", F.expr("transform(index, x -> named_struct('record_id', x.record_id, 'frame', x.frame, 'offset', x.offset, 'length', x.length))").alias("places")).mapInArrow(_unpack, RECORDS)


def record_index(bundles: DataFrame) -> DataFrame:
    """record_id, page_id -> bundle_id, frame, offset, length."""
    return bundles.select("bundle_id", F.explode("index").alias("i")).select("i.*", "bundle_id")


def read_records(bundles: DataFrame, wanted: DataFrame) -> DataFrame:
    """record_id, record (its bytes) of the wanted record ids (column record_id), through the index: only the frames that hold them are decompressed.

    Ids that no bundle has are left out, repeated ones are read once; null ids are none."""
    prepare(bundles.sparkSession)
    entries = record_index(bundles).join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    places = entries.groupBy("bundle_id").agg(F.collect_list(F.struct("record_id", "frame", "offset", "length")).alias("places"))  # as many as a bundle holds at most
    return bundles.select("bundle_id", "data").join(places, "bundle_id").select("data", "places").mapInArrow(_seek, "record_id string, record binary")


def _seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, places in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            bundle, frames, held = data.as_py(), {}, []
            table = seek_table(bundle)
            for place in places:
                frame = place["frame"]
                if frame not in frames:
                    frames[frame] = read_frame(bundle, table[frame])
                held.append((place["record_id"], frames[frame][place["offset"] : place["offset"] + place["length"]]))
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in held], pa.string()), pa.array([r for _, r in held], pa.binary())], names=["record_id", "record"])
