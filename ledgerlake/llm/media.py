"""Media columns: AVI files with motion-JPEG frames held in a binary column.

Bytes are stored as 8-bit grey samples, one sample per flat 8x8 block of a baseline JPEG: with a DC quantiser of 8 the decoded pixels of block
k all equal byte k, so any JPEG decoder returns the payload. The Huffman table gives the DC difference of size s a code of 15 - s bits and the
end of block one bit; each block is then exactly 16 bits and never holds 0xFF, so a whole document is coded and decoded by table lookups.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jpeg
from .common import materialise, prepare, slices

SIDE = 32  # samples along each edge of a frame
FRAME = SIDE * SIDE
FPS = 25
BINS = 16
PAD = 64
MOST_BYTES = 900 << 20
SIZES = range(8, -1, -1)  # sizes of a DC difference, in the order of their code lengths 7..15


def _words() -> np.ndarray:
    """16-bit word of each difference -255..255: canonical code of its size, its bits, then the one-bit end of block."""
    out, code = np.zeros(511, np.uint16), 0
    for size in SIZES:
        for d in [0] if size == 0 else [*range(-(1 << size) + 1, -(1 << (size - 1)) + 1), *range(1 << (size - 1), 1 << size)]:
            if -255 <= d <= 255:
                bits = d if d >= 0 else d + (1 << size) - 1
                out[d + 255] = ((code << size | bits) & 0x7FFF) << 1
        code = (code + 1) << 1
    return out


WORDS = _words()
DIFFS = np.full(1 << 16, -1000, np.int16)
DIFFS[WORDS] = np.arange(-255, 256)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _jpeg_head() -> bytes:
    dqt = bytes([0]) + bytes([8] + [1] * 63)
    edge = SIDE * 8
    sof = struct.pack(">BHHB", 8, edge, edge, 1) + bytes([1, 0x11, 0])
    dc = bytes([0x00]) + bytes([0] * 6 + [1] * 9 + [0]) + bytes(SIZES)
    ac = bytes([0x10]) + bytes([1] + [0] * 15) + bytes([0])
    return b"\xff\xd8" + _segment(0xDB, dqt) + _segment(0xC0, sof) + _segment(0xC4, dc + ac) + _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))


HEAD, TAIL = _jpeg_head(), b"\xff\xd9"


def encode_frames(payload: bytes) -> list[bytes]:
    """JPEG images of FRAME samples each; the last one is filled up with zero samples."""
    raw = np.frombuffer(payload, np.uint8)
    samples = np.zeros(-(-len(raw) // FRAME) * FRAME, np.int16)
    samples[: len(raw)] = raw
    rows = samples.reshape(-1, FRAME)
    diffs = np.diff(rows, axis=1, prepend=np.int16(128))
    words = WORDS[diffs + 255].astype(">u2")
    return [HEAD + w.tobytes() + TAIL for w in words]


def decode_frame(image: bytes) -> np.ndarray:
    """The samples of one image, one for each 8x8 block: of an image that encode_frames wrote by table, of any other by decoding it (the block's mean
    luminance; blocks at the edges are what is there of them)."""
    if image.startswith(HEAD) and image.endswith(TAIL):
        diffs = DIFFS[np.frombuffer(image, ">u2", FRAME, len(HEAD))]
        return np.cumsum(diffs, dtype=np.int16) + 128
    plane = jpeg.decode(image)[0].astype(np.float64)
    rows, columns = (np.arange(0, n, 8) for n in plane.shape)
    sums = np.add.reduceat(np.add.reduceat(plane, rows, axis=0), columns, axis=1)
    sizes = np.diff(np.append(rows, plane.shape[0]))[:, None] * np.diff(np.append(columns, plane.shape[1]))
    return np.rint(sums / sizes).astype(np.int16).reshape(-1)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def _list(kind: bytes, *parts: bytes) -> bytes:
    return _chunk(b"LIST", kind + b"".join(parts))


def write_avi(payload: bytes) -> bytes:
    """Of up to MOST_BYTES (twice as much media fits one cell of a table and RIFF's 32-bit sizes; more raises), a RIFF AVI: header lists, the payload's length in an INFO comment, one 00dc chunk a frame, an idx1 index."""
    if len(payload) > MOST_BYTES:
        raise ValueError(f"a payload of {len(payload)} bytes is over {MOST_BYTES}")
    frames, edge = encode_frames(payload), SIDE * 8
    largest = max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // FPS, largest * FPS, 0, 0x10, len(frames), 0, 1, largest, edge, edge, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIiI4H", 0, 0, 0, 0, 1, FPS, 0, len(frames), largest, -1, 0, 0, 0, edge, edge)
    strf = struct.pack("<IiiHH4sIiiII", 40, edge, edge, 1, 24, b"MJPG", edge * edge * 3, 0, 0, 0, 0)
    movi, index, at = [], [], 4
    for f in frames:
        movi.append(_chunk(b"00dc", f))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        at += len(movi[-1])
    body = _list(b"hdrl", _chunk(b"avih", avih), _list(b"strl", _chunk(b"strh", strh), _chunk(b"strf", strf)))
    body += _list(b"INFO", _chunk(b"ICMT", b"payload=%d\0" % len(payload))) + _list(b"movi", *movi) + _chunk(b"idx1", b"".join(index))
    return b"RIFF" + struct.pack("<I", len(body) + 4) + b"AVI " + body


def read_riff(avi: bytes) -> dict:
    """Frame rate, payload length and the frames as (start, size), from the headers and the idx1 index."""
    if avi[:4] != b"RIFF" or avi[8:12] != b"AVI ":
        raise ValueError("not a RIFF AVI file")
    out, at = {"payload": None, "us": 1_000_000 // FPS, "frames": []}, 12
    movi = 0
    while at + 8 <= len(avi):
        name, size = avi[at : at + 4], struct.unpack_from("<I", avi, at + 4)[0]
        kind = avi[at + 8 : at + 12]
        if name == b"LIST" and kind == b"hdrl":
            out["us"] = struct.unpack_from("<I", avi, at + 20)[0]
        elif name == b"LIST" and kind == b"INFO":
            out["payload"] = int(avi[at + 20 : at + 8 + size].rstrip(b"\0").partition(b"=")[2])
        elif name == b"LIST" and kind == b"movi":
            movi = at + 8
        elif name == b"idx1":
            for i in range(at + 8, at + 8 + size, 16):
                chunk, _, offset, length = struct.unpack_from("<4sIII", avi, i)
                if chunk[2:] in (b"dc", b"db"):
                    out["frames"].append((movi + offset + 8, length))
        at += 8 + size + (size & 1)
    return out


def read_avi(avi: bytes) -> tuple[bytes, np.ndarray, int]:
    """(payload, frames x samples, microseconds a frame). The payload of a file that names no length is all its samples."""
    riff = read_riff(avi)
    frames = np.stack([decode_frame(avi[a : a + n]) for a, n in riff["frames"]]) if riff["frames"] else np.zeros((0, FRAME), np.int16)
    samples = frames.astype(np.uint8)
    return samples.tobytes()[: riff["payload"]], samples, riff["us"]


def find_shots(frames: np.ndarray, window: int = 8, ratio: float = 2.0, least: float = 0.12) -> list[tuple[int, int]]:
    """[start, end) frames of each shot. A cut lies where the histogram difference to the frame before reaches `least` and `ratio` times
    the mean difference over the `window` frames around it."""
    n = len(frames)
    if n == 0:
        return []
    hist = np.bincount((np.arange(n)[:, None] * BINS + (frames >> 4)).reshape(-1), minlength=n * BINS).reshape(n, BINS)
    diff = np.abs(np.diff(hist, axis=0)).sum(axis=1) / (2 * frames.shape[1])
    cuts = []
    for i, d in enumerate(diff):
        near = np.concatenate([diff[max(0, i - window // 2) : i], diff[i + 1 : i + 1 + window // 2]])
        if d >= least and d >= ratio * (near.mean() if len(near) else 0):
            cuts.append(i + 1)
    return list(zip([0, *cuts], [*cuts, n], strict=True))


def pad(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + b"\0" * (-len(raw) % PAD if raw else PAD)


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        made = [pad(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([write_avi(p) for _, p in made], pa.binary())], names=["doc_id", "n_bytes", "media"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib
    import zlib

    for batch in slices(batches, "media", 8 << 20):
        rows = []
        for media in batch.column(2):
            media = media.as_py()
            payload, frames, us = read_avi(media)
            shots = find_shots(frames)
            clips = [{"clip": k, "start_ms": a * us // 1000, "end_ms": b * us // 1000, "frames": b - a} for k, (a, b) in enumerate(shots)]
            said = f"{len(frames)} frames;" + ",".join(f"{c['start_ms']}-{c['end_ms']}" for c in clips)
            rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-PAD:]), len(media), hashlib.sha256(media).hexdigest(), said, clips))
        clip = pa.list_(pa.struct([("clip", pa.int32()), ("start_ms", pa.int64()), ("end_ms", pa.int64()), ("frames", pa.int32())]))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), clip]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "clips"])


def store_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: every whole text as an AVI, in a table of the shared folder. Null text is empty; an empty text has one block
    of zeros. Ids may be null or repeat; other columns are ignored."""
    prepare(docs.sparkSession)
    stored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_store, "doc_id bigint, n_bytes bigint, media binary")
    return materialise(stored, "media")


def media_features(media: DataFrame) -> DataFrame:
    """One row per stored file with the payload's and the file's digests, a feature string (frames and shots) and the clips as an array."""
    prepare(media.sparkSession)
    clip = "clips array<struct<clip:int,start_ms:bigint,end_ms:bigint,frames:int>>"
    return media.mapInArrow(_features, f"doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, {clip}")


def clip_rows(features: DataFrame) -> DataFrame:
    """One row per clip: doc_id, clip, start_ms, end_ms, frames."""
    return features.select("doc_id", F.explode("clips").alias("c")).select("doc_id", "c.*")
