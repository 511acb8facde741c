"""Decoding of single sequential JPEG images (baseline Huffman coding, 8 bits a sample), as motion-JPEG streams hold them.

Entropy decoding walks the codes one after the other; dequantisation and the inverse cosine transform run over all blocks at once. Streams that leave
their Huffman tables out use the standard's.
"""

from __future__ import annotations

import struct

import numpy as np

# The zigzag order, and the standard's Huffman tables (codes of each length 1 to 16, then the symbols). Symbols of AC tables that are not
# spelled out follow in ascending order.
ZIGZAG = np.array(
    [0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28, 35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63]
)
STANDARD = {
    (0, 0): ("00 01 05 01 01 01 01 01 01 00 00 00 00 00 00 00", "00 01 02 03 04 05 06 07 08 09 0a 0b"),
    (0, 1): ("00 03 01 01 01 01 01 01 01 01 01 00 00 00 00 00", "00 01 02 03 04 05 06 07 08 09 0a 0b"),
    (1, 0): ("00 02 01 03 03 02 04 03 05 05 04 04 00 00 01 7d", "01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 23 42 b1 c1 15 52 d1 f0 24 33 62 72 82"),
    (1, 1): ("00 02 01 02 04 04 03 04 07 05 04 04 00 01 02 77", "00 01 02 03 11 04 05 21 31 06 12 41 51 07 61 71 13 22 32 81 08 14 42 91 a1 b1 c1 09 23 33 52 f0 15 62 72 d1 0a 16 24 34 e1 25 f1"),
}

_K = np.arange(8)
_COSINES = np.cos((2 * _K[None, :] + 1) * _K[:, None] * np.pi / 16) * np.where(_K == 0, np.sqrt(1 / 8), 0.5)[:, None]


def _code_table(counts: bytes, symbols: bytes) -> list[int]:
    """For each 16 bits that may come next: length of the code << 8 | symbol; 0 where no code fits."""
    out, code, at = [0] * (1 << 16), 0, 0
    for length, n in enumerate(counts, 1):
        for symbol in symbols[at : at + n]:
            first = code << (16 - length)
            out[first : first + (1 << (16 - length))] = [length << 8 | symbol] * (1 << (16 - length))
            code += 1
        at += n
        code <<= 1
    return out


def _standard(kind: int, number: int) -> list[int]:
    counts, said = (bytes.fromhex(x) for x in STANDARD[kind, min(number, 1)])
    rest = bytes(run << 4 | size for run in range(16) for size in range(1, 11) if run << 4 | size not in said) if kind else b""
    return _code_table(counts, said + rest)


class _Bits:
    """Bits of one stretch of entropy-coded data, stuffing removed."""

    def __init__(self, data: bytes):
        self.data, self.at = data.replace(b"\xff\x00", b"\xff") + b"\xff\xff\xff\xff", 0

    def peek(self) -> int:
        i = self.at >> 3
        return (int.from_bytes(self.data[i : i + 3], "big") >> (8 - (self.at & 7))) & 0xFFFF

    def symbol(self, table: list[int]) -> int:
        found = table[self.peek()]
        if not found or self.at >= 8 * (len(self.data) - 4):
            raise ValueError("broken entropy-coded data")
        self.at += found >> 8
        return found & 0xFF

    def value(self, size: int) -> int:
        """A signed value of that many bits."""
        if not size:
            return 0
        said = self.peek() >> (16 - size)
        self.at += size
        return said if said >> (size - 1) else said - (1 << size) + 1


def _stretches(data: bytes, at: int) -> tuple[list[bytes], int]:
    """(entropy-coded data between restart markers, where it ends)."""
    out, start = [], at
    while True:
        at = data.index(b"\xff", at)
        mark = data[at + 1 : at + 2]
        if mark == b"\x00":
            at += 2
        elif mark and 0xD0 <= mark[0] <= 0xD7:
            out.append(data[start:at])
            at = start = at + 2
        else:
            return [*out, data[start:at]], at


def decode(data: bytes) -> list[np.ndarray]:
    """The planes of an image (luminance first), each at its own resolution, as uint8."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG image")
    quant: dict[int, np.ndarray] = {}
    codes: dict[tuple[int, int], list[int]] = {}
    frame, every, at = None, 0, 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            raise ValueError("a marker is missing")
        mark, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if mark == 0xDB:
            while body:
                wide, number = body[0] >> 4, body[0] & 15
                n = 64 << bool(wide)
                quant[number] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else "u1").astype(np.int64)
                body = body[1 + n :]
        elif mark == 0xC4:
            while body:
                n = sum(body[1:17])
                codes[body[0] >> 4, body[0] & 15] = _code_table(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif mark in (0xC0, 0xC1):
            bits, height, width, n = struct.unpack_from(">BHHB", body)
            if bits != 8:
                raise ValueError("only 8 bits a sample are decoded")
            frame = (height, width, [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)])
        elif 0xC2 <= mark <= 0xCF and mark != 0xC8 and mark != 0xCC:
            raise ValueError("only sequential Huffman coding is decoded")
        elif mark == 0xDD:
            every = struct.unpack(">H", body)[0]
        elif mark == 0xDA:
            if frame is None:
                raise ValueError("a scan without a frame")
            chosen = {body[1 + 2 * k]: (body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])}
            if len(chosen) != len(frame[2]):
                raise ValueError("only images of one scan are decoded")
            return _scan(_stretches(data, at)[0], frame, chosen, quant, codes, every)
    raise ValueError("no scan")


def _scan(parts: list[bytes], frame, chosen, quant, codes, every: int) -> list[np.ndarray]:
    height, width, components = frame
    most_h, most_v = max(c[1] for c in components), max(c[2] for c in components)
    if len(components) == 1:
        components, most_h, most_v = [(components[0][0], 1, 1, components[0][3])], 1, 1
    across, down = -(-width // (8 * most_h)), -(-height // (8 * most_v))
    grids = [np.zeros((down * v, across * h, 64), np.int64) for _, h, v, _ in components]
    tables = [tuple(codes.get((kind, chosen[c[0]][kind])) or _standard(kind, chosen[c[0]][kind]) for kind in (0, 1)) for c in components]
    order = ZIGZAG.tolist()
    last, part, bits = [0] * len(components), 0, _Bits(parts[0])
    for unit in range(across * down):
        if every and unit and unit % every == 0:
            last, part = [0] * len(components), part + 1
            bits = _Bits(parts[part])
        y, x = divmod(unit, across)
        for k, (_, h, v, _) in enumerate(components):
            dc, ac = tables[k]
            for dy in range(v):
                for dx in range(h):
                    block = grids[k][y * v + dy, x * h + dx]
                    last[k] += bits.value(bits.symbol(dc))
                    block[0] = last[k]
                    place = 1
                    while place < 64:
                        said = bits.symbol(ac)
                        run, size = said >> 4, said & 15
                        if not size:
                            if run < 15:
                                break
                            place += 16
                            continue
                        place += run
                        if place > 63:
                            raise ValueError("broken entropy-coded data")
                        block[order[place]] = bits.value(size)
                        place += 1
    out = []
    for grid, (_, h, v, q) in zip(grids, components, strict=True):
        steps = np.zeros(64, np.int64)
        steps[ZIGZAG] = quant[q]
        pixels = _COSINES.T @ (grid * steps).reshape(*grid.shape[:2], 8, 8) @ _COSINES + 128
        plane = np.clip(np.rint(pixels), 0, 255).astype(np.uint8).transpose(0, 2, 1, 3).reshape(8 * grid.shape[0], 8 * grid.shape[1])
        out.append(plane[: -(-height * v // most_v), : -(-width * h // most_h)])
    return out
