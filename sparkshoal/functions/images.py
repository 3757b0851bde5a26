"""Uncompressed access to PNG and BMP files in NumPy, for tasks that have no imaging library.

PNG with 8 bits a channel (grey, grey with alpha, RGB, RGBA, palette), not
interlaced, and BMP with 8, 24 or 32 bits, not compressed, are read; PNG is
written. Other files give None, as a file does that is cut off or no image.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}  # of PNG's colour types (fixed values)


def decode(data: bytes | None) -> np.ndarray | None:
    """Pixels (height, width) of a grey image or (height, width, 3) RGB of a coloured one; alpha is left out."""
    try:
        if data and data[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(data)
        if data and data[:2] == b"BM":
            return _bmp(data)
    except (ValueError, IndexError, struct.error, zlib.error):
        return None
    return None


def grey(image: np.ndarray) -> np.ndarray:
    """Luminance of an RGB image (weights of ITU-R BT.601), a grey image as it is."""
    if image.ndim == 2:
        return image
    return np.rint(image[..., :3].astype(float) @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)


def _png(data: bytes) -> np.ndarray:
    at, body, palette, head = 8, [], None, None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, dtype=np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(part)
        elif kind == b"IEND":
            break
        at += size + 12
    width, height, depth, colour, _, _, interlaced = head or (0,) * 7
    if depth != 8 or interlaced or colour not in CHANNELS or not width or not height:
        raise ValueError("a form of PNG that is not read")
    n = CHANNELS[colour]
    raw = np.frombuffer(zlib.decompress(b"".join(body)), dtype=np.uint8).reshape(height, width * n + 1)
    out = np.zeros((height, width, n), dtype=np.uint8)
    above = np.zeros((width, n), dtype=np.uint8)
    for y in range(height):
        line = raw[y, 1:].reshape(width, n)
        out[y] = above = _unfiltered(int(raw[y, 0]), line, above)
    if colour == 3:
        return palette[out[..., 0]]
    return out[..., 0] if n < 3 else out[..., :3]


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray) -> np.ndarray:
    """A line of a PNG with its filter taken back: none, left, above, mean of both, or the nearest of left, above and their corner."""
    if kind == 0:
        return line.copy()
    if kind == 1:
        return np.cumsum(line, axis=0, dtype=np.uint8)
    if kind == 2:
        return line + above
    if kind not in (3, 4):
        raise ValueError("no such filter")
    a, up, out = np.zeros(line.shape[1], dtype=int), above.astype(int), np.empty_like(line)
    corner = np.zeros_like(a)
    for x, v in enumerate(line.astype(int)):
        b = up[x]
        if kind == 3:
            guess = (a + b) // 2
        else:
            p = a + b - corner
            da, db, dc = np.abs(p - a), np.abs(p - b), np.abs(p - corner)
            guess = np.where((da <= db) & (da <= dc), a, np.where(db <= dc, b, corner))
        a, corner = (v + guess) & 255, b
        out[x] = a
    return out


def _bmp(data: bytes) -> np.ndarray:
    start, size, width, height, _, bits, packed = struct.unpack("<I", data[10:14]) + struct.unpack("<IiiHHI", data[14:34])
    if packed or bits not in (8, 24, 32) or width <= 0 or not height:
        raise ValueError("a form of BMP that is not read")
    n, row = bits // 8, (width * bits // 8 + 3) // 4 * 4
    pixels = np.frombuffer(data, dtype=np.uint8, count=row * abs(height), offset=start).reshape(abs(height), row)[:, : width * n].reshape(abs(height), width, n)
    pixels = pixels if height < 0 else pixels[::-1]
    if n == 1:
        table = np.frombuffer(data, dtype=np.uint8, count=start - 14 - size, offset=14 + size).reshape(-1, 4)[:, 2::-1]
        return table[pixels[..., 0]]
    return pixels[..., 2::-1].copy()


def encode_png(image: np.ndarray) -> bytes:
    """An image of 8 bits a channel, grey or RGB, as PNG."""
    height, width = image.shape[:2]
    chunk = lambda kind, part: struct.pack(">I", len(part)) + kind + part + struct.pack(">I", zlib.crc32(kind + part))
    lines = np.concatenate([np.zeros((height, 1), dtype=np.uint8), np.ascontiguousarray(image, dtype=np.uint8).reshape(height, -1)], axis=1)
    head = struct.pack(">IIBBBBB", width, height, 8, 0 if image.ndim == 2 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")
