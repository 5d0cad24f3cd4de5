"""Images as bytes: PNG and baseline TIFF of one or three 8 or 16 bit channels, with a description."""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
DESCRIPTION = "Description"


def to_png(image: np.ndarray, description: dict | None = None, level: int = 6) -> bytes:
    """(height, width) or (height, width, 3) of unsigned 8 or 16 bit numbers."""
    height, width = image.shape[:2]
    depth, colour = 8 * image.dtype.itemsize, 2 if image.ndim == 3 else 0
    rows = image.astype(image.dtype.newbyteorder(">")).reshape(height, -1)
    raw = b"".join(b"\0" + r.tobytes() for r in rows)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    text = chunk(b"iTXt", DESCRIPTION.encode() + b"\0\0\0\0\0" + json.dumps(description).encode()) if description else b""
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, 0)) + text + chunk(b"IDAT", zlib.compress(raw, level)) + chunk(b"IEND", b"")


def _unfiltered(raw: bytes, height: int, stride: int, step: int) -> np.ndarray:
    """Rows of a PNG whose bytes were stored as differences from those to the left, above or both."""
    out = np.zeros((height + 1, stride + step), np.uint8)  # a row above and a pixel to the left of zeros
    for y in range(height):
        kind, row = raw[y * (stride + 1)], np.frombuffer(raw, np.uint8, stride, y * (stride + 1) + 1)
        above = out[y, step:]
        if kind == 0:
            out[y + 1, step:] = row
        elif kind == 2:
            out[y + 1, step:] = row + above
        elif kind == 1:
            out[y + 1, step:] = np.cumsum(row.reshape(-1, step), axis=0, dtype=np.uint64).astype(np.uint8).ravel()
        elif kind in (3, 4):
            now = out[y + 1]
            for i, v in enumerate(row.tolist()):
                a, b, c = int(now[i]), int(above[i]), int(out[y, i])
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - c
                    guess = min((a, b, c), key=lambda x: abs(p - x))
                now[i + step] = (v + guess) & 255
        else:
            raise ValueError(f"PNG row filter {kind}")
    return out[1:, step:]


def from_png(data: bytes) -> tuple[np.ndarray, dict]:
    if not data.startswith(SIGNATURE):
        raise ValueError("no PNG")
    at, parts, info, header = 8, [], {}, None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            parts.append(body)
        elif kind == b"iTXt" and body.startswith(DESCRIPTION.encode() + b"\0"):
            info = json.loads(body.split(b"\0", 5)[5])
        at += n + 12
    width, height, depth, colour, _, _, interlaced = header
    if depth not in (8, 16) or colour not in (0, 2) or interlaced:
        raise ValueError("only plain PNG of 8 or 16 bits, gray or colour")
    channels = 3 if colour == 2 else 1
    step = channels * depth // 8
    rows = _unfiltered(zlib.decompress(b"".join(parts)), height, width * step, step)
    image = np.ascontiguousarray(rows).view(">u2" if depth == 16 else np.uint8).astype(np.uint16 if depth == 16 else np.uint8)
    return image.reshape((height, width, 3) if channels == 3 else (height, width)), info


# fixed values: tags of the format
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, TEXT, OFFSETS, SAMPLES, ROWS, COUNTS = 256, 257, 258, 259, 262, 270, 273, 277, 278, 279


def to_tiff(image: np.ndarray, description: dict | None = None, compress: int = 0) -> bytes:
    """(height, width) of unsigned 8 or 16 bit numbers in one strip, with zlib if ``compress`` is a level."""
    height, width = image.shape
    raw = image.astype(image.dtype.newbyteorder("<")).tobytes()
    body = zlib.compress(raw, compress) if compress else raw
    text = json.dumps(description or {}).encode() + b"\0"
    text += b"\0" * max(0, 5 - len(text))  # a value of four bytes would stand in the entry itself
    tags = {WIDTH: (4, 1, width), HEIGHT: (4, 1, height), BITS: (3, 1, 8 * image.dtype.itemsize), COMPRESSION: (3, 1, 8 if compress else 1), PHOTOMETRIC: (3, 1, 1), TEXT: (2, len(text), 0), OFFSETS: (4, 1, 0), SAMPLES: (3, 1, 1), ROWS: (4, 1, height), COUNTS: (4, 1, len(body))}
    after = 8 + 2 + 12 * len(tags) + 4
    tags[TEXT], tags[OFFSETS] = (2, len(text), after), (4, 1, after + len(text))
    entries = b"".join(struct.pack("<HHII", tag, *tags[tag]) for tag in sorted(tags))
    return struct.pack("<2sHI", b"II", 42, 8) + struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0) + text + body


def from_tiff(data: bytes) -> tuple[np.ndarray, dict]:
    """The first image of a TIFF file, in strips without compression or with zlib."""
    end = {b"II": "<", b"MM": ">"}.get(data[:2])
    if end is None:
        raise ValueError("no TIFF")
    at = struct.unpack(end + "I", data[4:8])[0]
    sizes, tags = {1: "B", 2: "s", 3: "H", 4: "I"}, {}
    for i in range(struct.unpack(end + "H", data[at : at + 2])[0]):
        tag, kind, n = struct.unpack(end + "HHI", data[at + 2 + 12 * i : at + 10 + 12 * i])
        if kind not in sizes:
            continue
        form = end + (f"{n}s" if kind == 2 else f"{n}{sizes[kind]}")
        where = at + 10 + 12 * i
        if struct.calcsize(form) > 4:
            where = struct.unpack(end + "I", data[where : where + 4])[0]
        tags[tag] = struct.unpack(form, data[where : where + struct.calcsize(form)])
    packed = tags.get(COMPRESSION, (1,))[0]
    if packed not in (1, 8, 32946) or tags.get(SAMPLES, (1,))[0] != 1 or tags[BITS][0] not in (8, 16):
        raise ValueError("only gray TIFF of 8 or 16 bits, plain or with zlib")
    strips = [data[a : a + n] for a, n in zip(tags[OFFSETS], tags[COUNTS], strict=True)]
    raw = b"".join(strips if packed == 1 else map(zlib.decompress, strips))
    kind = np.dtype(f"u{tags[BITS][0] // 8}")
    try:
        info = json.loads(tags[TEXT][0].rstrip(b"\0").decode()) if TEXT in tags else {}
    except ValueError:
        info = {}
    return np.frombuffer(raw, kind.newbyteorder(end)).astype(kind).reshape(tags[HEIGHT][0], tags[WIDTH][0]), info if isinstance(info, dict) else {}


def decode(data: bytes) -> tuple[np.ndarray, dict]:
    return from_png(data) if data.startswith(SIGNATURE) else from_tiff(data)
