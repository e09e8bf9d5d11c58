"""PNG and JPEG: sizes, checks and pixels, without an image library (one is used for JPEG pixels if it is there)."""

from __future__ import annotations

import importlib.util
import io
import struct
import zlib

import numpy as np

_SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples of a pixel by PNG's colour types.
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
#: First column and row, and steps, of the seven passes of an interlaced PNG.
_PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))


def _chunks(data: bytes, checked: bool) -> list[tuple[bytes, bytes]]:
    """(kind, body) of a PNG's chunks up to its end."""
    at, out = len(_SIGNATURE), []
    while at + 12 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        if len(body) < n or at + 12 + n > len(data):
            break
        if checked and zlib.crc32(kind + body) != struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("damaged PNG chunk")
        out.append((kind, body))
        if kind == b"IEND" or not checked and kind == b"IHDR":
            return out
        at += 12 + n
    raise ValueError("truncated PNG")


def _row_bytes(width: int, depth: int, colour: int) -> int:
    return -(-width * depth * _SAMPLES[colour] // 8)


def _inflated(header: bytes, chunks: list[tuple[bytes, bytes]]) -> bytes:
    """A PNG's filtered rows; ValueError if they are not as many bytes as its size asks for, or begin with no filter's number."""
    width, height, depth, colour, _, _, laced = struct.unpack(">IIBBBBB", header)
    if not width or not height or colour not in _SAMPLES or depth not in (1, 2, 4, 8, 16) or laced > 1:
        raise ValueError("bad PNG header")
    if colour == 3 and not any(k == b"PLTE" for k, _ in chunks):
        raise ValueError("PNG without its palette")
    passes = [(-(-(width - x) // dx), -(-(height - y) // dy)) for x, y, dx, dy in _PASSES] if laced else [(width, height)]
    rows = [(h, 1 + _row_bytes(w, depth, colour)) for w, h in passes if w > 0 and h > 0]
    raw = zlib.decompress(b"".join(body for kind, body in chunks if kind == b"IDAT"))
    if len(raw) < sum(h * n for h, n in rows):
        raise ValueError("PNG with too few pixels")
    at = 0
    for h, n in rows:
        if max(raw[at : at + h * n : n]) > 4:
            raise ValueError("PNG row with an unknown filter")
        at += h * n
    return raw


def _jpeg_size(data: bytes, full: bool) -> tuple[int, int]:
    """Size of a JPEG. full: every segment and scan is walked to the end, and tables, frame and scan must be there."""
    at, size, seen = 2, None, set()
    while at + 4 <= len(data) and data[at] == 0xFF:
        kind = data[at + 1]
        if kind == 0xFF:  # padding
            at += 1
            continue
        if kind == 0xD9:
            break
        n = struct.unpack(">H", data[at + 2 : at + 4])[0]
        if n < 2 or at + 2 + n > len(data):
            raise ValueError("truncated JPEG")
        seen.add(kind)
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            size = width, height
            if not full:
                return size
        at += 2 + n
        if kind == 0xDA:  # coded data goes on to a marker that is neither stuffing nor a restart
            while True:
                at = data.find(b"\xff", at)
                if at < 0 or at + 1 >= len(data):
                    raise ValueError("truncated JPEG")
                if data[at + 1] == 0 or 0xD0 <= data[at + 1] <= 0xD7:
                    at += 2
                elif data[at + 1] == 0xFF:
                    at += 1
                else:
                    break
    if size is None:
        raise ValueError("JPEG without a frame")
    if full and (data[at : at + 2] != b"\xff\xd9" or not {0xDA, 0xDB} <= seen or 0xC4 not in seen and 0xCC not in seen):
        raise ValueError("truncated JPEG")
    return size


def image_size(data: bytes, full: bool = True) -> tuple[int, int]:
    """Width and height of a PNG or JPEG; ValueError if it cannot be one. full: all its pixels must be there, too.

    A PNG is inflated and its rows are counted. A JPEG is decoded by Pillow where that is installed; elsewhere its segments
    and scans are walked to the end, which finds cut and mixed-up files, though not flipped bits in its coded data.
    """
    if data[: len(_SIGNATURE)] == _SIGNATURE:
        chunks = _chunks(data, checked=full)
        if not chunks or chunks[0][0] != b"IHDR" or len(chunks[0][1]) != 13:
            raise ValueError("PNG without a header")
        if full:
            _inflated(chunks[0][1], chunks)
        return struct.unpack(">II", chunks[0][1][:8])
    if data[:2] == b"\xff\xd8":
        if full and importlib.util.find_spec("PIL"):
            return decoded(data).shape[1::-1]
        return _jpeg_size(data, full)
    raise ValueError("neither PNG nor JPEG")


def _unfiltered(raw: bytes, height: int, n: int, step: int) -> np.ndarray:
    """Rows of n bytes from rows of 1 + n filtered ones; step: bytes of a pixel."""
    rows, out = np.frombuffer(raw, np.uint8, height * (n + 1)).reshape(height, n + 1), np.zeros((height + 1, n), np.uint8)
    for y in range(height):
        kind, x, up = int(rows[y, 0]), rows[y, 1:], out[y]
        if kind == 0:
            out[y + 1] = x
        elif kind == 1:
            padded = np.zeros(-(-n // step) * step, np.uint8)
            padded[:n] = x
            out[y + 1] = np.cumsum(padded.reshape(-1, step), 0, dtype=np.uint8).reshape(-1)[:n]
        elif kind == 2:
            out[y + 1] = x + up
        else:
            line, above = bytearray(x.tobytes()), up.tolist()
            for i in range(n):
                a, b = line[i - step] if i >= step else 0, above[i]
                if kind == 3:
                    guess = a + b >> 1
                else:
                    c = above[i - step] if i >= step else 0
                    p = a + b - c
                    guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                line[i] = line[i] + guess & 255
            out[y + 1] = np.frombuffer(bytes(line), np.uint8)
    return out[1:]


def decoded(data: bytes) -> np.ndarray:
    """height x width x 3 of a PNG of eight bits that is not interlaced; of other images by Pillow. ValueError if neither can."""
    if data[: len(_SIGNATURE)] == _SIGNATURE:
        chunks = _chunks(data, checked=True)
        width, height, depth, colour, _, _, laced = struct.unpack(">IIBBBBB", chunks[0][1])
        if depth == 8 and not laced:
            step = _SAMPLES[colour]
            page = _unfiltered(_inflated(chunks[0][1], chunks), height, width * step, step).reshape(height, width, step)
            if colour == 3:
                palette = np.zeros((256, 3), np.uint8)
                found = np.frombuffer(next(body for kind, body in chunks if kind == b"PLTE"), np.uint8).reshape(-1, 3)
                palette[: len(found)] = found
                return palette[page[:, :, 0]]
            return np.repeat(page[:, :, :1], 3, 2) if colour in (0, 4) else page[:, :, :3]
    if importlib.util.find_spec("PIL") is None:
        raise ValueError("no decoder for this image")
    from PIL import Image

    with Image.open(io.BytesIO(data)) as image:
        return np.asarray(image.convert("RGB"))


def png(width: int, height: int, rows: bytes) -> bytes:
    """A PNG of width x height pixels: grey from one byte each, colour from three."""
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    n = len(rows) // max(1, height)
    lines = b"".join(b"\0" + rows[i * n : (i + 1) * n] for i in range(height))
    return _SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0 if n == width else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def shrunk(page: np.ndarray, width: int, height: int) -> np.ndarray:
    """The mean colours of width x height cells of a page."""
    def cells(x: np.ndarray, n: int) -> np.ndarray:
        cuts = np.arange(n) * len(x) // n
        sizes = np.maximum(np.diff(np.r_[cuts, len(x)]), 1)
        return np.add.reduceat(x, cuts, 0) / sizes.reshape(-1, *[1] * (x.ndim - 1))

    return cells(cells(page.astype(np.float64), height).swapaxes(0, 1), width).swapaxes(0, 1)


def grown(page: np.ndarray, width: int, height: int) -> np.ndarray:
    """A page of so many pixels, with colours between those of the cells."""
    def between(x: np.ndarray, n: int) -> np.ndarray:
        at = np.clip((np.arange(n) + 0.5) * len(x) / n - 0.5, 0, len(x) - 1)
        low = at.astype(np.int64)
        part = (at - low).reshape(-1, *[1] * (x.ndim - 1))
        return x[low] * (1 - part) + x[np.minimum(low + 1, len(x) - 1)] * part

    return between(between(page, height).swapaxes(0, 1), width).swapaxes(0, 1).round().clip(0, 255).astype(np.uint8)
