"""Codecs that need bytes: compressed run lengths and 16-bit PNG."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf


def pack_runs(counts) -> str:
    """The compact COCO string: from the fourth count on the difference from
    the one two before, in 5-bit groups, least first, offset by 48."""
    out = []
    for i, n in enumerate(counts):
        x = int(n) - (int(counts[i - 2]) if i > 2 else 0)
        while True:
            group, x = x & 31, x >> 5
            last = x == (-1 if group & 16 else 0)
            out.append(chr((group if last else group | 32) + 48))
            if last:
                break
    return "".join(out)


def unpack_runs(text: str) -> list[int]:
    counts, x, shift = [], 0, 0
    for c in text:
        group = ord(c) - 48
        x |= (group & 31) << shift
        shift += 5
        if not group & 32:
            if group & 16:
                x -= 1 << shift
            counts.append(x + (counts[-2] if len(counts) > 2 else 0))
            x = shift = 0
    return counts


def png16(values, width: int, height: int) -> bytes:
    """A 16-bit grayscale PNG of row-major values."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    lines = np.zeros((height, 2 * width + 1), np.uint8)  # each begins with its filter, none
    lines[:, 1:] = np.asarray(values).astype(">u2").reshape(height, width).view(np.uint8)
    rows = lines.tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 16, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def read_png16(data: bytes) -> tuple[list[int], int, int]:
    """Of a PNG as ``png16`` writes it: values, width, height."""
    at, parts, size = 8, [], (0, 0)
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IHDR":
            size = struct.unpack(">II", data[at + 8 : at + 16])
        elif kind == b"IDAT":
            parts.append(data[at + 8 : at + 8 + n])
        at += n + 12
    raw, (w, h) = zlib.decompress(b"".join(parts)), size
    return [v for y in range(h) for v in struct.unpack(f">{w}H", raw[y * (2 * w + 1) + 1 : (y + 1) * (2 * w + 1)])], w, h


def rle_string(counts: Column) -> Column:
    def encode(values: pd.Series) -> pd.Series:
        return values.map(lambda c: None if c is None else pack_runs(c))

    return pandas_udf(encode, "string")(counts)


def png16_column(values: Column, width: int, height: int) -> Column:
    def encode(maps: pd.Series) -> pd.Series:
        return maps.map(lambda v: None if v is None else png16(v, width, height))

    return pandas_udf(encode, "binary")(values)
