"""Bytes: digests, packing, and the few functions that need an Arrow UDF."""

from __future__ import annotations

import gzip
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def digest(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def n_bytes(content: Column) -> Column:
    return F.octet_length(content).cast("long")


def little_endian(value: Column) -> Column:
    """A uint32 as four bytes, lowest first."""
    h = F.lpad(F.hex(value.cast("long")), 8, "0")
    return F.unhex(F.concat(*[F.substring(h, k, 2) for k in (7, 5, 3, 1)]))


def vocabulary_entry(token: Column, token_id: Column) -> Column:
    """The token in UTF-8, a zero byte, and its id."""
    return F.concat(F.encode(token, "UTF-8"), F.unhex(F.lit("00")), little_endian(token_id))


@F.pandas_udf(T.BinaryType())
def inflate(content: pd.Series) -> pd.Series:
    """What a gzip file holds; null for null."""
    return content.map(lambda x: None if x is None else zlib.decompress(x, 31))


@F.pandas_udf(T.BinaryType())
def deflate(content: pd.Series) -> pd.Series:
    """A gzip file of the content, the same bytes each time; null for null."""
    return content.map(lambda x: None if x is None else gzip.compress(bytes(x), mtime=0))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def solve(matrix: pd.Series, right: pd.Series) -> pd.Series:
    """The solution of a square system given row by row (perspective transforms have 8 unknowns)."""
    return pd.Series([np.linalg.solve(np.asarray(a, float).reshape(len(b), len(b)), np.asarray(b, float)).tolist() for a, b in zip(matrix, right, strict=True)])


def png(width: int, height: int, channels: int, raw: bytes) -> bytes:
    """A PNG of 8-bit grey (1 channel) or RGB (3 channels) pixels."""
    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    stride = width * channels
    lines = b"".join(b"\0" + raw[k * stride : (k + 1) * stride] for k in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0 if channels == 1 else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def png_pixels(data: bytes) -> bytes:
    """The pixels of an 8-bit PNG without palette or interlacing."""
    at, body, width, height, channels = 8, b"", 0, 0, 1
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IHDR":
            width, height, depth, color = struct.unpack(">IIBB", data[at + 8 : at + 18])
            channels = {0: 1, 2: 3, 4: 2, 6: 4}[color]
            if depth != 8:
                raise ValueError("8-bit images only")
        elif kind == b"IDAT":
            body += data[at + 8 : at + 8 + n]
        at += n + 12
    stride = width * channels
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, stride + 1)
    out = np.zeros((height, stride), np.uint8)
    above = np.zeros(stride, np.uint8)
    for y in range(height):
        kind, line = lines[y, 0], lines[y, 1:]
        if kind == 0:
            out[y] = line
        elif kind == 1:  # by the pixel to the left: a running sum of each channel
            out[y] = np.cumsum(line.reshape(width, channels), 0, dtype=np.uint8).ravel()
        elif kind == 2:  # by the pixel above
            out[y] = line + above
        else:  # by both: pixel after pixel, the channels together
            up, pixels, left = (x.reshape(width, channels).astype(np.int32) for x in (above, line, np.zeros(stride)))
            a, c = np.zeros(channels, np.int32), np.zeros(channels, np.int32)
            for x in range(width):
                b = up[x]
                if kind == 3:
                    near = (a + b) // 2
                else:
                    pa, pb, pc = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
                    near = np.where((pa <= pb) & (pa <= pc), a, np.where(pb <= pc, b, c))
                left[x] = a = (pixels[x] + near) & 255
                c = b
            out[y] = left.ravel()
        above = out[y]
    return out.tobytes()


@F.pandas_udf(T.BinaryType())
def encode_png(raw: pd.Series, width: pd.Series, height: pd.Series, channels: pd.Series) -> pd.Series:
    return pd.Series([None if r is None else png(int(w), int(h), int(c), bytes(r)) for r, w, h, c in zip(raw, width, height, channels, strict=True)])


@F.pandas_udf(T.BinaryType())
def decode_png(data: pd.Series) -> pd.Series:
    return data.map(lambda x: None if x is None else png_pixels(x))
