"""Image headers, pixel formats and camera models: SQL expressions where bytes can be cut, numpy where loops run."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _hex(data: Column, start: int, n: int) -> Column:
    return F.hex(F.substring(data, start, n))


def image_format(data: Column) -> Column:
    """From magic bytes: jpeg, png, else unknown; null data is unknown."""
    head = _hex(data, 1, 4)
    return F.when(F.octet_length(data) < 4, F.lit("unknown")).when(head.startswith("FFD8FF"), F.lit("jpeg")).when(
        head == "89504E47", F.lit("png")
    ).otherwise(F.lit("unknown"))


#: Names of pixel and stream formats in recordings; streams hold single JPEG images.
NAMED_FORMATS = {
    "rgb8": "rgb8", "rgba8": "rgb8", "bgr8": "bgr8", "bgra8": "bgr8", "mono8": "gray8", "gray8": "gray8",
    "jpeg": "jpeg", "jpg": "jpeg", "jpe": "jpeg", "jfif": "jpeg", "png": "png", "avi": "jpeg", "h264": "jpeg", "hevc": "jpeg",
}


def named_format(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in NAMED_FORMATS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(name)), F.lit("unknown"))


def detect_format(data: Column, name: Column) -> Column:
    found = image_format(data)
    return F.when(found != "unknown", found).otherwise(F.coalesce(named_format(name), F.lit("unknown")))


def is_jpeg(data: Column) -> Column:
    return F.coalesce(_hex(data, 1, 3) == "FFD8FF", F.lit(False))


def is_png(data: Column) -> Column:
    """Wants the whole eight-byte signature."""
    return F.coalesce(_hex(data, 1, 8) == "89504E470D0A1A0A", F.lit(False))


def png_size(data: Column) -> Column:
    """STRUCT<width, height> of the IHDR chunk; null unless both are above zero."""
    whole = F.octet_length(data) >= 24
    w, h = (F.conv(_hex(data, at, 4), 16, 10).cast("long") for at in (17, 21))
    return F.when(is_png(data) & whole & (w > 0) & (h > 0), F.struct(w.alias("width"), h.alias("height")))


def _jpeg_size(data: bytes | None) -> tuple[int, int] | None:
    if not data or data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            at += 1
            continue
        marker = data[at + 1]
        if marker in (0xC0, 0xC2):  # the frame header of baseline and progressive images
            h, w = int.from_bytes(data[at + 5 : at + 7]), int.from_bytes(data[at + 7 : at + 9])
            return (w, h) if w and h else None
        if marker == 0xFF or marker == 0x01 or 0xD0 <= marker <= 0xD8:  # fill bytes and markers without a length
            at += 1 if marker == 0xFF else 2
            continue
        if marker in (0xD9, 0xDA):
            return None
        at += 2 + max(2, int.from_bytes(data[at + 2 : at + 4]))
    return None


@F.pandas_udf(T.StructType([T.StructField("width", T.LongType()), T.StructField("height", T.LongType())]))
def jpeg_size(data: pd.Series) -> pd.DataFrame:
    """Walks a JPEG's markers to its frame header; nulls where there is none."""
    found = [_jpeg_size(x) or (None, None) for x in data]
    return pd.DataFrame({"width": pd.array([w for w, _ in found], "Int64"), "height": pd.array([h for _, h in found], "Int64")})


#: Bytes a pixel takes in raw layouts, times two.
HALF_BYTES = {"rgb24": 6, "bgr24": 6, "rgba": 8, "bgra": 8, "gray8": 2, "yuv420p": 3, "nv12": 3, "yuv422p": 4, "yuyv422": 4}


def raw_bytes(layout: Column, width: Column, height: Column) -> Column:
    """Size a raw frame must have; null for an unknown layout, zero sizes, and odd sizes of layouts with halved chroma."""
    out = F.lit(None).cast("long")
    for name, n in HALF_BYTES.items():
        even = (width % 2 == 0) & (height % 2 == 0) if name in ("yuv420p", "nv12") else width % 2 == 0 if "422" in name else F.lit(True)
        out = F.when((layout == name) & even, width * height * n / 2).otherwise(out)
    return F.when((width > 0) & (height > 0), out.cast("long"))


def frame_is_valid(layout: Column, width: Column, height: Column, size: Column) -> Column:
    return F.coalesce(raw_bytes(layout, width, height) == size, F.lit(False))


def _planes(rgb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Full-range BT.601 in 8-bit fixed point of pictures of one size; chroma is the mean of each 2 x 2 square."""
    n, height, width, _ = rgb.shape
    r, g, b = (rgb[..., k].astype(np.int32) for k in range(3))
    y = (77 * r + 150 * g + 29 * b) >> 8
    u, v = ((-43 * r - 85 * g + 128 * b) >> 8) + 128, ((128 * r - 107 * g - 21 * b) >> 8) + 128
    square = lambda p: p.reshape(n, height // 2, 2, width // 2, 2).sum(axis=(2, 4)) // 4
    return tuple(np.clip(p, 0, 255).astype(np.uint8).reshape(n, -1) for p in (y, square(u), square(v)))


#: Bytes of pictures that are converted at once.
AT_ONCE = 4 << 20


def _converted(data: pd.Series, width: pd.Series, height: pd.Series, layout) -> pd.Series:
    """layout(y, u, v) of the pictures, those of one size together; null for odd sizes or a wrong number of bytes."""
    w, h = (x.fillna(0).to_numpy().astype(np.int64) for x in (width, height))
    size = np.fromiter((-1 if d is None else len(d) for d in data), np.int64, len(data))
    ready = (w > 0) & (h > 0) & (w % 2 == 0) & (h % 2 == 0) & (size == w * h * 3)
    data, out = data.to_numpy(), np.full(len(data), None, object)
    for own_w, own_h in {*zip(w[ready].tolist(), h[ready].tolist(), strict=True)}:
        rows = np.flatnonzero(ready & (w == own_w) & (h == own_h))
        step = max(1, AT_ONCE // (own_w * own_h * 3))
        for at in range(0, len(rows), step):
            own = rows[at : at + step]
            planes = layout(*_planes(np.frombuffer(b"".join(data[own]), np.uint8).reshape(len(own), own_h, own_w, 3)))
            n, whole = planes.shape[1], planes.tobytes()
            out[own] = [whole[k : k + n] for k in range(0, len(whole), n)]
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.BinaryType())
def rgb_to_yuv420p(data: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """Planes Y, U, V one after another; null for odd sizes or a wrong number of bytes."""
    return _converted(data, width, height, lambda y, u, v: np.concatenate([y, u, v], axis=1))


@F.pandas_udf(T.BinaryType())
def rgb_to_nv12(data: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """Plane Y, then U and V interleaved."""
    return _converted(data, width, height, lambda y, u, v: np.concatenate([y, np.stack([u, v], axis=-1).reshape(len(u), -1)], axis=1))


#: Channels and bits of a channel by colour type; floats are from 0 to 1.
COLOURS = {"l8": (1, 8), "la8": (2, 8), "rgb8": (3, 8), "rgba8": (4, 8), "l16": (1, 16), "la16": (2, 16), "rgb16": (3, 16), "rgba16": (4, 16), "rgb32f": (3, 32), "rgba32f": (4, 32)}


def _to_rgb8(data: bytes | None, colour: str) -> bytes | None:
    if data is None or colour not in COLOURS:
        return None
    channels, bits = COLOURS[colour]
    if len(data) % (channels * bits // 8):
        return None
    x = np.frombuffer(data, {8: np.uint8, 16: "<u2", 32: "<f4"}[bits]).reshape(-1, channels)
    x = (x >> 8).astype(np.uint8) if bits == 16 else (np.clip(np.nan_to_num(x), 0, 1) * 255).astype(np.uint8) if bits == 32 else x
    return (np.repeat(x[:, :1], 3, axis=1) if channels < 3 else x[:, :3]).tobytes()


@F.pandas_udf(T.BinaryType())
def to_rgb8(data: pd.Series, colour: pd.Series) -> pd.Series:
    """Raw pixels of a colour type as RGB8: alpha goes, grey is repeated, deeper channels keep their high byte."""
    return pd.Series([_to_rgb8(d, c) for d, c in zip(data, colour, strict=True)])


def intrinsics(k: Column, d: Column) -> Column:
    """STRUCT of the pinhole model of K (row-major 3 x 3) and distortion D; what is missing is 0."""
    at = lambda a, i: F.coalesce(F.get(a, F.lit(i)), F.lit(0.0))
    places = {"fx": (k, 0), "fy": (k, 4), "ppx": (k, 2), "ppy": (k, 5), "k1": (d, 0), "k2": (d, 1), "p1": (d, 2), "p2": (d, 3), "k3": (d, 4)}
    return F.struct(*[at(*v).alias(n) for n, v in places.items()])


def extrinsics(k: Column, p: Column) -> Column:
    """STRUCT<rotation, translation> of K^-1 P for a K without skew; null without P (row-major 3 x 4) or focal lengths."""
    g = lambda a, i: F.get(a, F.lit(i))
    rows = []
    for c in range(4):
        z = g(p, 8 + c)
        rows.append([(g(p, c) - g(k, 2) * z) / F.nullif(g(k, 0), F.lit(0.0)), (g(p, 4 + c) - g(k, 5) * z) / F.nullif(g(k, 4), F.lit(0.0)), z])
    turn = F.array(*[rows[c][r] for r in range(3) for c in range(3)])
    out = F.struct(turn.alias("rotation"), F.array(*rows[3]).alias("translation"))
    return F.when((F.size(p) == 12) & (F.size(k) == 9) & (g(k, 0) != 0) & (g(k, 4) != 0), out)


def audio_frames(samples: Column, channels: Column) -> Column:
    return F.when(channels > 0, F.floor(F.size(samples) / channels)).otherwise(F.lit(0))


def audio_seconds(samples: Column, rate: Column, channels: Column) -> Column:
    return F.when((rate > 0) & (channels > 0), F.size(samples) / (rate * channels)).otherwise(F.lit(0.0))
