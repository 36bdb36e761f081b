"""Compressed arrays of small numbers, as they travel between tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def squeeze(raw: bytes) -> bytes:
    """Length (4 bytes), then the compressed bytes."""
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def expand(raw: bytes) -> bytes:
    size = int.from_bytes(raw[:4], "little")
    return pa.decompress(raw[4:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def pack_numbers(x: np.ndarray) -> bytes:
    """Numbers from 0 to 2^64 - 1, by byte plane since most are small; the first byte is the width."""
    x = np.asarray(x).astype("<u8")
    width = 4 if not len(x) or int(x.max()) < 1 << 32 else 8
    planes = x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + squeeze(np.ascontiguousarray(planes).tobytes())


def unpack_numbers(raw: bytes) -> np.ndarray:
    width = raw[0]
    planes = np.frombuffer(expand(raw[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}").ravel()
