"""Sorted numbers in few bytes: differences, byte by byte, compressed. Used for what crosses a shuffle."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as bytes; those in rising order take the least room."""
    values = np.asarray(values, np.int64)
    step = np.diff(values, prepend=0).astype("<i8")
    step = (step << 1) ^ (step >> 63)  # a negative step has its sign in the last bit
    planes = np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    step = np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel()
    return np.cumsum((step >> 1) ^ -(step & 1))
