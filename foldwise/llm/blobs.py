"""Compact columns for exchanges that carry many small numbers: a numpy array as one compressed binary value."""

from __future__ import annotations

import numpy as np
import zstandard

_PACK, _UNPACK = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(a: np.ndarray) -> bytes:
    """Bytes of equal weight are put together, so that sorted or small numbers compress."""
    a = np.ascontiguousarray(a)
    return _PACK.compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw, size = np.frombuffer(_UNPACK.decompress(data), np.uint8), np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)


def unpack_all(column, dtype) -> list[np.ndarray]:
    return [unpack(x.as_buffer(), dtype) for x in column]


def gaps(cells: np.ndarray) -> bytes:
    """Sorted distinct cell numbers as one byte a gap (a byte 255 adds 255 and goes on)."""
    g = np.diff(cells, prepend=0).astype(np.int64)
    more = g // 255
    ends = np.cumsum(more + 1) - 1
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 255, np.uint8)
    out[ends] = g % 255
    return out.tobytes()


def cells(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    return np.cumsum(b, dtype=np.int64)[b != 255]


def groups(*keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal keys in sorted arrays, and the length at the end."""
    n = len(keys[0])
    if not n:
        return np.zeros(1, np.int64)
    new = np.zeros(n - 1, bool)
    for k in keys:
        new |= k[1:] != k[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1, [n]])
