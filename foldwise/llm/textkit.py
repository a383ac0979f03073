"""Vectorised word and fingerprint kernels over Arrow string columns.

A batch of texts is one UTF-8 buffer.  Both word patterns used by the operators exclude
ASCII characters only, so word ends are found on bytes; a fingerprint of any byte span comes
from one prefix sum of ``random[byte] * base**position`` (mod 2**64), so hashing all words
and all word windows costs a few passes over the buffer and no Python loop per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20  # texts are handled in slices of about this size; one text is never cut


def byte_set(*inside) -> bytes:
    """Translation table that maps the given bytes to 1 and all others to 0."""
    keep = {b for x in inside for b in (x if isinstance(x, range) else [x])}
    return bytes(b in keep for b in range(256))


#: bytes of ``[^\x20\x09-\x0D]+``
NOT_SPACE = byte_set(range(0x00, 0x09), range(0x0E, 0x20), range(0x21, 0x100))

#: bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (texts are lower-cased first)
ALNUM = byte_set(range(0x30, 0x3A), range(0x61, 0x7B), range(0x80, 0x100))

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def mix_int(x: int) -> int:
    return int(mix(np.array([x & (2**64 - 1)], U64))[0])


class SpanHasher:
    """Fingerprints of spans of a sequence: sum of value[i] * base**(i - start), mixed."""

    def __init__(self, seed: int):
        r = np.random.default_rng(seed)
        self.base = int(r.integers(1, 2**62, dtype=np.int64)) * 2 + 1
        self.inv = pow(self.base, -1, 2**64)
        self._pow = np.ones(1, U64)
        self._ipow = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self._pow) < n:
            n = max(n, 2 * len(self._pow), 1 << 16)
            for name, b in (("_pow", self.base), ("_ipow", self.inv)):
                p = np.full(n, U64(b), U64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, U64)
        np.cumsum(np.multiply(values, self._pow[: len(values)], dtype=U64), out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self._ipow[start] + (end - start).astype(U64))

    def words(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.spans(self.prefix(buf), start, end)

    def windows(self, items: np.ndarray, start: np.ndarray, size) -> np.ndarray:
        """Fingerprints of items[start : start + size]; items are hashes themselves."""
        return self.spans(self.prefix(items), start, start + size)


@dataclass
class Texts:
    """A slice of texts: buf holds their bytes, text i is buf[offs[i]:offs[i + 1]]; null texts are empty."""

    buf: np.ndarray
    offs: np.ndarray
    null: np.ndarray
    first: int  # row of the batch that text 0 came from

    def __len__(self) -> int:
        return len(self.offs) - 1


@dataclass
class Words:
    """Words of a Texts: byte span of each, first[i]:first[i + 1] are the words of text i."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def arrow_texts(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    null = np.asarray(col.is_null())
    if col.null_count:
        col = col.fill_null("")
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, offs, null


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a string column in slices of about ``limit`` bytes."""
    buf, offs, null = arrow_texts(col)
    i, n = 0, len(null)
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield Texts(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], null[i:j], i)
        i = j
    del buf, offs, null, col
    release()


def release() -> None:
    """Hands freed memory of Arrow's pool and of the C library back to the system: Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def _libc():
    try:
        lib = ctypes.CDLL("libc.so.6")
        return lib if hasattr(lib, "malloc_trim") else None
    except OSError:  # another C library
        return None


_LIBC = _libc()


def translate(buf: np.ndarray, table: bytes) -> np.ndarray:
    return np.frombuffer(buf.tobytes().translate(table), np.uint8)


def find_words(t: Texts, inside: bytes, lower: bool = False) -> tuple[Words, np.ndarray]:
    """Maximal runs of bytes in the set ``inside``; no run goes over the end of a text.

    Returns the words and the buffer they index (lower-cased A-Z if asked)."""
    buf = translate(t.buf, LOWER) if lower else t.buf
    m = np.zeros(len(buf) + 2, np.uint8)
    m[1:-1] = translate(buf, inside)
    ends = np.flatnonzero(m[1:] != m[:-1])
    start, end = ends[0::2], ends[1::2]
    cuts = t.offs[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(buf))]
    cuts = cuts[(m[cuts] == 1) & (m[cuts + 1] == 1)]
    if len(cuts):  # a run that goes on over the end of a text is two words
        cuts = sorted_unique(cuts)
        start, end = np.sort(np.concatenate([start, cuts])), np.sort(np.concatenate([end, cuts]))
    return Words(start, end, np.searchsorted(start, t.offs)), buf


def sorted_unique(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values by sorting (np.unique hashes, which is slower on 64-bit keys)."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def text_hash(t: Texts, hasher: SpanHasher) -> np.ndarray:
    return hasher.spans(hasher.prefix(t.buf), t.offs[:-1], t.offs[1:])


def has(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """keys in a sorted table."""
    if not len(table):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return table[at] == keys
