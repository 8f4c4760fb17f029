r"""Array kernels over whole batches of texts (numpy inside Arrow tasks).

A batch is one byte array in which every text is followed by one line feed,
plus the offsets of the texts. Words, lines, shingles and windows are then
index arrays into it, so a task handles millions of words without a Python
object per word. Callers pass ``terminated(col)``: the separator is added by
Spark, the Arrow buffer is used as it arrives.

Null texts count as empty. Texts of any length are handled whole; a batch is
cut into slices of about ``SLICE_BYTES`` (one text is never cut), which bounds
the memory of the index arrays by the slice or the longest text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19
#: spans of more bytes than this are hashed one by one
LONG = 64

_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo:hi + 1] = True
    return out


#: bytes of words ``[^\x20\x09-\x0D]+``
WORD = ~_table((0x20, 0x20), (0x09, 0x0D))
#: bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
ALNUM = _table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: lower-cases A-Z only
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def terminated(col: Column | str) -> Column:
    """The text (null: empty) with the line feed that ends it in a batch."""
    col = F.col(col) if isinstance(col, str) else col
    return F.concat(F.coalesce(col, F.lit("")), F.lit("\n"))


def slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive slices; the bytes
    of row i of a slice are ``bytes[offsets[i]:offsets[i + 1]]``, its end line feed included."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + slice_bytes, "right")) - 1)
        yield lo, min(hi, n), raw[at[lo]:at[min(hi, n)]], at[lo:min(hi, n) + 1] - at[lo]
        lo = hi
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: a worker that waits for its next task
    should not hold what the last batch took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True. The last byte of a batch is a line
    feed, so no run crosses from one text to the next."""
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if len(mask) and mask[0]:
        edge = np.concatenate(([0], edge))
    if len(edge) % 2:
        edge = np.append(edge, len(mask))
    return edge[0::2], edge[1::2]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values[offsets[i]:offsets[i + 1]]`` (empty ranges: 0)."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def counts(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of ``mask[offsets[i]:offsets[i + 1]]`` are true; for sparse masks."""
    return np.diff(np.searchsorted(np.flatnonzero(mask), offsets))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values with good avalanche."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h ^= h >> np.uint64(33)
    h *= _M2
    h ^= h >> np.uint64(33)
    return h


_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def lanes(buf: np.ndarray) -> np.ndarray:
    """View of the eight bytes from every position on (zeros after the end)."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = buf
    return np.ndarray((len(buf) + 1,), "<u8", buffer=padded.data, strides=(1,))


def span_hash(view: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes at a time over all spans at once
    (spans of up to eight bytes and equal length never collide). The few spans
    over ``LONG`` bytes are hashed one by one."""
    size = ends - starts
    h = mix(size.astype(np.uint64) * _M3 + np.uint64(seed * 2 + 1))
    h = mix(h ^ (view[starts] & _KEEP[np.minimum(size, 8)]))
    rows = np.flatnonzero((size > 8) & (size <= LONG))
    pos, left = starts[rows] + 8, size[rows] - 8
    while len(rows):
        h[rows] = mix(h[rows] * _M3 ^ (view[pos] & _KEEP[np.minimum(left, 8)]))
        more = left > 8
        rows, pos, left = rows[more], pos[more] + 8, left[more] - 8
    data = memoryview(view.base)
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] ^= np.uint64(xxhash.xxh64_intdigest(data[starts[i]:ends[i]], seed))
    return h


BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2^64."""
    have = len(_powers.get("up", ()))
    if have < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            seq = np.full(size, base, np.uint64)
            seq[0] = 1
            _powers[name] = np.cumprod(seq, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def windows(h: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of every window of ``width`` consecutive words of one text.

    ``h``: word hashes; ``bounds[i]:bounds[i + 1]`` are the words of text i.
    The rolling sums of all windows come from one prefix sum of word hashes
    times inverse powers of the base. Returns (first word, hash).
    """
    n = len(h)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = powers(n)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(h * down, out=prefix[1:])
    text_end = np.repeat(bounds[1:], np.diff(bounds))
    first = np.flatnonzero(np.arange(n) + width <= text_end)
    return first, mix((prefix[first + width] - prefix[first]) * up[first])


def crc32s(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of each range of ``values`` as little-endian bytes."""
    import zlib
    view, width = memoryview(np.ascontiguousarray(values).view(np.uint8)), values.dtype.itemsize
    return np.fromiter((zlib.crc32(view[a * width:b * width]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)),
                       np.int64, len(offsets) - 1)
