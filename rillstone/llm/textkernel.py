"""Words of many texts at once, as arrays over the bytes of an Arrow column.

White space is the bytes 0x20 and 0x09-0x0D; words never span two texts. Hashes are of 64 bits and
depend on the bytes of words alone, so that they agree between tasks and runs.
"""

from __future__ import annotations

import ctypes
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

_K1, _K2, _K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_P = 0x5851F42D4C957F2D
_pow = np.ones(1, np.uint64)
#: Bytes of text that are worked on at once; a longer text is a portion of its own.
PORTION = 1 << 21


def powers(n: int) -> np.ndarray:
    global _pow
    if len(_pow) < n:
        out = np.full(max(n, 1024), np.uint64(_P))
        out[0] = 1
        _pow = np.multiply.accumulate(out)
    return _pow


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters them; works in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def join_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of ordered pairs."""
    return mix(a * _K1 + b * _K2 + _K3)


@dataclass
class Tokens:
    """Words of units (texts or parts of texts): byte ranges, the unit each stands in, hashes."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each unit, and the number of words at last
    hashes: np.ndarray

    def unit(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def tokens_of(buf: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Tokens:
    """Words of the units that start at offsets of buf; the last offset is the end."""
    if lower:
        buf = np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)
    black = ((buf - np.uint8(9)) > 4) & (buf != 32)
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(buf), bool)
    before[:1] = True
    np.logical_not(black[:-1], out=before[1:])
    starts = np.flatnonzero(black & (before | edge[:-1]))
    after = np.empty(len(buf), bool)
    after[-1:] = True
    np.logical_not(black[1:], out=after[:-1])
    ends = np.flatnonzero(black & (after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Tokens(buf, starts, ends, first, np.zeros(0, np.uint64))
    lens = ends - starts
    at = np.cumsum(lens) - lens
    within = np.arange(at[-1] + lens[-1], dtype=np.int64) - np.repeat(at, lens)
    terms = powers(int(lens.max()) + 1)[within] * (buf[black].astype(np.uint64) + np.uint64(1))
    return Tokens(buf, starts, ends, first, mix(np.add.reduceat(terms, at) + lens.astype(np.uint64) * _K3))


def shapes(t: Tokens, kinds: np.ndarray) -> np.ndarray:
    """Of each word the union of kinds (bits by byte; none of white space) of its bytes."""
    if not len(t.starts):
        return np.zeros(0, kinds.dtype)
    # Up to the next word stands white space only, which adds nothing.
    return np.bitwise_or.reduceat(kinds[t.buf], t.starts)


def window_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values, by doubling; shorter than h by k - 1 (empty if h is shorter)."""
    if len(h) < k:
        return h[:0]
    n, parts, size, level, at = len(h) - k + 1, [], 1, h, 0
    while size <= k:
        if k & size:
            parts.append((level, at))
            at += size
        if 2 * size <= k:
            level = join_hashes(level[:-size], level[size:]) if len(level) > size else level[:0]
        size *= 2
    out = parts[0][0][parts[0][1] : parts[0][1] + n].copy()
    for level, at in parts[1:]:
        out = join_hashes(out, level[at : at + n])
    return out


def window_min(h: np.ndarray, k: int) -> np.ndarray:
    """Least of each k consecutive values."""
    if len(h) < k:
        return h[:0]
    size, level = 1, h
    while 2 * size <= k:
        level = np.minimum(level[:-size], level[size:])
        size *= 2
    n = len(h) - k + 1
    return np.minimum(level[:n], level[k - size : k - size + n])


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, end to end."""
    if not len(starts):
        return np.zeros(0, np.int64)
    at = np.cumsum(lens) - lens
    return np.arange(int(lens.sum())) + np.repeat(starts - at, lens)


def portions(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows from, to, their bytes and offsets, of a string or binary column; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + PORTION, "right")) - 1)
        yield row, end, buf[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


@lru_cache
def keep_memory() -> None:
    """Lets this process keep what arrays free, where its allocator can be told to: they come and go by the million."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-1, 1 << 28)  # trim threshold
        libc.mallopt(-3, 1 << 25)  # threshold for maps of their own
    except (OSError, AttributeError):  # another C library: only slower
        pass


_codec = pa.Codec("zstd", compression_level=1)


def squeeze(*parts: bytes | np.ndarray) -> bytes:
    """The parts as one compressed string."""
    raw = [p if isinstance(p, bytes) else np.ascontiguousarray(p).tobytes() for p in parts]
    body = b"".join([struct.pack(f"<{len(raw) + 1}q", len(raw), *map(len, raw)), *raw])
    return struct.pack("<q", len(body)) + _codec.compress(body, asbytes=True)


def spread(packed: bytes) -> list[memoryview]:
    body = memoryview(_codec.decompress(packed[8:], struct.unpack_from("<q", packed)[0], asbytes=True))
    n = struct.unpack_from("<q", body)[0]
    sizes = struct.unpack_from(f"<{n}q", body, 8)
    out, at = [], 8 * (n + 1)
    for s in sizes:
        out.append(body[at : at + s])
        at += s
    return out


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket and the indices that fall in it."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part
