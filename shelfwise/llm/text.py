"""Vectorised text helpers for Arrow batches.

A batch of strings is one UTF-8 buffer with offsets, so words and their 64-bit
fingerprints are computed for many rows at once, without a Python loop per
word.  Null texts count as empty.  Fingerprints are 64 bits wide: two different
sequences among n collide with probability below n^2 / 2^65.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: White space of the word rule [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of a run of texts that are worked on at once.
RUN_BYTES = 2 << 20

_rng = np.random.default_rng(20240229)
BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
STEP = 0xD1342543DE82EF95 | 1


_LOWER_POINTS: list[np.ndarray] = []


def lower_points() -> np.ndarray:
    """Code point -> its lower case, where that is a single character."""
    if not _LOWER_POINTS:
        out = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x20000):
            if not 0xD800 <= c < 0xE000 and len(low := chr(c).lower()) == 1:
                out[c] = ord(low)
        _LOWER_POINTS.append(out)
    return _LOWER_POINTS[0]


def give_back() -> None:
    """Hand freed memory back to the system, since a Python worker lives on for tasks of other stages."""
    _RUN_POWERS.clear()
    gc.collect()
    trim()


def trim() -> None:
    """As ``give_back``, without a search for garbage: cheap enough for every group of a grouped map."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def inverse(base: int) -> int:
    return pow(base, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every bit of the result depends on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def unsigned(col) -> np.ndarray:
    return np.ascontiguousarray(np.asarray(col, np.int64)).view(np.uint64)


def slices(col: pa.Array | pa.ChunkedArray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row offsets) of runs of rows of about ``limit`` bytes.

    A single longer text makes a run of its own.
    """
    if isinstance(col, pa.ChunkedArray):
        at = 0
        for c in col.chunks:
            for i, j, data, offs in slices(c, limit):
                yield at + i, at + j, data, offs
            at += len(c)
        return
    if not len(col):
        return
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    offs = np.frombuffer(col.buffers()[1], kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        j = min(j, len(col))
        yield i, j, data[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
        i = j


def word_spans(data: np.ndarray, offs: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words, and the first word of each row (rows + 1 entries)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    word = ~SPACE[data] if inside is None else inside
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One fingerprint per word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _both_powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(np.multiply(vals := BYTE[data], up[: len(data)], out=vals), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: The powers of BASE and of its inverse for the longest run of texts so far; those of a longer text are made anew.
_RUN_POWERS: list[np.ndarray] = []


def _both_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > RUN_BYTES:
        return powers(BASE, n), powers(inverse(BASE), n)
    if not _RUN_POWERS or len(_RUN_POWERS[0]) < n:
        most = min(RUN_BYTES, 1 << n.bit_length())
        _RUN_POWERS[:] = powers(BASE, most), powers(inverse(BASE), most)
    return _RUN_POWERS[0], _RUN_POWERS[1]


class Rolling:
    """Fingerprints of windows of a sequence of values, from one prefix sum."""

    def __init__(self, values: np.ndarray, base: int = STEP):
        n = len(values)
        self.back = powers(inverse(base), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(base, n)[:n], dtype=np.uint64, out=self.sums[1:])

    def windows(self, at: np.ndarray, size) -> np.ndarray:
        return mix((self.sums[at + size] - self.sums[at]) * self.back[at] + np.uint64(1) * np.asarray(size).astype(np.uint64))


def distinct_counts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and whether each occurs more than once here."""
    if not len(h):
        return h, np.zeros(0, bool)
    h = np.sort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    first = np.flatnonzero(new)
    return h[first], np.diff(np.append(first, len(h))) > 1


def found(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values occur in ``among`` (sorted)."""
    if not len(among) or not len(values):
        return np.zeros(len(values), bool)
    k = np.searchsorted(among, values)
    k[k == len(among)] = 0
    return among[k] == values


def _loose(kind: pa.DataType) -> pa.DataType:
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, _loose(f.type)) for f in kind])
    if pa.types.is_map(kind):
        return pa.map_(_loose(kind.key_type), _loose(kind.item_type))
    if pa.types.is_list(kind):
        return pa.list_(_loose(kind.value_type))
    return kind


def loose(col):
    """The column with every nested field nullable, as a declared result schema has them."""
    kind = _loose(col.type)
    return col if kind == col.type else col.cast(kind)
