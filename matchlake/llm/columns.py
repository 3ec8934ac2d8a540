"""Numpy views of Arrow string columns, shared by the operators that read whole
texts inside Arrow batches.  All work is per slice of bounded size, so a task's
memory follows the longest text, not the partition."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_MULT = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)


def slices(batch: pa.RecordBatch, text_index: int, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about ``limit``
    bytes of text (one row at least); null texts are empty."""
    col = batch.column(text_index)
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if not n:
        return
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64)[col.offset: col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
        i = j


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` in a task that gives its memory back: Python workers serve one
    task after the other, and what an allocator keeps of a task's arrays would
    add up over the stages of a job."""
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        map_arrays()
        try:
            yield from run(batches)
        finally:
            give_back()
    return go


def map_arrays() -> None:
    """From now on this process maps large arrays, so that they go when they are freed."""
    libc = _libc()
    if libc:
        libc.mallopt(-3, 1 << 20)       # M_MMAP_THRESHOLD, fixed


def give_back() -> None:
    """Returns what this process has freed to the system."""
    _powers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = _libc()
    if libc:
        libc.malloc_trim(0)


def _libc():
    """The C library where it is glibc, else None."""
    libc = ctypes.CDLL(None)
    return libc if hasattr(libc, "malloc_trim") and hasattr(libc, "mallopt") else None


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads a 64-bit value over all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    got = _powers.get(seed)
    if got is None or len(got[0]) < n:
        base = (_BASE + 2 * seed * _MULT) % (1 << 64) | 1
        size = max(n, SLICE_BYTES + 1)
        up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
        up[1:], down[1:] = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        got = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 16 * SLICE_BYTES:
            _powers[seed] = got
    return got


class Rolling:
    """Hashes of any substring of one symbol sequence in constant time."""

    def __init__(self, symbols: np.ndarray, seed: int = 0):
        up, self.down = powers(len(symbols) + 1, seed)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[: len(symbols)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def byte_symbols(seed: int) -> np.ndarray:
    """A fixed 64-bit value for each byte."""
    return mix(mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT) + np.uint64(seed)) + np.uint64(seed))


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def words(raw: np.ndarray, offs: np.ndarray, letters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte positions of the words ``[^\\x20\\x09-\\x0D]+`` and the
    index of the first word of each row (one more entry than rows).
    ``letters``: words are runs of A-Z, a-z and bytes beyond ASCII instead."""
    inside = _LETTER[raw] if letters else ~_SPACE[raw]
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = inside
    cut = offs[:-1][offs[:-1] < len(raw)]
    joined = before[:-1].copy()
    joined[cut] = False
    starts = np.flatnonzero(inside & ~joined)
    after = np.zeros(len(raw), bool)
    if len(raw):
        after[:-1] = inside[1:]
        ends_at = offs[1:] - 1
        after[ends_at[(ends_at >= 0)]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    return Rolling(byte_symbols(seed)[raw], seed).of(starts, ends)


def window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` keys (length len(keys) - width + 1)."""
    n = len(keys)
    if n < width:
        return keys[:0]
    if width == 1:
        return keys
    pad = -n % width
    top = np.iinfo(keys.dtype).max
    a = np.concatenate([keys, np.full(pad, top, keys.dtype)]).reshape(-1, width)
    head = np.minimum.accumulate(a, axis=1).ravel()
    tail = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[: n - width + 1], head[width - 1: n])
