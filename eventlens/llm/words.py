"""Vectorised word kernels over Arrow string columns.

A batch of texts is one byte buffer plus row offsets.  Words are maximal runs
of "word" bytes (a 256-entry table), found with a handful of numpy passes; no
Python object is made per word.  Hashes are 64-bit polynomials over randomly
mapped bytes, taken from one running sum, so any span costs two look-ups.

All kernels work on slices of bounded size (``slices``), so a task's memory
does not grow with the batch; a single longer text forms a slice by itself.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
#: Random odd 64-bit value for each byte, and the multipliers of the two sums.
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = int(_rng.integers(1, 2**62)) * 4 + 3
_Q = int(_rng.integers(1, 2**62)) * 4 + 3

# Separators of plain words: space and \t \n \v \f \r.
PLAIN = np.ones(256, dtype=bool)
PLAIN[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

# Words of letters, digits and all non-ASCII bytes (text is lower-cased first).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def hand_back() -> None:
    """Give memory that a task has freed back to the system: workers wait between tasks, next to the executor's own memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def handing_back(run):
    """``run`` over the batches of a partition, and ``hand_back`` at its end."""
    @functools.wraps(run)
    def done(batches):
        yield from run(batches)
        hand_back()
    return done


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, b, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = Powers(_R), Powers(_Q)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value (never 0)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    h[h == 0] = 1
    return h


class Spans:
    """Hashes of arbitrary spans of a sequence of 64-bit codes."""

    def __init__(self, codes: np.ndarray, powers: Powers):
        up, self.down = powers.get(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[:-1], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold ``most`` bytes at most, or one row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def merged(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive batches as one, up to ``most`` bytes of ``column`` together, so that a batch's end does not cut a slice short."""
    held, size = [], 0
    for b in batches:
        n = b.column(column).nbytes
        if held and size + n > most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if b.num_rows:
            held.append(b)
            size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def even_slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges as few as ``slices`` of ``most`` bytes need, of about equal bytes: none is a small rest."""
    total = int(offsets[-1] - offsets[0])
    longest = int(np.diff(offsets).max(initial=0))
    return slices(offsets, min(most, total // max(1, -(-total // most)) + longest))


@dataclass
class Words:
    """Words of some rows: byte spans in ``buf`` and ``rows`` (first word of each row, and the end)."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    rows: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, worked out over about ``SLICE_BYTES`` at a time."""
        n = len(self.start)
        out = np.empty(n, np.uint64)
        i = 0
        while i < n:
            a = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, a + SLICE_BYTES, "right")))
            codes = BYTE_CODE[self.buf[a:int(self.end[j - 1])]]
            out[i:j] = Spans(codes, _BYTES).hash(self.start[i:j] - a, self.end[i:j] - a)
            i = j
        return out

    def joined(self, tail: bool = True) -> Words:
        """The same words with exactly one space after each (``tail``: also a row's last), as a new buffer."""
        lens = self.end - self.start
        gap = np.ones(len(lens), np.int64)
        if not tail:
            gap[self.rows[1:][self.counts > 0] - 1] = 0
        off = np.zeros(len(lens) + 1, np.int64)
        np.cumsum(lens + gap, out=off[1:])
        out = np.full(off[-1], 0x20, np.uint8)
        total, before = int(lens.sum()), np.cumsum(lens) - lens
        at = np.arange(total)
        out[np.repeat(off[:-1] - before, lens) + at] = self.buf[np.repeat(self.start - before, lens) + at]
        return Words(out, off[:-1], off[:-1] + lens, self.rows)

    def kept(self, keep: np.ndarray) -> Words:
        """Only the words marked in ``keep``."""
        rows = np.zeros(len(self.rows), np.int64)
        rows[1:] = np.cumsum(keep)[self.rows[1:] - 1] if len(keep) else 0
        rows[self.rows == 0] = 0
        return Words(self.buf, self.start[keep], self.end[keep], rows)


def find_words(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray = PLAIN) -> Words:
    """Words of rows ``offsets`` (relative to ``buf``); a row's end also ends a word."""
    inside = table[buf]
    prev = np.zeros(len(buf) + 1, bool)
    prev[1:] = inside
    nxt = np.zeros(len(buf) + 1, bool)
    nxt[:-1] = inside
    prev[offsets] = False
    nxt[offsets] = False
    start = np.flatnonzero(inside & ~prev[:-1])
    end = np.flatnonzero(inside & ~nxt[1:]) + 1
    return Words(buf, start, end, np.searchsorted(start, offsets))


def gram_spans(hashes: np.ndarray) -> Spans:
    """Hashes of runs of consecutive words, from word hashes."""
    return Spans(hashes, _WORDS)


def window_starts(rows: np.ndarray, size: int) -> np.ndarray:
    """Index of every word that starts a run of ``size`` words inside its row."""
    n = int(rows[-1])
    room = np.repeat(rows[1:], np.diff(rows)) - np.arange(n)
    return np.flatnonzero(room >= size)


def leftmost_min(values: np.ndarray, width: int) -> np.ndarray:
    """For each i, the leftmost position of the minimum of ``values[i:i+width]`` (cut at the end)."""
    n = len(values)
    pos = np.arange(n)
    val = values.copy()
    span = 1
    while span < width:
        step = min(span, width - span)
        if step >= n:
            break
        right = val[step:] < val[:-step]
        val[:-step] = np.where(right, val[step:], val[:-step])
        pos[:-step] = np.where(right, pos[step:], pos[:-step])
        span += step
    return pos
