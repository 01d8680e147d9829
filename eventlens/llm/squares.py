"""Operator 12: periodic runs of words, caught block by block."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eventlens.llm import words as W

LEAST = 6  # words of a run
TIMES = 4  # periods of a run


def _after(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows of twice the width, from those of a width."""
    return W.mix(h[:-width] * np.uint64(0x9E3779B97F4A7C15) + h[width:])


def catch_runs(seq: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of ``seq`` with its smallest period, at least 6 long and 4 periods.

    ``seq`` holds word numbers, ``longest`` bounds the length of a run.  For
    every level k the sequence is cut into blocks of 2**k.  A completed block
    is a catcher for the periods of its level, 2**k to 2**(k+1) - 1: the word
    appended at i + 2**k - 1 completes the window that starts at i, and exactly
    one catcher, the block before that of i, is that far back.  If the window
    equals the catcher's block, the two are a repeat with period q = i - block.
    A run of four periods holds several whole blocks in sequence, so a catch
    counts if enough blocks in sequence caught the same period; they merge into
    one run, which reaches less than a block beyond them on either side, where
    words are compared one by one.  All words of the sequence advance together,
    one level at a time: n comparisons a level, n log n in all.

    Windows are compared by hash and every run then word by word, so hashes
    never decide a result.  Levels go up, and a catch inside a run with a
    smaller period is skipped: by the periodicity lemma it is that run again.
    """
    found: set[tuple[int, int, int]] = set()
    n = len(seq)
    reach = np.zeros(n, np.int64)  # how far the runs of lower levels reach from each word
    h = W.mix(seq.astype(np.uint64) + np.uint64(0x1234567))
    width, k = 1, 0
    while TIMES * width <= longest and len(h) >= 2 * width:
        blocks = -(-len(h) // width)
        grid = np.zeros((blocks, width), np.uint64)  # no window has hash 0
        grid.ravel()[:len(h)] = h
        b, r = np.nonzero(grid[1:] == grid[:-1, :1])
        by = np.argsort(r * np.int64(blocks + 1) + b, kind="stable")
        b, r = b[by], r[by]
        head = np.ones(len(b), bool)
        head[1:] = (np.diff(b) != 1) | (np.diff(r) != 0)
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(b)))
        q = width + r[at]
        least = np.maximum(LEAST, TIMES * q) - q  # words that equal the one a period later
        start, end = b[at] << k, (b[at] + size) << k
        some = (size >= (least + 1) // width - 1) & (size > 0)
        some[some] &= reach[start[some]] < end[some] + q[some]
        new = []
        for s, e, p, m in zip(start[some].tolist(), end[some].tolist(), q[some].tolist(), least[some].tolist()):
            lo, hi = max(0, s - width), min(n - p, e + width)
            same = np.zeros(hi - lo + 2, bool)
            same[1:-1] = seq[lo:hi] == seq[lo + p:hi + p]
            step = np.flatnonzero(same[1:] != same[:-1])
            for a, z in zip(step[::2].tolist(), step[1::2].tolist()):
                if z - a >= m:
                    new.append((lo + a, z - a + p, p))
        for a, length, p in new:
            found.add((a, length, p))
            np.maximum(reach[a:a + length], a + length, out=reach[a:a + length])
        if len(h) <= 2 * width:
            break
        h = _after(h, width)
        width, k = 2 * width, k + 1
    return sorted((a, length, p) for a, length, p in found)


def _numbered(rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all rows with a number of its own after each row, and where the rows begin."""
    number: dict[bytes, int] = {}
    total = sum(map(len, rows)) + len(rows)
    seq, begin, at = np.empty(total, np.int64), np.zeros(len(rows), np.int64), 0
    for i, row in enumerate(rows):
        begin[i] = at
        seq[at:at + len(row)] = np.fromiter((number.setdefault(w, len(number)) for w in row), np.int64, len(row))
        at += len(row) + 1
        seq[at - 1] = total + i
    return seq, begin


def _runs(text: pa.Array) -> pa.Array:
    """Words, runs and collapsed text of each text."""
    data, at = W.string_buffers(text)
    n, size, flat, out = [], [], [], []
    for i, j in W.slices(at):
        raw = data[at[i]:at[j]].tobytes()
        # bytes.split cuts at space and \t \n \v \f \r alone.
        rows = [raw[a - at[i]:b - at[i]].split() for a, b in zip(at[i:j].tolist(), at[i + 1:j + 1].tolist())]
        seq, begin = _numbered(rows)
        caught = np.array(catch_runs(seq, max(map(len, rows))), np.int64).reshape(-1, 3)
        cut = np.searchsorted(caught[:, 0], np.append(begin, len(seq)))
        for row, first, a, b in zip(rows, begin.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
            n.append(len(row))
            size.append(b - a)
            if a < b:
                own = caught[a:b] - np.array([first, 0, 0])
                flat.append(own)
                keep = np.ones(len(row), bool)
                for start, length, period in own.tolist():
                    keep[start + period:start + length] = False
                row = [row[x] for x in np.flatnonzero(keep).tolist()]
            out.append(b" ".join(row))
    table = np.concatenate(flat) if flat else np.zeros((0, 3), np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)),
                                     pa.StructArray.from_arrays([pa.array(table[:, x]) for x in range(3)], ["start", "length", "period"]))
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), lists, pa.array(out, pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])


_RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are runs of anything but space and \\t \\n \\v \\f \\r, numbered from 0.
    A run is a stretch of words with smallest period q (words q apart are the
    same) and at least max(6, 4 q) words that no neighbouring word extends.
    ``collapsed`` joins by one space the words that no run holds after its
    first q.  Each text is worked on where it is read: nothing is shuffled, and
    a copy costs what any text costs.

    Defined results: null, empty and wordless texts have no words, no runs and
    the empty string; runs may overlap, a word goes if any of them drops it;
    repeated rows get the same result; ids are not looked at; columns with these
    names are replaced; an empty table gives an empty table.
    """
    own = ("n_words", "runs", "collapsed")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       arrow_udf(_runs, _RESULT)(F.col(f"`{text_col}`").cast("string")).alias("s"))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in own], *[F.col(f"s.{c}").alias(c) for c in own])
