"""Repeated word windows through minimiser segments (super-k-mers).

A *window* is ``size`` consecutive words of one document.  Consecutive windows
that share the same minimiser (the leftmost smallest hash of their ``gram``-word
runs) form one *segment*, which travels once, as a packed string, to the bucket
of its minimiser: equal windows have equal minimisers, so they always meet.

Flow: ``cut`` (map side) -> shuffle by bucket -> a matcher (``matched``) that
returns the word ranges of later occurrences -> ``remove`` joins the ranges
back to the documents.

Scale and skew.  The number of buckets follows the bytes of the input, so a
bucket is about ``BUCKET_BYTES`` of text whatever the size.  Segments that are
equal inside one slice of a map task are combined before the shuffle: only the
earliest travels and the others are known to repeat, so a group of copies costs
a bucket one row per slice, not one per copy.  A bucket that is larger all the
same is spilled to the task's temporary file and counted in several passes over
window hashes; memory stays bounded and nothing is dropped.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eventlens.llm import words as W

BUCKET_BYTES = 12 << 20
MEMORY_BYTES = 32 << 20
CUT_SCHEMA = "bucket int, n int, raw long, segs binary, text binary, known binary"
HIT_SCHEMA = "id long, th int, lo int, hi int"
NULL_ID = -(2**63)

_codec = pa.Codec("zstd", compression_level=9)
#: Whole texts: a few percent larger, in less than half the time.
TEXT_CODEC = pa.Codec("zstd", compression_level=5)


def pack_bytes(b: bytes, codec: pa.Codec = _codec) -> bytes:
    return len(b).to_bytes(8, "little") + codec.compress(b, asbytes=True)


def unpack_bytes(b: bytes) -> bytes:
    return _codec.decompress(b[8:], int.from_bytes(b[:8], "little"), asbytes=True)


@dataclass
class Segments:
    """Segments of one bucket: the occurrence of each (id, th, start) and its words."""

    id: np.ndarray
    th: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    words: W.Words

    def occurrence_order(self) -> np.ndarray:
        return np.lexsort((self.start, self.th, self.id))


def _pack_segs(cols: list[np.ndarray]) -> bytes:
    return pack_bytes(b"".join(np.ascontiguousarray(c).tobytes() for c in cols))


_SEG_TYPES = (np.int64, np.int32, np.int32, np.int16, np.int16)


def _unpack_segs(blob: bytes, n: int) -> list[np.ndarray]:
    raw, out, at = unpack_bytes(blob), [], 0
    for t in _SEG_TYPES:
        out.append(np.frombuffer(raw, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def cut_slice(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, th: np.ndarray,
              size: int, gram: int, buckets: int) -> Iterator[dict]:
    """Segments of a slice, combined and grouped by bucket, as rows of ``CUT_SCHEMA``."""
    words = W.find_words(data, offsets).joined()
    rows = words.rows
    s = W.window_starts(rows, size)
    if not len(s):
        return
    spans = W.gram_spans(words.hashes())
    g = np.full(int(rows[-1]), np.iinfo(np.uint64).max, np.uint64)
    v = W.window_starts(rows, gram)
    g[v] = spans.hash(v, v + gram)
    anchor = W.leftmost_min(g, size - gram + 1)[s]
    new = np.ones(len(s), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (s[1:] != s[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1
    s0, s1, a = s[first], s[last], anchor[first]
    row = np.searchsorted(rows, s0, "right") - 1
    start = s0 - rows[row]
    sid, sth = ids[row], th[row]
    content = spans.hash(s0, s1 + size)
    raw = words.buf.tobytes()
    begin, stop = words.start[s0], words.end[s1 + size - 1]

    # Equal segments of this slice: the earliest travels, later ones are known to repeat.
    order = np.lexsort((start, sth, sid, content))
    head = np.ones(len(order), bool)
    head[1:] = content[order][1:] != content[order][:-1]
    lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    travels = np.ones(len(order), bool)
    later, lead = order[~head], lead[~head]
    same = np.fromiter((raw[b:e] == raw[c:d] for b, e, c, d in zip(
        begin[later].tolist(), stop[later].tolist(), begin[lead].tolist(), stop[lead].tolist())), bool, len(later))
    later, lead = later[same], lead[same]
    travels[later] = False
    real = (sid[later] != sid[lead]) | (sth[later] != sth[lead]) | (start[later] != start[lead])
    later = later[real]
    known = _pack_hits(sid[later], sth[later], start[later], start[later] + (s1 - s0)[later] + size) if len(later) else None

    bucket = (g[a] % np.uint64(buckets)).astype(np.int32)
    pick = np.flatnonzero(travels)
    pick = pick[np.argsort(bucket[pick], kind="stable")]
    edges = np.flatnonzero(np.append(True, bucket[pick][1:] != bucket[pick][:-1]))
    for lo, hi in zip(edges, np.append(edges[1:], len(pick))):
        p = pick[lo:hi]
        text = b"\n".join([raw[b:e] for b, e in zip(begin[p].tolist(), stop[p].tolist())])
        segs = _pack_segs([sid[p], sth[p], start[p].astype(np.int32), (s1 - s0 + 1)[p].astype(np.int16),
                           (a - s0)[p].astype(np.int16)])
        yield {"bucket": int(bucket[p[0]]), "n": len(p), "raw": len(text), "segs": segs,
               "text": pack_bytes(text), "known": known}
        known = None


def _pack_hits(sid, sth, lo, hi) -> bytes:
    return pack_bytes(b"".join(np.ascontiguousarray(c).tobytes() for c in
                               (sid.astype(np.int64), sth.astype(np.int32), lo.astype(np.int32), hi.astype(np.int32))))


def _unpack_hits(blob: bytes) -> list[np.ndarray]:
    raw = unpack_bytes(blob)
    n, out, at = len(raw) // 20, [], 0
    for t in (np.int64, np.int32, np.int32, np.int32):
        out.append(np.frombuffer(raw, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def _hit_batch(cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
                                      ["id", "th", "lo", "hi"])


class Bucket:
    """Payloads of one bucket, kept compressed and spilled to a temporary file beyond 32 MB."""

    def __init__(self):
        self.file = tempfile.SpooledTemporaryFile(max_size=32 << 20)
        self.entries: list[tuple[int, int, int]] = []
        self.raw = 0

    def add(self, n: int, raw: int, segs: bytes, text: bytes) -> None:
        self.entries.append((n, len(segs), len(text)))
        self.raw += raw + 32 * n
        self.file.write(segs)
        self.file.write(text)

    def parts(self, most: int | None = None) -> Iterator[tuple[list[list[np.ndarray]], list[bytes]]]:
        """Decoded payloads, in groups of about ``most`` bytes (None: all at once)."""
        self.file.seek(0)
        segs, texts, held = [], [], 0
        for n, a, b in self.entries:
            segs.append(_unpack_segs(self.file.read(a), n))
            texts.append(unpack_bytes(self.file.read(b)))
            held += len(texts[-1])
            if most and held >= most:
                yield segs, texts
                segs, texts, held = [], [], 0
        if segs:
            yield segs, texts

    def segments(self, size: int, most: int | None = None) -> Iterator[Segments]:
        for segs, texts in self.parts(most):
            cols = [np.concatenate(c) for c in zip(*segs)]
            buf = np.frombuffer(b"\n".join(texts), np.uint8)
            words = W.find_words(buf, np.array([0, len(buf)]))
            words.rows = np.concatenate(([0], np.cumsum(cols[3].astype(np.int64) + size - 1)))
            yield Segments(*cols, words)


def buckets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Bucket | None, list]]:
    """Consecutive rows of one bucket; ranges already known come first."""
    current, bucket = None, None
    for batch in batches:
        cols = {c: batch.column(c) for c in ("bucket", "n", "raw", "segs", "text", "known")}
        for i in range(batch.num_rows):
            row = {c: v[i].as_py() for c, v in cols.items()}
            if row["known"] is not None:
                yield None, _unpack_hits(row["known"])
            if bucket is None or row["bucket"] != current:
                if bucket is not None:
                    yield bucket, []
                current, bucket = row["bucket"], Bucket()
            bucket.add(row["n"], row["raw"], row["segs"], row["text"])
    if bucket is not None:
        yield bucket, []


def window_table(segs: Segments, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window in occurrence order: its segment, offset in it, and first word."""
    order = segs.occurrence_order()
    n = segs.windows[order].astype(np.int64)
    seg = np.repeat(order, n)
    off = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
    return seg, off, segs.words.rows[seg] + off


def ranges_of(segs: Segments, seg: np.ndarray, off: np.ndarray, size: int) -> list[np.ndarray]:
    """Word ranges covered by windows (``seg``, ``off``), consecutive ones merged; input in that order."""
    if not len(seg):
        return [np.zeros(0, np.int64)] * 4
    new = np.ones(len(seg), bool)
    new[1:] = (seg[1:] != seg[:-1]) | (off[1:] != off[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(seg)) - 1
    s = seg[a]
    return [segs.id[s], segs.th[s], segs.start[s] + off[a], segs.start[s] + off[b] + size]


def repeated_by_sorting(segs: Segments, size: int, part: int = 0, parts: int = 1) -> list[np.ndarray]:
    """Ranges of windows that are not the earliest of their word sequence: sort, then compare runs.

    Only windows whose hash is ``part`` modulo ``parts`` are looked at.  Equal
    hashes are confirmed on the bytes.
    """
    seg, off, at = window_table(segs, size)
    spans = W.gram_spans(segs.words.hashes())
    h = spans.hash(at, at + size)
    if parts > 1:
        pick = h % np.uint64(parts) == np.uint64(part)
        seg, off, at, h = seg[pick], off[pick], at[pick], h[pick]
    if not len(h):
        return [np.zeros(0, np.int64)] * 4
    order = np.argsort(h, kind="stable")
    head = np.ones(len(order), bool)
    hs = h[order]
    head[1:] = hs[1:] != hs[:-1]
    first = np.empty(len(order), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    where = segs.start[seg] + off
    later = np.ones(len(order), bool)
    later[order[head]] = False
    later &= (segs.id[seg] != segs.id[seg[first]]) | (segs.th[seg] != segs.th[seg[first]]) | (where != where[first])
    i = np.flatnonzero(later)
    f = first[i]
    if len(i):
        # Runs of windows that repeat one earlier run are compared as one string.
        new = np.ones(len(i), bool)
        new[1:] = (i[1:] != i[:-1] + 1) | (seg[i][1:] != seg[i][:-1]) | (f[1:] != f[:-1] + 1) | (seg[f][1:] != seg[f][:-1]) \
            | (off[i][1:] != off[i][:-1] + 1) | (off[f][1:] != off[f][:-1] + 1)
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(i)) - 1
        raw, ws, we = segs.words.buf.tobytes(), segs.words.start, segs.words.end
        span = lambda k: (ws[at[k[a]]].tolist(), we[at[k[b]] + size - 1].tolist())
        for k, (x, y, u, v) in enumerate(zip(*span(i), *span(f))):
            if raw[x:y] != raw[u:v]:  # two word sequences with one 64-bit hash
                for j in range(a[k], b[k] + 1):
                    later[i[j]] = _repeats_exactly(raw, ws, we, at, size, h, i[j])
    keep = np.flatnonzero(later)
    return ranges_of(segs, seg[keep], off[keep], size)


def _repeats_exactly(raw, ws, we, at, size, h, i) -> bool:
    text = lambda k: raw[ws[at[k]]:we[at[k] + size - 1]]
    return any(text(k) == text(i) for k in np.flatnonzero(h[:i] == h[i]))


def match_in_passes(bucket: Bucket, size: int) -> Iterator[list[np.ndarray]]:
    """Windows of a bucket of any size, in passes that each hold a bounded share of the windows.

    Within a pass the parts of the bucket are reduced to the pass's windows
    before they are put together, as (word sequence, occurrence) pairs sorted
    on sequence hash and confirmed on the bytes.
    """
    passes = -(-bucket.raw // MEMORY_BYTES)
    for p in range(passes):
        seen: dict[bytes, tuple] = {}
        held = []
        for segs in bucket.segments(size, MEMORY_BYTES // 4):
            seg, off, at = window_table(segs, size)
            h = W.gram_spans(segs.words.hashes()).hash(at, at + size)
            pick = np.flatnonzero(h % np.uint64(passes) == np.uint64(p))
            raw, ws, we = segs.words.buf.tobytes(), segs.words.start, segs.words.end
            for s, o, w in zip(seg[pick].tolist(), off[pick].tolist(), at[pick].tolist()):
                key = raw[ws[w]:we[w + size - 1]]
                me = (int(segs.id[s]), int(segs.th[s]), int(segs.start[s]) + o)
                other = seen.setdefault(key, me)
                if me < other:
                    seen[key] = me
                    held.append(other)
                elif me > other:
                    held.append(me)
            if len(held) > 200_000:
                yield _as_ranges(held, size)
                held = []
        if held:
            yield _as_ranges(held, size)


def _as_ranges(held: list, size: int) -> list[np.ndarray]:
    a = np.array(sorted(held), np.int64)
    new = np.ones(len(a), bool)
    new[1:] = (a[1:, :2] != a[:-1, :2]).any(1) | (a[1:, 2] > a[:-1, 2] + size)
    i = np.flatnonzero(new)
    j = np.append(i[1:], len(a)) - 1
    return [a[i, 0], a[i, 1], a[i, 2], a[j, 2] + size]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns), ``id``, ``th`` (hash of the text) and ``text``: no name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.shiftright(F.xxhash64(F.col(f"`{text_col}`").cast("string")), 32).cast("int").alias("th"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def repeated_ranges(docs: DataFrame, size: int, gram: int,
                    match: Callable[[Segments, int], list[np.ndarray]]) -> DataFrame:
    """Word ranges ``(id, th, lo, hi)`` of ``keyed`` documents that repeat an earlier window."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Segments overlap: a run of w words and (w - gram + 2) / 2 windows for each minimiser.
    buckets = max(1, round(total * (1 + 2 * size / (size - gram + 2)) / BUCKET_BYTES))

    def cut(batches):
        for b in batches:
            data, at = W.string_buffers(b.column("text"))
            ids, th = b.column("id").to_numpy(), b.column("th").to_numpy()
            for i, j in W.slices(at):
                rows = list(cut_slice(data[at[i]:at[j]], at[i:j + 1] - at[i], ids[i:j], th[i:j], size, gram, buckets))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([
                        ("bucket", pa.int32()), ("n", pa.int32()), ("raw", pa.int64()),
                        ("segs", pa.binary()), ("text", pa.binary()), ("known", pa.binary())]))

    def matched(batches):
        for bucket, known in buckets_of(batches):
            if bucket is None:
                yield _hit_batch(known)
            elif bucket.raw > MEMORY_BYTES:
                for hits in match_in_passes(bucket, size):
                    yield _hit_batch(hits)
            else:
                for segs in bucket.segments(size):
                    yield _hit_batch(match(segs, size))

    segs = docs.select("id", "th", "text").mapInArrow(cut, CUT_SCHEMA)
    return segs.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(matched, HIT_SCHEMA)


def _removed(text: pa.Array, spans: pa.Array, one_space: bool) -> pa.StructArray:
    data, at = W.string_buffers(text)
    flat = spans.flatten()
    lo, hi = flat.field("lo").to_numpy(zero_copy_only=False), flat.field("hi").to_numpy(zero_copy_only=False)
    lens = np.nan_to_num(np.asarray(pc.list_value_length(spans).to_numpy(zero_copy_only=False), float)).astype(np.int64)
    span_at = np.concatenate(([0], np.cumsum(lens)))
    n_words, n_removed, bufs, sizes = [], [], [], []
    for i, j in W.slices(at):
        off = at[i:j + 1] - at[i]
        words = W.find_words(data[at[i]:at[j]], off)
        n = len(words.start)
        delta = np.zeros(n + 1, np.int32)
        base = np.repeat(words.rows[:-1], lens[i:j])
        np.add.at(delta, base + lo[span_at[i]:span_at[j]], 1)
        np.add.at(delta, base + hi[span_at[i]:span_at[j]], -1)
        gone = np.cumsum(delta[:-1]) > 0
        left = words.kept(~gone)
        n_words.append(words.counts)
        n_removed.append(words.counts - left.counts)
        if one_space:
            out = left.joined(tail=False)
            ends = np.concatenate(([0], out.end))[out.rows]  # rows without words end where the last one did
            bufs.append(out.buf)
            sizes.append(np.diff(ends))
        else:
            row_end = np.repeat(off[1:], words.counts)
            stop = np.append(words.start[1:], len(words.buf))[:n]
            stop = np.minimum(stop, row_end)
            mark = np.zeros(len(words.buf) + 1, np.int32)
            np.add.at(mark, words.start[gone], 1)
            np.add.at(mark, stop[gone], -1)
            keep = np.cumsum(mark[:-1]) == 0
            total = np.concatenate(([0], np.cumsum(keep)))
            bufs.append(words.buf[keep])
            sizes.append(np.diff(total[off]))
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    ends = np.concatenate(([0], np.cumsum(cat(sizes)))).astype(np.int32)
    body = np.concatenate(bufs) if bufs else np.zeros(0, np.uint8)
    kept = pa.StringArray.from_buffers(len(text), pa.py_buffer(ends.tobytes()), pa.py_buffer(body.tobytes()))
    return pa.StructArray.from_arrays([pa.array(cat(n_words), pa.int64()), pa.array(cat(n_removed), pa.int64()), kept],
                                      ["n_words", "n_removed", "text"])


def remove(docs: DataFrame, hits: DataFrame, one_space: bool) -> DataFrame:
    """``keyed`` documents with ``cut`` (n_words, n_removed, text): the hit words taken out of the text.

    ``one_space``: what is left is joined by single spaces; else the text keeps
    its own separators and texts without hits stay as they are, byte for byte.
    """
    @arrow_udf("n_words long, n_removed long, text string")
    def cut_words(text: pa.Array, spans: pa.Array) -> pa.Array:
        return _removed(text, spans, one_space)

    found = hits.groupBy("id", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return docs.join(found, ["id", "th"], "left").select("row", "id", "text", "spans", cut_words("text", "spans").alias("cut"))
