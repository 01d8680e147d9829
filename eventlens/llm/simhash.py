"""Operator 11: SimHash near-duplicates, pairs discarded by their distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eventlens.llm import graph as G
from eventlens.llm import words as W
from eventlens.session import cut_lineage

SHINGLE = 3
SEED = 42
DISTANCE = 3
REFERENCES = 32
#: Most fingerprints of a bucket that are compared at once; must be 2**12 at least, see ``_split``.
BUCKET = 4096
CHUNK = 1 << 16

#: Reference fingerprints of the distance tables.
_pivots = np.random.Generator(np.random.PCG64(11)).integers(0, 2**64, REFERENCES, dtype=np.uint64)
_ALL = (1 << 64) - 1


def _fingerprint(words: list[bytes]) -> int:
    """The fingerprint of lower-cased words: bits set in over half of the shingle hashes."""
    size = min(SHINGLE, len(words))
    if not size:
        return 0
    n = len(words) - size + 1
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, CHUNK):
        part = words[i:min(i + CHUNK, n) + size - 1]
        line = b" ".join(part)
        end = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        begin = [0, *(end[:-1] + 1).tolist()]
        h = np.array([digest(line[a:b], SEED) for a, b in zip(begin, end[size - 1:].tolist())], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


_LOWER = bytes(W.LOWER)


def _fingerprints(text: pa.Array) -> pa.Array:
    data, at = W.string_buffers(text)
    out = np.zeros(len(text), np.uint64)
    for i, j in W.slices(at):
        raw = data[at[i]:at[j]].tobytes().translate(_LOWER)
        for k in range(i, j):
            # bytes.split cuts at space and \t \n \v \f \r alone.
            out[k] = _fingerprint(raw[at[k] - at[i]:at[k + 1] - at[i]].split())
    return pa.array(out.view(np.int64))


def fingerprint(text):
    """Fingerprint of a text column, as a signed long."""
    return arrow_udf(_fingerprints, "long")(text)


def split_mask(mask: int) -> list[int]:
    """The mask with each quarter of the bits outside it added in turn.

    Fingerprints that agree on the mask and differ in three bits at most agree
    on one of the four quarters as well, so each such pair agrees on one of the results.
    """
    rest = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in rest[k * len(rest) // 4:(k + 1) * len(rest) // 4]) for k in range(4)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: 16 masks of 28 bits: a quarter of the fingerprint, and a quarter of the rest.
MASKS = [m for first in split_mask(0) for m in split_mask(first)]


def _link(fp: np.ndarray, run: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside buckets; rows come by bucket, ``run`` and ``size`` are a row's bucket and its rows.

    The table holds the distances of each fingerprint to the references.  Rows of
    a bucket are sorted by the first; a pair is discarded as soon as one
    coordinate differs by more than three, and what is left is verified.
    """
    table = np.bitwise_count(fp[None, :] ^ _pivots[:, None]).astype(np.int8)
    by = np.lexsort((table[0], run))
    fp, run, size, table = fp[by], run[by], size[by], table[:, by]
    root = np.arange(len(fp))
    # Rows that still have a row ``step`` places on in their bucket, near enough by the first coordinate.
    left, step = np.arange(len(fp)), 1
    while len(left):
        left = left[left + step < len(fp)]
        left = left[run[left] == run[left + step]]
        # Sorted by the first coordinate: once too far, every later row is too.
        left = left[table[0, left + step] - table[0, left] <= DISTANCE]
        a = left
        for coordinate in table[1:]:
            if not len(a):
                break
            a = a[np.abs(coordinate[a + step] - coordinate[a]) <= DISTANCE]
        a = a[np.bitwise_count(fp[a] ^ fp[a + step]) <= DISTANCE]
        b = a + step
        while len(a):
            x, y = root[a], root[b]
            other = x != y
            a, b, x, y = a[other], b[other], x[other], y[other]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
        step += 1
    some = np.flatnonzero(root != np.arange(len(fp)))
    return fp[some], fp[root[some]]


def _out(a, b, mask) -> pa.RecordBatch:
    """Links (mask null), or fingerprints of a bucket that is to be split (in ``a``, with its mask)."""
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(a, np.uint64).view(np.int64)), b if isinstance(b, pa.Array) else pa.array(np.asarray(b, np.uint64).view(np.int64)),
                                       mask], ["a", "b", "mask"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the rows of each bucket; rows come sorted by (mask, key).  A larger bucket is passed on unread."""
    held_m, held_f, over = np.zeros(0, np.int64), np.zeros(0, np.uint64), None

    def later(m, f):
        return _out(f, pa.nulls(len(f), pa.int64()), pa.array(m))

    def done(m, f, run):
        size = np.bincount(run)[run] if len(run) else run
        some = size > 1
        if some.any():
            a, b = _link(f[some], run[some], size[some])
            if len(a):
                yield _out(a, b, pa.nulls(len(a), pa.int64()))

    for batch in batches:
        m = np.concatenate((held_m, batch.column("mask").to_numpy()))
        f = np.concatenate((held_f, batch.column("fp").to_numpy().view(np.uint64)))
        key = f & m.view(np.uint64)
        if over is not None:  # rows of a bucket that is already known to be too large
            rest = int(((m == over[0]) & (key == over[1])).sum())
            if rest:
                yield later(m[:rest], f[:rest])
            if rest < len(m):
                over = None
            m, f, key = m[rest:], f[rest:], key[rest:]
        if not len(m):
            held_m, held_f = m, f
            continue
        head = np.ones(len(m), bool)
        head[1:] = (m[1:] != m[:-1]) | (key[1:] != key[:-1])
        run = np.cumsum(head) - 1
        large = np.bincount(run)[run] > BUCKET
        last = run == run[-1]
        if large.any():
            yield later(m[large], f[large])
            if large[-1]:
                over = (m[-1], key[-1])
        now = ~large & ~last
        yield from done(m[now], f[now], run[now] - (run[now][0] if now.any() else 0))
        hold = last & ~large
        held_m, held_f = m[hold], f[hold]
    if len(held_m):
        yield from done(held_m, held_f, np.zeros(len(held_m), np.int64))


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row under the four finer masks of its mask.

    Masks of 52 bits leave 12, so their buckets hold 2**12 fingerprints at most and are never split.
    """
    for batch in batches:
        m, f = batch.column("mask").to_numpy(), batch.column("fp")
        masks, at = np.unique(m, return_inverse=True)
        finer = np.array([[_signed(x) for x in split_mask(int(v) & _ALL)] for v in masks.tolist()], np.int64).reshape(-1, 4)
        for k in range(4):
            yield pa.RecordBatch.from_arrays([pa.array(finer[at, k]), f], ["mask", "fp"])


def links(prints: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect all fingerprints (column ``fp``, distinct) whose distance is 3 or less.

    Every fingerprint goes to 16 buckets, by the bits of 16 masks; a pair
    within distance 3 meets in one of them at least.  A bucket of over 4,096
    fingerprints is not compared but split by four finer masks, again without
    losing a pair, until it is small; so a task never holds more, and a bucket
    of near copies costs no more than its size.  Inside a bucket, distances to
    32 reference fingerprints are tabled and discard pairs before any is
    verified.  Links are returned as a spanning forest for each bucket.
    """
    masks = F.array(*[F.lit(_signed(m)) for m in MASKS])
    rows = prints.select(F.explode(masks).alias("mask"), "fp")
    edges = None
    while True:
        key = F.col("fp").bitwiseAND(F.col("mask"))
        met = cut_lineage(rows.withColumn("key", key).repartition("mask", "key").sortWithinPartitions("mask", "key")
                              .select("mask", "fp").mapInArrow(_meet, "a long, b long, mask long"))
        now = met.where("mask is null").select("a", "b")
        edges = now if edges is None else edges.unionByName(now)
        more = met.where("mask is not null").select(F.col("mask"), F.col("a").alias("fp"))
        if more.isEmpty():
            return edges
        rows = more.mapInArrow(_split, "mask long, fp long")


def _by_print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each fingerprint of a batch, with the ids that have it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        fp = batch.column("fp").to_numpy()
        by = np.argsort(fp, kind="stable")
        at = np.flatnonzero(np.concatenate(([True], np.diff(fp[by]) != 0)))
        ids = pa.ListArray.from_arrays(pa.array(np.append(at, len(fp)), pa.int32()), batch.column("id").take(pa.array(by)))
        yield pa.RecordBatch.from_arrays([pa.array(fp[by][at]), ids], ["fp", "ids"])


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint, component_id`` for every row of the documents.

    A-Z are lower-cased; words are runs of anything but space and \\t \\n \\v \\f
    \\r; shingles are three words joined by a space, repeats included (fewer
    words: the whole sequence).  A bit of the 64-bit fingerprint (16 hex digits)
    is 1 if it is set in over half of the shingles' XXH64 values (seed 42).
    Documents link if their fingerprints differ in three bits at most;
    ``component_id`` is the smallest id reachable through links.

    Equal fingerprints are one row, with their smallest id, before any bucket is
    formed, so a group of copies costs one row for each task that reads it.

    Defined results: null, empty and wordless texts have fingerprint zero, which
    links like any other; every row comes back, repeated rows with the same
    result; a null id counts in no minimum, and a component of null ids alone has
    a null component_id; extra columns are left out; an empty table gives an empty table.
    """
    base = cut_lineage(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), fingerprint(F.col(f"`{text_col}`").cast("string")).alias("fp")))
    prints = cut_lineage(base.groupBy("fp").agg(F.min("id").alias("least")))
    near = G.components(links(prints.select("fp")))
    grouped = prints.join(near.withColumnRenamed("node", "fp"), "fp")
    classes = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = grouped.join(classes, "component").select("fp", "component_id")
    found = prints.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    # Copies travel as one row a batch, so a fingerprint of most documents is a few rows in its task.
    packed = base.select("fp", "id").mapInArrow(_by_print, "fp long, ids array<long>")
    return packed.join(found, "fp").select("fp", "component_id", F.explode("ids").alias("id")).select("id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
