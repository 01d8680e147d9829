"""Connected components over an edge table, and streaming helpers for sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.session import cut_lineage

EDGE = "a long, b long"


def grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys as one table; rows must arrive sorted by the keys."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for i, j in zip(edges[:-1], edges[1:]):
            key = tuple(c[i] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(i, j - i))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def first_of_run(key: np.ndarray, value: np.ndarray, carry: tuple | None) -> tuple[np.ndarray, tuple | None]:
    """For sorted keys, the first value of each row's run; ``carry`` is the last run of the batch before."""
    if not len(key):
        return value, carry
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    first = value[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
    if carry is not None and key[0] == carry[0]:
        first = np.where(key == carry[0], carry[1], first)
    return first, (key[-1], first[-1])


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _large_star(batches):
    """Larger neighbours of ``a`` point to the least of its neighbourhood; rows come sorted by (a, b)."""
    carry = None
    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        least, carry = first_of_run(a, b, carry)
        up = b > a
        yield _edges(b[up], np.minimum(least, a)[up])


def _small_star(batches):
    """``a`` and its smaller neighbours point to the least of them; rows come sorted by (a, b), b < a."""
    carry = None
    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        least, carry = first_of_run(a, b, carry)
        other = b != least
        yield _edges(np.concatenate((a, b[other])), np.concatenate((least, least[other])))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of an undirected edge table ``(a, b)``; the component is its least node.

    Alternates large-star and small-star steps until the edges are stars.  Each
    step sorts the edges of a node and streams over them, so a node with any
    number of neighbours takes constant memory and no join is skewed.  Rounds
    grow with the logarithm of the longest path; each is checkpointed.
    """
    now = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if state == seen or not state["n"]:
            break
        seen = state
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.repartition("a").sortWithinPartitions("a", "b").mapInArrow(_large_star, EDGE).distinct()
        small = large.repartition("a").sortWithinPartitions("a", "b").mapInArrow(_small_star, EDGE).distinct()
        now = cut_lineage(small)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
