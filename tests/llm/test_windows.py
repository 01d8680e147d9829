"""Operators 2 and 10 against brute force over all windows."""

import re
from collections import defaultdict

import pytest

from llm_helpers import near_texts, rows_of
from eventlens.llm import segments, substring, suffix
from eventlens.llm.substring import dedup_substrings
from eventlens.llm.suffix import dedup_passages

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, size):
    """(doc_id, text) -> (number of words, removed word positions, words)."""
    first = {}
    out = []
    for d, t in sorted(docs, key=lambda x: x[0]):
        w = WORDS.findall(t or "")
        gone = set()
        for i in range(len(w) - size + 1):
            if first.setdefault(tuple(w[i:i + size]), (d, i)) != (d, i):
                gone.update(range(i, i + size))
        out.append((d, w, gone))
    return {d: (w, gone) for d, w, gone in out}


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


@pytest.mark.parametrize("seed", range(3))
def test_substrings(spark, seed):
    docs = list(enumerate(near_texts(seed)))
    want = brute(docs, 20)
    got = rows_of(dedup_substrings(frame(spark, docs).repartition(5)))
    assert len(got) == len(docs) and any(r["n_removed"] for r in got)
    for r in got:
        w, gone = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"]) == (len(w), len(gone)), r["doc_id"]
        assert r["kept_text"] == " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("seed,size,gram", [(0, 50, 8), (1, 50, 8), (2, 20, 5), (3, 12, 3)])
def test_passages(spark, seed, size, gram):
    docs = list(enumerate(near_texts(seed, n=60)))
    want = brute(docs, size)
    got = rows_of(dedup_passages(frame(spark, docs).repartition(3), passage=size, gram=gram))
    assert len(got) == len(docs) and any(r["n_removed"] for r in got)
    for r in got:
        w, gone = want[r["doc_id"]]
        assert {i for s in r["spans"] for i in range(s["lo"], s["hi"])} == gone, r["doc_id"]
        assert (r["n_words"], r["n_removed"]) == (len(w), len(gone))
        assert WORDS.findall(r["text"]) == [x for i, x in enumerate(w) if i not in gone]
        if not gone:
            assert r["text"] == docs[r["doc_id"]][1]


@pytest.mark.parametrize("op", [dedup_substrings, dedup_passages])
def test_small_buckets_and_passes(spark, op, monkeypatch):
    docs = list(enumerate(near_texts(7, n=80)))
    whole = {r["doc_id"]: r["n_removed"] for r in rows_of(op(frame(spark, docs)))}
    # many buckets
    monkeypatch.setattr(segments, "BUCKET_BYTES", 500)
    assert whole == {r["doc_id"]: r["n_removed"] for r in rows_of(op(frame(spark, docs)))}


def test_passes_equal_one_sort(spark):
    """The path for oversized buckets gives the ranges of the usual one."""
    import numpy as np
    import pyarrow as pa
    from eventlens.llm import words as W
    texts = near_texts(11, n=60)
    data, at = W.string_buffers(pa.array(texts))
    rows = list(segments.cut_slice(data, at, np.arange(60), np.zeros(60, np.int32), 20, 6, 1))
    b = segments.Bucket()
    for r in rows:
        b.add(r["n"], r["raw"], r["segs"], r["text"])

    def cover(hits):
        out = defaultdict(set)
        for cols in hits:
            for d, _, lo, hi in zip(*[c.tolist() for c in cols]):
                out[d].update(range(lo, hi))
        return out

    [segs] = b.segments(20)
    one = cover([segments.repeated_by_sorting(segs, 20)])
    old = segments.MEMORY_BYTES
    try:
        segments.MEMORY_BYTES = 4000
        assert cover(segments.match_in_passes(b, 20)) == one
    finally:
        segments.MEMORY_BYTES = old
    [segs] = b.segments(20)
    assert cover([suffix.repeated_by_suffixes(segs, 20)]) == one


@pytest.mark.parametrize("op", [dedup_substrings, dedup_passages])
def test_edges(spark, op):
    long = " ".join(f"x{i}" for i in range(20000))
    df = spark.createDataFrame(
        [(1, None, "a", 1), (2, "", "a", 1), (3, " \n ", None, 2), (None, long, "b", 3), (5, long, "b", 3), (5, long, "b", 3),
         (6, long + " tail", None, None), (7, "short text", "c", 1)], "doc_id long, text string, th string, spans int")
    got = {(r["doc_id"], i): r for i, r in enumerate(sorted(rows_of(op(df)), key=lambda r: r["doc_id"] or 0))}
    assert len(got) == 8
    by = defaultdict(list)
    for r in got.values():
        by[r["doc_id"]].append((r["n_words"], r["n_removed"], r["th"]))
    assert by[1] == [(0, 0, "a")] and by[2] == [(0, 0, "a")] and by[3] == [(0, 0, None)]
    assert by[None] == [(20000, 0, "b")] and by[5] == [(20000, 20000, "b")] * 2
    assert by[6] == [(20001, 20000, None)] and by[7] == [(2, 0, "c")]
    assert op(df.limit(0)).collect() == []


def test_repeated_rows_do_not_remove_themselves(spark):
    t = " ".join(f"y{i}" for i in range(100))
    got = rows_of(dedup_substrings(frame(spark, [(1, t), (1, t), (1, t + " z")])))
    assert sorted((r["n_words"], r["n_removed"]) for r in got) in ([(100, 0), (100, 0), (101, 100)], [(100, 100), (100, 100), (101, 0)])
