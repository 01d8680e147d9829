"""Operator 2: removal of long repeated passages with sparse suffix arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import segments as S
from eventlens.llm import words as W

PASSAGE = 50
GRAM = 8


def _columns(codes: np.ndarray, base: np.ndarray, n: np.ndarray, width: int, step: int) -> np.ndarray:
    """Word codes at base, base+step, ... (``n`` of them, then 0) as one row for each suffix."""
    at = base[:, None] + step * np.arange(width)
    ok = np.arange(width) < n[:, None]
    return np.where(ok, codes[np.where(ok, at, 0)], np.uint64(0))


def repeated_by_suffixes(segs: S.Segments, size: int) -> list[np.ndarray]:
    """Ranges of windows that are not the earliest of their word sequence, from sorted sparse suffixes.

    One suffix is kept for each minimiser position (``anchor``).  Suffixes are
    sorted by the words right of the anchor, and neighbours give the lengths of
    common prefixes (LCP).  A window that starts ``o`` words left of the anchor
    equals another exactly if both suffixes lie in one run of LCP >= size - o
    (right extension) and the ``o`` words to the left agree (left extension).
    Suffixes whose neighbours share too little for any window drop out first.
    """
    n = len(segs.id)
    words = segs.words
    h = words.hashes()
    anchor = words.rows[:-1] + segs.anchor
    left = segs.anchor.astype(np.int64)  # words left of the anchor, inside the segment
    right = np.diff(words.rows) - left
    width = int(min(size, right.max()))
    codes = np.ascontiguousarray(_columns(h, anchor, right, width, 1))
    key = codes.astype(">u8").tobytes()
    keys = [key[i:i + 8 * width] for i in range(0, 8 * width * n, 8 * width)]
    order = np.array(sorted(range(n), key=keys.__getitem__), np.int64)
    del key, keys
    same = codes[order[1:]] == codes[order[:-1]]
    lcp = np.where(same.all(1), width, np.argmin(same, 1)) if n > 1 else np.zeros(0, np.int64)
    link = lcp >= size - left.max()  # fewer common words cannot belong to one window
    joined = np.zeros(n, bool)
    joined[1:] |= link
    joined[:-1] |= link
    pick = np.flatnonzero(joined)
    if not len(pick):
        return [np.zeros(0, np.int64)] * 4
    step = np.concatenate(([0], lcp))  # common words with the suffix before
    m = order[pick]
    # LCP with the previous *retained* suffix: the least on the way there.
    common = np.minimum.reduceat(step[:pick[-1] + 1], np.concatenate(([0], pick[:-1] + 1)))
    rank = np.empty(n, np.int64)
    rank[segs.occurrence_order()] = np.arange(n)
    rank = rank[m]
    low = left[m] - segs.windows[m] + 1  # offsets o of this suffix's windows: low..left
    spans = W.gram_spans(h)
    found_seg, found_off = [], []
    for o in range(int(low.min()), int(left[m].max()) + 1):
        has = (low <= o) & (o <= left[m])
        run = np.cumsum(common < size - o)
        i = np.flatnonzero(has)
        if len(i) < 2:
            continue
        a = anchor[m[i]]
        lh = spans.hash(a - o, a) if o else np.zeros(len(i), np.uint64)
        by = np.lexsort((rank[i], lh, run[i]))
        head = np.ones(len(by), bool)
        r, l = run[i][by], lh[by]
        head[1:] = (r[1:] != r[:-1]) | (l[1:] != l[:-1])
        first = by[np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))]
        s, f = m[i[by]], m[i[first]]
        where = segs.start[s] + left[s] - o
        later = ~head & ((segs.id[s] != segs.id[f]) | (segs.th[s] != segs.th[f]) | (where != segs.start[f] + left[f] - o))
        found_seg.append(s[later])
        found_off.append(left[s[later]] - o)
    if not found_seg:
        return [np.zeros(0, np.int64)] * 4
    seg, off = np.concatenate(found_seg), np.concatenate(found_off)
    by = np.lexsort((off, seg))
    return S.ranges_of(segs, seg[by], off[by], size)


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   passage: int = PASSAGE, gram: int = GRAM) -> DataFrame:
    """Take out of ``text`` every passage of ``passage`` words or more that also starts earlier.

    Sparse suffix array: only suffixes at minimiser positions are retained, and
    any two equal passages retain a suffix at the same place.  The suffixes meet
    in the bucket of their minimiser, are sorted, compared with their
    neighbours, and matches are extended right and left to whole passages; the
    result equals that of a full suffix array (words are compared by 64-bit
    hashes).  A bucket beyond the memory bound is counted window by window in
    passes, with the same result.

    Returns the input columns with the shortened text in place (texts without
    repeats stay byte for byte; separators of kept words stay) and ``n_words``,
    ``n_removed`` and ``spans`` (lo, hi in words, sorted, merged) added; columns
    of these names are replaced.  The first occurrence, by id and position,
    always stays.

    Defined results: null text stays null (0 words); empty and short texts stay.
    A null id counts as the smallest id.  Rows that repeat an id and text are
    one document and get the same result; rows that repeat an id with another
    text are separate documents, ordered by a hash of the text.  An empty table
    gives an empty table.
    """
    keyed = S.keyed(docs, id_col, text_col)
    hits = S.repeated_ranges(keyed, passage, gram, repeated_by_suffixes)
    out = S.remove(keyed, hits, one_space=False)
    own = ("n_words", "n_removed", "spans")
    text = F.when(F.col("text").isNull(), F.lit(None).cast("string")).otherwise(F.col("cut.text"))
    cols = [text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in own]
    merged = F.aggregate(
        F.array_sort(F.coalesce("spans", F.array().cast("array<struct<lo:int,hi:int>>"))),
        F.array().cast("array<struct<lo:int,hi:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["hi"] >= x["lo"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["lo"].alias("lo"), F.greatest(F.element_at(acc, -1)["hi"], x["hi"]).alias("hi")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"))))))
    return out.select(*cols, F.col("cut.n_words").alias("n_words"), F.col("cut.n_removed").alias("n_removed"),
                      merged.alias("spans"))
