"""Operator 5: benchmark decontamination by winnowing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eventlens.llm import words as W
from eventlens.session import cut_lineage

WINDOW = 10
#: The test side's fingerprints as a bitmap: 2 MB, whatever the size of the benchmark.
BITS = 1 << 24
#: Largest test side, in windows, that is broadcast (about 16 MB); above, the join shuffles.
BROADCAST_WINDOWS = 100_000


def _fingerprints(words: W.Words, spans: W.Spans, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``size`` words and the smallest k-gram hash inside each.

    k-grams have half the window's words; two equal windows select the same
    k-gram, so every shared span of ``size`` words shares a fingerprint.
    """
    k = max(1, size // 2)
    s = W.window_starts(words.rows, size)
    g = np.full(int(words.rows[-1]), np.iinfo(np.uint64).max, np.uint64)
    v = W.window_starts(words.rows, k)
    g[v] = spans.hash(v, v + k)
    return s, W.mix(g[W.leftmost_min(g, size - k + 1)[s]] + np.uint64(size))


def _list_of(fields: dict[str, pa.Array], counts: np.ndarray) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(list(fields.values()), list(fields)))


def _lower_words(data: np.ndarray, offsets: np.ndarray) -> W.Words:
    return W.find_words(W.LOWER[data], offsets, W.ALNUM).joined()


def _texts(words: W.Words, s: np.ndarray, size: int) -> list[bytes]:
    raw = words.buf.tobytes()
    return [raw[b:e] for b, e in zip(words.start[s].tolist(), words.end[s + size - 1].tolist())]


def _item_windows(text: pa.Array) -> pa.Array:
    """Windows of benchmark items: all runs of WINDOW words, or the whole of a shorter item."""
    out = []
    data, at = W.string_buffers(text)
    for i in range(len(text)):
        words = _lower_words(data[at[i]:at[i + 1]], np.array([0, at[i + 1] - at[i]]))
        size = min(WINDOW, len(words.start))
        if not size:
            out.append([])
            continue
        s, fp = _fingerprints(words, W.gram_spans(words.hashes()), size)
        out.append([{"n": size, "fp": f, "window": t.decode()} for f, t in zip(fp.astype(np.int64).tolist(), _texts(words, s, size))])
    return pa.array(out, pa.list_(pa.struct([("n", pa.int32()), ("fp", pa.int64()), ("window", pa.string())])))


def _candidate_udf(sizes: list[int], bitmap):
    def candidates(text: pa.Array) -> pa.Array:
        bits = bitmap.value
        n_words, counts, start, n, texts = [], [], [], [], []
        data, at = W.string_buffers(text)
        for i, j in W.slices(at):
            words = _lower_words(data[at[i]:at[j]], at[i:j + 1] - at[i])
            spans = W.gram_spans(words.hashes())
            row, first, size_of, text_of = [], [], [], []
            for size in sizes:
                s, fp = _fingerprints(words, spans, size)
                b = fp % np.uint64(BITS)
                s = s[(bits[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 > 0]
                r = np.searchsorted(words.rows, s, "right") - 1
                row.append(r)
                first.append(s - words.rows[r])
                size_of.append(np.full(len(s), size))
                text_of += _texts(words, s, size)
            row = np.concatenate(row)
            by = np.argsort(row, kind="stable")
            n_words.append(words.counts)
            counts.append(np.bincount(row, minlength=j - i))
            start.append(np.concatenate(first)[by])
            n.append(np.concatenate(size_of)[by])
            texts += [text_of[k] for k in by.tolist()]
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        found = _list_of({"start": pa.array(cat(start), pa.int32()), "n": pa.array(cat(n), pa.int32()),
                          "window": pa.array(texts, pa.binary()).cast(pa.string())}, cat(counts))
        return pa.StructArray.from_arrays([pa.array(cat(n_words), pa.int64()), found], ["n_words", "found"])
    return arrow_udf(candidates, "struct<n_words:long,found:array<struct<start:int,n:int,window:string>>>")


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, n, fp, window)`` of every benchmark item; an item of null or wordless text has none."""
    windows = arrow_udf(_item_windows, "array<struct<n:int,fp:long,window:string>>")
    return items.select(F.col(f"`{id_col}`").alias("item_id"), F.explode(windows(F.col(f"`{text_col}`").cast("string"))).alias("w")) \
                .select("item_id", "w.*")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Bitmap of fingerprints, or-ed on the executors; at most BITS / 32 rows reach the driver."""
    bit = F.col("fp").bitwiseAND(F.lit(BITS - 1)).cast("int")
    rows = windows.select(bit.alias("b")).select(F.shiftright("b", 5).alias("w"), F.expr("shiftleft(1L, b & 31)").alias("v")) \
                  .groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    out = np.zeros(BITS // 32, np.uint32)
    out[rows["w"].to_numpy()] = rows["v"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: ``id, th, n_words, n_hit, items, spans, contaminated``.

    A-Z are lower-cased; words are runs of letters, digits and non-ASCII
    characters.  A window is 10 consecutive words of an item (all of a shorter
    one); a document word inside any occurrence of a window is hit.

    Both sides keep the smallest k-gram hash of each window (winnowing); since
    equal windows select equal k-grams, no shared window is missed.  The test
    side's fingerprints form a bitmap of fixed size that thins the training
    side inside the scan; what passes is joined with the test windows on the
    window's words and extended to hit ranges.  So the documents are read once
    and never shuffled, and only candidate windows move.  The test side is
    broadcast while it is under BROADCAST_WINDOWS windows, else joined by
    shuffle.

    ``id, th`` identify a document (id, null as the smallest long, and a hash of
    its text); ``items`` are the distinct ids of items with an occurring window,
    sorted as strings; ``spans`` the hit word ranges.

    Defined results: null, empty or wordless text -> 0 words, no hits.  Items
    without words hit nothing.  Repeated rows each get their row.  Items that
    repeat an id count once.  Null item ids count as ''.  Empty tables: no
    documents -> no rows; no items -> no hits.
    """
    spark = docs.sparkSession
    tests = cut_lineage(item_windows(items, item_id, item_text))
    sizes = sorted(r[0] for r in tests.select("n").distinct().collect())  # 1..WINDOW
    n_windows = tests.count()
    key = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(2**63))).alias("id"),
                      F.shiftright(F.xxhash64(F.col(f"`{text_col}`").cast("string")), 32).cast("int").alias("th"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    bitmap = spark.sparkContext.broadcast(_bitmap(tests))
    udf = _candidate_udf(sizes or [WINDOW], bitmap)
    found = cut_lineage(key.select("id", "th", udf("text").alias("c")).select("id", "th", "c.n_words", "c.found"))
    lookup = tests.select(F.col("window").alias("_window"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
    if n_windows <= BROADCAST_WINDOWS:
        lookup = F.broadcast(lookup)
    hits = found.select("id", "th", F.explode("found").alias("f")).select("id", "th", "f.*") \
                .join(lookup, F.col("window") == F.col("_window")) \
                .groupBy("id", "th").agg(F.collect_set(F.struct(F.col("start").alias("lo"), (F.col("start") + F.col("n")).alias("hi"))).alias("r"),
                                         F.array_sort(F.collect_set("item")).alias("items"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(F.array_sort("r"), zero, lambda acc, x: F.struct(
        F.greatest(acc["end"], x["hi"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), x["hi"] - F.greatest(x["lo"], acc["end"]))).alias("n")), lambda acc: acc["n"])
    hits = hits.select("id", "th", covered.alias("n_hit"), "items", F.array_sort("r").alias("spans"))
    return found.select("id", "th", "n_words").join(hits, ["id", "th"], "left").select(
        "id", "th", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<lo:int,hi:int>>")).alias("spans"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without any hit, with their columns; all others go.  Cases as in ``contamination``."""
    bad = contamination(docs, items, id_col, text_col, item_id, item_text).where("contaminated").select("id", "th").distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(2**63))).alias("id"),
                      F.shiftright(F.xxhash64(F.col(f"`{text_col}`").cast("string")), 32).cast("int").alias("th"))
    return row.join(bad, ["id", "th"], "left_anti").select("row.*")
