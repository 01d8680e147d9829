"""Operator 8: language identification with segmentation-marginalised unigrams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eventlens.llm import words as W
from eventlens.llm.pieces import NORMAL, read_pieces
from eventlens.session import cut_lineage

#: Documented bound of the classifier's training sample: documents of each language, about.
SAMPLE = 3000
ROUNDS = 3
FLOOR = 1e-7  # probability of a piece or byte that a language never showed
MAX_PIECE = 64  # bytes; a vocabulary with a longer piece is refused, none is left out
EVEN = 32  # words up to this many bytes meet words of their own length; longer ones words of about their length
UNKNOWN_LANGUAGE = "und"


class Pieces:
    """The fixed vocabulary as a hash table over byte strings, plus the 256 single bytes."""

    def __init__(self, path: str | None = None):
        found = {}
        for p in read_pieces(path):
            raw = p.text.replace("▁", " ").encode()
            if p.kind == NORMAL and (" " not in p.text.replace("▁", " ")[1:]):
                found.setdefault(raw, len(found))
        for b in range(256):
            found.setdefault(bytes([b]), len(found))
        self.n = len(found)
        keys = list(found)
        self.lengths = sorted({len(k) for k in keys})
        if self.lengths[-1] > MAX_PIECE:
            raise ValueError(f"a piece of {self.lengths[-1]} bytes; at most {MAX_PIECE} are handled")
        buf = np.frombuffer(b"".join(keys), np.uint8)
        ends = np.cumsum([len(k) for k in keys])
        h = W.Words(buf, ends - np.array([len(k) for k in keys]), ends, np.array([0, len(keys)])).hashes()
        bits = 20
        self.shift = np.uint64(64 - bits)
        # Open addressing: slots hold (hash, piece).
        self.slots = np.zeros((1 << bits) + 64, np.uint64)
        self.piece = np.full((1 << bits) + 64, -1, np.int32)
        for i, x in enumerate(h):
            s = int(x >> self.shift)
            k = 0
            while self.piece[s + k] >= 0:
                k += 1
            self.slots[s + k], self.piece[s + k] = x, i

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, or -1."""
        s = (h >> self.shift).astype(np.int64)
        held = self.piece[s]
        same = self.slots[s] == h
        out = np.where(same, held, -1)
        # A key lies before the first empty slot after its own.
        go = np.flatnonzero((held >= 0) & ~same)
        k = 0
        while go.size:
            k += 1
            at = s[go] + k
            held, same = self.piece[at], self.slots[at] == h[go]
            out[go[same]] = held[same]
            go = go[(held >= 0) & ~same]
        return out


def distinct_words(data: np.ndarray, offsets: np.ndarray) -> tuple[W.Words, np.ndarray, np.ndarray]:
    """Words of a slice, the index of each distinct one, and for every word which distinct one it is."""
    words = W.find_words(data, offsets)
    _, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
    return words, first, inverse


class Lattice:
    """Pieces inside words of ``n`` bytes at most, each with a space before it.

    What follows a shorter word is read along and left aside by its reader.
    """

    def __init__(self, buf: np.ndarray, start: np.ndarray, n: int, pieces: Pieces):
        m = len(start)
        text = np.empty((m, n + 1), np.uint8)
        text[:, 0] = 0x20
        text[:, 1:] = buf[np.minimum(start[:, None] + np.arange(n), len(buf) - 1)]
        flat = W.Spans(W.BYTE_CODE[text].ravel(), W._BYTES)
        base = np.arange(m) * (n + 1)
        self.sizes = [size for size in reversed(pieces.lengths) if size <= n + 1]
        self.held = {}
        step = max(1, (1 << 18) // max(1, m))  # positions at a time
        for size in self.sizes:
            words, found, counts = [], [], []
            for a in range(0, n + 2 - size, step):
                at = (np.arange(a, min(n + 2 - size, a + step))[:, None] + base[None, :]).ravel()
                p = pieces.find(flat.hash(at, at + size))
                hit = np.flatnonzero(p >= 0)
                words.append((hit % m).astype(np.int32))
                found.append(p[hit])
                counts.append(np.bincount(hit // m, minlength=len(at) // m))
            self.held[size] = np.concatenate(words), np.concatenate(found), [0, *np.cumsum(np.concatenate(counts)).tolist()]

    def ends(self, j: int):
        """By ascending beginning: (beginning, words that hold a piece from there to ``j``, the pieces)."""
        for size in self.sizes:
            if size <= j:
                words, found, first = self.held[size]
                lo, hi = first[j - size], first[j - size + 1]
                if lo < hi:
                    yield j - size, words[lo:hi], found[lo:hi]


def forward(buf: np.ndarray, start: np.ndarray, lens: np.ndarray, pieces: Pieces, prob: np.ndarray,
            expect: np.ndarray | None = None, weight: np.ndarray | None = None) -> np.ndarray:
    """Log probability of each word under every language, summed over all segmentations.

    ``prob`` is (pieces, languages).  Position 0 is the space before the word;
    a word is read at its own end, whatever the longest of the batch.  Forward
    values are held as logs, so long words do not underflow.  With ``expect``,
    backward values are formed too and the expected piece counts, times
    ``weight`` (words x languages), are added to it.
    """
    m, k, n = len(start), prob.shape[1], int(lens.max())
    lattice = Lattice(buf, start, n, pieces)
    scales = np.zeros((n + 2, m, k))
    for j in range(1, n + 2):
        total = np.zeros((m, k))
        for i, hit, p in lattice.ends(j):
            total[hit] += np.exp(scales[i][hit] - scales[j - 1][hit]) * prob[p]
        scales[j] = scales[j - 1] + np.log(total)
    out = scales[lens + 1, np.arange(m)]
    if expect is not None:
        beta = np.full((n + 2, m, k), -np.inf)  # log backward
        beta[lens + 1, np.arange(m)] = 0
        for j in range(n + 1, 0, -1):
            for i, hit, p in lattice.ends(j):
                beta[i][hit] = np.logaddexp(beta[i][hit], beta[j][hit] + np.log(prob[p]))
        found, shares, size = [], [], 0
        for j in range(1, n + 2):
            for i, hit, p in lattice.ends(j):
                found.append(p)
                shares.append(np.exp(scales[i][hit] + np.log(prob[p]) + beta[j][hit] - out[hit]) * weight[hit])
                size += len(p)
            if size and (size > 1 << 18 or j == n + 1):
                p, share = np.concatenate(found), np.concatenate(shares)
                for c in range(k):
                    expect[:, c] += np.bincount(p, share[:, c], len(expect))
                found, shares, size = [], [], 0
    return out


def word_scores(words: W.Words, pick: np.ndarray, pieces: Pieces, prob: np.ndarray,
                expect: np.ndarray | None = None, weight: np.ndarray | None = None) -> np.ndarray:
    """``forward`` for whole words of any length, in batches of one length or, over ``EVEN`` bytes, of about one length."""
    start, lens = words.start[pick], (words.end - words.start)[pick]
    out = np.zeros((len(pick), prob.shape[1]))
    order = np.argsort(lens, kind="stable")
    a = 0
    while a < len(order):
        n = int(lens[order[a]])
        most = n if n <= EVEN else n + n // 4
        step = max(64 if n <= EVEN else 1, (1 << 20) // ((most + 2) * 8 * prob.shape[1]))
        g = order[a:min(a + step, int(np.searchsorted(lens[order], most, "right")))]
        out[g] = forward(words.buf, start[g], lens[g], pieces, prob, expect, None if weight is None else weight[g])
        a += len(g)
    return out


class Model:
    """Languages, and the probability of each piece under each of them."""

    def __init__(self, languages: list[str], prob: np.ndarray, path: str | None):
        self.languages, self.prob, self.path = languages, prob, path
        self.__dict__["_pieces"] = None

    def __getstate__(self):
        return {"languages": self.languages, "prob": self.prob, "path": self.path, "_pieces": None}

    @property
    def pieces(self) -> Pieces:
        if self._pieces is None:
            self._pieces = Pieces(self.path)
        return self._pieces


def _expectations(model, languages):
    def run(batches):
        m = model.value
        pieces, k = m.pieces, len(languages)
        expect = np.zeros((pieces.n, k))
        for b in batches:
            data, at = W.string_buffers(b.column("text"))
            lang = np.array([languages.index(x) for x in b.column("lang").to_pylist()])
            for i, j in W.slices(at):
                words, first, inverse = distinct_words(data[at[i]:at[j]], at[i:j + 1] - at[i])
                if not len(first):
                    continue
                weight = np.zeros((len(first), k))
                np.add.at(weight, (inverse, np.repeat(lang[i:j], words.counts)), 1)
                word_scores(words, first, pieces, m.prob, expect, weight)
        p, c = np.nonzero(expect)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(c, pa.int32()), pa.array(expect[p, c])], ["p", "c", "n"])
    return run


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE,
        rounds: int = ROUNDS, path: str | None = None) -> Model:
    """Piece probabilities of each language by expectation-maximisation over all segmentations.

    ``train`` holds (text, lang) rows.  The classifier is fitted on a bounded
    sample: about ``sample`` documents of each language, drawn by hash, whole
    texts.  Rows whose lang is null are left out.  Expected counts are summed on
    the executors; at most pieces x languages numbers reach the driver.
    """
    spark = train.sparkSession
    rows = train.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    pieces = Pieces(path)
    prob = np.full((pieces.n, max(1, len(languages))), 1 / pieces.n)
    if languages:
        share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))])
        drawn = cut_lineage(rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)))
        for _ in range(rounds):
            shared = spark.sparkContext.broadcast(Model(languages, prob, path))
            table = drawn.mapInArrow(_expectations(shared, languages), "p int, c int, n double").groupBy("p", "c").agg(F.sum("n").alias("n")).toArrow()
            count = np.zeros_like(prob)
            count[table["p"].to_numpy(), table["c"].to_numpy()] = table["n"].to_numpy()
            prob = np.maximum(count / np.maximum(count.sum(0), 1), FLOOR)
    return Model(languages, prob, path)


def _predict(model):
    def predict(text: pa.Array) -> pa.Array:
        m = model.value
        data, at = W.string_buffers(text)
        logs = []
        for i, j in W.slices(at, 4 << 20):
            words, first, inverse = distinct_words(data[at[i]:at[j]], at[i:j + 1] - at[i])
            score = np.zeros((j - i, len(m.languages)))
            if len(first):
                each = word_scores(words, first, m.pieces, m.prob)
                row = words.row_of_word()
                for c in range(score.shape[1]):
                    score[:, c] = np.bincount(row, each[inverse, c], j - i)
            logs.append(score)
        logs = np.concatenate(logs) if logs else np.zeros((0, len(m.languages)))
        best = logs.argmax(1) if len(logs) else np.zeros(0, int)
        top = logs.max(1, keepdims=True) if len(logs) else logs[:, :1]
        sure = 1 / np.exp(np.maximum(logs - top, -700)).sum(1)
        names = pa.array(m.languages).take(pa.array(best))
        return pa.StructArray.from_arrays([names, pa.array(sure)], ["lang_pred", "score"])
    return arrow_udf(predict, "lang_pred string, score double")


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (posterior probability under equal priors) for each whole text.

    A text's log probability under a language is the sum over its words of the
    log of the summed probability of all segmentations into vocabulary pieces
    (forward algorithm; every byte is a piece too, so each word has one).

    Defined results: null text or one without any letter -> 'und', 0.0; a model
    without languages says 'und' for all; equal languages -> the first by name;
    repeated rows score alike; columns with these names are replaced; an empty
    table gives an empty table.
    """
    own = ("lang_pred", "score")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.col(f"`{text_col}`").cast("string")
    if model.languages:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        lettered = F.coalesce(text.rlike("\\p{L}"), F.lit(False))
        rows = docs.select(row, lettered.alias("lettered"), _predict(shared)(text).alias("p")).select(
            "row", F.when(F.col("lettered"), F.col("p.lang_pred")).otherwise(UNKNOWN_LANGUAGE).alias("lang_pred"),
            F.when(F.col("lettered"), F.col("p.score")).otherwise(0.0).alias("score"))
    else:
        rows = docs.select(row, F.lit(UNKNOWN_LANGUAGE).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in own], *own)
