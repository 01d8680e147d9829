"""Operator 6: toxicity from the nearest labelled examples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eventlens.llm import words as W

#: Documented bound of the classifier: examples of each label.
EXAMPLES = 2048
BLOCK = 64
#: Settings among which ``fit`` chooses: neighbours that vote, power of the idf, and whether a word counts 1 + log(tf) or 1.
NEIGHBOURS = (25, 51, 101, 201)
POWERS = (0.25, 0.5, 1.0, 2.0)
LOGARITHMIC = (True, False)
#: Examples of each label that the settings are compared on, each against all other examples.
TRIALS = 256
#: A term held by over one in so many examples stands in a dense row; texts whose products with them are taken at once.
FREQUENT = 16
TOGETHER = 64


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word hash, count) of each distinct lower-cased word of each row, in order of row."""
    words = W.find_words(W.LOWER[data], offsets, W.ALNUM)
    h, row = words.hashes(), words.row_of_word()
    by = np.lexsort((h, row))
    h, row = h[by], row[by]
    head = np.ones(len(h), bool)
    head[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(head)
    return row[at], h[at], np.diff(np.append(at, len(h)))


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each range, ``count`` long."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Index:
    """Block-max inverted index of all words of the examples, and exact search by TF-IDF cosine.

    Examples are ordered so that neighbours have similar labels and words and
    are cut into blocks of 64.  A term has one posting list for each block that
    holds it: ``begin`` cuts ``doc`` and ``weight`` into lists, ``block`` and
    ``most`` are a list's block and greatest weight, ``lists`` cuts the lists by
    term.  A query's upper bound for a block is the sum of query weight times
    block maximum; blocks are opened in order of their bounds until no closed
    block can beat the k-th score, so the neighbours are exactly those of a full scan.
    The few terms that many examples hold are summed first, as a matrix product
    over several texts, then the short lists, so their part of a bound is exact.
    """

    def __init__(self, term: np.ndarray, df: np.ndarray, doc: np.ndarray, t: np.ndarray, tf: np.ndarray,
                 ids: np.ndarray, toxic: np.ndarray, power: float = 1.0, logarithmic: bool = True):
        """term, df: the words and the examples that hold them; doc, t, tf: one entry for each word of each example."""
        self.ids, self.toxic = ids, toxic
        self.blocks = -(-len(ids) // BLOCK)
        self.logarithmic, self.neighbours = logarithmic, NEIGHBOURS[0]
        n = len(ids)
        self.term, self.idf = term, (np.log((1 + n) / (1 + df)) + 0.05) ** power
        self.unseen = (np.log(1 + n) + 0.05) ** power
        weight = self.count(tf) * self.idf[t]
        weight = weight / np.sqrt(np.bincount(doc, weight * weight, n))[doc]
        by = np.lexsort((doc, t))
        self.doc, self.weight, t = doc[by].astype(np.int32), weight[by].astype(np.float32), t[by]
        block = self.doc // BLOCK
        head = np.ones(len(t), bool)
        head[1:] = (t[1:] != t[:-1]) | (block[1:] != block[:-1])
        at = np.flatnonzero(head)
        self.begin = np.append(at, len(t))
        self.block = block[at]
        self.most = np.maximum.reduceat(self.weight, at) if len(at) else np.zeros(0, np.float32)
        self.lists = np.searchsorted(t[at], np.arange(len(term) + 1))
        self.prior = 0.5
        self.slope, self.offset = 1.0, 0.0
        self.size = np.diff(self.begin[self.lists])
        self.opened = self.closed = 0
        self._dense = None

    def count(self, tf: np.ndarray) -> np.ndarray:
        return 1 + np.log(tf) if self.logarithmic else np.ones(len(tf))

    @property
    def post(self) -> np.ndarray:
        """The weights as a dense array (block, term, example of the block); only for small indexes."""
        dense = np.zeros((self.blocks, len(self.term), BLOCK), np.float32)
        t = np.repeat(np.repeat(np.arange(len(self.term)), np.diff(self.lists)), np.diff(self.begin))
        dense[self.doc // BLOCK, t, self.doc % BLOCK] = self.weight
        return dense

    def query(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index terms of a text and their TF-IDF weights; the text has unit length over all its words, unseen ones too."""
        if not len(self.term):
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        i = np.minimum(np.searchsorted(self.term, hashes), len(self.term) - 1)
        hit = self.term[i] == hashes
        w = self.count(counts) * np.where(hit, self.idf[i], self.unseen)
        norm = np.sqrt((w * w).sum())
        return i[hit], (w[hit] / norm if norm else w[hit]).astype(np.float32)

    def _frequent(self) -> tuple[np.ndarray, np.ndarray]:
        """The row of each frequent term in a dense matrix (-1: a rarer term), and the matrix, built where it is first used."""
        if self._dense is None:
            size = self.size
            often = np.flatnonzero(size * FREQUENT > len(self.ids))
            row = np.full(len(self.term), -1)
            row[often] = np.arange(len(often))
            rows = np.zeros((len(often), len(self.ids)), np.float32)
            p = _ranges(self.begin[self.lists[often]], size[often])
            rows[np.repeat(np.arange(len(often)), size[often]), self.doc[p]] = self.weight[p]
            self._dense = row, rows
        return self._dense

    def __getstate__(self):
        return self.__dict__ | {"_dense": None}

    def search(self, t: np.ndarray, w: np.ndarray, k: int, skip: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Examples and cosines of the k nearest with a positive cosine, best first; ties by example order."""
        return self.search_many([(t, w)], k, None if skip is None else [skip])[0]

    def search_many(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, skip=None) -> list[tuple[np.ndarray, np.ndarray]]:
        """``search`` for several texts; the frequent terms of ``TOGETHER`` texts are one matrix product."""
        out = []
        for i in range(0, len(queries), TOGETHER):
            some = queries[i:i + TOGETHER]
            row, rows = self._frequent()
            q = np.zeros((len(some), len(rows)), np.float32)
            for j, (t, w) in enumerate(some):
                r = row[t]
                q[j, r[r >= 0]] = w[r >= 0]
            part = (q @ rows).astype(np.float64)
            for j, (t, w) in enumerate(some):
                rest = row[t] < 0
                t, w = t[rest], w[rest]
                # A list of a block's length or less is summed at once: a bound would cost as much.
                rare = self.size[t] <= BLOCK
                p = _ranges(self.begin[self.lists[t[rare]]], self.size[t[rare]])
                score = part[j] + np.bincount(self.doc[p], np.repeat(w[rare], self.size[t[rare]]) * self.weight[p], len(self.ids))
                out.append(self._open(score, t[~rare], w[~rare], k, None if skip is None else skip[i + j]))
        return out

    def _open(self, score: np.ndarray, t: np.ndarray, w: np.ndarray, k: int, skip: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Open blocks for some terms of a text; ``score`` holds what its frequent and its rare terms give each example."""
        if not len(score):
            return np.zeros(0, np.int64), np.zeros(0)
        count = self.lists[t + 1] - self.lists[t]
        of, weight = _ranges(self.lists[t], count), np.repeat(w.astype(float), count)
        block = self.block[of]
        # A block's bound: the most that other terms give one of its examples, and the greatest weight of each of these.
        bound = np.maximum.reduceat(score, np.arange(0, len(score), BLOCK)) + np.bincount(block, weight * self.most[of], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        home = np.arange(len(score)) // BLOCK
        seen = np.zeros(self.blocks, bool)
        found, best, at, step = np.zeros(0, np.int64), 0.0, 0, max(4, -(-2 * k // BLOCK))
        # The bound and the scores are summed in another order, so a bound counts as a little more.
        while at < len(order) and bound[order[at]] * (1 + 1e-9) >= best:
            take = order[at:at + step]
            take = take[bound[take] * (1 + 1e-9) >= best]
            now = np.zeros(self.blocks, bool)
            now[take] = True
            seen |= now
            at, step = at + len(take), len(order)
            pick = np.flatnonzero(now[block])
            begin = self.begin[of[pick]]
            count = self.begin[of[pick] + 1] - begin
            p = _ranges(begin, count)
            score += np.bincount(self.doc[p], np.repeat(weight[pick], count) * self.weight[p], len(score))
            if skip is not None:
                score[skip] = 0
            found = np.flatnonzero((score > 0) & seen[home])
            if len(found) > k:
                s = score[found]
                found = found[s >= np.partition(s, len(s) - k)[len(s) - k]]
            found = found[np.lexsort((found, -score[found]))[:k]]
            best = score[found[-1]] if len(found) == k else 0.0
        self.opened += at
        self.closed += len(order) - at
        return found, score[found]

    def vote(self, found: np.ndarray, score: np.ndarray) -> float:
        """Log odds of the label from neighbours weighted by 1 / distance**2, with one neutral vote."""
        weight = 1 / np.maximum(1 - score.astype(float), 0.02) ** 2
        yes = (weight * self.toxic[found]).sum() + 0.5
        no = (weight * (1 - self.toxic[found])).sum() + 0.5
        return float(np.log(yes / no))

    def trial(self, cases: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The k nearest other examples of some examples."""
        term = np.repeat(np.repeat(np.arange(len(self.term)), np.diff(self.lists)), np.diff(self.begin))
        by = np.argsort(self.doc, kind="stable")
        cuts = np.searchsorted(self.doc[by], np.arange(len(self.ids) + 1))
        own = [by[cuts[i]:cuts[i + 1]] for i in cases.tolist()]
        return self.search_many([(term[p], self.weight[p]) for p in own], k, cases.tolist())

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt scaling of votes ``x`` on examples with labels ``y``, none among its own neighbours, at the labelled prior."""
        share = y.mean() if len(y) else 0.0
        if not 0 < share < 1:  # one label only, or none
            self.slope, self.offset = 0.0, 8.0 if share else -8.0
            return
        # Weight the balanced examples back to the labelled share.
        weight = np.where(y > 0, self.prior / share, (1 - self.prior) / (1 - share))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-(a * x + b)))
            g = weight * (p - y)
            h = weight * np.maximum(p * (1 - p), 1e-9)
            grad = np.array([(g * x).sum() + 1e-3 * a, g.sum()])
            hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
            step = np.linalg.solve(hess, grad)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-6:
                break
        self.slope, self.offset = a, b

    def probability(self, log_odds: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * log_odds + self.offset, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        examples: int = EXAMPLES) -> Index:
    """Index of labelled examples: the texts of ``examples`` labels of each kind at most, by smallest hash of the id.

    How many neighbours vote, the power of the idf and the count of a repeated
    word are chosen among fixed settings by leave-one-out trials on the examples
    themselves (256 of each label); the same trials calibrate the score.  The bound is a parameter; TF-IDF is worked out over the examples, with every
    word that any of them holds.  They are drawn from the labels alone, so no text is shuffled: the documents are
    scanned once against a broadcast of 2 x examples ids, and only the examples'
    term counts reach the driver.  An id labelled twice counts once, as toxic if
    any label says so; null ids, labels and texts are left out.
    """
    one = labels.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("toxic")) \
                .where("_id is not null and toxic in (0, 1)").groupBy("_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    drawn = [one.where(F.col("toxic") == k).orderBy(F.xxhash64("_id"), "_id").limit(examples) for k in (0, 1)]
    chosen = F.broadcast(drawn[0].union(drawn[1]))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    sample = rows.join(chosen, F.col("id") == F.col("_id")).select("id", "toxic", "text")

    def vectorise(batches):
        for b in batches:
            data, at = W.string_buffers(b.column("text"))
            for i in range(b.num_rows):
                _, h, n = _terms(data[at[i]:at[i + 1]], np.array([0, at[i + 1] - at[i]]))
                yield pa.RecordBatch.from_pydict({"id": b.column("id").slice(i, 1), "toxic": b.column("toxic").slice(i, 1),
                                                  "h": pa.array([h.view(np.int64)], pa.list_(pa.int64())), "n": pa.array([n], pa.list_(pa.int64()))})

    table = sample.mapInArrow(vectorise, "id long, toxic int, h array<long>, n array<long>").orderBy("toxic", "id").toArrow()
    ids, toxic = table["id"].to_numpy(), table["toxic"].to_numpy().astype(float)
    n = len(ids)
    lists = table["h"].combine_chunks()
    tf = table["n"].combine_chunks().flatten().to_numpy()
    doc = np.repeat(np.arange(n), lists.value_lengths().to_numpy())
    term, t, df = np.unique(lists.flatten().to_numpy().view(np.uint64), return_inverse=True, return_counts=True)
    idf = np.log((1 + n) / (1 + df)) + 0.05
    weight = (1 + np.log(tf)) * idf[t]
    # Examples next to each other share their label and the heaviest term that others have too.
    heaviest = np.full(n, -1)
    by = np.argsort(np.where(df[t] > 1, weight, 0), kind="stable")
    heaviest[doc[by]] = t[by]  # the last one written is the heaviest
    order = np.lexsort((ids, heaviest, toxic))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    ids, toxic = ids[order], toxic[order]
    # Settings are compared on examples, each against all others, by how well the votes rank the labels.
    cases = np.concatenate([np.flatnonzero(toxic == k)[np.argsort(W.mix(ids[toxic == k].astype(np.uint64)))[:TRIALS]] for k in (0, 1)])
    best, index, votes = -1.0, None, np.zeros(0)
    for logarithmic in LOGARITHMIC:
        for power in POWERS:
            one = Index(term, df, place[doc], t, tf, ids, toxic, power, logarithmic)
            found = one.trial(cases, max(NEIGHBOURS))
            for k in NEIGHBOURS:
                x = np.array([one.vote(f[:k], s[:k]) for f, s in found])
                rank = separation(x, toxic[cases])
                if rank > best:
                    best, index, votes = rank, one, x
                    index.neighbours = k
    index.prior = counts.get(1, 0) / max(1, sum(counts.values()))
    index.calibrate(votes, toxic[cases])
    index.opened = index.closed = 0
    return index


def separation(x: np.ndarray, y: np.ndarray) -> float:
    """Share of (label 1, label 0) pairs that the votes order rightly, ties half (0.5 where a label is missing)."""
    yes, no = x[y > 0], np.sort(x[y == 0])
    if not len(yes) or not len(no):
        return 0.5
    return float((np.searchsorted(no, yes, "left") + np.searchsorted(no, yes, "right")).mean() / 2 / len(no))


def _score(index):
    def score(text: pa.Array) -> pa.Array:
        ix = index.value
        data, at = W.string_buffers(text)
        out, ev_id, ev_cos, ev_tox = [], [], [], []
        for i, j in W.slices(at):
            row, h, n = _terms(data[at[i]:at[j]], at[i:j + 1] - at[i])
            ends = np.searchsorted(row, np.arange(j - i + 1))
            asked = [ix.query(h[a:b], n[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            for f, s in ix.search_many(asked, ix.neighbours):
                out.append(ix.probability(ix.vote(f, s)))
                ev_id.append(ix.ids[f[:3]])
                ev_cos.append(s[:3].astype(float))
                ev_tox.append(ix.toxic[f[:3]].astype(np.int32))
        lens = np.array([len(x) for x in ev_id], int)
        flat = lambda x, t: pa.array(np.concatenate(x) if x else [], t)
        evidence = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(lens))).astype(np.int32)),
            pa.StructArray.from_arrays([flat(ev_id, pa.int64()), flat(ev_cos, pa.float64()), flat(ev_tox, pa.int32())], ["id", "cosine", "toxic"]))
        return pa.StructArray.from_arrays([pa.array(out, pa.float64()), evidence], ["score", "evidence"])
    return arrow_udf(score, "score double, evidence array<struct<id:long,cosine:double,toxic:int>>")


def score_toxicity(docs: DataFrame, index: Index, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1), ``predicted`` (1 if score >= 0.5) and ``evidence`` (the three nearest examples).

    Each whole text is compared with all examples of the index, exactly; the nearest
    (as many as ``fit`` chose) vote with weight 1 / distance**2, and Platt scaling turns the vote
    into a probability.

    Defined results: null, empty and wordless texts, and texts without a
    word of the examples, have no neighbours and get the score of a neutral vote;
    equal cosines rank by the examples' order; repeated rows score alike;
    columns with these names are replaced; an empty table gives an empty table.
    """
    own = ("score", "predicted", "evidence")
    shared = docs.sparkSession.sparkContext.broadcast(index)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       _score(shared)(F.col(f"`{text_col}`").cast("string")).alias("s"))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in own],
                       F.col("s.score").alias("score"), (F.col("s.score") >= 0.5).cast("int").alias("predicted"), F.col("s.evidence").alias("evidence"))
