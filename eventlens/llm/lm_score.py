"""Operator 3: language-model scoring by cross-entropy difference."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import words as W
from eventlens.llm.segments import NULL_ID, pack_bytes, unpack_bytes
from eventlens.session import cut_lineage, ensure_checkpoint_dir

DISCOUNT = 0.75
SLICE_BYTES = 12 << 20
#: Pair occurrences counted in one group, and the groups that small inputs are dealt to all the same.
GROUP_WORDS, LEAST_GROUPS = 1 << 20, 64
#: Buckets of slices for each partition of documents.
BUCKETS = 2
#: Word occurrences a group of distinct words is counted for.
WORD_GROUP = 1 << 22
#: Target ids that are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1 << 20

START_KEY = np.uint64(1)  # stands for the start of a row among the words' hashes

_SLICE = pa.schema([("part", pa.int64()), ("words", pa.int64()), ("ids", pa.binary()), ("flags", pa.binary()), ("offsets", pa.binary()), ("text", pa.binary())])
_SLICE_DDL = "part long, words long, ids binary, flags binary, offsets binary, text binary"
#: Of a history, under (target, background): its occurrences, its distinct pairs, and the counts of these pairs' words.
#: Whole numbers: they add up alike in any order, and travel in few bytes.
_SUMS = ["h0", "h1", "types0", "types1", "seen0", "seen1"]


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers, compressed byte by byte of equal rank."""
    return pack_bytes(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _whole(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unpack_bytes(b), np.uint8).reshape(8, -1).T).view("<i8").ravel()


@W.handing_back
def _pack_slices(batches):
    """Slices of a task's documents; flags: 1 counted, 2 target (and counted)."""
    for b in W.merged(batches, "text", SLICE_BYTES):
        data, at = W.string_buffers(b.column("text"))
        for i, j in W.even_slices(at, SLICE_BYTES):
            text, ids = data[at[i]:at[j]].tobytes(), b.column("id").slice(i, j - i).to_numpy().tobytes()
            key = hashlib.blake2b(ids, digest_size=8)
            key.update(text)
            flags = b.column("flags").slice(i, j - i).to_numpy().astype(np.uint8)
            yield pa.RecordBatch.from_pydict({
                "part": [int.from_bytes(key.digest(), "little", signed=True)], "words": [len(W.find_words(data[at[i]:at[j]], at[i:j + 1] - at[i]).start)], "ids": [pack_bytes(ids)], "flags": [pack_bytes(flags.tobytes())],
                "offsets": [pack_bytes((at[i:j + 1] - at[i]).tobytes())], "text": [pack_bytes(text)]}, _SLICE)


def _slices(batches) -> Iterator[tuple[int, np.ndarray, W.Words]]:
    """(part, flags, words) of packed slices."""
    for b in batches:
        for k in range(b.num_rows):
            get = lambda c, t: np.frombuffer(unpack_bytes(b.column(c)[k].as_py()), t)  # noqa: B023, E731
            yield b.column("part")[k].as_py(), get("flags", np.uint8), W.find_words(get("text", np.uint8), get("offsets", np.int64))


def _weights(flags: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Of each word: counted by the target, by the background."""
    return [np.repeat(flags == 3, counts).astype(float), np.repeat(flags & 1, counts).astype(float)]


def _keys(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """START_KEY and the distinct words of a slice, as sorted hashes, and which of them each word is."""
    key, of = np.unique(words.hashes(), return_inverse=True)
    return np.append(START_KEY, key), of + 1


def _ranges(h: np.ndarray, groups: int) -> np.ndarray:
    """Which of ``groups`` equal ranges of 64 bits each hash is in."""
    return ((h >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def _spans(group: np.ndarray, groups: int) -> list[tuple[int, int, int]]:
    """(group, from, to) of each group that occurs in sorted ``group``."""
    cuts = np.searchsorted(group, np.arange(groups + 1))
    return [(int(g), int(cuts[g]), int(cuts[g + 1])) for g in np.flatnonzero(np.diff(cuts))]


def _word_counts(groups: int):
    """Each slice's distinct words and their counts in it, packed by group."""
    @W.handing_back
    def run(batches):
        for part, flags, words in _slices(batches):
            key, of = _keys(words)
            t, n = (np.bincount(of, w, len(key)).astype(np.int64) for w in _weights(flags, words.counts))
            m = np.bincount(of, minlength=len(key))  # as a history
            m[0] = (words.counts > 0).sum()
            spans = _spans(_ranges(key, groups), groups)
            yield pa.RecordBatch.from_arrays([
                pa.array([g for g, _, _ in spans], pa.int64()), pa.array([part] * len(spans), pa.int64()),
                pa.array([_planes(np.diff(key[i:j], prepend=np.uint64(0))) for _, i, j in spans], pa.binary()),
                *[pa.array([_planes(x[i:j]) for _, i, j in spans], pa.binary()) for x in (t, n, m)]], ["group", "part", "keys", "t", "n", "m"])
    return run


_WORDS = pa.schema([("group", pa.int64()), ("part", pa.int64()), ("rank", pa.binary()), ("t", pa.binary()), ("n", pa.binary()),
                    ("u", pa.int64()), *[(f"x{i}", pa.int64()) for i in range(4)]])
_WORDS_DDL = "group long, part long, rank binary, t binary, n binary, u long, x0 long, x1 long, x2 long, x3 long"


def _add_words(often: int):
    """One group of words: ranks and corpus counts for every slice that asked; rows of u = -1 with the group's sums,
    and of u = rank with the occurrences of a word that has more than ``often``."""
    def run(key, table):
        lists = [np.cumsum(_whole(x.as_py())).view(np.uint64) for x in table.column("keys")]
        k, of = np.unique(np.concatenate(lists), return_inverse=True)
        t, n, m = (np.bincount(of, np.concatenate([_whole(x.as_py()) for x in table.column(c)]), len(k)).astype(np.int64) for c in ("t", "n", "m"))
        to = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
        spans = list(zip(to[:-1].tolist(), to[1:].tolist()))
        rows = table.num_rows
        answers = [table.column("group").combine_chunks(), table.column("part").combine_chunks(),
                   pa.array([_planes(np.diff(of[i:j], prepend=0)) for i, j in spans], pa.binary()),
                   *[pa.array([_planes(x[of[i:j]]) for i, j in spans], pa.binary()) for x in (t, n)], *[pa.nulls(rows, pa.int64())] * 5]
        hot = np.flatnonzero(m > often)
        own = len(hot) + 1
        stats = [np.append(-1, hot), np.append(t.sum(), m[hot]), *[np.append(x, np.zeros(len(hot), np.int64)) for x in (n.sum(), (n > 0).sum(), len(k))]]
        sums = [pa.array(np.full(own, key[0].as_py())), pa.nulls(own, pa.int64()), *[pa.nulls(own, pa.binary())] * 3, *[pa.array(x, pa.int64()) for x in stats]]
        return pa.concat_tables([pa.Table.from_arrays(answers, schema=_WORDS), pa.Table.from_arrays(sums, schema=_WORDS)])
    return run


class Pairs:
    """A slice's distinct pairs (previous word ``u``, word ``w``: indexes of the slice's words), in order of their groups."""

    def __init__(self, model: Model, words: W.Words, answers: dict):
        key, at = _keys(words)
        got = [(g, answers[g]) for g, _, _ in _spans(_ranges(key, len(model.begin)), len(model.begin))]
        self.id = np.concatenate([model.begin[g] + np.cumsum(_whole(x[0])) for g, x in got])
        self.single = np.stack([np.concatenate([_whole(x[c]) for _, x in got]) for c in (1, 2)])
        prev = np.empty_like(at)
        prev[1:] = at[:-1]
        prev[words.rows[:-1][words.counts > 0]] = 0
        code, of = np.unique(prev.astype(np.int64) * len(key) + at, return_inverse=True)
        u, w = np.divmod(code, len(key))
        pieces = np.ones(len(key), np.uint64)
        often, i = model.often(self.id)
        pieces[often] = model.pieces[i]
        piece = W.mix(self.id.astype(np.uint64))[w] % pieces[u]
        group = _ranges(W.mix(self.id.astype(np.uint64)[u] * np.uint64(0x9E3779B97F4A7C15) + piece), model.groups)
        by = np.argsort(group, kind="stable")
        self.u, self.w = u[by], w[by]
        back = np.empty(len(by), np.int64)
        back[by] = np.arange(len(by))
        self.of = back[of]
        self.spans = _spans(group[by], model.groups)


class Model:
    """What both bigram models share; no entry for each word.

    Absolute discounting with back-off: p(w | u) = (c(u, w) - d) / c(u) for pairs
    that the model has seen, else backoff(u) * p(w); backoff(u) is the mass that
    the pairs of u leave, and p(w) is the share of w with one added, over all
    distinct words that are counted and two spare entries.  Neither word counts
    nor pair counts are part of it: they are as many as the corpus has words and
    pairs, stay dealt out, and each slice of documents is sent those of its own.
    A history of more than ``limit`` occurrences is cut over groups by its next
    words; only those histories, 1 / limit of all occurrences at most, are held here.
    """

    def __init__(self, found: pa.Table, word_groups: int, groups: int, limit: int):
        group, u, *x = (found[c].to_numpy() for c in ("group", "u", "x0", "x1", "x2", "x3"))
        sums = u < 0
        total = [int(c[sums].sum()) for c in x]
        self.groups = groups
        self.up = np.array([total[1] / total[0] if total[0] else 1.0, 1.0])
        self.mass = np.array(total[:2]) * self.up + total[2] + 2
        self.ids = total[3]
        sizes = np.zeros(word_groups, np.int64)
        sizes[group[sums]] = x[3][sums]
        self.begin = np.cumsum(sizes) - sizes  # first id of each group of words
        hot = self.begin[group[~sums]] + u[~sums]
        by = np.argsort(hot)
        self.hot, self.pieces = hot[by], (-(-x[0][~sums][by] // limit)).astype(np.uint64)
        self.history = None

    def often(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which ids are histories cut over groups, and the place of those in ``hot``."""
        if not len(self.hot):
            return np.zeros(len(ids), bool), np.zeros(0, np.int64)
        i = np.minimum(np.searchsorted(self.hot, ids), len(self.hot) - 1)
        hit = self.hot[i] == ids
        return hit, i[hit]

    def log_word(self, single: np.ndarray) -> np.ndarray:
        return np.log((single * self.up[:, None] + 1.0) / self.mass[:, None])

    def own(self, counts: np.ndarray) -> np.ndarray:
        return np.maximum(counts * self.up[:, None] - DISCOUNT, 0)

    def histories(self, sums: np.ndarray) -> np.ndarray:
        """Counts and log back-off (two rows each) of histories, from the rows of ``_SUMS``.  What the pairs seen leave
        goes to the words not seen after u."""
        count, types, seen = sums[0:2] * self.up[:, None], sums[2:4], sums[4:6]
        own, unigram = count - DISCOUNT * types, (seen * self.up[:, None] + types) / self.mass[:, None]
        count = np.maximum(count, 1.0)
        return np.concatenate([count, np.log(np.maximum(1 - own / count, 1e-9) / np.maximum(1 - unigram, 1e-9))])

    def finish(self, u: np.ndarray, sums: np.ndarray) -> None:
        """Sums of the histories that are cut over groups."""
        dense = np.zeros((6, len(self.hot)), np.int64)
        dense[:, np.searchsorted(self.hot, u)] = sums
        self.history = self.histories(dense)

    def losses(self, counts: np.ndarray, history: np.ndarray, single: np.ndarray) -> np.ndarray:
        """Loss of a word in each pair under (target, background), from the counts of the pair, its history and the word."""
        own = self.own(counts)
        return -np.where(own > 0, np.log(np.maximum(own, 1e-300) / history[0:2]), history[2:4] + self.log_word(single))


def _by_group(answers: pa.Table, columns: tuple[str, ...]) -> dict:
    """Packed answers of a slice by group."""
    return {g: x for g, *x in zip(*(answers.column(c).to_pylist() for c in ("group", *columns)))}


_ASKED = pa.schema([("group", pa.int64()), ("part", pa.int64()), *[(c, pa.binary()) for c in ("u", "w", "t", "n", "words", "wt", "wn")]])


def _pair_counts(model):
    """Each slice's distinct pairs, their counts in it and their words' counts in the corpus, packed by group."""
    def run(key, parts, answers):
        m, out = model.value, [_ASKED.empty_table()]
        got = _by_group(answers, ("rank", "t", "n"))
        for part, flags, words in _slices(parts.to_batches()):
            p = Pairs(m, words, got)
            t, n = (np.bincount(p.of, w, len(p.u)).astype(np.int64) for w in _weights(flags, words.counts))
            u = p.id[p.u]
            some = [np.unique(p.w[i:j], return_inverse=True) for _, i, j in p.spans]  # words are sent once for each group
            out.append(pa.Table.from_arrays([
                pa.array([g for g, _, _ in p.spans], pa.int64()), pa.array([part] * len(p.spans), pa.int64()),
                pa.array([_planes(np.diff(u[i:j], prepend=0)) for _, i, j in p.spans], pa.binary()),
                pa.array([_planes(x) for _, x in some], pa.binary()),
                *[pa.array([_planes(x[i:j]) for _, i, j in p.spans], pa.binary()) for x in (t, n)],
                pa.array([_planes(np.diff(p.id[x], prepend=0)) for x, _ in some], pa.binary()),
                *[pa.array([_planes(c[x]) for x, _ in some], pa.binary()) for c in p.single]], schema=_ASKED))
            del p, t, n, u, some, words
        W.hand_back()
        return pa.concat_tables(out)
    return run


_COUNTED = pa.schema([("group", pa.int64()), ("part", pa.int64()), ("t", pa.binary()), ("n", pa.binary()), ("history", pa.binary()), ("u", pa.int64()),
                      *[(c, pa.int64()) for c in _SUMS]])


def _heads(u: np.ndarray) -> np.ndarray:
    return np.append(True, u[1:] != u[:-1])


def _add_up(model):
    """One group of pairs: how often the other slices have its pairs, and the histories' sums, for every slice that asked; sums of the histories that are cut over groups."""
    def run(key, table):
        m = model.value
        lists = [np.cumsum(_whole(x.as_py())) for x in table.column("u")]
        whole = lambda c: np.concatenate([_whole(x.as_py()) for x in table.column(c)])
        word = [_whole(x.as_py()) for x in table.column("w")]
        of_word = lambda c, f=lambda x: x: np.concatenate([f(_whole(x.as_py()))[i] for x, i in zip(table.column(c), word)])
        u, at = np.unique(np.concatenate(lists), return_inverse=True)
        code, first, of = np.unique(at * m.ids + of_word("words", np.cumsum), return_index=True, return_inverse=True)
        mine = [whole(c) for c in ("t", "n")]
        counts = np.stack([np.bincount(of, x, len(code)) for x in mine]).astype(np.int64)
        single = np.stack([of_word(c)[first] for c in ("wt", "wn")])
        seen = counts > 0
        sums = np.stack([np.bincount(at[first], x, len(u)) for x in (*counts, *seen, *(single * seen))]).astype(np.int64)
        to = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
        spans = list(zip(to[:-1].tolist(), to[1:].tolist()))
        n = table.num_rows
        answers = [table.column("group").combine_chunks(), table.column("part").combine_chunks(),
                   *[pa.array([_planes(c[of[i:j]] - x[i:j]) for i, j in spans], pa.binary()) for c, x in zip(counts, mine)],
                   pa.array([_planes(sums[:, at[i:j][_heads(x)]].ravel()) for (i, j), x in zip(spans, lists)], pa.binary()),
                   *[pa.nulls(n, pa.int64())] * 7]
        hot, _ = m.often(u)
        k = int(hot.sum())
        cut = [pa.array(np.full(k, key[0].as_py())), pa.nulls(k, pa.int64()), *[pa.nulls(k, pa.binary())] * 3,
               pa.array(u[hot]), *[pa.array(x[hot]) for x in sums]]
        return pa.concat_tables([pa.Table.from_arrays(answers, schema=_COUNTED), pa.Table.from_arrays(cut, schema=_COUNTED)])
    return run


def _score(model):
    """The documents of one slice, scored from the counts of its words, pairs and histories."""
    def run(key, parts, answers):
        m, out = model.value, []
        of_words = pc.is_null(answers.column("history"))
        got = _by_group(answers.filter(of_words), ("rank", "t", "n"))
        paired = _by_group(answers.filter(pc.invert(of_words)), ("t", "n", "history"))
        for b in parts.to_batches():
            for k, (_, flags, words) in enumerate(_slices([b])):
                p = Pairs(m, words, got)
                counts, history = np.stack([np.bincount(p.of, x, len(p.u)) for x in _weights(flags, words.counts)]), np.zeros((4, len(p.u)))
                for g, i, j in p.spans:
                    t, n, h = paired[g]
                    counts[:, i:j] += _whole(t), _whole(n)  # the other slices'
                    history[:, i:j] = m.histories(_whole(h).reshape(6, -1))[:, np.cumsum(_heads(p.u[i:j])) - 1]
                cut, i = m.often(p.id[p.u])
                history[:, cut] = m.history[:, i]
                row, n = words.row_of_word(), words.counts
                t, bg = (np.bincount(row, loss[p.of], len(n)) / np.maximum(n, 1) for loss in m.losses(counts, history, p.single[:, p.w]))
                col = lambda x: pa.array(x, pa.float64(), mask=n == 0)  # noqa: B023, E731
                out.append(pa.table([pa.array(np.frombuffer(unpack_bytes(b.column("ids")[k].as_py()), np.int64)), pa.array(n.astype(np.int64)),
                                     col(t), col(bg), col(t - bg)], ["id", "n_tokens", "target_loss", "background_loss", "score"]))
                del p, counts, history, row, t, bg, words
        W.hand_back()
        return pa.concat_tables(out) if out else pa.table(
            [pa.array([], pa.int64()), pa.array([], pa.int64()), *[pa.array([], pa.float64())] * 3], ["id", "n_tokens", "target_loss", "background_loss", "score"])
    return run


def _bucketed(df: DataFrame, buckets: int, column: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``column`` and read back; the catalog forgets the table at once, the files stay."""
    spark = df.sparkSession
    name = f"eventlens_buckets_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).option("path", os.path.join(ensure_checkpoint_dir(spark), name)).option("compression", "none").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "target",
                 counted_col: str | None = None) -> DataFrame:
    """``(id, n_tokens, target_loss, background_loss, score)``: both models fitted on the rows, and every row scored.

    The background model counts all rows (those with a true ``counted_col``,
    where one is named: the others are only scored), the target model those
    with a true ``target_col`` among them.  Losses are in nats per word; the
    lower ``score``, their difference, the closer a text is to the target.
    Target counts are scaled up to the background's total, so both models are
    smoothed alike.  Every word and every pair is counted, however rare; words
    that occur only in rows that are not counted have the probability of a spare entry.

    Every whole text travels in packed slices, written once to the shared folder, in buckets that both co-groups read without a shuffle.
    A slice sends its distinct words to groups of the words' hashes, then its
    distinct pairs to groups of the pair space; a group adds them up over all
    slices and sends each slice the counts of its own words, or pairs and histories.

    Defined results: null, empty and wordless texts have 0 tokens and null
    losses; null id -> null; without target rows the target model is uniform
    over the vocabulary; repeated rows count each time and score alike; extra
    columns are dropped; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    true = lambda c: F.coalesce(F.col(f"`{c}`").cast("boolean"), F.lit(False))
    counted = (true(counted_col) if counted_col else F.lit(True)).cast("int")
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                       (counted * (1 + 2 * true(target_col).cast("int"))).alias("flags"))
    slices = _bucketed(rows.mapInArrow(_pack_slices, _SLICE_DDL), BUCKETS * max(1, docs.rdd.getNumPartitions()), "part")
    total = slices.agg(F.sum("words")).first()[0] or 0
    word_groups = max(LEAST_GROUPS, -(-total // WORD_GROUP))
    most = max(1, min(GROUP_WORDS, total // LEAST_GROUPS))
    limit = max(1, most // 8)
    asked = slices.mapInArrow(_word_counts(word_groups), "group long, part long, keys binary, t binary, n binary, m binary")
    words = cut_lineage(asked.groupBy("group").applyInArrow(_add_words(limit), _WORDS_DDL))
    model = Model(words.where("u is not null").toArrow(), word_groups, max(1, -(-total // most)), limit)
    open_model = spark.sparkContext.broadcast(model)
    of_words = words.where("part is not null").select("part", "group", "rank", "t", "n")
    asked = slices.groupBy("part").cogroup(of_words.groupBy("part")).applyInArrow(
        _pair_counts(open_model), "group long, part long, u binary, w binary, t binary, n binary, words binary, wt binary, wn binary")
    sums = ", ".join(f"{c} long" for c in _SUMS)
    done = cut_lineage(asked.groupBy("group").applyInArrow(_add_up(open_model), f"group long, part long, t binary, n binary, history binary, u long, {sums}"))
    found = done.where("u is not null").groupBy("u").agg(*[F.sum(c).alias(c) for c in _SUMS]).toArrow()
    model.finish(found["u"].to_numpy(), np.stack([found[c].to_numpy() for c in _SUMS]))
    shared = spark.sparkContext.broadcast(model)
    of_pairs = done.where("part is not null").select("part", "group", F.lit(None).cast("binary").alias("rank"), "t", "n", "history")
    answers = of_words.withColumn("history", F.lit(None).cast("binary")).unionByName(of_pairs)
    scored = slices.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        _score(shared), "id long, n_tokens long, target_loss double, background_loss double, score double")
    return scored.withColumn("id", F.when(F.col("id") != NULL_ID, F.col("id")))


def with_target(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Add ``target``: whether any label of the document is 1 (no label, null id: false)."""
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("_good")).where(F.col("_good").isNotNull()).distinct()
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    return docs.join(good, docs[id_col] == good["_good"], "left").withColumn("target", F.col("_good").isNotNull()).drop("_good")
