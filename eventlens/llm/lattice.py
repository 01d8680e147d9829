"""Operator 4: SentencePiece encoding and decoding over a relational lattice."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eventlens.llm import words as W
from eventlens.llm.pieces import BYTE, NORMAL, read_pieces
from eventlens.llm.segments import NULL_ID, TEXT_CODEC, pack_bytes, unpack_bytes

SPACE = "▁"  # the vocabulary's mark for a space
MAX_UNIT = 512  # bytes; a longer unit is encoded in its slice
SLICE_BYTES = 28 << 20
HELD_ROWS = 1 << 18  # answers packed, or units looked up, at a time
OUT_BYTES = 2 << 20  # text in one batch of results
UNIT_PARTITIONS = 8  # partitions of units for each partition of documents


def piece_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """``(piece, piece_id)`` of the vocabulary's normal pieces, spaces written as such: a table of fixed size."""
    rows = [(p.text.replace(SPACE, " "), p.id) for p in read_pieces(path) if p.kind == NORMAL]
    return spark.createDataFrame(pa.table({"piece": [r[0] for r in rows], "piece_id": pa.array([r[1] for r in rows], pa.int32())}))


def _bytes_of(char: Column, first: int) -> Column:
    """Byte pieces of a character outside the vocabulary."""
    digits = F.hex(F.encode(char, "UTF-8"))
    return F.transform(F.sequence(F.lit(0), (F.length(digits) / 2).cast("int") - 1),
                       lambda i: F.conv(F.substring(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("int") + first)


def encode_units(units: DataFrame, path: str | None = None) -> DataFrame:
    """``(unit, ids)``: the best segmentation of each distinct ``unit``.

    The lattice as relations: substrings of bounded length are exploded, joined
    with the piece table (fixed size, broadcast), grouped by unit again, and one
    ``aggregate`` folds the edges, sorted by end, into the path of greatest
    total score (Viterbi).  ``units`` must be distinct and dealt by ``unit``;
    nothing else is shuffled.
    """
    spark = units.sparkSession
    pieces = read_pieces(path)
    longest = max(len(p.text) for p in pieces if p.kind == NORMAL)
    unknown = min(p.score for p in pieces if p.kind == NORMAL) - 10.0
    first_byte = min(p.id for p in pieces if p.kind == BYTE)
    n = F.length("unit")
    starts = units.select("unit", F.explode(F.sequence(F.lit(0), n - 1)).alias("start"))
    subs = starts.select("unit", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), n - F.col("start")))).alias("len"))
    subs = subs.select("unit", "start", "len", F.substring(F.col("unit"), F.col("start") + 1, F.col("len")).alias("sub"))
    edges = subs.join(F.broadcast(piece_table(spark, path)), F.col("sub") == F.col("piece"), "left").where("piece_id is not null or len = 1")
    # An edge is one long, end | start | piece | whether it is the last into its end, so that sorting the longs sorts
    # by end, then start.  Every position has an edge of one character into it, which sorts last.
    nobody = len(pieces)  # stands for a character outside the vocabulary
    edge = F.shiftleft((F.col("start") + F.col("len")).cast("long"), 40).bitwiseOR(F.shiftleft(F.col("start").cast("long"), 20)) \
            .bitwiseOR(F.shiftleft(F.coalesce("piece_id", F.lit(nobody)).cast("long"), 1)).bitwiseOR((F.col("len") == 1).cast("long"))
    grouped = edges.groupBy("unit").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    scores = F.split(F.lit(",".join(repr(float(p.score)) for p in pieces) + f",{unknown!r}"), ",").cast("array<double>")

    low = F.lit((1 << 20) - 1).cast("long")
    begin_of = lambda x: F.shiftright(x, 20).bitwiseAND(low).cast("int")
    piece_of = lambda x: F.shiftright(x.bitwiseAND(low), 1).cast("int")

    # State: the best paths to positions 0..k (done) and the best edge into k + 1 so far (now), held as (score, -edge):
    # of equal scores the smaller start is the greater.
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")))
    none = F.lit(None).cast("struct<score:double,edge:bigint>")

    def relax(acc, x):
        done = acc["done"]
        score = F.get(done, begin_of(x))["score"] + F.get(scores, piece_of(x))
        now = F.greatest(acc["now"], F.struct(score.alias("score"), F.negative(x).alias("edge")))
        last = x.bitwiseAND(F.lit(1).cast("long")) == 1

        def path(best):
            e = F.negative(best["edge"])
            own = F.when(piece_of(e) == nobody, _bytes_of(F.substring(F.col("unit"), begin_of(e) + 1, F.lit(1)), first_byte)).otherwise(F.array(piece_of(e)))
            return F.struct(best["score"].alias("score"), F.concat(F.get(done, begin_of(e))["ids"], own).alias("ids"))

        return F.struct(F.when(last, F.concat(done, F.transform(F.array(now), path))).otherwise(done).alias("done"),
                        F.when(last, none).otherwise(now).alias("now"))

    best = F.aggregate("edges", F.struct(first.alias("done"), none.alias("now")), relax, lambda acc: F.element_at(acc["done"], -1)["ids"])
    return grouped.select("unit", best.alias("ids"))


_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = True
_SIGN &= ~_LETTER


def joined_bytes(path: str | None = None) -> np.ndarray:
    """Whether some piece holds one byte right before another, as a table of all pairs: no unit may end between those."""
    joined = np.zeros((256, 256), bool)
    for p in read_pieces(path):
        if p.kind == NORMAL:
            raw = np.frombuffer(p.text.replace(SPACE, " ").encode(), np.uint8)
            joined[raw[:-1], raw[1:]] = True
    return joined


def _units(text: np.ndarray, offsets: np.ndarray, joined: np.ndarray) -> W.Words:
    """Units of each text with a space before it: a run of spaces with the letters after it, a run of signs,
    or one control character; what ``joined`` says that a piece may hold together stays in one unit.

    No piece reaches over the start of a unit, so units are encoded one by one.
    """
    lens = np.diff(offsets)
    some = (lens > 0).astype(np.int64)
    at = offsets + np.concatenate(([0], np.cumsum(some)))
    buf = np.insert(text, offsets[:-1][lens > 0], 0x20)
    prev = np.empty_like(buf)
    prev[1:] = buf[:-1]
    prev[:1] = 0
    head = ((buf == 0x20) & (prev != 0x20)) | (buf < 0x20) | (prev < 0x20)
    head |= (_LETTER[buf] & _SIGN[prev]) | (_SIGN[buf] & _LETTER[prev])
    some_heads = np.flatnonzero(head)
    head[some_heads] = ~joined[prev[some_heads], buf[some_heads]]
    head[at[:-1][lens > 0]] = True
    start = np.flatnonzero(head)
    rows = np.searchsorted(start, at)
    end = np.append(start[1:], len(buf)) if len(start) else start
    return W.Words(buf, start, end, rows)


@lru_cache(maxsize=1)
def _by_text(path: str | None) -> tuple[dict[str, tuple[float, int]], int, float, int]:
    """Score and id of each normal piece by its text, the longest piece, the score of an unknown character, the first byte piece."""
    pieces = read_pieces(path)
    found = {p.text.replace(SPACE, " "): (p.score, p.id) for p in pieces if p.kind == NORMAL}
    return found, max(map(len, found)), min(x for x, _ in found.values()) - 10.0, min(p.id for p in pieces if p.kind == BYTE)


def long_path(unit: str, path: str | None = None) -> list[int]:
    """The best segmentation of one unit of any length, by the rules of ``encode_units``: one score and one edge for each
    position, so time and memory are linear."""
    pieces, longest, unknown, first_byte = _by_text(path)
    score, back = [0.0], [0]
    for e in range(1, len(unit) + 1):
        best, begin = None, e - 1
        for s in range(max(0, e - longest), e):  # of equal scores the smaller start is kept
            p = pieces.get(unit[s:e])
            if p is None and s < e - 1:
                continue
            x = score[s] + (p[0] if p else unknown)
            if best is None or x > best:
                best, begin = x, s
        score.append(best)
        back.append(begin)
    out, e = [], len(unit)
    while e:
        p = pieces.get(unit[back[e]:e])
        out += [p[1]] if p else [first_byte + b for b in reversed(unit[back[e]:e].encode())]
        e = back[e]
    return out[::-1]


def _parts(batches):
    """Slices of a task's documents, and an id for each that depends on its content alone."""
    for b in W.merged(batches, "text", SLICE_BYTES):
        data, at = W.string_buffers(b.column("text"))
        for i, j in W.even_slices(at, SLICE_BYTES):
            text = data[at[i]:at[j]].tobytes()
            key = hashlib.blake2b(text, digest_size=8)
            key.update(b.column("id").slice(i, j - i).to_numpy().tobytes())
            yield int.from_bytes(key.digest(), "little", signed=True), b.slice(i, j - i), text, at[i:j + 1] - at[i]


def _distinct_units(joined: np.ndarray):
    @W.handing_back
    def run(batches):
        for part, _, text, offsets in _parts(batches):
            u = _units(np.frombuffer(text, np.uint8), offsets, joined)
            u = W.Words(u.buf, *(x[u.end - u.start <= MAX_UNIT] for x in (u.start, u.end)), u.rows)
            h = u.hashes()
            first = np.argsort(h)  # which of equal units comes first does not matter
            h = h[first]
            first = first[np.append(True, h[1:] != h[:-1])] if len(h) else first
            del h
            for a in range(0, len(first), 1 << 17):
                f = first[a:a + (1 << 17)]
                size = u.end[f] - u.start[f]
                to = np.concatenate(([0], np.cumsum(size)))
                body = u.buf[np.repeat(u.start[f] - to[:-1], size) + np.arange(to[-1])]
                found = pa.StringArray.from_buffers(len(f), pa.py_buffer(to.astype(np.int32).tobytes()), pa.py_buffer(body.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(f), part)), found], ["part", "unit"])
    return run


@W.handing_back
def _packed(batches):
    for part, b, text, offsets in _parts(batches):
        yield pa.RecordBatch.from_pydict({
            "part": [part], "ids": [pack_bytes(b.column("id").to_numpy().tobytes())], "nulls": [pack_bytes(b.column("null_text").to_numpy(zero_copy_only=False).tobytes())],
            "offsets": [pack_bytes(offsets.tobytes())], "text": [pack_bytes(text, TEXT_CODEC)]},
            pa.schema([("part", pa.int64()), ("ids", pa.binary()), ("nulls", pa.binary()), ("offsets", pa.binary()), ("text", pa.binary())]))


_ANSWERS = pa.schema([("part", pa.int64()), ("units", pa.binary()), ("unit_bytes", pa.binary()), ("ids", pa.binary()), ("id_counts", pa.binary())])


def _by_slice(batches: list[pa.RecordBatch]):
    """One packed row for each slice among these answers."""
    table = pa.Table.from_batches(batches)
    table = table.take(pc.sort_indices(table, [("part", "ascending"), ("unit", "ascending")])).combine_chunks()
    part = table.column("part").to_numpy()
    units, lists = (table.column(c).combine_chunks() for c in ("unit", "ids"))
    data, at = W.string_buffers(units)
    flat, to = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
    to = to - to[0]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)]))
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield pa.RecordBatch.from_pydict({
            "part": [int(part[i])], "units": [pack_bytes(data[at[i]:at[j]].tobytes())], "unit_bytes": [pack_bytes(np.diff(at[i:j + 1]).astype(np.uint16).tobytes())],
            "ids": [pack_bytes(flat[to[i]:to[j]].astype(np.int32).tobytes())], "id_counts": [pack_bytes(np.diff(to[i:j + 1]).astype(np.uint16).tobytes())]}, _ANSWERS)


@W.handing_back
def _packed_answers(batches):
    """Answers packed by slice, a bounded number of rows at a time, so that the way back moves little."""
    held, rows = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows >= HELD_ROWS:
            yield from _by_slice(held)
            held, rows = [], 0
    if held:
        yield from _by_slice(held)


_DONE = pa.schema([("id", pa.int64()), ("text", pa.string()), ("ids", pa.list_(pa.int32())), ("exact", pa.bool_())])


def _exact(decoder: Decoder, ids: np.ndarray, ends: np.ndarray, text: bytes, offsets: np.ndarray) -> list[bool]:
    """Whether the ids of each document decode to its text, worked out over about OUT_BYTES of text at a time."""
    out = []
    for i, j in W.slices(offsets, OUT_BYTES):
        back, to = decoder.texts(ids[ends[i]:ends[j]], ends[i:j + 1] - ends[i])
        back = back.tobytes()
        out += [back[a:b] == text[c:d] for a, b, c, d in zip(to[:-1].tolist(), to[1:].tolist(), offsets[i:j].tolist(), offsets[i + 1:j + 1].tolist())]
    return out


def _apply(parts: pa.Table, answers: pa.Table, joined: np.ndarray, decoder: Decoder, with_text: bool, path: str | None) -> pa.Table:
    """The documents of one slice with the ids of their units put together, and decoded again."""
    read = lambda c, t: np.concatenate([np.zeros(0, t), *(np.frombuffer(unpack_bytes(x.as_py()), t) for x in answers.column(c))])
    at = np.concatenate(([0], np.cumsum(read("unit_bytes", np.uint16).astype(np.int64))))
    known = W.Words(read("units", np.uint8), at[:-1], at[1:], np.array([0, len(at) - 1])).hashes()
    by = np.argsort(known)
    known, flat = known[by], read("ids", np.int32)
    size = read("id_counts", np.uint16).astype(np.int64)
    begin = (np.cumsum(size) - size)[by]
    size = size[by]
    del at, by
    ranges = _ranges(known)
    out, paths = [], {}
    for i in range(parts.num_rows):
        get = lambda c, t: np.frombuffer(unpack_bytes(parts.column(c)[i].as_py()), t)  # noqa: B023, E731
        whole, rows = unpack_bytes(parts.column("text")[i].as_py()), get("offsets", np.int64)
        nulls, names = get("nulls", bool), get("ids", np.int64)
        # Some documents at a time, so that what is held besides the slice is bounded by OUT_BYTES or one text.
        for x, y in W.slices(rows, OUT_BYTES):
            text, offsets = whole[rows[x]:rows[y]], rows[x:y + 1] - rows[x]
            ids, ends = _unit_ids(text, offsets, joined, (known, ranges, begin, size, flat), paths, path)
            texts = pa.StringArray.from_buffers(y - x, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(text)) if with_text else pa.nulls(y - x, pa.string())
            out.append(pa.table([pa.array(names[x:y]), pc.if_else(pa.array(nulls[x:y]), pa.scalar(None, pa.string()), texts),
                                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32())),
                                 pa.array(_exact(decoder, ids, ends, text, offsets), pa.bool_(), mask=nulls[x:y])], schema=_DONE))
    W.hand_back()
    return pa.concat_tables(out) if out else _DONE.empty_table()


def _ranges(known: np.ndarray) -> tuple[np.uint64, np.ndarray]:
    """How far to shift a hash, and where hashes with the leading bits that this leaves begin in sorted ``known``."""
    bits = len(known).bit_length() + 1
    shift = np.uint64(64 - bits)
    return shift, np.searchsorted(known >> shift, np.arange(1 << bits, dtype=np.uint64))


def _find(known: np.ndarray, ranges: tuple[np.uint64, np.ndarray], h: np.ndarray) -> np.ndarray:
    """Place of the first of sorted ``known`` that is not less than each ``h`` (the last place at most): a range holds about one hash, so it is a step or two away."""
    last = max(0, len(known) - 1)
    k = np.minimum(ranges[1][h >> ranges[0]], last)
    left = np.flatnonzero(known[k] < h) if len(known) else k[:0]
    left = left[k[left] < last]
    while len(left):
        k[left] += 1
        left = left[(known[k[left]] < h[left]) & (k[left] < last)]
    return k


def _unit_ids(text: bytes, offsets: np.ndarray, joined: np.ndarray, answers: tuple, paths: dict, path: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of some documents, and where each document's ids end; ``paths`` keeps those of long units."""
    known, ranges, begin, size, flat = answers
    u = _units(np.frombuffer(text, np.uint8), offsets, joined)
    mine = u.hashes()
    if not len(mine):
        return np.zeros(0, np.int32), np.zeros(len(u.rows), np.int64)
    long = np.flatnonzero(u.end - u.start > MAX_UNIT)
    k = _find(known, ranges, mine)
    hit = known[k] == mine if len(known) else np.zeros(len(mine), bool)
    hit[long] = True
    if not hit.all():
        raise RuntimeError("the documents changed between two reads; checkpoint them first")
    count = size[k] if len(known) else np.zeros(len(mine), np.int64)
    for x in long.tolist():  # not asked for, but encoded here
        own = int(mine[x])
        if own not in paths:
            paths[own] = np.array(long_path(u.buf[u.start[x]:u.end[x]].tobytes().decode(), path), np.int32)
        count[x] = len(paths[own])
    to = np.concatenate(([0], np.cumsum(count)))
    ids = np.empty(int(to[-1]), np.int32)
    short = np.ones(len(mine), bool)
    short[long] = False
    some = np.flatnonzero(short)
    from_, n = begin[k[some]] if len(known) else some, count[some]
    total = np.cumsum(n) - n
    at = np.arange(int(n.sum()))
    ids[np.repeat(to[some] - total, n) + at] = flat[np.repeat(from_ - total, n) + at]
    for x in long.tolist():
        ids[to[x]:to[x + 1]] = paths[int(mine[x])]
    return ids, to[u.rows]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           with_text: bool = True) -> DataFrame:
    """``(id, text, ids, n_tokens, exact)``: SentencePiece ids of every whole text, and whether they decode to it.

    Rules of the format: one space is put before the text, spaces are pieces'
    own, and a character outside the vocabulary becomes its UTF-8 bytes.  Among
    all segmentations the one with the greatest sum of piece scores is taken
    (ties: the longer last piece).  The vocabulary is a parameter and is not
    trained.

    Texts are cut into units that no piece crosses.  Each distinct unit of the
    corpus is encoded once, by ``encode_units``; units of over 512 bytes by
    ``long_path`` in each slice that holds them.  To move little, every slice of
    up to 28 MB of text asks for its distinct units only; the answers meet the
    packed slice again by its id, where the ids are put together and decoded
    (``exact``).  ``with_text`` false leaves the text column out.

    Defined results: null text -> null text, no ids and a null ``exact``; empty text -> no ids;
    null id -> null; repeated rows give equal rows; a run of any length
    without a space is one unit; extra columns are dropped; an
    empty table gives an empty table.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.coalesce(text, F.lit("")).alias("text"), text.isNull().alias("null_text"))
    joined, decoder = joined_bytes(path), Decoder(path)
    # Both sides of the join read one shuffle by unit; the smallest slice is asked for so that their columns agree.
    # A unit's lattice takes many times the room of the unit, so their partitions follow the input, not the bytes shuffled.
    dealt = UNIT_PARTITIONS * max(1, docs.rdd.getNumPartitions())
    asked = rows.mapInArrow(_distinct_units(joined), "part long, unit string").repartition(dealt, "unit")
    units = asked.groupBy("unit").agg(F.min("part").alias("least")).where("least is not null")
    answers = asked.join(encode_units(units, path).hint("shuffle_hash"), "unit").select("part", "unit", "ids").mapInArrow(
        _packed_answers, "part long, units binary, unit_bytes binary, ids binary, id_counts binary")
    packed = rows.mapInArrow(_packed, "part long, ids binary, nulls binary, offsets binary, text binary")
    done = packed.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        lambda key, a, b: _apply(a, b, joined, decoder, with_text, path), "id long, text string, ids array<int>, exact boolean")
    done = done.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("id"), "text", "ids", F.size("ids").cast("long").alias("n_tokens"), "exact")
    return done if with_text else done.drop("text")


class Decoder:
    """Bytes of each piece: a normal piece's text, a byte piece's byte, nothing for a control piece."""

    def __init__(self, path: str | None = None):
        pieces = read_pieces(path)
        first = min(p.id for p in pieces if p.kind == BYTE)
        raw = [b""] * (max(p.id for p in pieces) + 2)  # the last stands for ids outside the vocabulary
        for p in pieces:
            raw[p.id] = p.text.replace(SPACE, " ").encode() if p.kind == NORMAL else bytes([p.id - first]) if p.kind == BYTE else b""
        self.size = np.array([len(x) for x in raw], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    def texts(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the texts of some lists of ids, each without the space before it."""
        ids = np.where((ids < 0) | (ids >= len(self.size)), len(self.size) - 1, ids)
        size = self.size[ids]
        to = np.concatenate(([0], np.cumsum(size)))
        buf = np.empty(int(to[-1]), np.uint8)
        for a in range(0, len(ids), HELD_ROWS):
            some = slice(a, a + HELD_ROWS)
            first, last = int(to[a]), int(to[min(a + HELD_ROWS, len(ids))])
            buf[first:last] = self.raw[np.repeat(self.begin[ids[some]] - to[:-1][some], size[some]) + np.arange(first, last)]
        at = to[rows]
        spaced = at[:-1][at[1:] > at[:-1]]
        spaced = spaced[buf[spaced] == 0x20]
        gone = np.searchsorted(spaced, at, "left")
        return np.delete(buf, spaced), at - gone


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of an array of ids; unknown ids, null ids and control pieces give nothing, a null array gives null."""
    decoder = Decoder(path)

    def run(lists: pa.Array) -> pa.Array:
        at = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.slice(at[0], at[-1] - at[0]).fill_null(-1).to_numpy()
        text, to = decoder.texts(flat, at - at[0])
        done = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(to.tobytes()), pa.py_buffer(text.tobytes())])
        return pc.if_else(lists.is_null(), pa.scalar(None, pa.large_binary()), done).cast(pa.binary())
    return arrow_udf(run, "binary")(ids).cast("string")
