"""Operator 13: vector code compression, one codebook for each part of a vector, in exact integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 4096


def largest(dim: int) -> int:
    """Greatest size of a component with which every squared distance of ``dim`` components fits a long."""
    return math.isqrt((2**63 - 1) // dim) // 2


def limb_bits(width: int) -> int:
    """Bits of a limb so that ``width`` products of two limbs stay below 2**53."""
    return (52 - math.ceil(math.log2(max(width, 1)))) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs of integers, lowest first, as floats; all but the last are non-negative, the last holds the sign."""
    out = []
    while len(x) and max(int(x.max()), -int(x.min())) >= 1 << bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices.

    Each pair of limbs is one float64 matrix product, whose sums stay below
    2**53 and so are exact; the products are shifted and added in int64.
    """
    bits = limb_bits(x.shape[1])
    low, high = limbs(x.ravel(), bits), limbs(c.ravel(), bits)
    total = np.zeros((len(x), len(c)), np.int64)
    for i, a in enumerate(low):
        for j, b in enumerate(high):
            total += (a.reshape(x.shape) @ b.reshape(c.shape).T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First nearest row of ``c`` for each row of ``x``, and the squared distance."""
    d = (c * c).sum(1)[None, :] - 2 * dots(x, c)
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at] + (x * x).sum(1)


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of floor(1024 * x), padded with zeros to ``dim`` and held within ``largest``."""
    lens = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    top = largest(dim)
    # 1024 is a power of two, so the product is exact; what the bound cuts off it would also cut off before.
    whole = np.clip(np.floor(np.clip(flat, -top, top) * SCALE), -top, top).astype(np.int64)
    if len(lens) and (lens == dim).all():
        return whole.reshape(len(lens), dim)
    out = np.zeros((len(lens), dim), np.int64)
    row = np.repeat(np.arange(len(lens)), lens)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = whole
    return out


class Codebooks:
    """Entries as an integer array (part, entry, position within the part)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.dim = entries.shape[0] * entries.shape[2]

    def split(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.ascontiguousarray(p) for p in np.split(x, len(self.entries), axis=1)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry index of each part (row, part), and the squared error of each row."""
        code, error = np.zeros((len(x), len(self.entries)), np.int64), np.zeros(len(x), np.int64)
        for i in range(0, len(x), BLOCK):
            for p, (part, book) in enumerate(zip(self.split(x[i:i + BLOCK]), self.entries)):
                code[i:i + BLOCK, p], e = nearest(part, book)
                error[i:i + BLOCK] += e
        return code, error

    def decode(self, codes: list[str]) -> np.ndarray:
        """Integer vectors of code strings."""
        at = np.frombuffer(bytes.fromhex("".join(codes)), np.uint8).reshape(len(codes), len(self.entries))
        return np.concatenate([book[at[:, p]] for p, book in enumerate(self.entries)], axis=1)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def kept(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and holds finite components alone."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    return vectors.where(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))


def _sums(books, dim: int):
    """For each part and entry of a partition: how many parts it got, and their componentwise sums."""
    def run(batches):
        model = books.value
        parts, entries, width = model.entries.shape
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                x = integers(batch.column(0).slice(i, BLOCK), dim)
                code, _ = model.encode(x)
                for p, part in enumerate(model.split(x)):
                    at = (code[:, p, None] * width + np.arange(width)).ravel()
                    count[p] += np.bincount(code[:, p], minlength=entries)
                    for k, limb in enumerate(limbs(part.ravel(), 40)):  # 4,096 times 2**40 stays below 2**53
                        total[p] += np.bincount(at, limb, entries * width).astype(np.int64).reshape(entries, width) << (40 * k)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_pydict({"part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "n": pa.array(count[p, e]),
                                          **{f"s{k}": pa.array(total[p, e, k]) for k in range(width)}})
    return run


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of ``kept`` vectors, by exact integer k-means rounds.

    A codebook starts as that part of the vectors with the ``entries`` smallest
    ids (null ids last, equal ids by vector).  A round assigns every part of
    every vector to its nearest entry and replaces each used entry by the floor
    of the mean.  A task sends one row for each entry it used, with exact sums,
    so a round's shuffle is partitions times entries whatever the rows, and no
    label or vector can make it uneven; only the codebooks themselves reach the
    driver and are broadcast (parts x entries rows).  ``vectors`` is read
    rounds + 2 times: give a written table.

    Vectors count as padded with zeros to the greatest length, rounded up to a
    multiple of ``parts``; components beyond ``largest`` count as that, so that
    no distance overflows.  Fewer vectors than entries give fewer entries, no
    vector gives none.
    """
    rows = kept(vectors, vector_col)
    v = F.col(f"`{vector_col}`").cast("array<double>").alias("v")
    longest = rows.agg(F.max(F.size(f"`{vector_col}`"))).first()[0] or 1
    dim = -(-longest // parts) * parts
    first = rows.select(F.col(f"`{id_col}`").alias("id"), v).orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").toArrow()
    start = integers(first["v"].combine_chunks(), dim) if first.num_rows else np.zeros((0, dim), np.int64)
    model = Codebooks(np.stack(np.split(start, parts, axis=1)))
    width = dim // parts
    schema = "part int, entry int, n long, " + ", ".join(f"s{k} long" for k in range(width))
    for _ in range(rounds if len(start) else 0):
        books = vectors.sparkSession.sparkContext.broadcast(model)
        # Decimal sums hold for any number of rows.
        total = rows.select(v).mapInArrow(_sums(books, dim), schema).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col(f"s{k}").cast("decimal(28,0)")).alias(f"s{k}") for k in range(width)])
        after = model.entries.copy()
        for r in total.collect():
            after[r["part"], r["entry"]] = [int(r[f"s{k}"]) // r["n"] for k in range(width)]
        model = Codebooks(after)
        books.unpersist()
    return model


def _encode(books):
    def run(column: pa.Array) -> pa.Array:
        model = books.value
        texts, errors = [], []
        for i in range(0, len(column), BLOCK):
            code, error = model.encode(integers(column.slice(i, BLOCK), model.dim))
            digits = code.astype(np.uint8).tobytes().hex()
            size = 2 * code.shape[1]
            texts += [digits[k:k + size] for k in range(0, len(digits), size)]
            errors.append(error)
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(np.concatenate(errors) if errors else [], pa.int64())], ["code", "error"])
    return arrow_udf(run, "code string, error long")


def compress(vectors: DataFrame, model: Codebooks, vector_col: str = "embedding") -> DataFrame:
    """``kept`` rows with ``code`` (two hex digits of the entry for each part) and ``error`` (squared distance, all parts).

    Method.  A distance is |x|^2 - 2 x.c + |c|^2; the inner products of a block
    of vectors with a codebook are float64 matrix products over limbs of the
    integers, exact because all sums stay below 2^53, added up in int64.  Of
    equally near entries the first counts.

    Defined results: a vector longer than the codebooks' keeps its first
    components, a shorter one is padded with zeros; columns named ``code`` or
    ``error`` are replaced; an empty table gives an empty table.
    """
    own = ("code", "error")
    books = vectors.sparkSession.sparkContext.broadcast(model)
    v = F.slice(F.col(f"`{vector_col}`").cast("array<double>"), 1, model.dim)
    rows = kept(vectors, vector_col).select(F.struct(*[F.col(f"`{c}`") for c in vectors.columns]).alias("row"), _encode(books)(v).alias("s"))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in vectors.columns if c not in own], "s.code", "s.error")


def group_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """Add ``label_error``: the errors of all rows with an equal label, nulls together (null if beyond a long).

    Sums are combined before the shuffle and joined back, so a label that holds
    most rows is one row of the smaller side.
    """
    total = coded.groupBy(F.col(f"`{label_col}`").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return coded.drop("label_error").join(total, F.col(f"`{label_col}`").eqNullSafe(F.col("_label"))).drop("_label")
