"""Vectors: normalisation, encoding, blocked pairwise work, silhouette, K-Means.

Exact pairwise statistics (k nearest neighbours, silhouette, spanning-tree
edges) need every point compared with every other.  We never materialise
those point pairs as rows.  Points are split into ``B`` blocks; each row is
replicated once per partner block (``explode``), and one ``applyInArrow``
group per block pair computes its distances tile by tile with float64 matrix
products and emits only a per-point reduction (top-k, per-label sums, best
edge).  Block size, not data size, bounds every group's memory; what is moved is
the rows times the blocks, so blocks are large and tiles small.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions import text as T
from eventlens.operators import cells
from eventlens.operators.hooks import Hook, apply_hook, register_hook
from eventlens.session import cut_lineage

BLOCK_ROWS = 32768
#: Rows of the products inside a block pair: queries by stored vectors.
TILE_ROWS, TILE_COLS = 512, 8192


def l2_normalize(c) -> Column:
    """Unit-length float32 vector (zero vectors stay zero)."""
    v = T._c(c)
    # The one-element array binds the norm to a lambda variable, so it is evaluated once per vector.
    scaled = F.transform(F.array(l2_norm(c)), lambda norm: F.transform(
        v, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(F.lit(0.0)).cast("float")))
    return F.element_at(scaled, 1)


def l2_norm(c) -> Column:
    v = T._c(c)
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def norm_check(df: DataFrame, vec: str = "vec") -> DataFrame:
    """Mean / min / max L2 norm (near 1 after B21)."""
    n = l2_norm(vec)
    return df.agg(F.avg(n).alias("mean_norm"), F.min(n).alias("min_norm"), F.max(n).alias("max_norm"),
                  F.count(F.lit(1)).alias("n"))


# ---- blocked pairwise execution ----------------------------------------------

def n_blocks(df: DataFrame, block_rows: int = BLOCK_ROWS, n: int | None = None) -> int:
    """Blocks per side: enough that a block holds <= ``block_rows`` points,
    and at least ``2 sqrt(parallelism)`` so the ``B^2`` block pairs keep every
    core busy on small inputs."""
    n = df.count() if n is None else n
    par = df.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(n / block_rows), math.ceil(2 * math.sqrt(par)))


def block_pairs(df: DataFrame, id_col: str, blocks: int, asks: Column | None = None, block: Column | None = None) -> DataFrame:
    """Rows tagged ``_role`` L (block ``_bi``) and R (block ``_bj``) for every block pair.

    ``asks`` limits the L rows; ``block`` places the R rows, by the hash of their id where it is not given.
    """
    b = F.pmod(F.xxhash64(F.col(id_col)), F.lit(blocks)).cast("int")
    seq = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = df if asks is None else df.where(asks)
    left = left.withColumn("_b", b).select(F.col("_b").alias("_bi"), seq.alias("_bj"), F.lit("L").alias("_role"), *df.columns)
    right = df.withColumn("_b", b if block is None else block).select(seq.alias("_bi"), F.col("_b").alias("_bj"), F.lit("R").alias("_role"), *df.columns)
    return left.unionByName(right)


def sides(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The L and the R rows of a block pair."""
    left = pc.equal(table["_role"], "L")
    return table.filter(left), table.filter(pc.invert(left))


def rows_of(table: pa.Table, vec: str) -> np.ndarray:
    return cells.matrix(table[vec].combine_chunks())


def tiles(table: pa.Table, id_col: str, vec: str) -> list[cells.Tile]:
    """The rows of a block as tiles of ``TILE_COLS`` at most."""
    ids, x = table[id_col].to_numpy(), rows_of(table, vec)
    return [cells.Tile(ids[i:i + TILE_COLS], x[i:i + TILE_COLS]) for i in range(0, len(ids), TILE_COLS)]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    both = a @ b.T
    both *= 2.0
    sq -= both
    return np.sqrt(np.maximum(sq, 0.0, out=sq), out=sq)


def knn(df: DataFrame, k: int, id_col: str = "id", vec: str = "vec", blocks: int | None = None) -> DataFrame:
    """Exact ``k`` nearest other points per point: ``id, nbr, dist, rank`` (ties by neighbour id).

    Each block pair emits at most ``k`` candidates per left point; the final
    per-point top-k is a window over at most ``k * B`` candidates.  Points
    without id or vector are left out.
    """
    from pyspark.sql import Window
    points = df.select(id_col, vec).where(F.col(id_col).isNotNull() & F.col(vec).isNotNull())
    pairs = block_pairs(points, id_col, blocks or n_blocks(df))

    def fn(table: pa.Table) -> pa.Table:
        left, right = sides(table)
        ids, x = left[id_col].to_numpy(), rows_of(left, vec)
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        stored = tiles(right, id_col, vec)
        for i in range(0, len(ids), TILE_ROWS):
            near = cells.Nearest(ids[i:i + TILE_ROWS], x[i:i + TILE_ROWS], k)
            for tile in stored:
                near.meet(tile)
            out.append((near.ids[near.row], near.nbr, near.dist))
        return pa.table(dict(zip((id_col, "nbr", "dist"), (np.concatenate(c) for c in zip(*out)))))

    cand = pairs.groupBy("_bi", "_bj").applyInArrow(fn, f"{id_col} bigint, nbr bigint, dist double")
    w = Window.partitionBy(id_col).orderBy("dist", "nbr")
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def silhouette_points(df: DataFrame, id_col: str = "id", vec: str = "vec", label: str = "label", blocks: int | None = None) -> DataFrame:
    """Per-point silhouette (plain Euclidean, noise removed, singletons 0).

    Stored points lie in blocks by label.  A label that fits into one block is
    complete there, so for each point a block tells the least mean distance to
    such labels and its own label's sum, not a sum for every label; larger
    labels are dealt over blocks of their own and add up.
    """
    pts = df.where((F.col(label) != -1) & F.col(vec).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec).alias("vec"), F.col(label).cast("int").alias("label"))
    blocks = blocks or n_blocks(pts)
    sizes = cut_lineage(pts.groupBy("label").agg(F.count(F.lit(1)).alias("_n")))
    room = max(1, -(-int(sizes.agg(F.sum("_n")).first()[0] or 0) // blocks))
    # A label's blocks: one, or as many as it needs, from a hashed one on.
    parts = F.least(F.lit(blocks), F.ceil(F.col("_n") / F.lit(room))).cast("int")
    pts = pts.join(sizes.select("label", parts.alias("_parts")), "label").select("id", "vec", "label", "_parts")
    block = ((F.pmod(F.xxhash64("label"), F.lit(blocks)) + F.pmod(F.xxhash64("id"), F.col("_parts"))) % blocks).cast("int")
    pairs = block_pairs(pts, "id", blocks, block=block)

    def fn(table: pa.Table) -> pa.Table:
        left, right = sides(table)
        right = right.sort_by("label")
        ids, own = left["id"].to_numpy(), left["label"].to_numpy()
        labels, split = right["label"].to_numpy(), right["_parts"].to_numpy() > 1
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, bool))]
        if len(ids) and len(labels):
            names, start, count = np.unique(labels, return_index=True, return_counts=True)
            split = split[start]
            for i in range(0, len(ids), TILE_ROWS):
                tile, home = slice(i, i + TILE_ROWS), own[i:i + TILE_ROWS]
                total = np.zeros((len(home), len(names)))
                x = rows_of(left.slice(i, TILE_ROWS), "vec")  # of the float64 vectors, one tile of each side is held at a time
                for j in range(0, len(labels), TILE_COLS):
                    d = _distances(x, rows_of(right.slice(j, TILE_COLS), "vec"))
                    lo, hi = np.searchsorted(start, j, "right") - 1, np.searchsorted(start, j + d.shape[1], "left")
                    total[:, lo:hi] += np.add.reduceat(d, np.maximum(start[lo:hi] - j, 0), axis=1)
                at = np.searchsorted(names, home).clip(max=len(names) - 1)
                mine = np.flatnonzero(names[at] == home)
                part = lambda r, c: out.append((ids[tile][r], names[c], total[r, c], count[c], split[c]))  # noqa: B023, E731
                part(mine, at[mine])
                mean = np.where(split[None, :], np.inf, total / count)
                mean[mine, at[mine]] = np.inf
                best = mean.argmin(1)
                least = np.flatnonzero(np.isfinite(mean[np.arange(len(home)), best]))
                part(least, best[least])
                for c in np.flatnonzero(split).tolist():
                    other = np.flatnonzero(home != names[c])
                    part(other, np.full(len(other), c))
        return pa.table(dict(zip(("id", "other", "s", "c", "split"), (np.concatenate(c) for c in zip(*out)))))

    sums = pairs.groupBy("_bi", "_bj").applyInArrow(fn, "id bigint, other int, s double, c bigint, split boolean")
    p = cut_lineage(sums.groupBy("id", "other").agg(F.sum("s").alias("s"), F.sum("c").alias("c"))).join(pts.select("id", "label"), "id")
    mine = p.where(F.col("other") == F.col("label")).select("id", F.col("c").alias("n_own"), F.when(F.col("c") > 1, F.col("s") / (F.col("c") - 1)).alias("a"))
    oth = p.where(F.col("other") != F.col("label")).groupBy("id").agg(F.min(F.col("s") / F.col("c")).alias("b"))
    j = mine.join(oth, "id", "left")
    s = F.when((F.col("n_own") <= 1) | F.col("b").isNull(), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest(F.col("a"), F.col("b")))
    return j.select(F.col("id").alias(id_col), s.alias("silhouette"))


def silhouette(df: DataFrame, id_col: str = "id", vec: str = "vec", label: str = "label") -> DataFrame:
    """I4: mean silhouette; null when fewer than two clusters remain."""
    n_clusters = df.where(F.col(label) != -1).agg(F.count_distinct(label).alias("k"))
    pts = silhouette_points(df, id_col, vec, label).agg(F.avg("silhouette").alias("silhouette"))
    return n_clusters.join(pts, how="left", on=F.lit(True)).select(
        F.when(F.col("k") >= 2, F.col("silhouette")).alias("silhouette"))


# ---- K-Means (pyspark.ml) ------------------------------------------------------

def kmeans_labels(df: DataFrame, k: int = 20, n_init: int = 10, seed: int = 42, id_col: str = "id",
                  vec: str = "vec", max_iter: int = 300):
    """Best of ``n_init`` seeded K-Means fits (lowest training cost).

    Returns ``(labels DataFrame[id, label], training_cost)``.  Each fit is a
    distributed ``pyspark.ml`` job; only the fitted centres (k x dim) and the
    cost scalar come back to the driver.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    from concurrent.futures import ThreadPoolExecutor

    data = df.select(id_col, array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    data = cut_lineage(data)  # read by every fit; shared storage, so a lost executor costs nothing

    def fit(s):
        model = KMeans(k=k, seed=s, maxIter=max_iter, tol=1e-4).fit(data)
        return model.summary.trainingCost, s, model

    # Restarts are independent Spark jobs: submit them concurrently and keep
    # the lowest cost (ties: lowest seed, so the choice is deterministic).
    with ThreadPoolExecutor(max_workers=min(n_init, 4)) as pool:
        fits = list(pool.map(fit, range(seed, seed + n_init)))
    best_cost, _, best = min(fits, key=lambda t: (t[0], t[1]))
    out = best.transform(data).select(id_col, F.col("prediction").cast("int").alias("label"))
    return out, best_cost


# ---- built-in encoder (no model weights offline) --------------------------------

def encode_hashing(df: DataFrame, text: str = "text", id_col: str = "id", dim: int = 384) -> DataFrame:
    """I1 default encoder: word tokens -> HashingTF -> IDF -> L2 normalise.

    A pluggable model encoder would replace this with ``mapInPandas``; the
    output contract (``id, vec ARRAY<FLOAT>`` with unit norm) is the same.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    toks = df.select(id_col, T.word_tokens(F.lower(F.col(text))).alias("_toks"))
    # Counts of dim buckets a text, kept once: the fit and the answer read them, not the texts.
    counts = cut_lineage(HashingTF(inputCol="_toks", outputCol="_tf", numFeatures=dim).transform(toks).select(id_col, "_tf"))
    pipe = Pipeline(stages=[IDF(inputCol="_tf", outputCol="_idf"), Normalizer(inputCol="_idf", outputCol="_n", p=2.0)])
    return pipe.fit(counts).transform(counts).select(id_col, vector_to_array("_n", "float32").alias("vec"))


def encode_with(df: DataFrame, hook: Hook, text: str = "text", id_col: str = "id") -> DataFrame:
    """I1 / L2 plug-in: unit vectors ``id, vec`` (float32) from an encoder hook, one list of numbers for each text."""
    raw = apply_hook(df.select(id_col, text), hook, text, "_raw", "array<double>")
    return raw.select(id_col, l2_normalize("_raw").alias("vec"))


def letter_profile():
    """A small encoder: how often each of the letters a-z occurs in the lower-cased text."""
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]

    def encode(texts: list[str]) -> list[list[float]]:
        return [[float(low.count(c)) for c in letters] for low in map(str.lower, texts)]
    return encode


register_hook("encoder", "letter-profile", Hook(factory=letter_profile, batch_size=64))
