"""Summary scoring: ROUGE-N / L / Lsum, greedy soft token matching, means.

ROUGE-N is relational: n-grams of both sides are exploded, counted per
(pair, gram) in ONE conditional aggregate (map-side combined), and clipped
overlaps summed per pair.  The longest common subsequence (ROUGE-L/Lsum) is
a dynamic program per pair and runs as an Arrow UDF over token arrays, a
bounded number of pairs as Python objects at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from eventlens.functions import text as T
from eventlens.functions.stem import in_lists
from eventlens.operators.hooks import Hook, apply_hook, register_hook


def rouge_tokens(c, stem: bool = False) -> Column:
    """J9 tokenizer: lower, ``[^a-z0-9]+`` -> space, split; optional Porter stem.

    Stemming applies to tokens longer than three characters.
    """
    low = F.lower(F.coalesce(T._c(c), F.lit("")))
    toks = F.filter(F.split(F.regexp_replace(low, "[^a-z0-9]+", " "), " "), lambda w: w != "")
    if stem:
        from eventlens.functions.stem import porter_stem_array
        toks = porter_stem_array(toks)
    return toks


def ngrams(tokens, n: int) -> Column:
    """Space-joined n-grams of a token array (empty when shorter than n)."""
    t = T._c(tokens)
    if n == 1:
        return t
    idx = F.sequence(F.lit(1), F.size(t) - n + 1)
    grams = F.transform(idx, lambda i: F.array_join(F.slice(t, i, n), " "))
    return F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>"))


def prf(overlap: Column, n_pred: Column, n_ref: Column) -> list[Column]:
    p = overlap / F.greatest(n_pred, F.lit(1))
    r = overlap / F.greatest(n_ref, F.lit(1))
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return [p.cast("double"), r.cast("double"), f.cast("double")]


def _rouge_n_tokens(base: DataFrame, n: int, id_col: str) -> DataFrame:
    """ROUGE-N from token columns ``_pt`` (prediction) and ``_rt`` (reference)."""
    sides = base.select(id_col, F.explode(F.array(
        F.struct(F.lit(1).alias("p"), ngrams(F.col("_pt"), n).alias("g")),
        F.struct(F.lit(0).alias("p"), ngrams(F.col("_rt"), n).alias("g")))).alias("_s"))
    grams = sides.select(id_col, "_s.p", F.explode("_s.g").alias("gram"))
    per_gram = grams.groupBy(id_col, "gram").agg(F.sum("p").alias("cp"), F.sum(1 - F.col("p")).alias("cr"))
    per_pair = per_gram.groupBy(id_col).agg(F.sum(F.least("cp", "cr")).alias("overlap"),
                                            F.sum("cp").alias("n_pred"), F.sum("cr").alias("n_ref"))
    j = base.select(id_col).join(per_pair, id_col, "left").fillna(0, ["overlap", "n_pred", "n_ref"])
    p, r, f = prf(F.col("overlap"), F.col("n_pred"), F.col("n_ref"))
    return j.select(id_col, p.alias("precision"), r.alias("recall"), f.alias("fmeasure"))


def _token_base(pairs: DataFrame, id_col: str, pred: str, ref: str, stem: bool, sentences: bool = False) -> DataFrame:
    """Token columns for both sides (and sentence token lists when asked).

    Tokens become plain columns first: lambdas may not wrap a Python UDF.
    """
    cols = [id_col, rouge_tokens(pred, stem).alias("_pt"), rouge_tokens(ref, stem).alias("_rt")]
    if sentences:
        cols += [_sentence_tokens(pred, stem).alias("_ps"), _sentence_tokens(ref, stem).alias("_rs")]
    return pairs.select(*cols)


def rouge_n(pairs: DataFrame, n: int, id_col: str = "pair_id", pred: str = "prediction",
            ref: str = "reference", stem: bool = False) -> DataFrame:
    """Clipped n-gram overlap -> precision / recall / F per pair."""
    return _rouge_n_tokens(_token_base(pairs, id_col, pred, ref, stem), n, id_col)


# ---- longest common subsequence ---------------------------------------------

def lcs_length(a: list, b: list) -> int:
    """LCS length: the zero bits of the last bit-parallel row."""
    match = _places(b)
    v = full = (1 << len(b)) - 1
    for t in a:
        u = v & match.get(t, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


def _places(b: list) -> dict:
    """Token -> bits of its positions."""
    match: dict = {}
    for j, t in enumerate(b):
        match[t] = match.get(t, 0) | (1 << j)
    return match


def _lcs_rows(a, b) -> list[int]:
    """Bit-parallel LCS rows (Hyyro 2004): ``V_i`` for i = 0..len(a).

    A zero bit j in ``V_i`` marks a step of the DP row, so the table cell is
    ``T[i][j] = j - popcount(V_i & (2^j - 1))``.
    """
    match = _places(b)
    v = full = (1 << len(b)) - 1
    rows = [v]
    for t in a:
        u = v & match.get(t, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def _lcs_indices(a, b):
    """Positions in ``a`` of one LCS, with the standard ROUGE backtrack
    (diagonal on a match, else left if strictly larger, else up)."""
    rows = _lcs_rows(a, b)

    def cell(i, j):
        return j - (rows[i] & ((1 << j) - 1)).bit_count()

    i, j, out = len(a), len(b), []
    while i > 0 and j > 0:
        if a[i - 1] == b[j - 1]:
            out.append(i - 1)
            i -= 1
            j -= 1
        elif rows[i] >> (j - 1) & 1 and cell(i, j - 1) > cell(i - 1, j):  # a zero bit: the cell to the left is less than this one
            j -= 1
        else:
            i -= 1
    return out[::-1]


def summary_lcs_hits(ref_sents: list, pred_sents: list) -> tuple[int, int, int]:
    """Union-LCS hits with per-token clipping; returns (hits, n_ref, n_pred)."""
    m = sum(len(s) for s in ref_sents)
    n = sum(len(s) for s in pred_sents)
    if not m or not n:
        return 0, m, n
    from collections import Counter
    cnt_r = Counter(t for s in ref_sents for t in s)
    cnt_p = Counter(t for s in pred_sents for t in s)
    known = [set(p) for p in pred_sents]
    hits = 0
    for r in ref_sents:
        union = set()
        for p, words in zip(pred_sents, known):
            if not words.isdisjoint(r):
                union.update(_lcs_indices(r, p))
        for k in sorted(union):
            t = r[k]
            if cnt_p[t] > 0 and cnt_r[t] > 0:
                hits += 1
                cnt_p[t] -= 1
                cnt_r[t] -= 1
    return hits, m, n


@arrow_udf(LongType())
def _lcs_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([lcs_length(x, y) for x, y in zip(in_lists(a), in_lists(b))], pa.int64())


@arrow_udf(LongType())
def _lsum_udf(r: pa.Array, p: pa.Array) -> pa.Array:
    return pa.array([summary_lcs_hits(x, y)[0] for x, y in zip(in_lists(r), in_lists(p))], pa.int64())


def _rouge_l_tokens(base: DataFrame, id_col: str) -> DataFrame:
    x = base.withColumn("_l", _lcs_udf("_pt", "_rt"))
    p = F.when(F.size("_pt") > 0, F.col("_l") / F.size("_pt")).otherwise(F.lit(0.0))
    r = F.when(F.size("_rt") > 0, F.col("_l") / F.size("_rt")).otherwise(F.lit(0.0))
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return x.select(id_col, p.alias("precision"), r.alias("recall"), f.alias("fmeasure"))


def rouge_l(pairs: DataFrame, id_col: str = "pair_id", pred: str = "prediction", ref: str = "reference",
            stem: bool = False) -> DataFrame:
    """LCS-based precision / recall / F per pair (map-only)."""
    return _rouge_l_tokens(_token_base(pairs, id_col, pred, ref, stem), id_col)


def _sentence_tokens(c, stem: bool) -> Column:
    # Every newline ends a sentence too, also one that was in the text.
    lines = F.filter(F.flatten(F.transform(T.sentences(c), lambda s: F.split(s, "\n"))), lambda s: s != "")
    nested = F.transform(lines, lambda s: rouge_tokens(s, False))
    if stem:
        from eventlens.functions.stem import porter_stem_nested
        nested = porter_stem_nested(nested)
    return nested


def _rouge_lsum_tokens(base: DataFrame, id_col: str) -> DataFrame:
    x = base.withColumn("_h", _lsum_udf("_rs", "_ps"))
    n_p = F.aggregate("_ps", F.lit(0), lambda a, s: a + F.size(s))
    n_r = F.aggregate("_rs", F.lit(0), lambda a, s: a + F.size(s))
    x = x.withColumn("_np", n_p).withColumn("_nr", n_r)
    p = F.when(F.col("_np") > 0, F.col("_h") / F.col("_np")).otherwise(F.lit(0.0))
    r = F.when(F.col("_nr") > 0, F.col("_h") / F.col("_nr")).otherwise(F.lit(0.0))
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return x.select(id_col, p.alias("precision"), r.alias("recall"), f.alias("fmeasure"))


def rouge_lsum(pairs: DataFrame, id_col: str = "pair_id", pred: str = "prediction", ref: str = "reference",
               stem: bool = False) -> DataFrame:
    """Summary-level LCS over sentence-split texts (map-only)."""
    return _rouge_lsum_tokens(_token_base(pairs, id_col, pred, ref, stem, sentences=True), id_col)


def rouge_all(pairs: DataFrame, id_col: str = "pair_id", pred: str = "prediction", ref: str = "reference",
              stem: bool = False) -> DataFrame:
    """Per pair F-measures of rouge1, rouge2, rougeL, rougeLsum (wide).

    Tokenisation (and stemming) runs once; one checkpoint of the token
    columns feeds all four metric plans.
    """
    from eventlens.session import cut_lineage
    base = cut_lineage(_token_base(pairs, id_col, pred, ref, stem, sentences=True))
    parts = {
        "rouge1": _rouge_n_tokens(base, 1, id_col),
        "rouge2": _rouge_n_tokens(base, 2, id_col),
        "rougeL": _rouge_l_tokens(base, id_col),
        "rougeLsum": _rouge_lsum_tokens(base, id_col),
    }
    out = base.select(id_col)
    for k, v in parts.items():
        out = out.join(v.select(id_col, F.col("fmeasure").alias(k)), id_col, "left")
    return out


def mean_score(scores: DataFrame, cols: list[str], n_pred: Column | None = None) -> DataFrame:
    """Mean F over predictions; divisor ``max(n, 1)``, missing = 0."""
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    return scores.agg(*[(F.sum(F.coalesce(F.col(c), F.lit(0.0))) / n).alias(c) for c in cols])


def best_worst(scores: DataFrame, score: str, id_col: str, k: int = 5) -> DataFrame:
    """The ``k`` best and ``k`` worst rows by ``score`` with stable tie order."""
    worst = scores.orderBy(F.col(score).asc(), F.col(id_col).asc()).limit(k).withColumn("end", F.lit("worst"))
    best = scores.orderBy(F.col(score).desc(), F.col(id_col).desc()).limit(k).withColumn("end", F.lit("best"))
    return best.unionByName(worst)


# ---- greedy soft token matching (BERTScore-style, no IDF, raw scale) ----------

def _greedy(pred: np.ndarray, ref: np.ndarray) -> tuple[float, float, float]:
    if not len(pred) or not len(ref):
        return 0.0, 0.0, 0.0
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), np.finfo(float).tiny)
    a, b = unit(pred), unit(ref)  # a zero vector is similar to nothing
    sim = a @ b.T
    p = float(sim.max(axis=1).mean())
    r = float(sim.max(axis=0).mean())
    f = 2 * p * r / (p + r) if p + r != 0 else 0.0
    return p, r, f


def greedy_block(id_col: str):
    """Score the pairs of a block (token lists ``_p``, ``_r``) with the vectors of its tokens (``tok``, ``vec``; null: none)."""
    def run(pairs: pa.Table, words: pa.Table) -> pa.Table:
        names, vecs = words["tok"].combine_chunks(), words["vec"].combine_chunks()
        some = np.flatnonzero(vecs.is_valid().to_numpy(zero_copy_only=False))
        width = pc.max(pc.list_value_length(vecs)).as_py() or 1
        unit = np.zeros((len(names) + 1, width))  # the last stands for no vector
        unit[some] = vecs.flatten().to_numpy(zero_copy_only=False).reshape(len(some), width)
        norm = np.linalg.norm(unit, axis=1, keepdims=True)
        unit /= np.maximum(norm, np.finfo(float).tiny)
        found = norm[:, 0] > 0
        sides = []
        for c in ("_p", "_r"):
            lists = pairs[c].combine_chunks()
            at = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
            sides.append(np.split(pc.index_in(lists.flatten(), names).to_numpy(zero_copy_only=False).astype(int), at[1:-1]))
        out = np.array([_soft(unit, found, a, b) for a, b in zip(*sides)]).reshape(-1, 3)
        return pa.table([pairs[id_col], *(pa.array(x) for x in out.T)], [id_col, "precision", "recall", "f1"])
    return run


def _soft(unit: np.ndarray, found: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """Greedy match of two token lists; a token without a vector is nobody's match and scores 0 itself."""
    if not len(a) or not len(b) or not found[a].any() or not found[b].any():
        return 0.0, 0.0, 0.0
    sim = unit[a] @ unit[b].T
    best_a = np.where(found[a], np.where(found[b][None, :], sim, -np.inf).max(axis=1), 0.0)
    best_b = np.where(found[b], np.where(found[a][:, None], sim, -np.inf).max(axis=0), 0.0)
    p, r = float(best_a.mean()), float(best_b.mean())
    return p, r, 2 * p * r / (p + r) if p + r != 0 else 0.0


def greedy_match(token_vectors: DataFrame, id_col: str = "pair_id", side: str = "side",
                 vec: str = "vec", pred_side: str = "pred") -> DataFrame:
    """Greedy max-cosine matching per pair -> P / R / F.

    The similarity matrix of one pair is built inside one Arrow group
    (a pair's tokens, bounded by its text length) as a matrix product; no
    token-pair rows are ever materialised.
    """
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        ps = pdf[pdf[side] == pred_side].sort_values("pos") if "pos" in pdf else pdf[pdf[side] == pred_side]
        rs = pdf[pdf[side] != pred_side].sort_values("pos") if "pos" in pdf else pdf[pdf[side] != pred_side]
        a = np.array([np.asarray(v, dtype=np.float64) for v in ps[vec]]) if len(ps) else np.zeros((0, 1))
        b = np.array([np.asarray(v, dtype=np.float64) for v in rs[vec]]) if len(rs) else np.zeros((0, 1))
        p, r, f = _greedy(a, b)
        return pd.DataFrame({id_col: [pdf[id_col].iloc[0]], "precision": [p], "recall": [r], "f1": [f]})

    cols = [id_col, side, vec] + (["pos"] if "pos" in token_vectors.columns else [])
    id_type = token_vectors.schema[id_col].dataType.simpleString()  # ids keep their type
    schema = f"{id_col} {id_type}, precision double, recall double, f1 double"
    return token_vectors.select(*cols).groupBy(id_col).applyInPandas(fn, schema)


# ---- metrics as hooks (L5) ------------------------------------------------------

def score_with(pairs: DataFrame, metric: Hook, name: str, id_col: str = "pair_id", pred: str = "prediction", ref: str = "reference") -> DataFrame:
    """``id, name``: a metric hook over (prediction, reference) pairs."""
    return apply_hook(pairs.select(id_col, pred, ref), metric, [pred, ref], name, "double").select(id_col, name)


def _token_f1(pred: Column, ref: Column) -> Column:
    """F-measure over the distinct tokens of both texts."""
    p, r = F.array_distinct(rouge_tokens(pred)), F.array_distinct(rouge_tokens(ref))
    return prf(F.size(F.array_intersect(p, r)), F.size(p), F.size(r))[2]


def length_ratio():
    """A small Python metric: characters of the shorter text to those of the longer one (both empty: 1)."""
    def call(preds: list[str], refs: list[str]) -> list[float]:
        return [min(len(p), len(r)) / max(len(p), len(r)) if p or r else 1.0 for p, r in zip(preds, refs)]
    return call


register_hook("metric", "token-f1", Hook(column=_token_f1))
register_hook("metric", "length-ratio", Hook(factory=length_ratio, batch_size=256))
