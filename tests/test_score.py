"""ROUGE and soft matching against brute-force definitions."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlens.operators import score as SC


def lcs_brute(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        t[i][j] = t[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(t[i - 1][j], t[i][j - 1])
    return t


def union_lcs_hits(ref_sents, pred_sents):
    m, n = sum(map(len, ref_sents)), sum(map(len, pred_sents))
    if not m or not n:
        return 0
    cr, cp = Counter(x for s in ref_sents for x in s), Counter(x for s in pred_sents for x in s)
    hits = 0
    for r in ref_sents:
        idx = set()
        for p in pred_sents:
            t = lcs_brute(r, p)
            i, j = len(r), len(p)
            while i and j:
                if r[i - 1] == p[j - 1]:
                    idx.add(i - 1)
                    i, j = i - 1, j - 1
                elif t[i][j - 1] > t[i - 1][j]:
                    j -= 1
                else:
                    i -= 1
        for k in sorted(idx):
            if cp[r[k]] > 0 and cr[r[k]] > 0:
                hits += 1
                cp[r[k]] -= 1
                cr[r[k]] -= 1
    return hits


def test_lcs_random():
    rnd = random.Random(7)
    for _ in range(200):
        a = [rnd.choice("abcde") for _ in range(rnd.randint(0, 15))]
        b = [rnd.choice("abcde") for _ in range(rnd.randint(0, 15))]
        assert SC.lcs_length(a, b) == (lcs_brute(a, b)[-1][-1] if a and b else 0)


def test_summary_lcs_random():
    rnd = random.Random(11)
    for _ in range(100):
        r = [[rnd.choice("abcd") for _ in range(rnd.randint(0, 6))] for _ in range(rnd.randint(1, 3))]
        p = [[rnd.choice("abcd") for _ in range(rnd.randint(0, 6))] for _ in range(rnd.randint(1, 3))]
        assert SC.summary_lcs_hits(r, p)[0] == union_lcs_hits(r, p)


def test_rouge_identical_and_disjoint(spark):
    df = spark.createDataFrame([(1, "The cat sat. It ran!", "The cat sat. It ran!"), (2, "alpha beta", "gamma delta"),
                                (3, "", "x")], "pair_id long, prediction string, reference string")
    got = {r["pair_id"]: r for r in SC.rouge_all(df).collect()}
    assert all(got[1][k] == 1.0 for k in ("rouge1", "rouge2", "rougeL", "rougeLsum"))
    assert all(got[2][k] == 0.0 for k in ("rouge1", "rouge2", "rougeL", "rougeLsum"))
    assert got[3]["rouge1"] == 0.0


def test_rouge_n_counts(spark):
    df = spark.createDataFrame([(1, "a a b c", "a b b c d")], "pair_id long, prediction string, reference string")
    r1 = SC.rouge_n(df, 1).first()
    # overlap: a=min(2,1)=1, b=min(1,2)=1, c=1 -> 3; P=3/4, R=3/5
    assert r1["precision"] == pytest.approx(0.75) and r1["recall"] == pytest.approx(0.6)
    r2 = SC.rouge_n(df, 2).first()
    # pred bigrams: aa ab bc; ref: ab bb bc cd -> overlap 2
    assert r2["precision"] == pytest.approx(2 / 3) and r2["recall"] == pytest.approx(0.5)


def test_greedy_identity(spark):
    v = np.random.default_rng(1).normal(size=(4, 8)).tolist()
    data = [(0, "pred", i, v[i]) for i in range(4)] + [(0, "ref", i, v[i]) for i in range(4)]
    df = spark.createDataFrame(data, "pair_id long, side string, pos long, vec array<double>")
    r = SC.greedy_match(df).first()
    assert r["precision"] == pytest.approx(1.0) and r["f1"] == pytest.approx(1.0)


def test_stemmer_examples():
    from eventlens.functions.stem import porter_stem as s
    for a, b in [("caresses", "caress"), ("ponies", "poni"), ("motoring", "motor"), ("relational", "relat"),
                 ("hopping", "hop"), ("generalizations", "gener"), ("agreed", "agre"), ("sky", "sky")]:
        assert s(a) == b


def test_soft_match_moves_floats(spark):
    """Vectors of floats are not widened on the way; a token without a vector, a repeated one and no token score as defined."""
    from eventlens.operators import evaluate as EV
    table = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(5)], "vec_id long, embedding array<float>")
    pairs = spark.createDataFrame([(1, "a b a", "b c"), (2, "a b", "a b"), (3, "", ""), (4, "a", "")], "id long, p string, r string")
    got = EV.greedy_pairs(pairs, "id", "p", "r", table)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "array<double>" not in plan
    by = {x["id"]: x for x in got.collect()}
    assert sorted(by) == [1, 2, 4] and by[2]["f1"] == pytest.approx(1) and by[4]["f1"] == 0
    wide = EV.greedy_pairs(pairs, "id", "p", "r", table.withColumn("embedding", F.col("embedding").cast("array<double>")))
    assert sorted(wide.collect()) == sorted(got.collect())


def test_stems_of_lists_keep_nulls_and_shape():
    import pyarrow as pa
    from eventlens.functions import stem
    rows = [["running", "cats", "the"], None, [], ["running"]]
    assert stem._stem_arrays.func(pa.array(rows, pa.list_(pa.string()))).to_pylist() == [["run", "cat", "the"], None, [], ["run"]]
    nested = [[["running"], []], None, [["cats", "the"]]]
    assert stem._stem_nested.func(pa.array(nested, pa.list_(pa.list_(pa.string())))).to_pylist() == [[["run"], []], None, [["cat", "the"]]]


def test_html_is_decoded_some_rows_at_a_time():
    import pyarrow as pa
    from eventlens.functions import text as T
    rows = ["a &amp; b", None, "", "x &lt;"] * 200
    assert T._html_unescape_udf.func(pa.array(rows)).to_pylist() == ["a & b", None, "", "x <"] * 200


def test_sentence_tokens_are_shuffled_once(spark):
    """Tokens meet their weights without a second shuffle by item and term; null and repeated ids score as before."""
    import re
    from eventlens.operators import summarize as SU
    items = spark.createDataFrame([("a", "Red fox. Red dog."), ("b", "Blue dog."), ("b", "Blue dog."), (None, "Red fox.")], "cluster_id string, multi_doc_input string")
    scores = SU.sentence_scores(items)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(cluster_id#\d+, term#\d+", plan)) == 2
    got = sorted((x["cluster_id"] or "", x["pos"], x["score"]) for x in scores.collect())
    from math import log
    idf = {w: log(4 / n) + 1 for w, n in {"red": 2, "fox": 2, "dog": 2, "blue": 1}.items()}
    want = [("", 0, 0.0), ("a", 0, (2 * idf["red"] + idf["fox"]) / 2), ("a", 1, (2 * idf["red"] + idf["dog"]) / 2)] + [("b", 0, (2 * idf["blue"] + 2 * idf["dog"]) / 2)] * 2
    assert [(a, b, round(c, 6)) for a, b, c in got] == [(a, b, round(c, 6)) for a, b, c in want]
