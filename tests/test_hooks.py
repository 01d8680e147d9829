"""Model hooks: batches, options, reuse, and the stages that use them."""

import pytest
from pyspark.sql import functions as F

from eventlens.operators import score as SC
from eventlens.operators import summarize as SU
from eventlens.operators import vectors as V
from eventlens.operators.hooks import Hook, apply_hook, get_hook, register_hook


def seeing():
    """A model whose answer tells the batch it saw and its limits."""
    def call(texts, max_tokens=0, beams=1):
        return [f"{len(texts)}/{max_tokens}/{beams}: {' '.join(t.split()[:max_tokens])}" for t in texts]
    return call


def frame(spark, n=23):
    return spark.createDataFrame([(i, None if i == 5 else f"One two {i}. Three four.") for i in range(n)], "cluster_id long, multi_doc_input string").coalesce(1)


def by_value(factory):
    """The factory by value: workers do not import this test module."""
    factory.__module__ = "__main__"
    return factory


def test_each_stage_has_its_batch_size_and_limits(spark):
    model = by_value(seeing)
    head = Hook(factory=model, batch_size=4).with_options(max_tokens=2, beams=3)
    summ = Hook(factory=model, batch_size=9).with_options(max_tokens=1)
    got = SU.two_stage(frame(spark), head, summ).collect()
    heads = [r["generated_headline"].split(":")[0] for r in got]
    assert heads.count("4/2/3") == 20 and heads.count("3/2/3") == 3  # 23 rows in fours
    assert sum(r["generated_summary"].startswith("9/1/1:") for r in got) == 18
    one = [r for r in got if r["cluster_id"] == 7][0]
    assert one["generated_headline"] == "4/2/3: One two" and one["generated_summary"] == "9/1/1: 4/2/3:"
    assert [r for r in got if r["cluster_id"] == 5][0]["generated_headline"].strip().endswith(":")  # null text: an empty string


def test_hook_contract(spark):
    with pytest.raises(ValueError):
        Hook()
    with pytest.raises(ValueError):
        Hook(factory=seeing, column=F.lower)
    with pytest.raises(ValueError):
        Hook(factory=seeing, batch_size=0)
    with pytest.raises(ValueError):
        register_hook("painter", "x", Hook(column=F.lower))
    with pytest.raises(KeyError):
        get_hook("generator", "nobody")
    short = by_value(lambda: lambda texts: texts[:-1])
    with pytest.raises(Exception, match="results for"):
        apply_hook(frame(spark), Hook(factory=short), "multi_doc_input", "x").collect()
    df = spark.createDataFrame([("a", 1)], "text string, x int")
    assert apply_hook(df, Hook(column=F.upper), "text", "x").first().asDict() == {"text": "a", "x": "A"}
    assert apply_hook(df, Hook(factory=by_value(lambda: lambda t: [9.5])), "text", "x", "double").first().asDict() == {"text": "a", "x": 9.5}


def test_model_is_built_once_in_a_worker(spark):
    def counting():
        import builtins
        builtins._built = getattr(builtins, "_built", 0) + 1
        return lambda texts: [builtins._built] * len(texts)
    out = apply_hook(frame(spark, 60), Hook(factory=counting, batch_size=1), "multi_doc_input", "n", "long")
    assert out.agg(F.max("n")).first()[0] == 1


def test_encoder_and_metric_hooks(spark):
    df = spark.createDataFrame([(1, "abba"), (2, ""), (3, None)], "id long, text string")
    got = {r["id"]: r["vec"] for r in V.encode_with(df, get_hook("encoder", "letter-profile")).collect()}
    assert got[1][:2] == pytest.approx([2 / 8 ** .5, 2 / 8 ** .5]) and set(got[2]) == set(got[3]) == {0.0}
    pairs = spark.createDataFrame([(1, "a b c", "b c d"), (2, "", "x"), (3, None, None)], "pair_id long, prediction string, reference string")
    f1 = {r[0]: r[1] for r in SC.score_with(pairs, get_hook("metric", "token-f1"), "f").collect()}
    assert f1 == {1: pytest.approx(2 / 3), 2: 0.0, 3: 0.0}
    assert {r[0]: r[1] for r in SC.score_with(pairs, get_hook("metric", "length-ratio"), "r").collect()} == {1: 1.0, 2: 0.0, 3: 1.0}


def test_scorer_stemmer_dialect():
    from eventlens.functions.stem import porter_stem as s
    pairs = {"news": "news", "died": "die", "enjoy": "enjoy", "dying": "die", "skies": "sky", "ties": "tie", "tied": "tie", "spied": "spi",
             "happily": "happili", "possibly": "possibl", "usefulli": "use", "geology": "geolog", "proceed": "proceed", "innings": "inning",
             "generally": "gener", "playing": "play", "crying": "cri", "by": "by", "controlling": "control", "rolled": "roll", "filing": "file"}
    assert {w: s(w) for w in pairs} == pairs


def test_tokens_without_vector_match_nothing(spark):
    from eventlens.operators import evaluate as EV
    words = [f"w{i}" for i in range(30)]
    import hashlib
    row = {w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 50 for w in words}
    table = spark.createDataFrame([(i, [float((i * k) % 7 - 3) for k in range(1, 6)]) for i in range(50) if i != row["w3"]] + [(49, None)][:0],
                                  "vec_id long, embedding array<double>")
    if 49 == row["w3"]:
        row = {w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 49 for w in words}
    pairs = spark.createDataFrame([(1, "w3 w1", "w1 w3"), (2, "w3", "w3"), (3, "", "w1"), (4, "", ""), (5, "w1 w2", "w1 w2")], "id long, p string, r string")
    got = {r["id"]: (r["precision"], r["recall"]) for r in EV.greedy_pairs(pairs, "id", "p", "r", table).collect()}
    assert 4 not in got and got[3] == got[2] == (0.0, 0.0)
    assert got[1] == (pytest.approx(.5), pytest.approx(.5)) and got[5] == (pytest.approx(1), pytest.approx(1))
