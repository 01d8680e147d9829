"""The corpus pipeline, stage by stage in plain Python, against run()."""

import random

import corpus_pipeline
from eventlens.llm import lattice
from eventlens.llm.quality import STOP_WORDS
from llm_helpers import near_texts, rows_of
from test_documents import WORDS, brute_classes, brute_hits, brute_quality
from test_windows import brute


def kept(text):
    n, chars, symbols, dup, _, failed = brute_quality(text)
    words, lines = WORDS.findall(text), [x for x in text.split("\n") if WORDS.search(x)]
    letters, upper = sum(c.isalpha() for c in text), sum(c.isupper() for c in text)
    stop = sum(w.lower() in STOP_WORDS for w in words)
    return not (failed or not 200 * n <= 100 * chars <= 1500 * n or 100 * symbols > 10 * chars
                or len(lines) >= 4 and 100 * dup > 30 * len(lines) or n >= 50 and 100 * stop < 2 * n
                or letters >= 50 and 100 * upper > 60 * letters or n >= 20 and 100 * text.count("!") > 50 * n)


def test_pipeline(spark, tmp_path):
    r = random.Random(8)
    texts = near_texts(21, 60) + ["", "| # $ % " * 30, "SHOUTING WORDS ONLY " * 30]
    item = " ".join(f"bench{r.randrange(90)}" for _ in range(30))
    texts += [near_texts(22, 1)[0] + " and the " + item + " of it", "the " * 3 + " ".join(f"u{i}" for i in range(70))]
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [(i, t) for i, t in enumerate(texts) if kept(t)]
    classes = brute_classes([t for _, t in left])
    left = [d for k, d in enumerate(left) if classes[k][0] == k]
    cut = brute(left, 50)
    words = {d: [x for i, x in enumerate(w) if i not in gone] for d, (w, gone) in cut.items()}
    want = {d: w for d, w in words.items() if not brute_hits(" ".join(w), [(0, item)])[1]}
    assert 5 < len(want) < len(words) < len(texts) and any(gone for _, gone in cut.values())

    out = corpus_pipeline.run(spark, str(tmp_path))
    got = rows_of(out.withColumn("text", lattice.decode(out["ids"])))
    assert {x["doc_id"]: WORDS.findall(x["text"]) for x in got} == want
    assert all(x["exact"] and x["n_tokens"] == len(x["ids"]) for x in got)


def test_stages_keep_columns_and_take_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, id int, key string")
    for _, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, empty, "/root/testdata/sf0.001")
        assert got.columns == empty.columns and got.collect() == []
    assert corpus_pipeline.STAGES[4][1](spark, empty, "/root/testdata/sf0.001").collect() == []
