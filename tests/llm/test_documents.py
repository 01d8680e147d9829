"""Operators 1, 5 and 7 against brute force, and their edge cases."""

import random
import re

import duckdb
import pytest

from llm_helpers import SF_SMALL, near_texts, rows_of
from eventlens.llm import decontaminate, graph, jaccard
from eventlens.llm.quality import quality_rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# ---- operator 1 ---------------------------------------------------------------

def brute_quality(text):
    text = text or ""
    words = WORDS.findall(text)
    seen, repeated = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            repeated.update(k for i in at for k in range(i, i + 5))
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            len(words) < 10 or 100 * len(repeated) > 20 * len(words))


def test_quality_measures(spark):
    r = random.Random(5)
    texts = near_texts(3, 60, vocab=12) + near_texts(4, 30) + [
        None, "", " \n\t", "a", "|" * 50, "a b c d e " * 9, "x y z w v u\n" * 4 + "t", "é# ü$\n\n# ü$",
        " ".join(r.choice("abc") for _ in range(5000)), "a\x1cb c d\x0be\x0cf"]
    got = {x["doc_id"]: x for x in rows_of(quality_rules(frame(spark, texts)))}
    for i, t in enumerate(texts):
        x = got[i]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"], x["base_failed"]) == brute_quality(t), (i, t)
        assert not (x["kept"] and x["base_failed"])


def test_quality_is_native_and_filters_do_not_repeat_it(spark):
    df = quality_rules(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).where("kept").select("doc_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert plan.count("xxhash64") <= 2


def test_quality_edges(spark):
    df = spark.createDataFrame([(None, None, 5, "a"), (1, "a b " * 20, 6, None), (1, "a b " * 20, 6, None)],
                               "doc_id long, text string, n_words int, kept string")
    got = rows_of(quality_rules(df))
    assert sorted((r["doc_id"] or 0, r["n_words"], r["kept"]) for r in got) == [(0, 0, False), (1, 40, False), (1, 40, False)]
    assert quality_rules(df.limit(0)).collect() == []


# ---- operator 5 ---------------------------------------------------------------

ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return ITEM_WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items):
    w = lowered(text)
    hit, found = set(), set()
    for key, t in items:
        q = lowered(t)
        size = min(10, len(q))
        if not size:
            continue
        windows = {tuple(q[i:i + size]) for i in range(len(q) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(key))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("most", [100_000, 0])
def test_contamination(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", most)
    r = random.Random(1)
    word = lambda: r.choice(["alpha", "Beta", "gam-ma", "été", "Ünit", "x1", "of", "THE"]) + str(r.randrange(40))
    items = [(k, " ".join(word() for _ in range(r.choice([3, 1, 9, 10, 11, 25, 40])))) for k in range(30)]
    items += [(40, None), (41, ""), (42, "--- !!"), (2, items[2][1]), (43, items[20][1])]
    docs = []
    for _ in range(80):
        t = [word() for _ in range(r.randrange(60))]
        for _ in range(r.randrange(3)):
            q = re.split(" ", r.choice(items[:30])[1])
            a = r.randrange(len(q))
            t += q[a:a + r.randrange(4, 30)]
            t += [word()]
        docs.append(r.choice([" ", ", ", "\n"]).join(t).upper() if r.random() < .3 else " ".join(t))
    docs += [None, "", "!!!", items[7][1], items[7][1] * 3]
    got = {x["id"]: x for x in rows_of(decontaminate.contamination(frame(spark, docs).repartition(4), spark.createDataFrame(items, "item_id long, text string")))}
    assert len(got) == len(docs)
    for i, t in enumerate(docs):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == brute_hits(t, items), i
        assert got[i]["contaminated"] == (got[i]["n_hit"] > 0)
    clean = decontaminate.decontaminate(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(x["doc_id"] for x in rows_of(clean)) == [i for i in range(len(docs)) if not got[i]["n_hit"]]


def test_contamination_edges(spark):
    item = " ".join(f"q{i}" for i in range(12))
    docs = spark.createDataFrame([(None, item, "n"), (1, item, "a"), (1, item, "a"), (1, "clean", "b"), (2, None, None)],
                                 "doc_id long, text string, items string")
    items = spark.createDataFrame([(None, item, 1), (7, item, 2), (7, item, 2)], "item_id long, text string, doc_id int")
    got = rows_of(decontaminate.contamination(docs, items))
    assert sorted((r["id"], r["n_hit"], tuple(r["items"])) for r in got) == [
        (-2**63, 12, ("", "7")), (1, 0, ()), (1, 12, ("", "7")), (1, 12, ("", "7")), (2, 0, ())]
    assert [r["items"] for r in rows_of(decontaminate.decontaminate(docs, items).orderBy("doc_id"))] == ["b", None]
    assert decontaminate.contamination(docs.limit(0), items).collect() == []
    assert not any(r["contaminated"] for r in rows_of(decontaminate.contamination(docs, items.limit(0))))


# ---- operator 7 ---------------------------------------------------------------

def shingles(text):
    w = WORDS.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_classes(texts):
    sets = [shingles(t) for t in texts]
    links = [set() for _ in texts]
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j]:
                n = len(sets[i] & sets[j])
                if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n):
                    links[i].add(j)
                    links[j].add(i)
    root = list(range(len(texts)))
    for _ in texts:
        for i, x in enumerate(links):
            root[i] = min([root[i], *(root[j] for j in x)])
    return [(root[i], len(links[i])) for i in range(len(texts))]


@pytest.mark.parametrize("seed,block", [(0, None), (1, 6)])
def test_jaccard_join(spark, monkeypatch, seed, block):
    if block:  # every component is split into several blocks
        monkeypatch.setattr(jaccard, "BLOCK_TEXTS", block)
    texts = near_texts(seed, 90, words=120) + [None, "", "  ", "one two", "one two", "one  two", "one two three"]
    want = brute_classes(texts)
    got = {r["id"]: r for r in rows_of(jaccard.jaccard_join(frame(spark, texts).repartition(3)))}
    assert sum(n for _, n in want) > 20
    assert [(got[i]["class_id"], got[i]["n_links"]) for i in range(len(texts))] == want
    left = sorted(r["doc_id"] for r in rows_of(jaccard.one_of_each(frame(spark, texts))))
    assert left == sorted(i for i in range(len(texts)) if want[i][0] == i)


def test_jaccard_edges(spark):
    t = " ".join(f"z{i}" for i in range(60))
    docs = spark.createDataFrame([(3, t, 1), (3, t, 1), (None, t + " end", 2), (9, " ".join(f"v{i}" for i in range(20000)), 3)], "doc_id long, text string, key int")
    got = sorted((r["id"] or 0, r["class_id"], r["n_links"], r["class_size"]) for r in rows_of(jaccard.jaccard_join(docs)))
    assert got == [(0, 3, 2, 3), (3, 3, 2, 3), (3, 3, 2, 3), (9, 9, 0, 1)]
    assert sorted((r["doc_id"], r["key"]) for r in rows_of(jaccard.one_of_each(docs))) == [(3, 1), (9, 3)]
    assert jaccard.jaccard_join(docs.limit(0)).collect() == []


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1200)]
    root = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {x["node"]: x["component"] for x in rows_of(graph.components(spark.createDataFrame(edges, "a long, b long")))}
    assert got == {x: y for x, y in root.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_prefix_depth():
    assert jaccard.prefix_depth(24, .999, .8) == 6
    assert jaccard.prefix_depth(24, .99999, .8) < 6


def test_quality_oracle_words():
    """The DuckDB twin counts the same words as Python."""
    from eventlens.llm.queries import ORACLES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed FROM ({ORACLES['op1_quality_rules']})").fetchall()}
    for d, t in con.execute("SELECT doc_id, text FROM documents").fetchall():
        assert got[d] == brute_quality(t)
