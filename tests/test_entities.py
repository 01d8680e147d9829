"""Dictionary mentions and highlights."""

from pyspark.sql import functions as F

from eventlens.operators import entities as EN

PHRASES = [("Bosnia and Herzegovina", "GPE"), ("Herzegovina", "GPE"), ("United Arab Emirates Air Force", "ORG"), ("United", "ORG"),
           ("span", "ORG"), ("class", "EVENT"), ("Ana", "PERSON"), ("Ana", "ORG"), ("two  gaps", "ORG"), ("", "ORG"), (None, "ORG"), ("x", None)]
TEXTS = [(1, "In Bosnia and Herzegovina, the United Arab Emirates Air Force met Ana."), (2, None), (3, ""), (4, "  "),
         (5, "span of a class: 2024-01-05, 2024-1-5 and Ana\tAna"), (6, "United Arab Emirates Air"), (7, "Bosnia  and\nHerzegovina!")]


def frames(spark):
    return spark.createDataFrame(TEXTS, "cluster_id long, text string"), spark.createDataFrame(PHRASES, "phrase string, label string")


def rows(df):
    return sorted((r["cluster_id"], r["text"], r["label"], r["start"], r["end"]) for r in df.collect())


def test_phrases_of_any_length(spark):
    docs, names = frames(spark)
    got = rows(EN.extract_entities(docs, names, types=None))
    found = {(i, t, lab) for i, t, lab, _, _ in got}
    assert {(1, "Bosnia and Herzegovina", "GPE"), (1, "United Arab Emirates Air Force", "ORG"), (1, "United", "ORG"), (1, "Herzegovina", "GPE"),
            (1, "Ana", "ORG"), (1, "Ana", "PERSON"), (5, "2024-01-05", "DATE"), (5, "span", "ORG"), (6, "United", "ORG"),
            (7, "Bosnia and Herzegovina", "GPE"), (7, "Herzegovina", "GPE"), (5, "class", "EVENT"), (5, "Ana", "ORG"), (5, "Ana", "PERSON")} == found
    text = dict(TEXTS)
    for i, t, lab, start, end in got:
        assert " ".join(text[i][start:end].split()) == t
    assert len([g for g in got if g[0] == 5 and g[1] == "Ana"]) == 4


def test_joined_dictionary_equals_trie(spark, monkeypatch):
    docs, names = frames(spark)
    want = rows(EN.extract_entities(docs, names))
    monkeypatch.setattr(EN, "TRIE_PHRASES", 3)
    assert rows(EN.extract_entities(docs, names)) == want


def test_trie_matching_shuffles_nothing(spark):
    docs, names = frames(spark)
    plan = EN.extract_entities(docs, names)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_highlight_overlaps_and_markup_words(spark):
    text = "Ana and span class Ana Maria"
    cases = [
        ([("Ana", "PERSON", 0, 3), ("span", "ORG", 8, 12), ("class", "EVENT", 13, 18)],
         '<span class="ent ent-PERSON">Ana</span> and <span class="ent ent-ORG">span</span> <span class="ent ent-EVENT">class</span> Ana Maria'),
        ([("Ana", "PERSON", 19, 22), ("Ana Maria", "PERSON", 19, 28), ("Maria", "GPE", 23, 28), ("Ana Maria", "ORG", 19, 28)],
         'Ana and span class <span class="ent ent-ORG">Ana Maria</span>'),
        ([("x", "ORG", -1, 2), ("x", "ORG", 5, 99), ("x", "ORG", 4, 4), ("x", "ORG", None, 3)], text),
        ([], text), (None, text)]
    df = spark.createDataFrame([(i, text, e) for i, (e, _) in enumerate(cases)], f"i int, text string, e {EN.MENTIONS}")
    got = {r["i"]: r["h"] for r in df.select("i", EN.highlight(F.col("text"), F.col("e")).alias("h")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]
