"""Packing and prefix sums against plain Python."""

import random

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eventlens.operators import groups as G
from eventlens.operators.ordering import segmented_scan


def plain_pack(texts, budget, tokens=str.split, join=" ".join):
    used, out = 0, []
    for t in texts:
        n = len(tokens(t or ""))
        if not n or used >= budget:
            continue
        out.append(t if used + n <= budget else join(tokens(t)[:budget - used]))
        used += n
    return "\n\n".join(out)


def articles(seed=3):
    r = random.Random(seed)
    rows = []
    for g in range(6):
        for i in range(r.randrange(1, 40)):
            rows.append((g, i, r.choice(["", None, " ", " ".join(f"w{r.randrange(99)}" for _ in range(r.randrange(1, 30)))])))
    # A hot group that starts with more empty articles than the budget has tokens.
    rows += [(9, i, "" if i < 1024 else f"late {i} words here") for i in range(3000)]
    return rows


def test_all_forms_equal_plain_packing(spark):
    rows = articles()
    want = {}
    for g in {r[0] for r in rows}:
        packed = plain_pack([t for k, _, t in sorted(rows, key=lambda r: r[:2]) if k == g], 50)
        if packed:
            want[g] = packed
    df = spark.createDataFrame(rows, "g int, pos long, text string").repartition(5)
    long = G.pack_groups(df, "g", ["pos"], ["g", "pos"], "text", 50)
    assert {r["g"]: r["multi_doc_input"] for r in long.collect()} == want
    arrays = df.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("a")).select(
        "g", G.pack_array(F.transform("a", lambda e: e["text"]), 50).alias("x"))
    assert {r["g"]: r["x"] for r in arrays.collect() if r["x"]} == want


def test_leading_empty_articles_use_no_budget(spark):
    df = spark.createDataFrame([(1, i, "" if i < 1024 else f"text {i}") for i in range(1500)], "g int, pos long, text string")
    r = G.pack_groups(df, "g", ["pos"], ["pos"], "text", 1024).first()
    assert r["n_packed"] == 476 and r["multi_doc_input"].startswith("text 1024")


def test_model_tokenizer_counts_its_own_tokens(spark):
    def letters():
        """A tokenizer with one token for each character."""
        class Letters:
            def encode(self, text):
                return [ord(c) for c in text]

            def decode(self, ids):
                return "".join(map(chr, ids))
        return Letters()

    rows = [(1, 0, "abcdef"), (1, 1, "ghij"), (1, 2, "klm"), (2, 0, None), (3, 0, "zz")]
    df = spark.createDataFrame(rows, "g int, pos long, text string")
    got = G.pack_groups(df, "g", ["pos"], ["g", "pos"], "text", 8, G.model_tokenizer(letters)).collect()
    assert {r["g"]: r["multi_doc_input"] for r in got} == {1: "abcdef\n\ngh", 3: "zz"}


def test_prefix_sums_over_any_partitions(spark):
    r = random.Random(1)
    rows = [(r.choice([None, "a", "hot", "hot", "hot"]), i, r.randrange(9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, i long, n long").repartition(7)
    for parts in (1, 3, 16):
        got = {x["i"]: (x["at"], x["before"]) for x in segmented_scan(df, ["g"], ["i"], {"before": "n"}, rank="at", partitions=parts).collect()}
        count, total = {}, {}
        for g, i, n in rows:
            assert got[i] == (count.get(g, 0) + 1, total.get(g, 0)), (parts, i)
            count[g], total[g] = count.get(g, 0) + 1, total.get(g, 0) + n
    assert segmented_scan(df.limit(0), ["g"], ["i"]).collect() == []


def test_packing_does_not_depend_on_session_settings(spark):
    """No window over articles, so the group limit of a session does not matter."""
    other = spark.newSession()
    assert isinstance(other, SparkSession) and other.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    other.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    df = other.createDataFrame([(1, i, f"text {i}") for i in range(900)], "g int, pos long, text string")
    assert G.pack_groups(df, "g", ["pos"], ["pos"], "text", 100).first()["n_packed"] == 50
