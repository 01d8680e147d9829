"""Operators 3, 4, 6, 8 and 9: brute force, round trips and held-out accuracy."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF_SMALL, near_texts, rows_of
from eventlens.llm import chat, langid, lattice, lm_score, toxicity
from eventlens.llm import words as W
from eventlens.llm.pieces import NORMAL, read_pieces
from eventlens.sources.tables import read_table

SF_MID = "/root/testdata/sf0.01"


# ---- operator 3 ---------------------------------------------------------------

def test_bigram_models(spark):
    r = random.Random(2)
    texts = [" ".join(r.choice("the cat dog sat on mat ran".split()) for _ in range(r.randrange(0, 30))) for _ in range(40)]
    rows = [(i, t, i % 3 == 0) for i, t in enumerate(texts)] + [(40, None, True), (41, "unseen words only", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, target boolean")
    vocabulary = sorted({w for _, t, _ in rows for w in (t or "").split()})
    size = len(vocabulary) + 2

    def model_of(keep, total):
        pairs, single, history = Counter(), Counter(), Counter()
        for _, t, target in rows:
            w = (t or "").split()
            if keep(target):
                for a, b in zip(["<s>"] + w, w):
                    pairs[a, b] += 1
                    single[b] += 1
                    history[a] += 1
        up = total / sum(single.values()) if total else 1
        return {k: v * up for k, v in pairs.items()}, {k: v * up for k, v in single.items()}, {k: v * up for k, v in history.items()}, sum(single.values())

    *back, total = model_of(lambda t: True, None)
    front = model_of(bool, total)[:3]

    def loss(m, a, b):
        pairs, single, history = m
        n = sum(single.values())
        word = lambda w: (single.get(w, 0) + 1) / (n + size)
        own = lambda x, y: max(pairs.get((x, y), 0) - lm_score.DISCOUNT, 0)
        h = max(1, history.get(a, 0))
        if own(a, b):
            return -math.log(own(a, b) / h)
        mass = sum(own(a, w) for w in vocabulary) / h
        seen = sum(word(w) for w in vocabulary if own(a, w))
        return -math.log((1 - mass) / (1 - seen) * word(b))

    got = {x["id"]: x for x in rows_of(lm_score.score_corpus(df))}
    for i, t, _ in rows:
        w = (t or "").split()
        assert got[i]["n_tokens"] == len(w)
        if not w:
            assert got[i]["score"] is None
            continue
        want = [sum(loss(m, a, b) for a, b in zip(["<s>"] + w, w)) / len(w) for m in (front, back)]
        assert [got[i]["target_loss"], got[i]["background_loss"]] == pytest.approx(want, rel=1e-6)
        assert got[i]["score"] == pytest.approx(want[0] - want[1], abs=1e-6)


def test_lm_edges(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, "", "y")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    marked = lm_score.with_target(df, labels)
    assert sorted(r["target"] for r in rows_of(marked)) == [False, True, True]
    got = rows_of(lm_score.score_corpus(marked))
    assert sorted((r["id"] is None, r["n_tokens"]) for r in got) == [(False, 2), (False, 2), (True, 0)]
    assert lm_score.score_corpus(marked.limit(0)).collect() == []
    # Without target rows the target model is uniform over the words and the two spare entries.
    none = rows_of(lm_score.score_corpus(marked.withColumn("target", F.lit(None).cast("boolean"))))
    assert [r["target_loss"] for r in none if r["n_tokens"]] == pytest.approx([math.log(4)] * 2)


def test_lm_rows_only_scored_and_cuts(spark, monkeypatch):
    """Rows that are not counted change no score; groups of any size give the same ones."""
    texts = near_texts(9, n=60)
    df = spark.createDataFrame([(i, t, i % 4 == 0) for i, t in enumerate(texts)], "doc_id long, text string, target boolean")
    want = {r["id"]: r for r in rows_of(lm_score.score_corpus(df))}
    more = df.withColumn("counted", F.lit(True)).union(spark.createDataFrame([(1000, "quite unseen words " + texts[0], True, False)],
                                                                            "doc_id long, text string, target boolean, counted boolean"))
    monkeypatch.setattr(lm_score, "GROUP_WORDS", 50)
    got = {r["id"]: r for r in rows_of(lm_score.score_corpus(more.repartition(5), counted_col="counted"))}
    assert got.pop(1000)["score"] is not None
    assert got.keys() == want.keys()
    for i, r in want.items():
        assert got[i]["n_tokens"] == r["n_tokens"]
        if r["n_tokens"]:
            assert [got[i]["target_loss"], got[i]["background_loss"]] == pytest.approx([r["target_loss"], r["background_loss"]], rel=1e-9)


def test_lm_slices_stay_where_they_are(spark, monkeypatch):
    """Only what answers a slice is shuffled to it, not the slice; cut otherwise, the same rows score alike to the last bit."""
    df = spark.createDataFrame([(i, t, i % 4 == 0) for i, t in enumerate(near_texts(5, n=60))], "doc_id long, text string, target boolean").repartition(3, "doc_id")
    scored = lm_score.score_corpus(df)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(part") == 1
    want = sorted(scored.collect())
    monkeypatch.setattr(lm_score, "SLICE_BYTES", 2000)
    assert sorted(lm_score.score_corpus(df).collect()) == want
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("eventlens_buckets")]


def test_lm_rare_words_are_kept(spark):
    """Words that occur once among 150,000 are words of their own, in both models."""
    texts = [("x y " * 75000, False), ("alpha x", True), ("beta x", False)]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id long, text string, target boolean")
    got = {r["id"]: r for r in rows_of(lm_score.score_corpus(df))}
    size, total = 4 + 2, 150004
    up = total / 2
    word = lambda n: (n + 1) / (total + size)
    # The target model saw "alpha x" once, scaled up; "beta" is left to the back-off from the start of a row.
    alpha = -math.log((up - .75) / up)
    beta = [-math.log((.75 / up) / (1 - word(up)) * word(0)), -math.log(word(up))]
    assert got[1]["target_loss"] == pytest.approx(alpha, rel=1e-6, abs=1e-12)
    assert got[2]["target_loss"] == pytest.approx(sum(beta) / 2, rel=1e-6)
    # The background saw each of them once, after 1 of 3 starts, and before one x.
    assert [got[i]["background_loss"] for i in (1, 2)] == pytest.approx([-(math.log(.25 / 3) + math.log(.25)) / 2] * 2, rel=1e-6)


# ---- operator 4 ---------------------------------------------------------------

def best_path(unit, pieces, longest, unknown):
    best = [(0.0, [])] + [None] * len(unit)
    for e in range(1, len(unit) + 1):
        for s in range(max(0, e - longest), e):
            p = pieces.get(unit[s:e])
            if p is None and e - s > 1:
                continue
            score, ids = p if p else (unknown, [3 + b for b in unit[s:e].encode()])
            if best[e] is None or best[s][0] + score > best[e][0]:
                best[e] = (best[s][0] + score, best[s][1] + ids)
    return best[-1][1]


TEXTS = ["Hello world", "  two  spaces   here ", "line\nbreak\ttab", "été naïve Ünïcode", "漢字 and emoji 🙂🙂", "▁ is a mark", "", " ",
         "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "x" * 1200, "\x00\x01 control", "1234567890 3.14", "a" + " " * 40 + "b", "\n", " "]


def test_encode_matches_viterbi_and_decodes(spark):
    texts = TEXTS + near_texts(4, 20)
    rows = list(enumerate(texts)) + [(None, "null id"), (900, None), (0, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", lattice.F.lit(1))
    table = [p for p in read_pieces() if p.kind == NORMAL]
    pieces = {p.text.replace("▁", " "): (p.score, [p.id]) for p in table}
    longest, unknown = max(map(len, pieces)), min(p.score for p in table) - 10
    enc = lattice.encode(df.repartition(3))
    got = rows_of(enc.withColumn("back", lattice.decode(lattice.F.col("ids"))))
    assert len(got) == len(rows)
    for r in got:
        if r["text"] is None:
            assert r["ids"] == [] and r["id"] == 900 and r["exact"] is None
            continue
        assert r["back"] == r["text"] and r["exact"], r["text"]
        assert r["n_tokens"] == len(r["ids"])
        if len(r["text"]) < 500:
            assert r["ids"] == (best_path(" " + r["text"], pieces, longest, unknown) if r["text"] else []), r["text"]
    assert lattice.encode(df.limit(0)).collect() == []


def assert_best_paths(spark, texts):
    table = [p for p in read_pieces() if p.kind == NORMAL]
    pieces = {p.text.replace("▁", " "): (p.score, [p.id]) for p in table}
    longest, unknown = max(map(len, pieces)), min(p.score for p in table) - 10
    got = {r["id"]: r for r in rows_of(lattice.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))}
    for i, t in enumerate(texts):
        assert got[i]["exact"] and got[i]["ids"] == best_path(" " + t, pieces, longest, unknown), t


def test_pieces_with_control_characters_are_used(spark):
    assert_best_paths(spark, [" A line.\r\nNext", "a();\r\n\r\nb }\r\n", "\r\r\r", "x \r", "one,\r\ttwo;\r"])


def test_long_runs_are_one_unit(spark):
    r = random.Random(7)
    run = "".join(r.choice("the international segmentation of words which are joined without any space".split()) for _ in range(260))
    assert len(run) > 1500
    assert_best_paths(spark, [run, f"a {run} b {run}, c", "漢字仮名交じり文" * 150, "a" + " " * 1300 + "b", "🙂" * 600])


def test_exact_notices_a_change():
    decoder = lattice.Decoder()
    plain = {p.text: p.id for p in read_pieces()}
    ids, ends = np.array([plain["▁the"], plain["▁cat"], plain["▁the"]]), np.array([0, 2, 2, 3])
    assert lattice._exact(decoder, ids, ends, b"the catthe", np.array([0, 7, 7, 10])) == [True, True, True]
    assert lattice._exact(decoder, ids, ends, b"the cutthe", np.array([0, 7, 7, 10])) == [False, True, True]
    assert lattice._exact(decoder, ids, ends, b"the catxthe", np.array([0, 7, 8, 11])) == [True, False, True]


def test_matches_the_library_as_a_unigram_model(spark):
    """No path of the library, which reads the same pieces and scores as a unigram model, scores better."""
    sentencepiece = pytest.importorskip("sentencepiece")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    m = pb.ModelProto()
    with open("/opt/tokenizers/piece_bpe_32k.model", "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    known = {p.text for p in read_pieces() if p.kind == NORMAL}
    lines = [x for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect() for x in r[0].split("\n")]
    lines = sorted({" ".join(x.split()[:200]) for x in lines if len(x) > 20})
    # an unknown character costs 1e9 in the library's single precision, which blurs the rest of its line
    lines = [x for x in lines if all(c == " " or c in known for c in x)][:150] + ["Hello world 123.", "déjà vu (2)"]
    got = {r["id"]: r["ids"] for r in rows_of(lattice.encode(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")))}
    score = {p.id: p.score for p in read_pieces()}
    total = lambda ids: sum(score[i] for i in ids)
    assert len(lines) > 50
    for i, t in enumerate(lines):  # the library rounds to single precision, so its path may be a little worse
        theirs = lib.encode(t)
        assert total(got[i]) >= total(theirs) and abs(total(got[i]) - total(theirs)) <= 1e-3 * abs(total(theirs)), t


def test_units_are_found_by_ranges_of_hashes():
    """The place that a binary search gives, also for no hashes, one hash and hashes beyond the last."""
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        known = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        h = np.concatenate([known, r.integers(0, 2**64, 500, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        assert (lattice._find(known, lattice._ranges(known), h) == np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))).all()


def test_slices_reach_over_batches(spark):
    """Batches of few rows are put together, and slices are about equal."""
    batches = [pa.RecordBatch.from_pydict({"text": ["x" * 10] * 3}) for _ in range(7)]
    assert [b.num_rows for b in W.merged(iter(batches), "text", 100)] == [6, 6, 6, 3]
    assert [b.num_rows for b in W.merged(iter(batches), "text", 10000)] == [21]
    at = np.arange(0, 1300, 10)
    sizes = [j - i for i, j in W.even_slices(at, 1000)]
    assert sum(sizes) == 129 and len(sizes) == 2 and min(sizes) > 60


# ---- operator 6 ---------------------------------------------------------------

def held(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


@pytest.fixture(scope="module")
def index(spark):
    docs, labels = read_table(spark, SF_MID, "documents"), read_table(spark, SF_MID, "labels")
    return toxicity.fit(docs, labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0"), examples=300)


def test_block_max_search_is_exact(spark, index):
    docs = read_table(spark, SF_MID, "documents").limit(60).collect()
    full = index.post.transpose(0, 2, 1).reshape(-1, len(index.term))
    for d in docs:
        data = np.frombuffer((d["text"] or "").encode(), np.uint8)
        _, h, n = toxicity._terms(data, np.array([0, len(data)]))
        t, w = index.query(h, n)
        found, score = index.search(t, w, 10)
        want = full[:, t] @ w
        top = np.sort(want[want > 0])[::-1][:10]
        assert np.allclose(score, top, atol=1e-5)
        assert np.allclose(want[found], score, atol=1e-5)
    assert index.closed > 0  # some blocks were never opened


def test_toxicity_held_out(spark, index):
    docs, labels = read_table(spark, SF_MID, "documents"), read_table(spark, SF_MID, "labels")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if held(r["doc_id"], 5) == 0}
    got = {r["doc_id"]: r for r in rows_of(toxicity.score_toxicity(docs, index))}
    right = sum(got[d]["predicted"] == t for d, t in truth.items())
    assert right >= 0.9 * len(truth)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= .5) and len(r["evidence"]) <= 3 for r in got.values())


def test_toxicity_edges(spark, index):
    df = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "qqqq zzzz", "s"), (2, "", "s")], "doc_id long, text string, score string")
    got = rows_of(toxicity.score_toxicity(df, index))
    assert len(got) == 4 and len({r["score"] for r in got}) == 1 and all(r["evidence"] == [] for r in got)
    assert toxicity.score_toxicity(df.limit(0), index).collect() == []
    none = toxicity.fit(df.withColumnRenamed("score", "toxic"), spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, toxic int"))
    assert len(rows_of(toxicity.score_toxicity(df, none))) == 4


def test_toxic_documents_rank_above_clean_ones(spark):
    """Always answering "clean" passes a test of accuracy; here toxic held-out documents must score above nine tenths of the clean ones."""
    docs, labels = (read_table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    fold = "crc32(cast(cast(doc_id as string) as binary)) % 5"
    index = toxicity.fit(docs, labels.where(f"{fold} != 0"))
    asked = docs.join(labels.where(f"{fold} = 0 and toxic is not null").select("doc_id", "toxic").distinct(), "doc_id").where("text is not null")
    got = toxicity.score_toxicity(asked, index).select("toxic", "score").collect()
    clean, toxic = sorted(r["score"] for r in got if not r["toxic"]), [r["score"] for r in got if r["toxic"]]
    assert len(toxic) > 50 and sum(s > clean[int(0.9 * len(clean))] for s in toxic) >= 0.7 * len(toxic)


def test_settings_are_chosen_on_the_examples(index):
    assert index.neighbours in toxicity.NEIGHBOURS
    x, y = np.array([.1, .4, .4, .9]), np.array([0, 0, 1, 1])
    assert toxicity.separation(x, y) == 3.5 / 4 and toxicity.separation(x, y * 0) == 0.5


def test_toxicity_counts_every_word(spark, monkeypatch):
    """Cosines over all words, those of one example alone included, equal a plain computation."""
    monkeypatch.setattr(toxicity, "POWERS", (1.0,))
    monkeypatch.setattr(toxicity, "LOGARITHMIC", (True,))
    r = random.Random(5)
    common = [f"c{i}" for i in range(40)]
    texts = [" ".join(r.choices(common, k=30) + [f"own{i}", f"pair{i // 2}"]) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int"))
    df = Counter(w for t in texts for w in set(t.split()))
    assert len(index.term) == len(df)

    def vector(text):
        w = {x: (1 + math.log(c)) * (math.log(301 / (1 + df[x])) + .05) for x, c in Counter(text.split()).items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {x: y / norm for x, y in w.items()}

    asked = ["own7 c1 c2 unheard", "own100", "pair60 c3 c3 nowhere never"]
    got = {x["doc_id"]: x["evidence"] for x in rows_of(toxicity.score_toxicity(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), index))}
    for i, q in enumerate(asked):
        q = vector(q)
        want = sorted((sum(y * q.get(x, 0) for x, y in vector(t).items()) for t in texts), reverse=True)
        assert [e["cosine"] for e in got[i]] == pytest.approx([x for x in want[:3] if x > 0], abs=1e-6)
    assert got[0][0]["id"] == 7 and [e["id"] for e in got[1]] == [100] and {e["id"] for e in got[2][:2]} == {120, 121}


# ---- operator 8 ---------------------------------------------------------------

def test_forward_sums_all_segmentations():
    pieces = langid.Pieces()
    rng = np.random.default_rng(1)
    prob = rng.random((pieces.n, 2)) * 1e-2
    words = W.find_words(np.frombuffer("the naïve étés".encode(), np.uint8), np.array([0, 17]))
    expect = np.zeros_like(prob)
    got = langid.word_scores(words, np.arange(3), pieces, prob, expect, np.ones((3, 2)))
    raw = words.buf.tobytes()
    total = np.zeros_like(prob)
    for k, (s, e) in enumerate(zip(words.start, words.end)):
        w = b" " + raw[s:e]
        h = lambda i, j: pieces.find(W.Spans(W.BYTE_CODE[np.frombuffer(w, np.uint8)], W._BYTES).hash(np.array([i]), np.array([j])))[0]  # noqa: B023, E731
        grid = {(i, j): h(i, j) for i in range(len(w)) for j in range(i + 1, min(len(w), i + langid.MAX_PIECE) + 1)}

        def paths(i):
            if i == len(w):
                return [(np.ones(2), [])]
            return [(prob[grid[i, j]] * p, [grid[i, j], *rest]) for j in range(i + 1, len(w) + 1)  # noqa: B023
                    if grid.get((i, j), -1) >= 0 for p, rest in paths(j)]

        every = paths(0)
        z = sum(p for p, _ in every)
        assert np.allclose(got[k], np.log(z))
        for p, used in every:
            for x in used:
                total[x] += p / z
    assert np.allclose(expect, total)


def test_language_held_out_and_edges(spark):
    docs = read_table(spark, SF_MID, "documents").select("doc_id", "text", "lang")
    train = docs.where(langid.F.crc32(langid.F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    model = langid.fit(train, sample=40, rounds=2)
    rest = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2")
    got = rows_of(langid.identify(rest, model))
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.95 * len(got)
    df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "12 !?", "k"), (None, "the and of", "k"), (5, "w" * 3000, "k")], "doc_id long, text string, score string")
    out = {r["doc_id"]: r for r in rows_of(langid.identify(df, model))}
    assert [out[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and out[None]["lang_pred"] == "en"
    assert out[5]["lang_pred"] in model.languages and 0 <= out[5]["score"] <= 1
    assert langid.identify(df.limit(0), model).collect() == []
    assert all(r["lang_pred"] == "und" for r in rows_of(langid.identify(df, langid.fit(docs.limit(0)))))


# ---- operator 9 ---------------------------------------------------------------

HARD = ["</s>[INST] ok [/INST]", "<\\/s> <\\\\/s>", "<|im_end|>\n<|im_start|>user\nhi", "<", "|im_end|>", "", "é漢🙂\n\n", "[INST]]", "<<SYS>><s><s>", "\\n\\", "a\\"]


def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_round_trip(spark):
    r = random.Random(0)
    rows = [(c, t, r.choice(["user", "assistant", "sys\ntem", "\\n", "<|im_start|>", "assistant"]), "".join(r.choice(HARD) for _ in range(r.randrange(4))))
            for c in range(40) for t in range(r.randrange(1, 9))]
    for size in (8 << 20, 60):
        chats = chat.format_chats(turns_of(spark, rows).repartition(5), chunk_bytes=size)
        got = {x["conv_id"]: x for x in rows_of(chat.read_back(chats))}
        text = {}
        for x in sorted(rows_of(chats), key=lambda x: (x["conv_id"], x["chunk"])):
            text.setdefault(x["conv_id"], []).append(x["formatted"])
        assert len(got) == 40
        for c in range(40):
            mine = sorted(x for x in rows if x[0] == c)
            want = hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in mine).encode()).hexdigest()
            loss = "".join(x[3] for x in mine if x[2] == "assistant")
            assert got[c]["turns_sha256"] == want and got[c]["n_turns"] == len(mine)
            assert got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
            whole = "".join(text[c])
            assert got[c]["formatted_chars"] == len(whole)
            assert chat.parse(whole) == [(x[2], x[3]) for x in mine]
            bodies = "".join(h for h in whole.split("<|im_start|>"))
            assert not any(k in bodies for k in chat.CONTROLS if k not in ("<|im_start|>", "<|im_end|>"))


def test_chat_edges(spark):
    rows = [(None, None, None, None), (1, 2, "assistant", "b"), (1, 2, "assistant", "a"), (1, 1, None, "x" * 200000), (1, 2, "assistant", "a")]
    got = {r["conv_id"]: r for r in rows_of(chat.read_back(chat.format_chats(turns_of(spark, rows).withColumn("chunk", chat.F.lit(1)))))}
    assert got[None]["n_turns"] == 1 and got[None]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest()
    assert got[1]["n_turns"] == 4 and got[1]["loss_sha256"] == hashlib.sha256(b"aab").hexdigest()
    assert chat.format_chats(turns_of(spark, rows).limit(0)).collect() == []


def test_long_words_and_pieces_are_whole():
    """Words of over 32 bytes are not cut, batches of unlike lengths agree with words alone, and no piece is left out."""
    pieces = langid.Pieces()
    assert sum(p.kind == langid.NORMAL and " " not in p.text.replace("▁", " ")[1:] and len(p.text.replace("▁", " ").encode()) > 16
               for p in langid.read_pieces()) and pieces.lengths[-1] > 16
    rng = np.random.default_rng(3)
    prob = rng.random((pieces.n, 2))
    prob /= prob.sum(0)
    texts = ["internationalization" * 2, "x" * 33, "administration" * 3 + "s", "communication" * 30]
    data, at = langid.W.string_buffers(pa.array(texts))
    words = langid.W.find_words(data, at)
    expect = np.zeros((pieces.n, 2))
    got = langid.word_scores(words, np.arange(4), pieces, prob, expect, np.ones((4, 2)))
    number = {}
    for p in langid.read_pieces():
        raw = p.text.replace("▁", " ").encode()
        if p.kind == langid.NORMAL and " " not in p.text.replace("▁", " ")[1:]:
            number.setdefault(raw, len(number))
    for b in range(256):
        number.setdefault(bytes([b]), len(number))
    for i, text in enumerate(texts):
        w = b" " + text.encode()
        total, shift = [np.ones(2)], 0.0
        for j in range(1, len(w) + 1):
            total.append(sum(total[a] * prob[number[w[a:j]]] for a in range(max(0, j - 64), j) if w[a:j] in number))
            if total[-1].max() < 1e-100:
                total, shift = [t * 1e100 for t in total], shift - np.log(1e100)
        assert np.allclose(got[i], np.log(total[-1]) + shift, rtol=1e-9)
    lens = np.array([len(p) for p in number])
    assert np.allclose(lens @ expect, sum(len(t) + 1 for t in texts))  # each byte is in one piece
