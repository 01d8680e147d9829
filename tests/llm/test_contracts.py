"""The registered queries themselves, digests included, on small tables against brute force."""

import hashlib
import random
import re

from llm_helpers import near_texts, rows_of
from eventlens.llm import queries

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")


def lowered(text):
    return ALNUM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_op5_contract(spark, tmp_path):
    texts = near_texts(21, 40) + [None, "", "short item", "A short ITEM here"]
    docs = [(i if i != 3 else None, t, "en", "s", 1) for i, t in enumerate(texts)]
    items = [(f"b{i}", " ".join(PLAIN.findall(texts[i])[5:25])) for i in range(0, 12, 2)] + [("b99", "short item"), ("b98", ""), ("b97", None)]
    write(spark, tmp_path, "documents", docs, "doc_id long, text string, lang string, source string, n_chars long")
    write(spark, tmp_path, "benchmark", items, "item_id string, text string")
    got = {r["doc_id"]: r for r in rows_of(queries.op5_decontaminate(spark, str(tmp_path)))}
    assert len(got) == len(docs)
    for doc_id, text, *_ in docs:
        w, hit, found = lowered(text), set(), []
        for item, t in items:
            q = lowered(t)
            size = min(10, len(q))
            grams = {tuple(q[i:i + size]) for i in range(len(q) - size + 1)} if size else set()
            at = [i for i in range(len(w) - size + 1) if size and tuple(w[i:i + size]) in grams]
            hit |= {k for i in at for k in range(i, i + size)}
            found += [item] if at else []
        x = got[doc_id]
        assert (x["n_words"], x["n_hit"], x["n_items"], x["contaminated"]) == (len(w), len(hit), len(found), bool(hit)), doc_id
        assert x["items_sha256"] == sha(",".join(sorted(found)))


def test_op10_contract(spark, tmp_path):
    texts = near_texts(31, 40) + [None, "", "a b c", "x y " * 40, "p q r s t " * 9]
    docs = [(i * 5 % 47, t, "en", "s", 1) for i, t in enumerate(texts)]
    write(spark, tmp_path, "documents", docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in rows_of(queries.op10_substring_dedup(spark, str(tmp_path)))}
    words = {i: PLAIN.findall(t or "") for i, t, *_ in docs}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 19):
            first.setdefault(tuple(words[i][k:k + 20]), (i, k))
    for i, w in words.items():
        gone = {k + j for k in range(len(w) - 19) if first[tuple(w[k:k + 20])] != (i, k) for j in range(20)}
        x = got[i]
        assert (x["n_words"], x["n_removed"]) == (len(w), len(gone)), i
        assert x["kept_sha256"] == sha(" ".join(c for k, c in enumerate(w) if k not in gone))


def test_op9_contract(spark, tmp_path):
    r = random.Random(4)
    bits = ["</s>", "[INST]", "[/INST]", "hello ", "é𝄞", "\n", " ", "\\", "<s>"]
    rows = [(c, t, r.choice(["user", "assistant", "system"]), None if r.random() < .1 else "".join(r.choices(bits, k=r.randrange(6))))
            for c in range(30) for t in range(r.randrange(1, 7))]
    write(spark, tmp_path, "conversations", rows, "conv_id long, turn long, role string, text string")
    tricky = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    got = {x["conv_id"]: x for x in rows_of(queries.op9_chat_formatting(spark, str(tmp_path)))}
    assert set(got) == {c for c, *_ in rows}
    for c, x in got.items():
        turns = sorted((t, role, text or "") for k, t, role, text in rows if k == c)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert (x["n_turns"], x["loss_chars"], x["loss_sha256"]) == (len(turns), len(loss), sha(loss))
        assert x["turns_sha256"] == sha("".join(f"{role}\n{text}\n" for _, role, text in turns))
        assert x["formatted_chars"] >= sum(len(text) for *_, text in turns)


def test_op7_contract(spark, tmp_path):
    texts = near_texts(41, 50) + [None, "", "one two", "one two"]
    docs = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    write(spark, tmp_path, "documents", docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in rows_of(queries.op7_jaccard_join(spark, str(tmp_path)))}
    sets = []
    for t in texts:
        w = PLAIN.findall(t or "")
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    near = [[j for j in range(len(texts)) if j != i and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(texts))]
    for i in range(len(texts)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert (got[i]["n_links"], got[i]["class_id"], got[i]["class_size"]) == (len(near[i]), min(seen), len(seen)), i
