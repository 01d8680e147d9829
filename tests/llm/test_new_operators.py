"""Operators 11 to 13 against brute force, through the operators and through their queries."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import SF_SMALL, near_texts, rows_of
from eventlens.llm import codebook, queries, simhash, squares

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    out, now = [], ""
    for c in text or "":
        if c in SPACES:
            if now:
                out.append(now)
            now = ""
        else:
            now += c
    return [*out, now] if now else out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- operator 11 --------------------------------------------------------------

def plain_fingerprint(text):
    w = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [w[i:i + 3] for i in range(len(w) - 2)] if len(w) > 2 else [w] if w else []
    h = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(prints, ids):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(least.get(find(i), x), x)
    return [least.get(find(i)) for i in range(len(prints))]


def check_components(spark, rows):
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string, fp string, id int"))
    got = sorted(((r["id"], r["fingerprint"], r["component_id"]) for r in rows_of(got)), key=str)
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    want = plain_components(prints, [r[0] for r in rows])
    assert got == sorted(((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, want)), key=str)
    return want


def test_simhash_components_match_brute_force(spark):
    r = random.Random(2)
    base = [f"W{r.randrange(900)}é" for _ in range(400)]
    near = []
    for _ in range(60):  # near copies: few words changed in a long text
        t = list(base)
        for _ in range(r.randrange(3)):
            t[r.randrange(len(t))] = f"x{r.random()}"
        near.append(" ".join(t))
    texts = near + near_texts(9, 60) + [None, "", " \n\t", "one", "one two", "ONE two", "One\x0btwo  three", "a\x1cb", "x" * 200_000, "a b " * 50_000]
    rows = [(i * 3 % 131, t, "x", i) for i, t in enumerate(texts)]
    want = check_components(spark, rows + rows[:5] + [(None, "one", "x", 1), (None, "only null ids here", "x", 1)])
    assert len(set(want)) < len(want) - 40


def test_simhash_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(empty).collect() == []
    check_components(spark, [(None, None, None, None), (5, None, None, 1), (3, " ", None, 2)])


def test_fingerprint_is_spark_xxhash(spark):
    row = spark.sql("SELECT xxhash64('ab cd ef') AS h").first()
    assert row["h"] & (2**64 - 1) == plain_fingerprint("AB cd\tef")


def test_masks_meet_every_pair_within_three_bits():
    r = random.Random(1)
    for _ in range(3000):
        bits = r.sample(range(64), 3)
        diff = sum(1 << b for b in bits)
        masks = [m for m in simhash.MASKS if not m & diff]
        assert masks
        m = r.choice(masks)
        while 64 - bin(m).count("1") > 12:  # finer masks keep the pair together
            finer = [x for x in simhash.split_mask(m) if not x & diff]
            assert finer and all(x & m == m and x != m for x in finer)
            m = r.choice(finer)


def test_large_buckets_are_split_not_dropped(spark, monkeypatch):
    r = random.Random(4)
    centre = r.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in r.sample(range(40), r.randrange(6))) for _ in range(300)}
    prints |= {r.getrandbits(64) for _ in range(50)}
    prints = sorted(prints)
    signed = [(simhash._signed(p),) for p in prints]
    want = plain_components(prints, list(range(len(prints))))
    # A small bucket in the workers: the constant is read there, so the kernel is called here as well.
    monkeypatch.setattr(simhash, "BUCKET", 16)
    import pyarrow as pa
    todo = [(simhash._signed(m), p) for m in simhash.MASKS for p in prints]
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    rounds = 0
    while todo:
        rounds += 1
        todo.sort(key=lambda x: (x[0], simhash._signed(x[1] & x[0] & simhash._ALL)))
        table = pa.table({"mask": [m for m, _ in todo], "fp": pa.array([simhash._signed(p) for _, p in todo], pa.int64())})
        todo = []
        for size in (7,):
            out = list(simhash._meet(iter(table.to_batches(max_chunksize=size))))
        for batch in out:
            for a, b, m in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "mask"))):
                if m is None:
                    a, b = a & simhash._ALL, b & simhash._ALL
                    assert bin(a ^ b).count("1") <= 64
                    root[find(a)] = find(b)
                else:
                    todo.append((m, a & simhash._ALL))
        if todo:
            t = pa.record_batch({"mask": pa.array([m for m, _ in todo]), "fp": pa.array([simhash._signed(p) for _, p in todo], pa.int64())})
            todo = [(m, p & simhash._ALL) for b in simhash._split(iter([t])) for m, p in zip(b.column("mask").to_pylist(), b.column("fp").to_pylist())]
            # Buckets of 12 free bits hold more than 16 here, so the test stops splitting there.
            if any(64 - bin(m & simhash._ALL).count("1") <= 12 for m, _ in todo):
                monkeypatch.setattr(simhash, "BUCKET", 4096)
    assert rounds > 2
    groups = lambda c: sorted(sorted(i for i in range(len(prints)) if c[i] == k) for k in set(c))
    assert groups([find(p) for p in prints]) == groups(want)
    got = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    assert all((x["a"], ) in signed and (x["b"], ) in signed for x in got)


# ---- operator 12 --------------------------------------------------------------

def plain_runs(w):
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                s = w[i:j + q]
                if not any(all(s[x] == s[x + p] for x in range(len(s) - p)) for p in range(1, q)):
                    out.add((i, j - i + q, q))
            i = j + 1
    return sorted(out)


def numbers(w):
    seq, begin = squares._numbered([[str(x).encode() for x in w]])
    return seq


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(1, 12), st.integers(0, 9))
def test_runs_match_brute_force(w, period, times):
    w = w + (w[:period] * times)[:100] + w[::-1]
    assert squares.catch_runs(numbers(w), len(w)) == plain_runs(w)


def test_runs_across_levels():
    r = random.Random(3)
    for period in (1, 2, 3, 5, 7, 8, 15, 16, 17, 31, 32, 33, 50, 63, 64, 65, 100):
        for extra in (0, 1, period - 1):
            unit = [r.randrange(10**6) for _ in range(period)]
            w = [r.randrange(10**6) for _ in range(r.randrange(70))] + (unit * 6)[:4 * period + extra] + [r.randrange(10**6) for _ in range(r.randrange(70))]
            w += w[-40:] * 5
            assert squares.catch_runs(numbers(w), len(w)) == plain_runs(w)
    w = [1] * 3000
    assert squares.catch_runs(numbers(w), len(w)) == [(0, 3000, 1)]


def test_periodic_runs_edges(spark):
    texts = [None, "", " \n ", "a", "a " * 5, "a " * 6, "a b " * 3, "a b " * 4, "é ü\x0bé\tü é  ü é\x1c ü", "x y z " * 20_000]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)] + [(1, "a " * 6, 0), (None, "a " * 6, 0)], "doc_id long, text string, runs int")
    got = rows_of(squares.periodic_runs(df))
    assert len(got) == len(texts) + 2
    for x in got:
        w = words_of(x["text"])
        if len(w) < 1000:
            assert [(r["start"], r["length"], r["period"]) for r in x["runs"]] == plain_runs(w)
        assert x["n_words"] == len(w)
    long = [x for x in got if x["doc_id"] == 9][0]
    assert [tuple(r.values()) for r in long["runs"]] == [(0, 60_000, 3)] and long["collapsed"] == "x y z"
    assert squares.periodic_runs(df.limit(0)).collect() == []


def test_periodic_runs_query(spark, tmp_path):
    r = random.Random(8)
    texts = [" ".join(r.choice("abcd") for _ in range(r.randrange(120))) for _ in range(150)] + [None, "", "a a a a a a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    planted = 0
    for x in rows_of(queries.op12_periodic_runs(spark, str(tmp_path))):
        w, h = words_of(texts[x["doc_id"]]), zlib.crc32(str(x["doc_id"]).encode())
        if h % 10 == 0 and w:
            planted += 1
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w)
        top = min(((-n, s, p) for s, n, p in runs), default=None)
        drop = {i for s, n, p in runs for i in range(s + p, s + n)}
        assert x["n_runs"] == len(runs)
        want = (top[1], -top[0], top[2], 1000 * -top[0] // top[2]) if top else (None,) * 4
        assert (x["start"], x["length"], x["period"], x["exponent_milli"]) == want
        assert x["runs_sha256"] == sha("".join(f"{s},{n},{p}\n" for s, n, p in runs))
        assert x["collapsed_sha256"] == sha(" ".join(c for i, c in enumerate(w) if i not in drop))
    assert planted > 5


# ---- operator 13 --------------------------------------------------------------

def plain_codes(rows, entries=256, rounds=4):
    """rows: (vec_id, label, vector) of kept vectors, all of one length."""
    import math
    ints = [(i, lab, [math.floor(1024 * x) for x in v]) for i, lab, v in rows]
    width = len(ints[0][2]) // 4
    part = lambda v, p: v[p * width:(p + 1) * width]
    books = [[part(v, p) for _, _, v in sorted(ints)[:entries]] for p in range(4)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((dist(part(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        at = [[near(v, p)[1] for p in range(4)] for _, _, v in ints]
        for p in range(4):
            for k in range(len(books[p])):
                own = [part(v, p) for (_, _, v), a in zip(ints, at) if a[p] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    out, total = [], {}
    for i, lab, v in ints:
        best = [near(v, p) for p in range(4)]
        e = sum(d for d, _ in best)
        total[lab] = total.get(lab, 0) + e
        out.append([i, "".join(f"{k:02x}" for _, k in best), e, lab])
    text = ",".join(str(c) for b in books for e in b for c in e)
    return [(i, c, e, total[lab], sha(text)) for i, c, e, lab in out]


@pytest.mark.parametrize("scale,dim", [(1.0, 8), (3e4, 8), (1.5e5, 4)])
def test_vector_codes_match_plain_python(spark, tmp_path, scale, dim):
    r = random.Random(6)
    rows = [(i, r.choice([None, 1, 1, 2]), [scale * r.gauss(0, 1) for _ in range(dim)]) for i in r.sample(range(5000), 420)]
    rows += [(9000 + k, 1, list(rows[k][2])) for k in range(40)]
    rows += [(10_000 + k, 2, [0.0] * dim) for k in range(3)]
    bad = [(-1, 1, None), (-2, 1, [1.0] * (dim - 1) + [None]), (-3, 1, [float("nan")] * dim), (-4, None, [float("inf")] + [0.0] * (dim - 1)),
           (-5, None, [float("-inf")] + [0.0] * (dim - 1))]
    spark.createDataFrame(rows + bad, "vec_id long, label int, embedding array<double>").repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = rows_of(queries.op13_vector_codes(spark, str(tmp_path)))
    keys = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted(tuple(x[k] for k in keys) for x in got) == sorted(plain_codes(rows))


def test_vector_codes_edges(spark):
    few = spark.createDataFrame([(None, "a", [1.0, 2.0, 3.0, 4.0, 5.0]), (3, "b", [0.5]), (3, "b", [0.5]), (1, "c", []), (2, "d", [1e300] * 5), (4, None, None)],
                                "vec_id long, code string, embedding array<double>")
    model = codebook.train(few)
    assert model.entries.shape == (4, 5, 2) and model.dim == 8
    got = rows_of(codebook.compress(few, model))
    assert len(got) == 5 and all(x["error"] == 0 and len(x["code"]) == 8 for x in got)
    assert model.decode([got[0]["code"]]).shape == (1, 8)
    none = codebook.train(few.limit(0))
    assert none.entries.shape[1] == 0 and codebook.compress(few.limit(0), none).collect() == []


def test_limb_products_are_exact():
    r = np.random.Generator(np.random.PCG64(5))
    for width, top in ((1, 2**28), (16, 2**27), (16, 1000), (200, 2**25), (3, 1)):
        x, c = r.integers(-top, top + 1, (37, width)), r.integers(-top, top + 1, (11, width))
        x[0], c[0] = -top, -top
        want = np.array([[sum(int(a) * int(b) for a, b in zip(u, v)) for v in c] for u in x])
        assert (codebook.dots(x, c) == want).all()
        bits = codebook.limb_bits(width)
        assert width * 4**bits < 2**53
        for part in codebook.limbs(x.ravel(), bits):
            assert np.abs(part).max() <= 2**bits


def test_queries_read_the_given_tables(spark):
    assert queries.op13_vector_codes(spark, SF_SMALL).count() == spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = rows_of(queries.op11_simhash_dedup(spark, SF_SMALL))
    assert len(got) == len(docs)
    ids = [x["doc_id"] for x in got]
    prints = [plain_fingerprint(docs[i]) for i in ids]
    assert [x["fingerprint"] for x in got] == [f"{p:016x}" for p in prints]
    assert [x["component_id"] for x in got] == plain_components(prints, ids)
