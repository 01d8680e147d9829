"""Shared by the tests of this folder."""

import random

SF_SMALL = "/root/testdata/sf0.001"


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def near_texts(seed, n=40, words=80, vocab=400):
    """Random texts with copies, near copies, shared passages and odd separators."""
    r = random.Random(seed)
    word = lambda: r.choice("the of and in".split()) if r.random() < .3 else f"w{r.randrange(vocab)}é"
    base = [[word() for _ in range(words)] for _ in range(6)]
    out = []
    for _ in range(n):
        k = r.random()
        if k < .2:
            t = list(r.choice(base))
        elif k < .5:
            t = list(r.choice(base))
            for _ in range(r.randrange(1, 4)):
                t[r.randrange(len(t))] = word()
        elif k < .7:
            b, a = r.choice(base), r.randrange(20)
            t = [word() for _ in range(r.randrange(30))] + b[a:a + r.randrange(15, 60)] + [word() for _ in range(r.randrange(30))]
        elif k < .8:
            t = r.choice(base)[:15] * r.randrange(1, 9)
        else:
            t = [word() for _ in range(r.randrange(0, 2 * words))]
        out.append(r.choice(["", " ", "\n"]) + "".join(w + r.choice([" ", " ", " ", "\n", "  ", "\t"]) for w in t))
    return out
