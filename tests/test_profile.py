"""Order statistics against sorted lists."""

import random

import numpy as np
from pyspark.sql import functions as F

from eventlens.operators import profile as P


def test_positions_equal_sorted_values(spark):
    r = random.Random(2)
    rows = [("wide", r.randrange(-10**9, 10**12)) for _ in range(500)] + [("few", r.randrange(3)) for _ in range(400)]
    rows += [("one", 7)] + [("same", 5)] * 50 + [("few", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(5)
    at = {"first": lambda n: F.lit(0), "third": lambda n: F.floor(n / 3), "last": lambda n: n - 1, "beyond": lambda n: n + 5}
    got = {x["g"]: x for x in P.order_statistics(df, "v", at, ("g",)).collect()}
    assert set(got) == {"wide", "few", "one", "same"}
    for g, x in got.items():
        v = sorted(b for a, b in rows if a == g and b is not None)
        assert (x["n"], x["first"], x["third"], x["last"], x["beyond"]) == (len(v), v[0], v[len(v) // 3], v[-1], v[-1])
    assert P.order_statistics(df.limit(0), "v", at).collect() == []


def test_linear_percentiles(spark):
    r = random.Random(3)
    v = [r.randrange(5000) for _ in range(777)]
    row = P.quantile_row(spark.createDataFrame([(x,) for x in v], "v int"), "v").first()
    assert [row[c] for c in ("p25", "median", "p75", "p95")] == [int(np.percentile(v, p)) for p in (25, 50, 75, 95)]
    assert (row["min"], row["max"], row["mean"]) == (min(v), max(v), round(sum(v) / len(v), 1))


def test_no_window_over_values(spark):
    """What one task sorts is the parts of a range, 256 at most for each wanted rank."""
    df = spark.range(0, 50_000).select((F.col("id") * 7919 % 50_021).alias("v"))
    assert P.rank_profile(df, "v").first()["median"] == sorted(i * 7919 % 50_021 for i in range(50_000))[25_000]
