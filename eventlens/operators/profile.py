"""Distribution profiles: order statistics, linear percentiles, histograms.

Order statistics are found by selection over several tasks: values are counted
(one row for each distinct value, combined map-side), the value range of every
wanted rank is cut into 256 equal parts whose counts are added up, and the part
that holds the rank is cut again, until one value is left.  What is sorted in
one task is the 256 counts of a rank, never rows and never all distinct values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.session import cut_lineage

PARTS = 256


def order_statistics(df: DataFrame, value: str, positions: dict[str, Callable[[Column], Column]], group_cols: tuple = ()) -> DataFrame:
    """For each group its size ``n`` and, for each name, the value at a 0-based position of the sorted values.

    ``positions`` maps a name to a function from the size column to the position.
    Values must be integers, nulls are left out; positions are held within 0 and
    n - 1.  A table without values has no rows.  A pass narrows every range 256
    times, so values of 24 bits take three passes over the counts.
    """
    keys = list(group_cols)
    hist = cut_lineage(df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("long").alias("_v"))
                         .agg(F.count(F.lit(1)).alias("_c")))
    total = hist.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).where("_n is not null")
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.least(F.greatest(at(F.col("_n")).cast("long"), F.lit(0)), F.col("_n") - 1).alias("k"))
                       for name, at in positions.items()])
    # One row for each group and name.
    now = cut_lineage(total.select(*keys, "_n", "_lo", "_hi", F.explode(wanted).alias("w")).select(*keys, "_n", "_lo", "_hi", "w.name", "w.k"))
    w = Window.partitionBy(*keys, "name").orderBy("_part")
    while not now.where("_lo < _hi").isEmpty():
        small = now.withColumn("_step", F.expr(f"(_hi - _lo) div {PARTS} + 1"))
        j = hist.join(small, keys) if keys else hist.join(F.broadcast(small), F.lit(True))  # one row for each name
        part = j.where("_v between _lo and _hi").withColumn("_part", F.expr("(_v - _lo) div _step"))
        counts = part.groupBy(*keys, "name", "_n", "_lo", "_hi", "k", "_step", "_part").agg(F.sum("_c").alias("_c"))
        upto = counts.withColumn("_upto", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        found = upto.where((F.col("_upto") - F.col("_c") <= F.col("k")) & (F.col("k") < F.col("_upto")))
        now = cut_lineage(found.select(*keys, "_n", (F.col("_lo") + F.col("_part") * F.col("_step")).alias("_lo"),
                                       F.least(F.col("_hi"), F.col("_lo") + (F.col("_part") + 1) * F.col("_step") - 1).alias("_hi"),
                                       "name", (F.col("k") - F.col("_upto") + F.col("_c")).alias("k")))
    return now.groupBy(*keys, F.col("_n").alias("n")).agg(*[F.max(F.when(F.col("name") == name, F.col("_lo"))).alias(name) for name in positions])


def _nearest(num: int, den: int) -> Callable[[Column], Column]:
    """Position ``num * n // den``."""
    return lambda n: F.floor(n * num / den)


def _linear(fractions: dict[str, float]) -> dict[str, Callable[[Column], Column]]:
    """Positions below and above ``fraction * (n - 1)``."""
    out = {}
    for name, p in fractions.items():
        out[f"{name}_lo"] = lambda n, p=p: F.floor(F.lit(p) * (n - 1))
        out[f"{name}_hi"] = lambda n, p=p: F.ceil(F.lit(p) * (n - 1))
    return out


def _between(name: str, p: float) -> Column:
    """The value at ``p * (n - 1)``, linear between its neighbours."""
    at = F.lit(p) * (F.col("n") - 1)
    lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
    return F.when(F.floor(at) == F.ceil(at), lo.cast("double")).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi)


def rank_profile(df: DataFrame, value: str) -> DataFrame:
    """Min, ``sorted[n//4]``, ``sorted[n//2]``, ``sorted[3n//4]``, max."""
    kind = df.schema[value].dataType
    names = {"min": _nearest(0, 1), "p25": _nearest(1, 4), "median": _nearest(1, 2), "p75": _nearest(3, 4), "max": lambda n: n - 1}
    return order_statistics(df, value, names).select(*[F.col(c).cast(kind).alias(c) for c in names])


def grouped_rank_stats(long_df: DataFrame, group: str, value: str) -> DataFrame:
    """E5: per group min / max / mean (1 dp) / ``sorted[n//2]`` of ``value``."""
    med = order_statistics(long_df, value, {"median": _nearest(1, 2)}, (group,))
    base = long_df.groupBy(group).agg(
        F.min(value).alias("min"), F.max(value).alias("max"),
        F.round(F.avg(value), 1).alias("mean"))
    return base.join(med, group).select(group, "min", "max", "mean", "median")


def quantile_row(df: DataFrame, value: str) -> DataFrame:
    """Min / p25 / median / p75 / p95 (linear, truncated) / max / mean."""
    wanted = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}
    base = df.agg(F.min(value).alias("min"), F.max(value).alias("max"), F.round(F.avg(value), 1).alias("mean"))
    q = order_statistics(df, value, _linear(wanted))
    r = base.join(F.broadcast(q), F.lit(True), "left")  # one row
    return r.select(F.col("min").cast("int").alias("min"), *[_between(c, p).cast("int").alias(c) for c, p in wanted.items()],
                    F.col("max").cast("int").alias("max"), "mean")


def length_percentiles(long_df: DataFrame, field: str = "field", value: str = "words",
                       pcts=(50, 75, 90, 95, 99)) -> DataFrame:
    """Per field min, mean (1 dp), max and linear p50..p99 truncated to int."""
    wanted = {f"p{p}": p / 100 for p in pcts}
    base = long_df.groupBy(field).agg(F.min(value).cast("int").alias("min"), F.round(F.avg(value), 1).alias("mean"), F.max(value).cast("int").alias("max"))
    q = order_statistics(long_df, value, _linear(wanted), (field,))
    return base.join(q, field).select(field, "min", "mean", "max", *[_between(c, p).cast("int").alias(c) for c, p in wanted.items()])


def clipped_histogram(df: DataFrame, value: str, bins: int, clip_hi: float | None = None) -> DataFrame:
    """Equal-width histogram over the data range after clipping.

    Bin edges span min..max of the clipped data; the last bin is closed on
    the right.  A constant column uses the range (v - 0.5, v + 0.5).
    """
    x = F.col(value).cast("double")
    if clip_hi is not None:
        x = F.least(x, F.lit(float(clip_hi)))
    v = df.select(x.alias("_x")).where(F.col("_x").isNotNull())
    rng = v.agg(F.min("_x").alias("_lo0"), F.max("_x").alias("_hi0"))
    rng = rng.select(
        F.when(F.col("_lo0") == F.col("_hi0"), F.col("_lo0") - 0.5).otherwise(F.col("_lo0")).alias("_lo"),
        F.when(F.col("_lo0") == F.col("_hi0"), F.col("_hi0") + 0.5).otherwise(F.col("_hi0")).alias("_hi"))
    j = v.join(F.broadcast(rng), how="inner", on=F.lit(True))  # one-row range, bounded
    idx = F.floor((F.col("_x") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))).cast("int")
    idx = F.least(idx, F.lit(bins - 1))
    width = (F.col("_hi") - F.col("_lo")) / bins
    out = j.groupBy(idx.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    return out.select("bin", F.round(F.col("_lo") + F.col("bin") * width, 6).alias("bin_lo"),
                      F.round(F.col("_lo") + (F.col("bin") + 1) * width, 6).alias("bin_hi"), "n")


def value_distribution(df: DataFrame, value: str) -> DataFrame:
    """How many rows take each value, ascending by value."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(value)


def unpivot_counts(df: DataFrame, id_col: str, fields: dict[str, Column]) -> DataFrame:
    """Long form ``(id, field, words)`` for several per-row measures."""
    parts = [F.struct(F.lit(k).alias("field"), v.cast("long").alias("words")) for k, v in fields.items()]
    return df.select(id_col, F.explode(F.array(*parts)).alias("_m")).select(id_col, "_m.field", "_m.words")
