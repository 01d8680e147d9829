"""Order-dependent building blocks that stay safe under key skew.

* ``head_per_group`` keeps the first ``n`` rows per group by a unique integer
  ordinal without ever sorting a whole group in one task: it counts rows per
  (group, ordinal bucket) with a map-side combining aggregate, finds the
  bucket where the running count crosses ``n`` on that small table, and ranks
  rows only inside that one bucket (at most ``bucket_width`` rows).
* ``segmented_scan`` ranks rows and adds up a measure inside groups as a
  distributed prefix sum, so a hot group is scanned by many tasks.

Joins carry no broadcast hint unless the small side is one row for each
partition: AQE decides from the sizes it has measured.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType


def head_per_group(df: DataFrame, group_cols: list[str], ordinal: str, n, bucket_width: int = 4096,
                   n_col: str | None = None) -> DataFrame:
    """First ``n`` rows of each group in ascending ``ordinal`` order (A5).

    ``ordinal`` must be unique within a group.  ``n`` is an int, or pass
    ``n_col`` naming a column of ``df`` that holds a per-group limit.
    """
    b = F.floor(F.col(ordinal) / bucket_width).alias("_b")
    limit: Column = F.col(n_col) if n_col else F.lit(int(n))
    keys = list(group_cols)
    counts = (df.groupBy(*keys, b, limit.alias("_lim"))
              .agg(F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    kept = counts.where(F.col("_before") < F.col("_lim")).select(*keys, "_b", "_before", "_c", "_lim")
    tagged = df.withColumn("_b", F.floor(F.col(ordinal) / bucket_width))
    j = tagged.join(kept, [*keys, "_b"])
    full = F.col("_before") + F.col("_c") <= F.col("_lim")
    inner = Window.partitionBy(*keys, "_b").orderBy(ordinal)
    # Full buckets pass as they are; only the crossing bucket is ranked.
    whole = j.where(full)
    edge = (j.where(~full).withColumn("_r", F.row_number().over(inner))
            .where(F.col("_before") + F.col("_r") <= F.col("_lim")).drop("_r"))
    return whole.unionByName(edge).drop("_b", "_before", "_c", "_lim")


def _changed(column: pa.Array) -> np.ndarray:
    """For each row but the first, whether it differs from the row before; nulls equal each other."""
    now, before = column[1:], column[:-1]
    differ = pc.fill_null(pc.not_equal(now, before), False).to_numpy(zero_copy_only=False)
    return differ | (now.is_null().to_numpy(zero_copy_only=False) != before.is_null().to_numpy(zero_copy_only=False))


def _scan_partition(group_cols: list[str], sums: dict[str, str], count: str, part: str):
    """Ranks and exclusive running sums inside the groups of one sorted partition, batch by batch."""
    def run(batches):
        pid = TaskContext.get().partitionId()
        last, carry = None, {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(c) for c in group_cols]
            new = np.zeros(n, bool)
            for k in keys:
                new[1:] |= _changed(k)
            first = tuple(k[0].as_py() for k in keys)
            new[0] = last is None or first != last
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # -1: the group of the batch before goes on
            out = []
            for name, values in ((count, np.ones(n, np.int64)), *((o, batch.column(v).to_numpy()) for o, v in sums.items())):
                total = np.concatenate(([0], np.cumsum(values)))
                before = total[:-1] - np.where(start < 0, -carry.get(name, 0), total[start])
                carry[name] = int(before[-1] + values[-1])
                out.append(pa.array(before, pa.int64()))
            last = tuple(k[n - 1].as_py() for k in keys)
            yield pa.RecordBatch.from_arrays([*batch.columns, *out, pa.array(np.full(n, pid, np.int32))],
                                             [*batch.schema.names, count, *sums, part])
    return run


def segmented_scan(df: DataFrame, group_cols: list[str], order_cols: list, sums: dict[str, str] | None = None,
                   rank: str = "rank", partitions: int | None = None) -> DataFrame:
    """Add each row's 1-based ``rank`` in its group and, for ``sums`` (new column -> summed column), the sum of the rows before it.

    A distributed prefix sum: rows are range-partitioned by group and order, so
    a hot group lies over many partitions; every partition scans its rows once
    in order; the totals of a group in earlier partitions are its offset in
    later ones.  Only the first group of a partition can have an offset, so the
    offsets are one row for each partition at most and are broadcast.  No
    window ever holds a group, and each row is handled once.

    ``order_cols`` must order the rows of a group totally.  Pass keys and
    measures alone: the rows are checkpointed before and after the sort, the
    first so that sampling the ranges does not run the upstream plan again, the
    second to pin the partitions that the offsets refer to.  ``partitions``
    defaults to ``spark.sql.shuffle.partitions``; it bounds nothing but the
    number of tasks.
    """
    from eventlens.session import cut_lineage

    spark = df.sparkSession
    sums = sums or {}
    count, part = "_before", "_part"
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*[F.col(c) for c in group_cols], *[F.col(c) if isinstance(c, str) else c for c in order_cols]]
    keys = cut_lineage(df.select(*df.columns, *[F.col(v).cast("long").alias(f"_in{i}") for i, v in enumerate(sums.values())]))
    schema = StructType([*keys.schema.fields, *[StructField(c, LongType()) for c in (count, *sums)], StructField(part, IntegerType())])
    scan = _scan_partition(group_cols, {o: f"_in{i}" for i, o in enumerate(sums)}, count, part)
    local = cut_lineage(keys.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(scan, schema))
    # One row for each group and partition it touches; earlier partitions add up to the offset.
    ends = [(F.max(F.col(count)) + 1).alias(count), *[F.max(F.col(o) + F.col(f"_in{i}")).alias(o) for i, o in enumerate(sums)]]
    totals = local.groupBy(part, *group_cols).agg(*ends)
    before = Window.partitionBy(*group_cols).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(part).alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group_cols)],
                            *[F.sum(c).over(before).alias(f"_off{i}") for i, c in enumerate((count, *sums))]).where("_off0 is not null")
    same = F.col(part) == F.col("_p")
    for i, g in enumerate(group_cols):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    full = [F.col(c) + F.coalesce(F.col(f"_off{i}"), F.lit(0)) for i, c in enumerate((count, *sums))]
    return local.join(F.broadcast(offsets), same, "left").select(
        *df.columns, (full[0] + 1).cast("int").alias(rank), *[c.alias(o) for c, o in zip(full[1:], sums)])


def global_ordinal(df: DataFrame, order_cols: list, name: str = "row", partitions: int | None = None) -> DataFrame:
    """dense 0-based ids in a stated total order, computed in parallel.

    ``row_number()`` over an unpartitioned window would pull every row into
    one task.  Instead rows are range-partitioned and sorted on the key, each
    row's position inside its partition is pinned by a reliable checkpoint,
    and per-partition counts (one row per partition, a proven bound) give the
    offsets.  ``order_cols`` must form a unique key.
    """
    from eventlens.session import cut_lineage

    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    # Range partitioning samples its input before shuffling it; the checkpoint
    # keeps the upstream plan from running twice and survives a lost executor.
    s = (cut_lineage(df).repartitionByRange(n, *cols).sortWithinPartitions(*cols)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    s = cut_lineage(s)
    per = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    out = s.join(F.broadcast(per.select("_pid", "_off", "_first")), "_pid")
    return out.withColumn(name, F.col("_off") + F.col("_mid") - F.col("_first")).drop("_pid", "_mid", "_off", "_first")


def rank_within_group(df: DataFrame, group_cols: list[str], order_cols: list, name: str = "rank") -> DataFrame:
    """1-based rank inside each group, safe when one group holds most rows (see ``segmented_scan``)."""
    return segmented_scan(df, group_cols, order_cols, rank=name)
