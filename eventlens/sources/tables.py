"""Driver table access: one parquet dataset per table, read lazily.

Reads go through ``spark.read.parquet`` so Catalyst prunes columns and pushes
filters into the scan; nothing here materialises data.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; expected one of {TABLES}")
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame) -> DataFrame:
    """Deal a plain scan over all cores if it comes in fewer partitions than there are.

    A file of one row group is one partition, so its text work would run in one
    task.  A table of more partitions than cores is left as it is: at scale
    nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
