"""Skew-safe ordering helpers equal their plain-window definitions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID, rows
from eventlens.operators.ordering import global_ordinal, head_per_group


def test_head_per_group_matches_window(spark):
    df = spark.range(0, 20000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"))
    # a hot group: two thirds of all rows
    df = df.withColumn("g", F.when(F.col("g") == 2, F.lit(0)).otherwise(F.col("g")))
    got = head_per_group(df, ["g"], "o", 5000, bucket_width=700)
    w = Window.partitionBy("g").orderBy("o")
    want = df.withColumn("r", F.row_number().over(w)).where("r <= 5000").drop("r")
    assert rows(got, "g", "o") == rows(want, "g", "o")


def test_global_ordinal_matches_row_number(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3001).alias("k"), F.col("id"))
    got = global_ordinal(df, ["k", "id"], partitions=5)
    want = df.withColumn("row", F.row_number().over(Window.orderBy("k", "id")) - 1)
    assert rows(got, "k", "id", "row") == rows(want, "k", "id", "row")


def test_partition_count_invariance(spark):
    import __spark_entry__ as E
    qs = E.queries()
    names = ["dedup_first_url", "clean_articles", "pack_multidoc", "head_per_split", "sum_extractive", "ner_rank_entities"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in (1, 2, 7):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append({q: rows(qs[q](spark, SF_MID)) for q in names})
        assert results[0] == results[1] == results[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_rank_within_group_hot_group(spark):
    from eventlens.operators.ordering import rank_within_group
    n = 9000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 10 < 8, F.lit(7)).otherwise(F.col("id") % 5).alias("g"),  # 80% in one group
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise((F.col("id") * 37 % 101).cast("string")).alias("ts"),
        F.col("id").alias("ord"))
    order = [F.col("ts").asc_nulls_last(), F.col("ord").asc()]
    got = rank_within_group(df, ["g"], order, "pos")
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert rows(got, "g", "ord", "pos") == rows(want, "g", "ord", "pos")


def test_dedup_hot_url(spark):
    from eventlens.operators.clean import dedup_first_url
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("https://hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 500).cast("string"))).alias("url"),
        (F.col("id") % 7).alias("category_rank"), F.col("id").alias("ord"), (F.col("id") * 13 % 17).alias("payload"))
    got = dedup_first_url(df)
    w = Window.partitionBy("url").orderBy("category_rank", "ord")
    want = df.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    assert rows(got, "url", "ord", "payload") == rows(want, "url", "ord", "payload")
