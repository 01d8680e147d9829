"""K1: continuous live ingest with Structured Streaming.

Landed article files are read as a stream (explicit schema).  Every micro-batch
runs the batch operators: first copies are chosen on keys (a native minimum for
each URL), URLs of earlier batches are taken out by an anti join with the keys
seen so far, and only the articles that are left are cleaned and written.  No
article text enters a Python worker or the state.

State is one row for each URL: the URL, when it came and when it may come again.
It lies in the checkpoint folder, a sub-folder for each batch, so a batch that is
run again after a failure overwrites what it wrote before and sees the same
earlier batches: each article is written once.  Every 64th batch writes all rows
that are still valid, and later batches read from there on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampType

from eventlens.operators import clean as C
from eventlens.sources.files import RAW_ARTICLE

LANDED_ARTICLE = StructType(RAW_ARTICLE.fields + [StructField("category", StringType()),
                                                  StructField("ord", LongType()),
                                                  StructField("category_rank", LongType())])
# The dedup horizon is counted from *arrival* (modification time of the landed
# file): publishedAt is often missing or empty.

#: Batches between two that write the whole state.
FULL_EVERY = 64

SEEN = StructType([StructField("url", StringType()), StructField("event_time", TimestampType()), StructField("expires", TimestampType()),
                   StructField("fresh", BooleanType()), StructField("batch", LongType())])


def land_articles(raw: DataFrame, root: str) -> str:
    """Write raw articles as JSON-lines files, one folder per category."""
    raw.write.mode("overwrite").partitionBy("category").json(root)
    return root


def live_dedup_stream(spark: SparkSession, landing: str, horizon: str = "7 days",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of landed articles with their arrival and the end of their URL's horizon.

    ``run_available_now`` keeps the first copy of each URL.
    """
    reader = spark.readStream.schema(LANDED_ARTICLE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing).withColumn("event_time", F.col("_metadata.file_modification_time")) \
                 .withColumn("expires", F.col("event_time") + F.expr(f"INTERVAL {horizon}"))


def _seen(spark: SparkSession, state: str, batch_id: int) -> DataFrame:
    """Keys of earlier batches, from the last full write on."""
    full = (batch_id // FULL_EVERY) * FULL_EVERY - 1
    return spark.read.schema(SEEN).parquet(f"{state}/seen").where((F.col("batch") < batch_id) & (F.col("batch") >= full))


def _first_copies(out: str, state: str):
    """What a micro-batch does: late rows aside, new URLs into the state, their first copies cleaned and written."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _seen(spark, state, batch_id)
        latest = seen.agg(F.max("event_time")).first()[0]
        rows = C.with_url(batch)
        if latest is not None:
            # Whether such a row is a copy can no longer be told.
            rows.where(F.col("expires") <= F.lit(latest)).write.mode("overwrite").json(f"{out}-late/batch={batch_id}")
            rows = rows.where(F.col("expires") > F.lit(latest))
        first = rows.select("url", "event_time", "expires", C.arrival_order().alias("_order")).groupBy("url").agg(
            F.min("_order").alias("_order"), F.min("event_time").alias("event_time"), F.max("expires").alias("expires"))
        known = seen.select("url", F.col("expires").alias("_until"))
        new = first.join(known, (first["url"] == known["url"]) & (known["_until"] > first["event_time"]), "left_anti")
        keys = new.select("url", "event_time", "expires", F.lit(True).alias("fresh"), "_order")
        if batch_id % FULL_EVERY == FULL_EVERY - 1:
            still = seen if latest is None else seen.where(F.col("expires") > F.lit(latest))
            keys = keys.unionByName(still.select("url", "event_time", "expires", F.lit(False).alias("fresh"), F.lit(None).cast("long").alias("_order")))
        here = f"{state}/seen/batch={batch_id}"
        keys.write.mode("overwrite").parquet(here)
        winners = spark.read.parquet(here).where("fresh").select("url", "_order")
        # Cleaning is row-wise, so it runs where the files are read; a file landed twice gives equal copies.
        flags = C.clean_flags(rows, carry=("event_time",)).withColumn("_order", C.arrival_order())
        kept = flags.join(winners, ["url", "_order"], "left_semi").where("keep").dropDuplicates(["url"])
        kept.select("ord", "event_time", *C.CLEAN_COLUMNS).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return run


def run_available_now(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process everything landed so far, then stop (``trigger(availableNow)``).

    ``out`` gets the cleaned first copies, ``out``-late the articles that came
    after their horizon, both in a sub-folder for each batch.
    """
    spark, state = stream.sparkSession, f"{checkpoint}/urls"
    empty = StructType([f for f in SEEN.fields if f.name != "batch"])
    spark.createDataFrame([], empty).withColumn("_order", F.lit(None).cast("long")).write.mode("overwrite").parquet(f"{state}/seen/batch=-1")
    none = StructType([StructField("ord", LongType()), StructField("event_time", TimestampType()),
                       *[StructField(c, t) for c, t in C.CLEAN_SCHEMA]])
    spark.createDataFrame([], none).write.mode("overwrite").parquet(f"{out}/batch=-1")
    q = (stream.writeStream.foreachBatch(_first_copies(out, state)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
